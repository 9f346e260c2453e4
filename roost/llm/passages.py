"""Passages that repeat across documents, by seed and extend.

Seeds are winnowed anchors: of every window of ``words`` words the smallest of
its shorter word sequences, by hash (the last of equal ones). Equal windows have
equal anchors at equal places, so no repeat is missed, and a document has about
one anchor in sixteen words. The windows that share an anchor lie side by side
and together span it.

1. Occurrences are joined on the anchor. Those with equal spans are one class:
   its repeats are maximal at once, and the class is told by its smallest
   document and the largest one.
2. Where an anchor has several classes, their spans agree around it only for
   some words to the left and right. One occurrence a class is extended there,
   step by step in both directions: each step is one window, and those that a
   smaller document also reaches are kept.
3. What is left of an occurrence, all of it or some windows, is removed from
   its document; neighbouring and overlapping repeats grow together.

Nothing is compared pair by pair: classes and steps are grouped by hash. An
anchor, span or window hash has 64 bits; two texts are taken for the same if
an anchor and a span or window agree, with probability 2^-128 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roost.llm.batches import ready_workers, slices
from roost.operators.skew import split_hot
from roost.sources.stage import discard, stage


@dataclass(frozen=True)
class PassageParams:
    """Repeats of at least ``words`` words; anchors of ``anchor_words`` words."""

    words: int = 50
    anchor_words: int = 20


STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of two sequences in a row; mixed once more, as equal steps would cancel each other in an outer join."""
    return mixed(mixed(left + STEP) ^ right)


def sequences(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n consecutive words, from hashes of 1, 2, 4... consecutive ones."""
    total = len(words) - n + 1
    if total <= 0:
        return np.zeros(0, dtype=np.uint64)
    out, done, power, size = None, 0, words, 1
    while True:
        if n & size:
            part = power[done : done + total]
            out = part if out is None else joined(out, part)
            done += size
        if 2 * size > n:
            return out
        power = joined(power[: len(power) - size], power[size:])
        size *= 2


def last_smallest(values: np.ndarray, n: int) -> np.ndarray:
    """For all n consecutive values, the place of the last smallest one."""
    place = np.arange(len(values))
    size = 1
    while size < n:
        step = min(size, n - size)
        left, right = place[: len(place) - step], place[step:]
        place = np.where(values[right] <= values[left], right, left)
        size += step
    return place


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of all texts in a row, where each text starts and the last one ends)"""
    split = [t.split() for t in texts]
    starts = np.cumsum([0, *map(len, split)])
    flat = (xxhash.xxh3_64_intdigest(w) for words in split for w in words)
    return np.fromiter(flat, dtype=np.uint64, count=int(starts[-1])), starts


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def anchor_rows(texts: list[bytes], params: PassageParams) -> tuple[np.ndarray, ...]:
    """(text number, anchor, span, first, last): the windows first..last of a text share an anchor."""
    words, starts = hashed_words(texts)
    none = np.zeros(0, dtype=np.int64)
    if len(words) < params.words:
        return none, none, none, none, none
    windows = sequences(words, params.words)
    grams = sequences(words, params.anchor_words)
    owner = last_smallest(signed(grams), params.words - params.anchor_words + 1)
    text = np.repeat(np.arange(len(texts)), np.diff(starts))[: len(windows)]
    # Windows that lie in one text; an anchor's windows lie side by side.
    inside = np.flatnonzero(np.arange(len(windows)) + params.words <= starts[text + 1])
    if not len(inside):
        return none, none, none, none, none
    cut = np.flatnonzero((np.diff(owner[inside]) != 0) | (np.diff(text[inside]) != 0))
    first, last = inside[np.append(0, cut + 1)], inside[np.append(cut, len(inside) - 1)]
    at = owner[first]
    shape = (at - first).astype(np.uint64) << np.uint64(32) | (last - first).astype(np.uint64)
    span = joined(joined(windows[first], windows[last]), shape)
    base = starts[text[first]]
    return text[first], signed(grams[at]), signed(span), first - base, last - base


def arrow_lists(column: pa.Array) -> list[bytes]:
    return [v.as_py() or b"" for v in column]


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, body, raw): documents with an id; equal rows are told apart from others of their id by ``body``."""
    raw = F.col("text").cast("string").cast("binary")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.coalesce(raw, F.lit(b""))).alias("body"),
        F.coalesce(raw, F.lit(b"")).alias("raw"),
    )


def anchors(docs: DataFrame, params: PassageParams) -> DataFrame:
    """(anchor, span, doc_id, body, first, last) of every anchor of every document that has an id."""
    ready_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, "raw")):
            text, *columns = anchor_rows(arrow_lists(part.column("raw")), params)
            at = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [
                    *map(pa.array, columns[:2]),
                    part.column("doc_id").take(at),
                    part.column("body").take(at),
                    *(pa.array(c, pa.int64()).cast(pa.int32()) for c in columns[2:]),
                ],
                ["anchor", "span", "doc_id", "body", "first", "last"],
            )

    rows = identified(docs).where("doc_id IS NOT NULL")
    return rows.mapInArrow(run, "anchor bigint, span bigint, doc_id bigint, body bigint, first int, last int")


def window_rows(docs: DataFrame, wanted: DataFrame, params: PassageParams) -> DataFrame:
    """(anchor, span, step, seen, doc_id): the hash of every window of the wanted spans (doc_id, body, anchor, span, first, last)."""
    spans = wanted.groupBy("doc_id", "body").agg(F.collect_list(F.struct("anchor", "span", "first", "last")).alias("spans"))
    texts = identified(docs).join(spans, ["doc_id", "body"]).select("doc_id", "raw", "spans")
    names = ("anchor", "span", "first", "last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, "raw")):
            for doc_id, raw, spans in zip(part.column("doc_id"), part.column("raw"), part.column("spans"), strict=True):
                windows = sequences(hashed_words([raw.as_py()])[0], params.words)
                anchor, span, first, last = (spans.values.field(n).to_numpy() for n in names)
                n = last - first + 1
                before = np.repeat(np.cumsum(n) - n, n)
                step = np.arange(n.sum()) - before
                seen = signed(windows[np.repeat(first, n) + step])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(anchor, n)),
                        pa.array(np.repeat(span, n)),
                        pa.array(step.astype(np.int32)),
                        pa.array(seen),
                        pa.array([doc_id.as_py()] * len(seen), pa.int64()),
                    ],
                    ["anchor", "span", "step", "seen", "doc_id"],
                )

    return texts.mapInArrow(run, "anchor bigint, span bigint, step int, seen bigint, doc_id bigint")


def with_facts(rows: DataFrame, facts: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """``rows`` joined with one fact a key. Rows of the few hot values of the last key get theirs by broadcast."""
    ordinary, crowded = split_hot(rows, keys[-1], hot)
    few = facts.join(F.broadcast(hot), keys[-1], "left_semi")
    return ordinary.join(facts, keys).unionByName(crowded.join(F.broadcast(few), keys))


def share(rows: DataFrame) -> int:
    """How many rows of one key are more than a task's due: at most four keys a partition exceed it."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1000, rows.count() // (4 * tasks))


def repeats(docs: DataFrame, params: PassageParams) -> DataFrame:
    """(doc_id, body, first, last, steps): spans to remove; with ``steps`` only the windows at these places of them."""
    found = stage(anchors(docs, params), "passage-anchors")
    classes = stage(
        found.groupBy("anchor", "span").agg(
            F.count("*").alias("n"),
            F.min(F.struct("doc_id", "body", "first", "last")).alias("least"),
            F.max("doc_id").alias("most"),
        ),
        "passage-classes",
    )
    # Anchors whose classes start in different documents: their spans agree in part at most.
    rivals = (
        classes.groupBy("anchor")
        .agg(F.min("least.doc_id").alias("a"), F.max("least.doc_id").alias("b"))
        .where("a < b")
        .select("anchor")
    )
    wanted = classes.join(rivals, "anchor").select("anchor", "span", "least.*")
    steps = stage(window_rows(docs, wanted, params), "passage-windows")
    windows = stage(
        steps.groupBy("anchor", "seen")
        .agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .where("low < high"),
        "passage-window-classes",
    )
    crowded = windows.where(F.col("n") > share(steps)).select("seen").distinct()
    later = with_facts(steps, windows.select("anchor", "seen", "low"), ["anchor", "seen"], crowded)
    partly = later.where("doc_id > low").groupBy("anchor", "span").agg(F.collect_set("step").alias("steps"))
    decided = stage(
        classes.join(partly, ["anchor", "span"], "left")
        .where("least.doc_id < most OR steps IS NOT NULL")
        .select("anchor", "span", F.col("least.doc_id").alias("low"), "steps", "n"),
        "passage-decided",
    )
    crowded = decided.where(F.col("n") > share(found)).select("span").distinct()
    marked = with_facts(found, decided.drop("n"), ["anchor", "span"], crowded)
    whole: Column = F.col("doc_id") > F.col("low")
    out = marked.where(whole | F.col("steps").isNotNull()).select(
        "doc_id", "body", "first", "last", F.when(~whole, F.col("steps")).alias("steps")
    )
    out = stage(out, "passage-repeats")
    discard(found, classes, steps, windows, decided)
    return out


def remove_repeats(docs: DataFrame, params: PassageParams = PassageParams()) -> DataFrame:
    """(doc_id, n_words, removed array<struct<start, length>>, kept), one row per input row.

    Each word is removed that a window of ``words`` consecutive words covers
    whose word sequence also starts in a document of smaller doc_id; windows
    are judged on the input. ``removed`` lists stretches of word numbers from
    0, ``kept`` joins the other words by one space. Words end at ASCII white
    space and are compared as they are. Null, empty and shorter texts have no
    window. A document without an id is neither smaller nor larger than others:
    it keeps its words and takes none. Rows that repeat an id are one document
    to each other and take nothing from one another. An empty table gives an
    empty one; other columns are ignored, whatever their names.
    """
    ready_workers(docs.sparkSession)
    found = repeats(docs, params)
    per_doc = found.groupBy("doc_id", "body").agg(F.collect_list(F.struct("first", "last", "steps")).alias("spans"))
    rows = identified(docs).join(per_doc, ["doc_id", "body"], "left").select("doc_id", "raw", "spans")
    size = params.words
    stretch = pa.struct([("start", pa.int64()), ("length", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, "raw")):
            counts, removed, texts = [], [], []
            for raw, spans in zip(part.column("raw"), part.column("spans"), strict=True):
                words = raw.as_py().split()
                gone = covered(len(words), spans.as_py() or [], size)
                edges = np.flatnonzero(np.diff(gone, prepend=False, append=False))
                pairs = zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)
                counts.append(len(words))
                removed.append([{"start": a, "length": b - a} for a, b in pairs])
                texts.append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.list_(stretch)),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "removed", "kept"],
            )

    schema = "doc_id bigint, n_words bigint, removed array<struct<start: bigint, length: bigint>>, kept string"
    return rows.mapInArrow(run, schema)


def covered(n: int, spans: list[dict], size: int) -> np.ndarray:
    """Which of n words the windows of these spans cover."""
    change = np.zeros(n + 1, dtype=np.int64)
    for s in spans:
        starts = [(s["first"], s["last"])] if s["steps"] is None else [(s["first"] + k,) * 2 for k in s["steps"]]
        for first, last in starts:
            change[first] += 1
            change[last + size] -= 1
    return np.cumsum(change[:n]) > 0


def passage_digests(docs: DataFrame, params: PassageParams = PassageParams()) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), one row per document."""
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda a, s: a + s["length"])
    return remove_repeats(docs, params).select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )
