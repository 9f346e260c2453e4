"""Language identification with error-correcting output codes.

Every language has a codeword; one linear classifier per code position tells
from byte n-grams whether the position is +1 or -1. The languages' losses
against a text's margins, weighted by how well each position was predicted
when left out of training, give the nearest codeword. A text whose nearest
codewords are almost equally near is flagged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roost.llm.batches import ready_workers, slices


UNKNOWN = "und"


@dataclass(frozen=True)
class LangIdParams:
    """``sample_rows`` bounds the labelled rows that the classifiers are fitted on.

    Many languages share them equally, but each has at least ``least_rows``.
    """

    sample_rows: int = 2000
    least_rows: int = 4
    pair_buckets: int = 4096
    triple_buckets: int = 8192
    ridge: float = 0.02
    ambiguous_below: float = 0.6
    sharpness: float = 6.0
    seed: int = 7


@dataclass(frozen=True)
class LangIdModel:
    languages: list[str]
    code: np.ndarray  # languages x positions, +1 / -1
    weights: np.ndarray  # features x positions
    bias: np.ndarray
    trust: np.ndarray  # weight of each position in decoding


def codebook(n: int, seed: int) -> np.ndarray:
    """Codewords of n languages: all distinct splits for a few, well separated random ones for many."""
    if n < 2:
        return np.zeros((n, 0))
    if n <= 6:
        splits = [s for s in product((1, -1), repeat=n) if s[0] == 1 and -1 in s]
        return np.array(splits, dtype=np.float64).T
    length = int(np.ceil(10 * np.log2(n)))
    rng = np.random.default_rng(seed)
    best, far = None, -1
    for _ in range(50):
        code = rng.choice((-1.0, 1.0), size=(n, length))
        apart = (length - code @ code.T) / 2 + length * np.eye(n)
        split = np.abs(code.sum(axis=0)).max() < n
        if split and apart.min() > far:
            best, far = code, apart.min()
    return best


def features(raw: bytes, params: LangIdParams) -> np.ndarray:
    """Square roots of n-gram shares: a vector of length one per n-gram size, whatever the text's length."""
    b = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    out = []
    pairs = b[:-1] << np.uint32(8) | b[1:]
    grams = [(pairs, params.pair_buckets)]
    if len(b) > 2:
        grams.append((pairs[:-1] << np.uint32(8) | b[2:], params.triple_buckets))
    for gram, buckets in grams:
        place = (gram * np.uint32(2654435761)) >> np.uint32(32 - int(np.log2(buckets)))
        counts = np.bincount(place, minlength=buckets).astype(np.float32)
        out.append(np.sqrt(counts / max(1, len(gram))))
    if len(grams) == 1:
        out.append(np.zeros(params.triple_buckets, dtype=np.float32))
    return np.concatenate(out)


def prepared(text: str) -> bytes:
    """Lower case, with a blank at either end so that short words have edges."""
    return f" {text.lower()} ".encode("utf-8", "replace")


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def fit(docs: DataFrame, learn: Column, params: LangIdParams = LangIdParams()) -> LangIdModel:
    """Fit on about ``sample_rows`` rows where ``learn`` holds, as many of each language as there are.

    Rows without a language or a letter teach nothing. Which rows are taken
    follows from a hash of doc_id and text, not from their place; rows that
    repeat both count once. Every language has at least the row of its
    smallest hash; all languages are learned, however many.
    """
    usable = docs.where(learn & F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(params.seed), F.col("text")), F.lit(1 << 30)) / float(1 << 30)
    usable = usable.select("lang", "text", draw.alias("_draw"))
    # One row a language: its number of rows and smallest hash.
    counted = usable.groupBy("lang").agg(F.count("*").alias("n"), F.min("_draw").alias("least")).collect()
    sizes = {r["lang"]: r for r in sorted(counted, key=lambda r: r["lang"])}
    languages = list(sizes)
    width = params.pair_buckets + params.triple_buckets
    if not languages:
        return LangIdModel([], np.zeros((0, 0)), np.zeros((width, 0)), np.zeros(0), np.zeros(0))
    each = max(params.sample_rows / len(languages), params.least_rows)
    most = [(k, max(min(1.0, each / r["n"]), r["least"])) for k, r in sizes.items()]
    # Broadcast bound: one row a language.
    shares = F.broadcast(docs.sparkSession.createDataFrame(most, "lang string, _share double"))
    drawn = usable.join(shares, "lang").where(F.col("_draw") <= F.col("_share"))
    sample = drawn.groupBy("lang", "_draw").agg(F.min("text").alias("text")).select("lang", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [
                features(prepared(t), params).astype(np.float16).tobytes() for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(packed, pa.binary())], ["lang", "x"])

    ready_workers(docs.sparkSession)
    rows = sample.mapInArrow(vectors, "lang string, x binary").collect()
    # A hash of doc_id orders no rows here: sorting makes the sums the same however tasks end.
    rows.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    place = {lang: i for i, lang in enumerate(languages)}
    label = np.array([place[r["lang"]] for r in rows])
    x = np.stack([np.frombuffer(r["x"], dtype=np.float16).astype(np.float32) for r in rows])
    return solve(languages, x, label, params)


def solve(languages: list[str], x: np.ndarray, label: np.ndarray, params: LangIdParams) -> LangIdModel:
    """Ridge classifiers for all positions at once, each row weighted for equal languages."""
    code = codebook(len(languages), params.seed)
    y = code[label]
    middle = x.mean(axis=0)
    centred = x - middle
    kernel = (centred @ centred.T).astype(np.float64)
    sizes = np.bincount(label, minlength=len(languages))
    per_row = (len(label) / (len(languages) * np.maximum(sizes, 1)))[label]
    # Rows of rare languages get less ridge: the same as weighing them more.
    inverse = np.linalg.inv(kernel + np.diag(params.ridge * len(label) / per_row / 100 + 1e-9) + 1.0)
    alpha = inverse @ y
    weights = centred.T.astype(np.float64) @ alpha
    bias = alpha.sum(axis=0) - middle @ weights
    left_out = y - alpha / np.diag(inverse)[:, None]
    right = ((left_out * y) > 0).mean(axis=0) if len(label) else np.zeros(code.shape[1])
    trust = np.maximum(right - 0.5, 1e-3)
    return LangIdModel(languages, code, weights.astype(np.float32), bias, trust / trust.sum() if trust.size else trust)


def decode(margins: np.ndarray, model: LangIdModel, params: LangIdParams) -> tuple[np.ndarray, np.ndarray]:
    """(best language, its share of the softmax of minus the weighted losses) for rows of margins."""
    agree = margins[:, None, :] * model.code[None, :, :]
    losses = (np.log1p(np.exp(-2 * np.clip(agree, -8, 8))) * model.trust).sum(axis=2)
    near = np.exp(-params.sharpness * (losses - losses.min(axis=1, keepdims=True)))
    best = losses.argmin(axis=1)
    return best, near[np.arange(len(best)), best] / near.sum(axis=1)


def predict(docs: DataFrame, model: LangIdModel, params: LangIdParams = LangIdParams()) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous), one row per document, from whole texts alone.

    Null text or no letter: ``und`` with score 0. Without any learned language
    everything is ``und``; with one, that one is certain. Of equally near
    codewords the language first in the alphabet wins. Repeated rows are
    answered one by one; whole texts are read, however long.
    """
    ready_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for whole in batches for p in slices(whole, "text")):
            texts = batch.column("text").to_pylist()
            known = [i for i, t in enumerate(texts) if model.languages and has_letter(t)]
            lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            for k in range(0, len(known), 256):
                part = known[k : k + 256]
                x = np.stack([features(prepared(texts[i]), params) for i in part])
                best, sure = decode(x @ model.weights + model.bias, model, params)
                for i, b, s in zip(part, best, sure, strict=True):
                    lang[i], score[i] = model.languages[b], float(s)
            unsure = [lang[i] != UNKNOWN and score[i] < params.ambiguous_below for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())],
                ["doc_id", "lang_pred", "score", "ambiguous"],
            )

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, lang_pred string, score double, ambiguous boolean")


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text is a multiple of five."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def identify_languages(docs: DataFrame, params: LangIdParams = LangIdParams()) -> DataFrame:
    """Learn from the rows that are not held out and predict every row.

    Returns doc_id, held_out, lang_pred, score, ambiguous. A row without
    doc_id is not held out, and not learned from either.
    """
    model = fit(docs, ~held_out(F.col("doc_id")), params)
    return predict(docs, model, params).select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        "ambiguous",
    )
