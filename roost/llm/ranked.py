"""Ranked lexical search by the best position algorithm.

The documents are read once, in shards of bounded text. A shard keeps, for the
terms that the queries name, its documents and their counts: a row of the
index. Collection counts come from the index. Then every shard answers every
query by itself: a term's documents in order of falling impact are its list;
lists are read side by side, and each document met is looked up at once in all
other lists (direct access), which also marks its positions there as seen. The
best position of a list is the last one before which all are seen; no unseen
document can score more than the impacts at the best positions add up to. Once
the k-th score found lies strictly above that sum, the shard is done: ties
included, no unseen document belongs to its k best. The best of all shards'
best are the answer.

Queries come in blocks of bounded numbers of terms, so what is sent to the
tasks does not grow with them; more queries mean more blocks.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roost.llm.batches import ready_workers, slices
from roost.sources.stage import stage


@dataclass(frozen=True)
class RankParams:
    """The ``k`` best; shards of about ``shard_bytes`` of text; blocks of about ``block_terms`` query terms."""

    k: int = 20
    shard_bytes: int = 16_000_000
    block_terms: int = 200_000


# Bytes of ASCII that end a term; all others, those of other characters included, belong to terms.
TERM_BYTES = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz")
SEPARATE = bytes(b if b >= 0x80 or b in TERM_BYTES else 0x20 for b in range(256))
LAST_ID = 2**63 - 1

INDEX = pa.schema(
    [
        ("docs", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int64())),
        ("with_terms", pa.int64()),
        ("terms", pa.list_(pa.int32())),
        ("ends", pa.list_(pa.int32())),
        ("held_by", pa.list_(pa.int32())),
        ("times", pa.list_(pa.int32())),
    ]
)
INDEX_DDL = (
    "docs array<bigint>, sizes array<bigint>, with_terms bigint, "
    "terms array<int>, ends array<int>, held_by array<int>, times array<int>"
)


def terms_of(raw: bytes | None) -> list[bytes]:
    """Terms of a whole text given as UTF-8, in order; only A-Z are lower-cased."""
    return (raw or b"").lower().translate(SEPARATE).split()


def weight(n_docs: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders + 1)))


@dataclass(frozen=True)
class Block:
    """Some queries: item ids, and the numbers of their terms with repeats, by place in ``vocabulary``."""

    items: list
    wanted: list[dict[int, int]]
    vocabulary: dict[bytes, int]


def query_blocks(queries: DataFrame, params: RankParams) -> Iterator[Block]:
    """The queries in blocks, by a hash of their rows: only one block is on the driver at a time."""
    raw = queries.select("item_id", F.col("text").cast("string").cast("binary").alias("raw"))
    # A term has at least one byte and one separator, so bytes / 2 bounds the number of terms.
    size = raw.agg(F.sum(F.length("raw"))).first()[0] or 0
    n = max(1, -(-size // (2 * params.block_terms)))
    for i in range(n):
        part = raw if n == 1 else raw.where(F.pmod(F.xxhash64("item_id", "raw"), F.lit(n)) == i)
        items, wanted, vocabulary = [], [], {}
        for row in part.toLocalIterator():
            counts = Counter(terms_of(row["raw"] and bytes(row["raw"])))
            if counts:
                items.append(row["item_id"])
                wanted.append({vocabulary.setdefault(t, len(vocabulary)): c for t, c in counts.items()})
        if items:
            yield Block(items, wanted, vocabulary)


class Shard:
    """Documents whose counts of query terms are gathered until they fill an index row."""

    def __init__(self, vocabulary: dict[bytes, int]) -> None:
        self.number = vocabulary.get
        self.docs, self.sizes, self.bytes = [], [], 0
        self.at, self.terms = [], []

    def add(self, doc_id: int | None, raw: bytes | None) -> None:
        words = terms_of(raw)
        found = [t for t in map(self.number, words) if t is not None]
        self.at.append(np.full(len(found), len(self.docs), dtype=np.int64))
        self.terms.append(np.array(found, dtype=np.int64))
        self.docs.append(doc_id)
        self.sizes.append(len(words))
        self.bytes += len(raw or b"")

    def row(self) -> pa.RecordBatch:
        n = max(1, len(self.docs))
        keys, times = np.unique(np.concatenate(self.terms) * n + np.concatenate(self.at), return_counts=True)
        terms, first = np.unique(keys // n, return_index=True)
        ends = np.append(first[1:], len(keys))[: len(terms)]
        values = (self.docs, self.sizes, sum(s > 0 for s in self.sizes), terms, ends, keys % n, times)
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(values, INDEX, strict=True)], schema=INDEX
        )


def index_documents(docs: DataFrame, vocabulary: dict[bytes, int], params: RankParams) -> DataFrame:
    """One row per shard: its documents and, term by term, which of them hold the term how often."""
    ready_workers(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    most = params.shard_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(shared.value)
        for part in (p for batch in batches for p in slices(batch, "raw")):
            for doc_id, raw in zip(part.column("doc_id"), part.column("raw"), strict=True):
                shard.add(doc_id.as_py(), raw.as_py())
                if shard.bytes >= most or len(shard.docs) >= most // 64:
                    yield shard.row()
                    shard = Shard(shared.value)
        if shard.docs:
            yield shard.row()

    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("raw")
    )
    return narrow.mapInArrow(run, INDEX_DDL)


class ImpactList:
    """A term's documents in one shard, by falling impact, with direct access by document."""

    def __init__(self, docs: np.ndarray, impacts: np.ndarray) -> None:
        self.docs, self.impacts = docs, impacts
        self.order = np.argsort(-impacts, kind="stable")
        self.position = np.empty(len(docs), dtype=np.int64)
        self.position[self.order] = np.arange(len(docs))

    def read(self, start: int, stop: int) -> np.ndarray:
        return self.docs[self.order[start:stop]]

    def look_up(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the wanted documents are here, their places)"""
        at = np.searchsorted(self.docs, wanted)
        at[at == len(self.docs)] = 0
        here = np.flatnonzero(self.docs[at] == wanted)
        return here, at[here]


def best_documents(lists: list[tuple[ImpactList, int]], ids: np.ndarray, k: int) -> tuple[list[tuple[int, int]], int]:
    """((score, document) of the k best, highest first, ties by id, and how many documents were looked up).

    ``lists`` come with the number of times that the query names their term.
    Documents whose score is 0 are not returned.
    """
    seen = [np.zeros(len(one.docs) + 1, dtype=bool) for one, _ in lists]
    best_position = [0] * len(lists)
    known = np.zeros(0, dtype=np.int64)
    scores = np.zeros(0, dtype=np.int64)
    looked, depth, step = 0, 0, k
    met = np.zeros(len(ids), dtype=bool)
    while True:
        new = np.unique(np.concatenate([one.read(depth, depth + step) for one, _ in lists]))
        new = new[~met[new]]
        met[new] = True
        looked += len(new)
        total = np.zeros(len(new), dtype=np.int64)
        for (one, times), marks in zip(lists, seen, strict=True):
            here, at = one.look_up(new)
            total[here] += times * one.impacts[at]
            marks[one.position[at]] = True
        known, scores = np.append(known, new), np.append(scores, total)
        order = np.lexsort((ids[known], -scores))[:k]
        known, scores = known[order], scores[order]
        bound = 0
        for i, ((one, times), marks) in enumerate(zip(lists, seen, strict=True)):
            # The mark behind the list's end is never set.
            best_position[i] += int(np.argmin(marks[best_position[i] :]))
            if best_position[i] < len(one.docs):
                bound += times * int(one.impacts[one.order[max(0, best_position[i] - 1)]])
        depth += step
        step *= 2
        exhausted = all(depth >= len(one.docs) for one, _ in lists)
        if exhausted or (len(scores) == k and int(scores[-1]) > bound):
            return [(s, d) for s, d in zip(scores.tolist(), known.tolist(), strict=True) if s > 0], looked


def shard_answers(row: dict, block: Block, weights: list[int], n_docs: int, n_terms: int, k: int) -> list[tuple]:
    """(query, document id, score) of the k best documents of one shard for every query of the block."""
    ids = np.array([LAST_ID if d is None else d for d in row["docs"]], dtype=np.int64)
    length = 75 + (25 * row["sizes"] * n_docs) // n_terms
    lists: dict[int, ImpactList] = {}
    start = 0
    for term, end in zip(row["terms"].tolist(), row["ends"].tolist(), strict=True):
        docs, times = row["held_by"][start:end], row["times"][start:end].astype(np.int64)
        impacts = weights[term] * ((1_000_000_000 * times) // (1000 * times + 12 * length[docs]))
        lists[term] = ImpactList(docs, impacts)
        start = end
    out = []
    for q, wanted in enumerate(block.wanted):
        chosen = [(lists[t], c) for t, c in wanted.items() if t in lists]
        if chosen:
            found, _ = best_documents(chosen, ids, k)
            out += [(q, row["docs"][d], s) for s, d in found]
    return out


def search_block(docs: DataFrame, block: Block, params: RankParams) -> DataFrame | None:
    """(item_id, rank, doc_id, score) for one block of queries; None if no document has a term."""
    spark = docs.sparkSession
    index = stage(index_documents(docs, block.vocabulary, params), "impact-index")
    n_docs, n_terms = index.agg(
        F.sum("with_terms"), F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b))
    ).first()
    if not n_terms:
        return None
    # A term's list runs from its forerunner's end to its own.
    lists = index.select("ends", F.posexplode("terms").alias("i", "term"))
    held = F.col("ends")[F.col("i")] - F.when(F.col("i") > 0, F.col("ends")[F.col("i") - 1]).otherwise(0)
    holders = lists.groupBy("term").agg(F.sum(held.cast("bigint")).alias("n"))
    weights = [0] * len(block.vocabulary)
    for r in holders.collect():
        weights[r["term"]] = weight(n_docs, r["n"])
    shared = spark.sparkContext.broadcast((block, weights))
    k = params.k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weights = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {f: batch.column(f)[i].values.to_numpy(zero_copy_only=False) for f in INDEX.names if f not in ("docs", "with_terms")}
                row["docs"] = batch.column("docs")[i].as_py()
                found = shard_answers(row, block, weights, n_docs, n_terms, k)
                columns = list(zip(*found, strict=True)) or [(), (), ()]
                kinds = (pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["query", "doc_id", "score"]
                )

    best = index.mapInArrow(run, "query int, doc_id bigint, score bigint")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    kind = "bigint" if all(isinstance(i, int | None) for i in block.items) else "string"
    named = spark.createDataFrame(list(enumerate(block.items)), f"query int, item_id {kind}")
    return ranked.join(F.broadcast(named), "query").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, queries: DataFrame, params: RankParams = RankParams()) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents for every row of ``queries``, ranks from 1.

    Only documents with a score above 0 are ranked; equal scores go by doc_id,
    a null one last. Null texts and texts without terms match nothing, and such
    queries have no rows; empty tables give an empty result. Every input row
    counts as a document and every query row as a query, repeated or not.
    Other columns are ignored. Whole texts are counted; one text belongs to one
    shard, however long.
    """
    found = None
    for block in query_blocks(queries, params):
        part = search_block(docs, block, params)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return found
