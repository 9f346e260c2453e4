"""Near-duplicate vectors: sign hashing in several tables, exact cosines, connected components.

Equal vectors of one label are one class with a count, so copies are never
compared. Classes fall into buckets by the signs of random projections; in a
bucket all cosines are computed in double precision. A pair that shares
buckets in several tables counts in the first of them only, which both rows
can tell from their keys: link counts are sums, and no pair is ever written
out. Large buckets are cut into blocks and each pair of blocks is a group of
its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roost.llm.batches import ready_workers
from roost.operators.components import connected
from roost.sources.stage import stage


# Bucket numbers are 32-bit integers.
MAX_BITS = 30


@dataclass(frozen=True)
class VectorParams:
    """As many tables as find a pair at the threshold with probability ``recall``.

    ``bits`` per table follow the number of different vectors in the largest label
    unless they are given: ``least_bits``, and one more whenever a bucket would hold more
    than ``bucket_rows`` of them on average. Tables are added to hold the recall.
    """

    threshold: float = 0.98
    bits: int | None = None
    least_bits: int = 12
    bucket_rows: int = 4
    recall: float = 0.9995
    block_rows: int = 1500
    seed: int = 5

    def fitted(self, largest: int) -> VectorParams:
        """With ``bits`` for so many vectors in a label."""
        if self.bits is not None:
            return self
        needed = ceil(log2(max(largest, 1) / self.bucket_rows))
        return replace(self, bits=min(max(self.least_bits, needed), MAX_BITS))

    def tables(self) -> int:
        same = (1 - acos(self.threshold) / pi) ** self.bits
        return max(1, ceil(log(1 - self.recall) / log(1 - same)))


def vector_classes(rows: DataFrame) -> DataFrame:
    """(vec_id, cls, label, v): ``cls`` is null where a vector links with nothing."""
    v = F.col("embedding").cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    sound = F.col("label").isNotNull() & (F.size(v) > 0) & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)
    exact = F.transform(v, lambda x: x + 0.0)
    return rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.when(F.coalesce(sound, F.lit(False)), F.xxhash64(F.col("label"), exact)).alias("cls"),
        F.col("label").cast("string").alias("label"),
        exact.alias("v"),
    )


def flat_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all elements, first element of each row, length of each row) of lists without nulls."""
    ends = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False), ends[:-1], np.diff(ends)


def bucket_keys(classes: DataFrame, params: VectorParams) -> DataFrame:
    """Adds ``keys``: one bucket number per table. Vectors of each length have hyperplanes of their own."""
    ready_workers(classes.sparkSession)
    tables, bits = params.tables(), params.bits
    powers = 1 << np.arange(bits, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            flat, starts, lengths = flat_lists(batch.column("v"))
            keys = np.zeros((batch.num_rows, tables), dtype=np.int32)
            for d in np.unique(lengths):
                if d not in planes:
                    planes[d] = np.random.default_rng([params.seed, int(d)]).standard_normal((int(d), tables * bits))
                at = np.flatnonzero(lengths == d)
                x = flat[starts[at][:, None] + np.arange(d)]
                # Scaled to the largest component: projections of huge vectors stay finite.
                x /= np.abs(x).max(axis=1, keepdims=True)
                signs = (x @ planes[d] > 0).reshape(len(at), tables, bits)
                keys[at] = signs @ powers
            columns = [batch.column(c) for c in ("cls", "label", "n", "v")]
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * tables)
            found = pa.ListArray.from_arrays(ends, pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*columns, found], ["cls", "label", "n", "v", "keys"])

    return classes.select("cls", "label", "n", "v").mapInArrow(
        run, "cls bigint, label string, n bigint, v array<double>, keys array<int>"
    )


GROUP = ["label", "dims", "tab", "key", "low", "high"]


def blocks(keyed: DataFrame, params: VectorParams) -> DataFrame:
    """Each class once per table, and once more for each further block of a bucket too large for one."""
    entries = keyed.select(
        "cls", "label", F.size("v").alias("dims"), F.posexplode("keys").alias("tab", "key")
    )
    sizes = entries.groupBy("label", "dims", "tab", "key").agg(F.count("*").alias("members")).where("members > 1")
    pieces = F.ceil(F.col("members") / params.block_rows).cast("int")
    placed = (
        entries.join(sizes, ["label", "dims", "tab", "key"])
        .withColumn("pieces", pieces)
        .withColumn("own", F.pmod(F.xxhash64("cls"), F.col("pieces")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    )
    return placed.select(
        "cls", "label", "dims", "tab", "key", "own",
        F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
    )


def links_in(x: np.ndarray, own: np.ndarray, low: int, high: int, keys: np.ndarray, tab: int, threshold: float):
    """Index pairs of one group that reach the threshold, and which of them are counted here."""
    norms = np.sqrt((x * x).sum(axis=1))
    if low == high:
        a, b = np.nonzero(np.triu(x @ x.T >= threshold * np.outer(norms, norms), 1))
    else:
        first, second = np.flatnonzero(own == low), np.flatnonzero(own == high)
        a, b = np.nonzero(x[first] @ x[second].T >= threshold * np.outer(norms[first], norms[second]))
        a, b = first[a], second[b]
    earlier = (keys[a, :tab] == keys[b, :tab]).any(axis=1) if tab else np.zeros(len(a), dtype=bool)
    return a, b, ~earlier


def lowest_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n rows the smallest index that it reaches over the pairs."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def groups_of(batch: pa.RecordBatch) -> Iterator[tuple[tuple, dict[str, np.ndarray]]]:
    """A sorted batch as its groups: what names each, and its rows as arrays; a group may go on in the next batch."""
    if not batch.num_rows:
        return
    labels = batch.column("label")
    codes = labels.dictionary_encode().indices.to_numpy()
    numbers = {c: batch.column(c).to_numpy() for c in (*GROUP[1:], "own", "cls", "n")}
    places = np.stack([codes, *[numbers[c] for c in GROUP[1:]]])
    cuts = np.flatnonzero((places[:, 1:] != places[:, :-1]).any(axis=0)) + 1
    vectors, v_starts, v_lengths = flat_lists(batch.column("v"))
    keys, k_starts, k_lengths = flat_lists(batch.column("keys"))
    for i, j in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        part = {c: numbers[c][i:j] for c in ("tab", "low", "high", "own", "cls", "n")}
        # Lists of a group are of one length and lie side by side.
        part["v"] = vectors[v_starts[i] : v_starts[j - 1] + v_lengths[j - 1]].reshape(j - i, -1)
        part["keys"] = keys[k_starts[i] : k_starts[j - 1] + k_lengths[j - 1]].reshape(j - i, -1)
        yield (labels[int(i)].as_py(), *[int(numbers[c][i]) for c in GROUP[1:]]), part


def verified(grouped: DataFrame, params: VectorParams) -> DataFrame:
    """(cls, links, root): what each group adds to a class's links, and a link to the group's smallest."""
    ready_workers(grouped.sparkSession)
    schema = pa.schema([("cls", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def judge(parts: list[dict[str, np.ndarray]]) -> pa.RecordBatch | None:
        g = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
        if len(g["cls"]) < 2:
            return None
        x = g["v"] / np.abs(g["v"]).max(axis=1, keepdims=True)
        low, high, tab = (int(g[c][0]) for c in ("low", "high", "tab"))
        a, b, counted = links_in(x, g["own"], low, high, g["keys"], tab, params.threshold)
        if not len(a):
            return None
        links = np.zeros(len(x), dtype=np.int64)
        np.add.at(links, a[counted], g["n"][b[counted]])
        np.add.at(links, b[counted], g["n"][a[counted]])
        lowest = lowest_linked(len(x), a, b)
        at = np.unique(np.concatenate([a, b]))
        made = (g["cls"][at], links[at], g["cls"][lowest[at]])
        return pa.RecordBatch.from_arrays([pa.array(c) for c in made], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        last = None
        for batch in batches:
            for group, part in groups_of(batch):
                if group != last and held:
                    made = judge(held)
                    if made is not None:
                        yield made
                    held = []
                last = group
                held.append(part)
        made = judge(held) if held else None
        if made is not None:
            yield made

    return grouped.mapInArrow(run, "cls bigint, links bigint, root bigint")


def near_vectors(rows: DataFrame, params: VectorParams = VectorParams()) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row.

    Only vectors of equal label (and length) are compared. Vectors that are
    null, empty, zero, or hold null or non-finite components, and those
    without a label, link with nothing and stay. Repeated rows are vectors of
    their own. Null ids count as links of others and never name a component.
    An empty table gives none.

    ``n_links`` is a lower bound: a pair at the threshold is found with probability
    ``recall`` and a nearer one more surely; no pair below it is counted. Components
    miss a link only where no chain of found links takes its place.
    """
    placed = vector_classes(rows)
    classes = stage(
        placed.where("cls IS NOT NULL").groupBy("cls", "label", "v").agg(F.count("*").alias("n"), F.min("vec_id").alias("first")),
        "vector-classes",
    )
    largest = classes.groupBy("label", F.size("v")).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    params = params.fitted(largest or 0)
    keyed = stage(bucket_keys(classes, params), "vector-keys")
    grouped = (
        blocks(keyed, params)
        .join(keyed.select("cls", "n", "v", "keys"), "cls")
        .repartition(*GROUP)
        .sortWithinPartitions(*GROUP)
    )
    found = stage(verified(grouped, params), "vector-links")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = connected(found.select(F.col("cls").alias("u"), F.col("root").alias("v")))
    rooted = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", "n", "first", F.coalesce("root", "cls").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    per_class = (
        rooted.join(smallest, "root")
        .join(links, "cls", "left")
        .select("cls", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    )
    return (
        placed.select("vec_id", "cls")
        .join(per_class, "cls", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
