"""Helpers for keys that hold too many rows for one task.

Most devices are small, and one task per group is the cheapest plan for them.
A *hot* key - one with more rows than a given limit - is routed to another
plan, whose pieces come from range partitioning on a full ordering of its
rows. Spark samples that ordering, so the pieces are even whatever the
distribution, and no row is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roost.sources.stage import stage

CHUNK_ROWS = 1_000_000
MAX_HOT_KEYS = 500_000


def key_sizes(df: DataFrame, key: str, limit: int) -> tuple[int, int, DataFrame]:
    """(number of rows, rows of the largest key, the keys with more than ``limit`` rows).

    One count serves all three. It reads the key column only, adds up map-side
    first, keeps a row for each large key and one for all others together, and
    brings two numbers to the driver.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    large = F.when(F.col("n") > limit, F.col(key)).alias(key)
    folded = stage(counts.groupBy(large).agg(F.sum("n").alias("n"), F.max("n").alias("largest")), "key-sizes")
    total, largest = folded.agg(F.sum("n"), F.max("largest")).first()
    return total or 0, largest or 0, folded.where(F.col(key).isNotNull()).select(key)


def by_key(df: DataFrame, key: str, total: int, rows_per_task: int) -> DataFrame:
    """Repartition by ``key``, in so many partitions that a task gets about ``rows_per_task`` rows.

    A number keeps adaptive execution from merging partitions by their compressed
    size, which lets a task's sorts grow with the rows. Few rows take no number.
    """
    needed = -(-total // rows_per_task)
    if needed <= 1:
        return df.repartition(key)
    return df.repartition(max(needed, df.sparkSession.sparkContext.defaultParallelism), key)


def split_hot(df: DataFrame, key: str | list[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys).

    A NULL key counts as ordinary. Up to MAX_HOT_KEYS, counted here, are broadcast,
    so neither side is shuffled; more are joined by shuffle.
    """
    marks = F.broadcast(hot) if hot.count() <= MAX_HOT_KEYS else hot
    return df.join(marks, key, "left_anti"), df.join(marks, key, "left_semi")


def range_chunks(
    df: DataFrame, order: list[str], rows_per_chunk: int = CHUNK_ROWS, staged: bool = False
) -> DataFrame:
    """Stage the rows with a ``chunk`` number that follows ``order``.

    ``order`` should identify a row (ties cannot be split). The numbers are
    written with the rows, so they cannot change when a task is run again. The
    input is read three times (count, sample, rows), so it is staged first
    unless the caller has done so.
    """
    source = df if staged else stage(df, "chunk-input")
    pieces = max(1, -(-source.count() // rows_per_chunk))
    return stage(
        source.repartitionByRange(pieces, *order).withColumn("chunk", F.spark_partition_id()),
        "chunks",
    )


def offsets_before(chunks: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """Per key and chunk: the sum of ``amount`` over the key's earlier chunks.

    ``chunks`` has one row per key and chunk. A key can have as many rows here
    as there are chunks, not as it has rows.
    """
    earlier = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return chunks.select(
        *keys, "chunk", F.coalesce(F.sum(amount).over(earlier), F.lit(0)).cast("bigint").alias("offset")
    )


def number_rows(
    df: DataFrame, keys: list[str], order: list[str], name: str, rows_per_chunk: int = CHUNK_ROWS
) -> DataFrame:
    """``row_number`` over (non-NULL) ``keys`` by ``order``, every key spread over many tasks."""
    pieces = range_chunks(df, keys + order, rows_per_chunk)
    counts = pieces.groupBy(*keys, "chunk").agg(F.count("*").alias("n"))
    offsets = offsets_before(counts, keys, "n")
    within = Window.partitionBy(*keys, "chunk").orderBy(*order)
    numbered = pieces.withColumn("_rn", F.row_number().over(within))
    joined = numbered.join(offsets, keys + ["chunk"])
    return joined.withColumn(name, F.col("offset") + F.col("_rn")).drop("_rn", "offset", "chunk")


def spread_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    tiebreak: list[str],
    how: str = "inner",
    rows_per_chunk: int = CHUNK_ROWS,
    staged: bool = False,
) -> DataFrame:
    """Join where a key of ``big`` may hold most of its rows.

    ``big`` is cut into even chunks; a row of ``small`` is copied once for each
    chunk its key occurs in - one copy for nearly all keys - and the join then
    runs on key and chunk. Keys are not NULL; ``how`` is ``inner`` or ``left``;
    ``staged`` says that ``big`` is a stored table.
    """
    pieces = range_chunks(big, keys + tiebreak, rows_per_chunk, staged)
    where = pieces.select(*keys, "chunk").distinct()
    copies = where.join(small, keys)
    return pieces.join(copies, keys + ["chunk"], how).drop("chunk")
