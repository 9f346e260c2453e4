"""Middle values of groups of any size, exact, without sorting or numbering their rows.

Groups up to a limit take Spark's own percentile, whose buffer that limit bounds.
A larger group's values become integers of the same order and are counted by value,
added up map-side and spread by value. Four passes then narrow each wanted rank by
sixteen bits: counts per piece, a running sum over at most 65,536 pieces, and on into
the piece that holds the rank.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roost.operators.skew import CHUNK_ROWS, MAX_HOT_KEYS, split_hot
from roost.sources.stage import stage

DIGIT_BITS = 16
PASSES = (48, 32, 16, 0)

# Copies of an open rank where there are too many to broadcast.
RANK_COPIES = 32


def middle_values(
    df: DataFrame,
    keys: list[str],
    columns: list[str],
    observed: bool = True,
    limit: int = CHUNK_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Per group its ``keys`` and the middle value of each of the double ``columns``.

    ``observed`` picks the lower of two middle values, else their mean is taken.
    NULL counts for nothing; not a number is the largest value. ``sizes`` are the
    groups with their rows ``n``, counted here if not given; ``df`` is read again
    for the groups with more than ``limit`` rows, so pass a stored table.
    """
    if sizes is None:
        sizes = stage(df.groupBy(*keys).agg(F.count("*").alias("n")), "group-sizes")
    large = sizes.where(F.col("n") > limit).select(*keys)
    if large.isEmpty():
        return small_groups(df, keys, columns, observed)
    ordinary, crowded = split_hot(df, keys, large)
    return small_groups(ordinary, keys, columns, observed).unionByName(
        large_groups(crowded, keys, columns, observed)
    )


def small_groups(df: DataFrame, keys: list[str], columns: list[str], observed: bool) -> DataFrame:
    return df.groupBy(*keys).agg(*[middle_of(c, observed).alias(c) for c in columns])


def middle_of(c: str, observed: bool = True) -> Column:
    """The middle value of a group that a task may hold."""
    if observed:
        return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {c})")
    return F.percentile(c, F.lit(0.5))


def large_groups(df: DataFrame, keys: list[str], columns: list[str], observed: bool) -> DataFrame:
    """The same by counting passes; no task holds more of a group than its share of the values."""
    encode, decode = _order_codes()
    group = [*keys, "_column"]
    one_by_one = F.explode(F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).alias("v")) for c in columns]))
    values = df.select(*keys, one_by_one.alias("_p")).select(*keys, "_p.*").where(F.col("v").isNotNull())
    counts = stage(
        values.withColumn("_code", encode("v")).groupBy(*group, "_code").agg(F.count("*").alias("_n")), "value-counts"
    )
    total = F.sum("_n")
    ranks = [F.floor((total + 1) / 2)] if observed else [F.floor((total + 1) / 2), F.floor(total / 2) + 1]
    open_ranks = stage(
        counts.groupBy(*group)
        .agg(F.array_distinct(F.array(*ranks)).alias("_ranks"))
        .select(*group, F.explode("_ranks").alias("_rank"), F.lit(0).cast("bigint").alias("_within")),
        "open-ranks",
    )
    few = open_ranks.count() <= MAX_HOT_KEYS
    for shift in PASSES:
        piece = F.shiftright("_code", shift)
        # The first pass has no piece to stay within.
        within = F.lit(0).cast("bigint") if shift == PASSES[0] else F.shiftright("_code", shift + DIGIT_BITS)
        pieces = counts.withColumns({"_within": within, "_piece": piece})
        if shift != PASSES[0]:
            pieces = _in_open_pieces(pieces, open_ranks, [*group, "_within"], few)
        add_up = Window.partitionBy(*group, "_within").orderBy("_piece")
        counted = (
            pieces.groupBy(*group, "_within", "_piece")
            .agg(F.sum("_n").alias("_n"))
            .withColumn("_upto", F.sum("_n").over(add_up))
        )
        before = F.col("_upto") - F.col("_n")
        open_ranks = stage(
            open_ranks.join(counted, [*group, "_within"])
            .where((before < F.col("_rank")) & (F.col("_rank") <= F.col("_upto")))
            .select(*group, (F.col("_rank") - before).alias("_rank"), F.col("_piece").alias("_within")),
            "open-ranks",
        )
    # One or two rows per group and column are left.
    found = open_ranks.select(*group, decode("_within").alias("_v"))
    middles = [F.avg(F.when(F.col("_column") == c, F.col("_v"))).alias(c) for c in columns]
    # A group without any value still has its row.
    rows = df.select(*keys).distinct()
    return rows.join(found.groupBy(*keys).agg(*middles), keys, "left")


def _in_open_pieces(pieces: DataFrame, open_ranks: DataFrame, place: list[str], few: bool) -> DataFrame:
    """Counts whose place holds a wanted rank. Many places are copied, and the counts spread over the copies."""
    places = open_ranks.select(*place).distinct()
    if few:
        return pieces.join(F.broadcast(places), place, "left_semi")
    copies = places.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(RANK_COPIES - 1))))
    turn = F.pmod(F.xxhash64("_code"), F.lit(RANK_COPIES))
    return pieces.withColumn("_copy", turn).join(copies, [*place, "_copy"], "left_semi").drop("_copy")


def _order_codes():
    """Doubles to integers of the same order, and back. Their own inverse but for the view."""
    below_zero = np.int64(0x7FFF_FFFF_FFFF_FFFF)

    def flip(bits):
        return np.where(bits < 0, bits ^ below_zero, bits)

    @F.arrow_udf("bigint")
    def encode(v: pa.Array) -> pa.Array:
        x = v.to_numpy(zero_copy_only=False) + 0.0  # one zero
        x[np.isnan(x)] = np.nan  # one not-a-number
        return pa.array(flip(x.view(np.int64)))

    @F.arrow_udf("double")
    def decode(code: pa.Array) -> pa.Array:
        return pa.array(flip(code.to_numpy(zero_copy_only=False)).view(np.float64))

    return encode, decode
