"""Mixing sources to target weights by Poisson replication.

A source's target share of the output over its share of the input is the mean
number of times that each of its documents is repeated. A document's own
number is a Poisson variable with that mean, read off the inverse of the
distribution at a number between 0 and 1 that a hash of its id gives: runs
repeat exactly, and no document needs to know of another.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roost.sources.stage import stage

# exp(-mean) must stay well above the smallest double: means above this are sums of several draws.
LARGEST_STEP = 8.0
MAX_BROADCAST_SOURCES = 100_000


@dataclass(frozen=True)
class MixParams:
    """Target weights by source, normalised; a source not named weighs ``default_weight``.

    ``size``: what a source's share is counted in, an expression over the documents.
    ``scale``: size of the output over size of the input, in expectation.
    """

    weights: dict[str, float] = field(default_factory=dict)
    default_weight: float = 1.0
    size: str = "1"
    scale: float = 1.0
    seed: str = "mix"


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits of an md5."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(1 << 52))


def poisson(mean: Column, draw) -> Column:
    """Inverse of the Poisson distribution; ``draw(i)`` is the i-th uniform number.

    A large mean is split into equal steps, whose counts add up. In a step k
    grows until the summed probability passes the draw; the terms below
    1e-18 that lie beyond 60 cannot be reached by a number of 52 bits.
    """
    steps = F.greatest(F.lit(1), F.ceil(mean / LARGEST_STEP)).cast("int")
    part = mean / steps
    zero = F.lit(0).cast("bigint")

    def one(i: Column) -> Column:
        start = F.struct(draw(i).alias("u"), F.exp(-part).alias("p"), F.exp(-part).alias("cdf"), zero.alias("k"))

        def grow(s: Column, n: Column) -> Column:
            further = s["u"] >= s["cdf"]
            p = F.when(further, s["p"] * part / n).otherwise(0.0)
            return F.struct(
                s["u"].alias("u"),
                F.when(further, p).otherwise(s["p"]).alias("p"),
                (s["cdf"] + p).alias("cdf"),
                (s["k"] + F.when(further, 1).otherwise(0)).alias("k"),
            )

        return F.aggregate(F.sequence(F.lit(1), F.lit(60)), start, grow, lambda s: s["k"])

    return F.when(mean > 0, F.aggregate(F.sequence(F.lit(1), steps), zero, lambda n, i: n + one(i))).otherwise(zero)


def repetition_rates(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """(source, rate): the mean number of copies of a document of each source.

    Counted over all documents. A null source is a source of its own, called
    by the empty name in ``weights``; sizes below zero or null count as zero.
    A source of size zero cannot reach a weight: its documents come ``scale``
    times on average, and no weight is set aside for it. Where all sizes are
    zero, documents are counted instead. No documents, no sources: an empty table.
    """
    size = F.greatest(F.coalesce(F.expr(params.size).cast("double"), F.lit(0.0)), F.lit(0.0))
    rows = F.count("*").cast("double")
    sums = stage(docs.groupBy("source").agg(F.sum(size).alias("size"), rows.alias("rows")), "source-sizes")
    if not sums.agg(F.sum("size")).first()[0]:
        sums = sums.withColumn("size", F.col("rows"))
    named = F.lit(params.default_weight)
    for name, weight in params.weights.items():
        named = F.when(F.coalesce("source", F.lit("")) == name, F.lit(float(weight))).otherwise(named)
    weighed = sums.withColumn("weight", F.when(F.col("size") > 0, named).otherwise(0.0))
    all_size, all_weight = weighed.agg(F.sum("size"), F.sum("weight")).first()
    target = F.lit((all_size or 0.0) * params.scale) * F.col("weight") / F.lit(float(all_weight or 1.0))
    rate = F.when(F.col("size") > 0, target / F.col("size")).otherwise(float(params.scale))
    return weighed.select("source", rate.alias("rate"))


def copies(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """``docs`` with ``_copies``, the number of times each row is to appear.

    Rows draw by doc_id: repeated rows get equal numbers. A null doc_id draws
    as an id of its own.
    """
    rates = repetition_rates(docs, params)
    few = rates.limit(MAX_BROADCAST_SOURCES + 1).count() <= MAX_BROADCAST_SOURCES
    rates = rates.select(F.col("source").alias("_source"), F.col("rate").alias("_rate"))
    # Broadcast bound: counted just now. Beyond it the planner joins by shuffle and splits hot sources.
    side = F.broadcast(rates) if few else rates
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    number = poisson(F.col("_rate"), lambda i: uniform(F.lit(params.seed), doc, i.cast("string")))
    joined = docs.join(side, docs["source"].eqNullSafe(F.col("_source")))
    return joined.select(*docs.columns, number.alias("_copies"))


def mix(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """Every document as often as drawn, in a random order over the whole output.

    Columns stay as they are. A hash of id and copy number deals the rows out
    to partitions and orders them inside; a source of any size, or a document
    drawn many times, lies spread over all.
    """
    repeated = explode_copies(docs, params)
    return shuffled(repeated).select(*docs.columns)


def mix_numbered(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """As ``mix``, with ``copy`` (from 0), ``n_copies`` and ``shuffle_key`` added; input columns so called go."""
    plain = docs.select(*[c for c in docs.columns if c not in ("copy", "n_copies", "shuffle_key")])
    return shuffled(explode_copies(plain, params)).select(
        *plain.columns, F.col("_copy").alias("copy"), F.col("_copies").alias("n_copies"), F.col("_order").alias("shuffle_key")
    )


def explode_copies(docs: DataFrame, params: MixParams) -> DataFrame:
    drawn = copies(docs, params).where("_copies > 0")
    repeated = drawn.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)))
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    key = F.concat_ws(":", F.lit(params.seed), F.lit("order"), doc, F.col("_copy").cast("string"))
    return repeated.withColumn("_order", F.md5(key))


def shuffled(rows: DataFrame) -> DataFrame:
    return rows.repartition("_order").sortWithinPartitions("_order")
