"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Each document gives a vector of transformed text statistics. For each language
and source, the half of the documents whose covariance has the smallest
determinant is sought from two robust starting points by concentration steps;
documents near that half's centre give the final estimate (the usual
reweighting), and those far from it in its Mahalanobis distance are rejected.
Covariances are widened to that of all of a normal sample by factors that do
not look at the far documents: nearly half of a group may be junk. Everything is DataFrame functions: moments are sums that add up
before any shuffle, so a source with a third of all rows is no hot group.

Vectors are whole numbers of 1/1024, so that all sums are exact and the result
does not depend on the order of rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roost.sources.stage import stage

SPACE = " \t\n\x0b\x0c\r"
AXES = ("word_length", "symbols", "dup_lines", "repeats", "length")
GRID = 1024.0
# Upper quantiles of the chi-square distribution with five degrees of freedom. Fixed values.
CHI5_UPPER = {0.999: 20.515006, 0.9999: 25.744838, 0.99999: 30.856190}
STARTS = (0, 1)
# The share of normal rows near the half's centre that the final estimate is made of, and its quantile.
NEAR, CHI5_NEAR = 0.975, 12.832502
# Pison, Van Aelst and Willems (2002): for five axes the half of n normal rows, and the rows near it,
# come out too narrow by 1 - a / n^b.
NARROW_HALF, NARROW_NEAR = (4.926194, 0.836056), (217.754758, 2.058710)


@dataclass(frozen=True)
class OutlierParams:
    """``half``: the share whose determinant is minimised; the rest of a group, less three rows, may be junk.
    ``least_spread``: standard deviations (in ``AXES`` order) that are granted on top of the measured ones.

    Groups with fewer than ``min_group`` usable documents are pooled by
    language, then all together; a pool that is still smaller rejects nothing.
    """

    half: float = 0.5
    steps: int = 4
    quantile: float = 0.99999
    min_group: int = 50
    min_words: int = 50
    max_repeat_percent: int = 50
    least_spread: tuple[float, ...] = (0.08, 0.7, 0.5, 0.7, 0.5)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` needs it inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more, each once.

    Windows are compared by 64-bit hashes. Only texts with some repeated hash are sorted.
    """
    n = F.size(words)
    windows = lambda w: F.transform(
        F.slice(w, 1, F.size(w) - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))
    )

    def places(hashes: Column) -> Column:
        numbered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = lambda s: F.filter(
            s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"])
        )
        covered = F.flatten(F.transform(let(numbered, again), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
        return F.size(F.array_distinct(covered))

    some = let(
        let(words, windows),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(places(h)),
    )
    return F.when(n < 4, F.lit(0)).otherwise(some).cast("bigint")


def text_statistics(docs: DataFrame, params: OutlierParams = OutlierParams()) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.

    A null text has no words. Words end at ASCII white space only.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))
    split = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        text.alias("text"),
        words.alias("words"),
    )
    joined = F.array_join("words", "")
    lines = F.filter(F.split(F.col("text"), "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    counted = split.select(
        "doc_id",
        "lang",
        "source",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(joined).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]+", ""))).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )
    short = F.col("n_words") < params.min_words
    repetitive = F.col("n_repeat_words") * 100 > F.col("n_words") * params.max_repeat_percent
    return counted.withColumn("base_failed", short | repetitive)


def vectors(stats: DataFrame) -> DataFrame:
    """Adds x0..x4, the transformed statistics in units of the grid."""
    n = F.col("n_words")
    percent = lambda c: F.log1p(F.col(c) * 100.0 / n)
    axes = (
        F.log(F.col("word_chars") / n),
        percent("n_symbols"),
        percent("n_dup_lines"),
        percent("n_repeat_words"),
        F.log(n.cast("double")),
    )
    return stats.select("*", *[F.round(x * GRID).cast("bigint").alias(f"x{i}") for i, x in enumerate(axes)])


def grouped(rows: DataFrame, params: OutlierParams) -> DataFrame:
    """Adds ``g``, the name of the group that judges a row: source, language or all, whichever is large enough."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    keyed = rows.withColumn("by_source", F.concat_ws("\n", name("lang"), name("source"))).withColumn("by_lang", name("lang"))
    sizes = keyed.groupBy("by_source", "by_lang").agg(F.count("*").alias("n"))
    small = F.col("n") < params.min_group
    pools = sizes.where(small).groupBy("by_lang").agg((F.sum("n") >= params.min_group).alias("enough"))
    named = sizes.join(pools, "by_lang", "left").select(
        "by_source", F.when(~small, F.col("by_source")).when(F.col("enough"), F.col("by_lang")).otherwise("*").alias("g")
    )
    return keyed.join(named, "by_source").drop("by_source", "by_lang")


PAIRS = [(i, j) for i in range(5) for j in range(i + 1)]


def inverse_factor(estimates: DataFrame, keys: list[str]) -> DataFrame:
    """keys, m0..m4, w_ij (the inverse of the covariance's lower factor) and logdet, from m_i and c_ij."""
    out = estimates
    for i, j in PAIRS:
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        value = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}")
        out = out.withColumn(f"l{i}{j}", value)
    for i, j in sorted(PAIRS, key=lambda p: (p[0] - p[1], p[0])):
        if i == j:
            value = 1.0 / F.col(f"l{i}{i}")
        else:
            value = F.lit(0.0)
            for k in range(j, i):
                value = value - F.col(f"l{i}{k}") * F.col(f"w{k}{j}")
            value = value / F.col(f"l{i}{i}")
        out = out.withColumn(f"w{i}{j}", value)
    logdet = sum((F.log(F.col(f"l{i}{i}")) for i in range(5)), F.lit(0.0)) * 2
    return out.select(*keys, *[f"m{i}" for i in range(5)], *[f"w{i}{j}" for i, j in PAIRS], logdet.alias("logdet"))


def distance() -> Column:
    """Squared Mahalanobis distance of x to m."""
    total = F.lit(0.0)
    for i in range(5):
        part = F.lit(0.0)
        for j in range(i + 1):
            part = part + F.col(f"w{i}{j}") * (F.col(f"x{j}") / GRID - F.col(f"m{j}"))
        total = total + part * part
    return total


def rank_of(d2: Column) -> Column:
    """Distances as whole numbers: few enough values for exact quantiles of any number of rows."""
    return F.round(F.log1p(d2) * 256).cast("int")


def consistency(share: float) -> float:
    """What the covariance of the nearest ``share`` of a normal sample in five dimensions is to be multiplied by."""

    def density(x: float) -> float:
        return math.sqrt(2 * x / math.pi) * math.exp(-x / 2)

    low, high = 0.0, 1000.0
    for _ in range(100):
        x = (low + high) / 2
        below = math.erf(math.sqrt(x / 2)) - density(x) * (1 + x / 3) < share
        low, high = (x, high) if below else (low, x)
    return share / (share - density(low) * low * low / 15)


def moments(rows: DataFrame, keys: list[str], params: OutlierParams, factor: float = 1.0) -> DataFrame:
    """keys, m_i and c_ij of the rows, c_ij times ``factor`` and the granted spreads added; sums are exact."""
    sums = [F.sum(f"x{i}").alias(f"s{i}") for i in range(5)]
    products = [
        F.sum((F.col(f"x{i}") * F.col(f"x{j}")).cast("decimal(38,0)")).alias(f"p{i}{j}") for i, j in PAIRS
    ]
    total = rows.groupBy(*keys).agg(F.count("*").alias("n"), *sums, *products)
    mean = lambda i: F.col(f"s{i}").cast("double") / F.col("n")
    covariances = []
    for i, j in PAIRS:
        c = (F.col(f"p{i}{j}").cast("double") / F.col("n") - mean(i) * mean(j)) * factor / (GRID * GRID)
        covariances.append((c + (params.least_spread[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}"))
    return total.select(*keys, *[(mean(i) / GRID).alias(f"m{i}") for i in range(5)], *covariances)


def starting_points(rows: DataFrame, params: OutlierParams) -> DataFrame:
    """Two robust estimates per group: medians with deviations alone, and with bounded correlations."""
    # The values lie on a grid: their counts, which percentile() keeps, are few.
    centre = rows.groupBy("g").agg(*[F.percentile(f"x{i}", 0.5).alias(f"q{i}") for i in range(5)])
    spread = (
        rows.join(centre, "g")
        .groupBy("g")
        .agg(
            *[F.first(f"q{i}").alias(f"q{i}") for i in range(5)],
            *[F.percentile(F.abs(F.col(f"x{i}") - F.col(f"q{i}")), 0.5).alias(f"a{i}") for i in range(5)],
        )
    )
    sigma = [F.sqrt((1.4826 * F.col(f"a{i}") / GRID) ** 2 + params.least_spread[i] ** 2) for i in range(5)]
    scaled = stage(
        spread.select("g", *[(F.col(f"q{i}") / GRID).alias(f"m{i}") for i in range(5)], *[s.alias(f"d{i}") for i, s in enumerate(sigma)]),
        "mcd-scales",
    )
    bounded = [
        F.round(F.tanh((F.col(f"x{i}") / GRID - F.col(f"m{i}")) / F.col(f"d{i}")) * GRID).cast("bigint") for i in range(5)
    ]
    shaped = rows.join(scaled, "g").select("g", *[b.alias(f"x{i}") for i, b in enumerate(bounded)])
    shape = moments(shaped, ["g"], OutlierParams(least_spread=(0.1,) * 5)).drop(*[f"m{i}" for i in range(5)])
    both = scaled.join(shape, "g").withColumn("start", F.explode(F.array(*[F.lit(s) for s in STARTS])))
    filled = both.select(
        "g",
        "start",
        *[f"m{i}" for i in range(5)],
        *[
            F.when(F.col("start") == 0, F.col(f"d{i}") * F.col(f"d{j}") if i == j else F.lit(0.0))
            .otherwise(F.col(f"c{i}{j}") / F.sqrt(F.col(f"c{i}{i}") * F.col(f"c{j}{j}")) * F.col(f"d{i}") * F.col(f"d{j}"))
            .alias(f"k{i}{j}")
            for i, j in PAIRS
        ],
    )
    renamed = filled.select("g", "start", *[f"m{i}" for i in range(5)], *[F.col(f"k{i}{j}").alias(f"c{i}{j}") for i, j in PAIRS])
    return stage(inverse_factor(renamed, ["g", "start"]), "mcd-estimates")


def measured(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    return rows.join(estimates, "g").withColumn("rank", rank_of(distance()))


def reach(ranked: DataFrame, params: OutlierParams) -> DataFrame:
    """(g, start, limit): the rank of the h-th nearest row, h = (n + p + 1) / 2 for the half.

    Rows are counted by rank before a group comes together: few counts for any number of rows.
    """
    counted = ranked.groupBy("g", "start", "rank").agg(F.count("*").alias("n"))
    listed = counted.groupBy("g", "start").agg(
        F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("rank", "n"))).alias("ranks")
    )
    least = F.floor((F.col("n") + len(AXES) + 1) / 2)
    h = F.least(F.col("n"), F.floor(least * 2 - F.col("n") + (F.col("n") - least) * 2 * params.half))
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("int").alias("limit"))
    walk = lambda s, x: F.struct(
        (s["seen"] + x["n"]).alias("seen"), F.when(s["seen"] < F.col("h"), x["rank"]).otherwise(s["limit"]).alias("limit")
    )
    limit = F.aggregate("ranks", start, walk, lambda s: s["limit"])
    return listed.withColumn("h", h).select("g", "start", limit.alias("limit"))


def concentrate(rows: DataFrame, estimates: DataFrame, params: OutlierParams) -> DataFrame:
    """Estimates of the nearest share of each group: never a larger determinant than before."""
    ranked = measured(rows, estimates)
    nearest = ranked.join(reach(ranked, params), ["g", "start"]).where(F.col("rank") <= F.col("limit"))
    found = moments(nearest, ["g", "start"], params, consistency(params.half))
    return stage(inverse_factor(found, ["g", "start"]), "mcd-estimates")


def widening(members: Column, narrow: tuple[float, float]) -> Column:
    """Groups of fewer than four rows an axis take that number's."""
    return 1.0 / (1.0 - narrow[0] / F.pow(F.greatest(members, F.lit(4 * len(AXES))), F.lit(narrow[1])))


def minimum_covariance(rows: DataFrame, params: OutlierParams) -> DataFrame:
    """Per group the estimate from the rows near the half of smaller determinant, ``members`` and ``scale``.

    ``scale`` widens the estimates of few members.
    """
    estimates = starting_points(rows, params)
    for _ in range(params.steps):
        estimates = concentrate(rows, estimates, params)
    fields = [c for c in estimates.columns if c != "g"]
    first = ["logdet", "start", *[c for c in fields if c not in ("logdet", "start")]]
    best = estimates.groupBy("g").agg(F.min(F.struct(*first)).alias("e")).select("g", "e.*")
    sizes = stage(rows.groupBy("g").agg(F.count("*").alias("members")), "mcd-members")
    half = best.join(sizes, "g")
    near = rows.join(half, "g").where(distance() <= widening(F.col("members"), NARROW_HALF) * CHI5_NEAR)
    final = inverse_factor(moments(near, ["g"], params, consistency(NEAR)), ["g"])
    return stage(final.join(sizes, "g").withColumn("scale", widening(F.col("members"), NARROW_NEAR)), "mcd-chosen")


def quality_rules(docs: DataFrame, params: OutlierParams = OutlierParams()) -> DataFrame:
    """Statistics, base_failed, ``distance`` (squared, scaled) and ``kept`` for every document.

    Documents that fail the base rules are not measured: no distance, not
    kept. Null languages and sources are groups like others. Repeated rows
    are judged one by one and count as often as they occur.
    """
    stats = stage(text_statistics(docs, params), "text-statistics")
    usable = stage(grouped(vectors(stats.where("NOT base_failed")), params), "statistic-vectors")
    chosen = minimum_covariance(usable.select("g", *[f"x{i}" for i in range(5)]), params)
    judged = usable.join(chosen, "g", "left").withColumn(
        "distance", F.when(F.col("members") >= params.min_group, distance() / F.col("scale"))
    )
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    near = F.coalesce(F.col("distance") <= CHI5_UPPER[params.quantile], F.lit(True))
    good = judged.select(*columns, near.alias("kept"), "distance")
    bad = stats.where("base_failed").select(*columns, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    return good.unionByName(bad)
