"""Stops over several exports: what one export leaves open goes on in the next.

An export ends in the middle of stays. What the next one needs of each device is
small: its last ping, the pings of a run that has not ended, and how many runs
and stops came before. That is the *carry*, a table of pings

    device_id, latitude, longitude, timestamp, run_base, stop_base

Each export is read once, with the carry of the one before; the stops that it
ends, over all exports, and those that the last carry still holds are the stops
of one run over everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roost.operators.selection import middle_of
from roost.operators.skew import CHUNK_ROWS, MAX_HOT_KEYS, by_key
from roost.operators.stops import (
    DEVICE,
    MAX_DEVICE_PINGS,
    ORDER,
    PING,
    PINGS_PER_TASK,
    STOP_COLUMNS,
    by_device_size,
    detect_stops,
    lasts,
    near_median,
    runs_by_chunk,
    stops_by_chunk,
    with_runs,
)
from roost.params import StopParams
from roost.sources.stage import discard, stage

BASES = ["run_base", "stop_base"]
OPEN_COLUMNS = [*PING, "last_run", "open"]


def detect_stops_after(
    pings: DataFrame,
    carry: DataFrame | None = None,
    params: StopParams = StopParams(),
    max_device_pings: int = MAX_DEVICE_PINGS,
    rows_per_chunk: int = CHUNK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(stops that end in this export, the carry for the next one); both staged.

    Numbers of runs and stops go on from export to export. ``carry`` is None for
    the first export. Pings without a time belong to no time line and are left
    out; pings of a device that come before its carried ones are an error, copies
    of its last ping are not. Pass stored tables: they are read several times.
    """
    points = pings.select(*PING).where(F.col(DEVICE).isNotNull() & F.col("timestamp").isNotNull())
    if carry is not None:
        refuse_earlier(points, carry)
        points = points.unionByName(carry.select(*PING))
    ordinary, crowded, total = by_device_size(points, max_device_pings)
    # One sort by device serves what has ended and what is left open.
    judged = stage(stops_and_open(by_key(ordinary, DEVICE, total, PINGS_PER_TASK), params), "stops-and-open")
    found = judged.where("is_stop").select(*STOP_COLUMNS)
    tails = judged.where("is_open").select(*OPEN_COLUMNS)
    if crowded is not None:
        found = found.unionByName(stops_by_chunk(crowded, params, rows_per_chunk))
        still = stage(crowded_open(crowded, params, rows_per_chunk), "crowded-open")
        tails = tails.unionByName(still)
    ends = tails.groupBy(DEVICE).agg(F.max("last_run").alias("last_run"), F.max("open").alias("open"))
    ends = stage(with_bases(ends, carry), "ends")

    ended = ~(F.col("open") & (F.col("stop_id") == F.col("last_run")))
    stops = stage(numbered_on(found.join(ends, DEVICE).where(ended)), "ended-stops")

    n = stops.groupBy(DEVICE).agg(F.count("*").alias("n"))
    bases = ends.join(n, DEVICE, "left").select(
        DEVICE,
        (F.col("run_base") + F.col("last_run") - F.col("open").cast("bigint")).alias("run_base"),
        (F.col("stop_base") + F.coalesce("n", F.lit(0))).alias("stop_base"),
    )
    left = stage(tails.select(*PING).join(bases, DEVICE).select(*PING, *BASES), "carry")
    discard(judged, ends, *([] if crowded is None else [still]))
    return stops, left


def stops_still_open(
    carry: DataFrame,
    params: StopParams = StopParams(),
    max_device_pings: int = MAX_DEVICE_PINGS,
    rows_per_chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """The stops that a carry holds, as they are if no further export comes."""
    found = detect_stops(carry.select(*PING), params, max_device_pings, rows_per_chunk)
    return numbered_on(found.join(device_bases(carry), DEVICE))


def numbered_on(found: DataFrame) -> DataFrame:
    """Numbers of this export's runs and stops as numbers over all exports."""
    on = {"stop_id": F.col("stop_id") + F.col("run_base"), "stop_events": F.col("stop_events") + F.col("stop_base")}
    return found.withColumns(on).select(*STOP_COLUMNS)


def device_bases(carry: DataFrame) -> DataFrame:
    return carry.groupBy(DEVICE).agg(*[F.max(c).alias(c) for c in BASES])


def with_bases(ends: DataFrame, carry: DataFrame | None) -> DataFrame:
    if carry is None:
        return ends.withColumns({c: F.lit(0).cast("bigint") for c in BASES})
    joined = ends.join(device_bases(carry), DEVICE, "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in BASES})


def refuse_earlier(points: DataFrame, carry: DataFrame) -> None:
    """An export must not reach back behind what an earlier one has judged."""
    at = F.struct(*ORDER)
    latest = carry.agg(F.max("timestamp")).first()[0]
    if latest is None:
        return
    # No later ping comes before any carried one: of most exports nothing is left to group.
    first = points.where(F.col("timestamp") <= F.lit(latest)).groupBy(DEVICE).agg(F.min(at).alias("first"))
    last = carry.groupBy(DEVICE).agg(F.max(at).alias("last"))
    early = first.join(last, DEVICE).where("first < last")
    if not early.isEmpty():
        raise ValueError(f"pings before the carried ones, of device {early.first()[DEVICE]!r} for one")


# --- what is still open ---------------------------------------------------------


def last_ping() -> Column:
    return F.col("next_timestamp").isNull()


def marks() -> list[tuple[Column, str]]:
    """Aggregates over a device's runs: its last run, and the last run known to have ended."""
    away = ~last_ping() & ~F.coalesce("stationary", F.lit(False))
    return [(F.max("event_id"), "last_run"), (F.max(F.when(away, F.col("event_id"))), "last_break")]


def with_open(runs: DataFrame) -> DataFrame:
    """Add ``open``, whether the device's last run has not ended, and ``is_open``: its last ping, and that run's pings."""
    unended = (F.col("last_run") > 0) & (F.coalesce("last_break", F.lit(-1)) < F.col("last_run"))
    in_open_run = F.col("open") & F.col("stationary") & (F.col("event_id") == F.col("last_run"))
    return (
        runs.withColumn("last_run", F.col("last_run").cast("bigint"))
        .withColumn("open", unended)
        .withColumn("is_open", last_ping() | F.coalesce(in_open_run, F.lit(False)))
    )


def summary_of(counts: str) -> list[tuple[Column, str]]:
    """Bounds and median position of the rows where the column ``counts`` is true."""
    when = F.when(F.col(counts), F.col("timestamp"))
    return [
        (F.min(when), "start_timestamp"),
        (F.max(when), "end_timestamp"),
        (middle_of(f"IF({counts}, latitude, NULL)"), "median_latitude"),
        (middle_of(f"IF({counts}, longitude, NULL)"), "median_longitude"),
    ]


def stops_and_open(pings: DataFrame, params: StopParams) -> DataFrame:
    """Rows that name a stop (``is_stop``), are left open (``is_open``), or both; of pings partitioned by device.

    The stops are those of ``stops_by_device``, open ones among them. No further shuffle.
    """
    device, run = Window.partitionBy(DEVICE), Window.partitionBy(DEVICE, "event_id")
    in_turn = Window.partitionBy(DEVICE).orderBy("event_id")
    so_far = in_turn.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = [*PING, "event_id", "last_run", "open", "is_open"]
    runs = with_runs(pings, [DEVICE], params).select("*", *[c.over(device).alias(n) for c, n in marks()])
    rows = with_open(runs).withColumn("stationary", F.coalesce("stationary", F.lit(False))).where("stationary OR is_open")
    near = F.coalesce(F.col("stationary") & lasts(params) & near_median(params), F.lit(False))
    kept = rows.select(*own, "stationary", *[c.over(run).alias(n) for c, n in summary_of("stationary")]).select(
        *own, near.alias("near")
    )
    # All rows of a run have its summary; any one of them may name the stop.
    first = ~F.col("event_id").eqNullSafe(F.lag("event_id").over(in_turn))
    told = kept.select(*own, *[c.over(run).alias(n) for c, n in summary_of("near")], first.alias("first"))
    named = told.withColumn("is_stop", F.coalesce(F.col("first") & lasts(params), F.lit(False)))
    return (
        named.where("is_stop OR is_open")
        .withColumn("stop_events", F.sum(F.col("is_stop").cast("bigint")).over(so_far))
        .withColumnRenamed("event_id", "stop_id")
    )


def crowded_open(crowded: DataFrame, params: StopParams, rows_per_chunk: int) -> DataFrame:
    """What devices too large for one task leave open, by chunks of their time line."""
    runs = runs_by_chunk(crowded, params, rows_per_chunk)
    ends = stage(runs.groupBy(DEVICE).agg(*[c.alias(n) for c, n in marks()]), "crowded-ends")
    few = F.broadcast(ends) if ends.count() <= MAX_HOT_KEYS else ends
    return with_open(runs.join(few, DEVICE)).where("is_open").select(*OPEN_COLUMNS)
