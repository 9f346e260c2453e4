"""Stop detection: pings to stops.

A ping is *stationary* if the device's next ping is near in space and time.
Unbroken runs of stationary pings that last long enough become stops, after
pings far from the run's median position are trimmed and the duration is
checked again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roost.functions.geo import haversine_m
from roost.operators.selection import middle_of, middle_values
from roost.operators.skew import (
    CHUNK_ROWS,
    by_key,
    key_sizes,
    number_rows,
    offsets_before,
    range_chunks,
    split_hot,
)
from roost.params import StopParams
from roost.sources.stage import stage

DEVICE = "device_id"
PING = ["device_id", "latitude", "longitude", "timestamp"]
ORDER = ["timestamp", "latitude", "longitude"]

# Pings of one device that a single task may sort, and pings a task should get.
MAX_DEVICE_PINGS = 5_000_000
PINGS_PER_TASK = 500_000


def detect_stops(
    pings: DataFrame,
    params: StopParams = StopParams(),
    max_device_pings: int = MAX_DEVICE_PINGS,
    rows_per_chunk: int = CHUNK_ROWS,
    valid_coords: bool = False,
) -> DataFrame:
    """Stops per device, numbered by start time.

    Ordinary devices take one shuffle by device, which serves the dedup, all
    windows and both aggregates. Devices with more than ``max_device_pings``
    are cut into chunks of their time line and take a plan of joins instead.
    ``valid_coords`` drops pings whose position is off the globe.
    """
    if valid_coords:
        pings = pings.where(F.col("latitude").between(-90.0, 90.0) & F.col("longitude").between(-180.0, 180.0))
    ordinary, crowded, total = by_device_size(pings, max_device_pings)
    stops = stops_by_device(by_key(ordinary, DEVICE, total, PINGS_PER_TASK), params)
    if crowded is None:
        return stops
    return stops.unionByName(stops_by_chunk(crowded, params, rows_per_chunk))


def ping_runs(
    pings: DataFrame,
    params: StopParams = StopParams(),
    max_device_pings: int = MAX_DEVICE_PINGS,
    rows_per_chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """All distinct pings with the next ping, ``stationary``, ``event_start`` and ``event_id``."""
    ordinary, crowded, total = by_device_size(pings, max_device_pings)
    runs = with_runs(by_key(ordinary, DEVICE, total, PINGS_PER_TASK), [DEVICE], params)
    if crowded is None:
        return runs
    return runs.unionByName(runs_by_chunk(crowded, params, rows_per_chunk).drop("chunk"))


def by_device_size(pings: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None, int]:
    """(pings of ordinary devices, pings of crowded devices or None, number of pings)."""
    # A ping without a device belongs to no one's time line and makes no stop.
    pings = pings.select(*PING).where(F.col(DEVICE).isNotNull())
    total, largest, hot = key_sizes(pings, DEVICE, limit)
    if largest <= limit:
        return pings, None, total
    return *split_hot(pings, DEVICE, hot), total


# --- expressions shared by both plans ----------------------------------------


def with_next(points: DataFrame, keys: list[str]) -> DataFrame:
    """Add the next ping's position and time, and drop exact copies.

    Copies are neighbours in this order; the last of them is kept, as it is the
    one whose next ping is another. So the dedup needs no pass of its own.
    """
    w = Window.partitionBy(*keys).orderBy(*ORDER)
    ahead = points.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in ORDER])
    copy = F.lit(True)
    for c in ORDER:
        copy = copy & F.col(c).eqNullSafe(F.col(f"next_{c}"))
    return ahead.where(~copy)


def distance_to_next() -> Column:
    return haversine_m("latitude", "longitude", "next_latitude", "next_longitude")


def gap_to_next_s() -> Column:
    return (F.col("next_timestamp") - F.col("timestamp")) / 1000


def stationary_flag(params: StopParams) -> Column:
    """Three-valued: NULL where the distance to the next ping is unknown."""
    distance, gap_s = distance_to_next(), gap_to_next_s()
    return (distance <= F.lit(params.distance_threshold)) & (
        (gap_s <= F.lit(params.time_threshold)) | gap_s.isNull()
    )


def with_runs(points: DataFrame, keys: list[str], params: StopParams, counts: Column | None = None) -> DataFrame:
    """Add ``stationary`` and the run number ``event_id``; one sort serves all windows.

    Rows where ``counts`` is false start no run of their own.
    """
    w = Window.partitionBy(*keys).orderBy(*ORDER)
    starts = F.col("stationary") & ~F.coalesce(F.lag("stationary").over(w), F.lit(False))
    if counts is not None:
        starts = starts & counts
    return (
        with_next(points, keys)
        .withColumn("stationary", stationary_flag(params))
        .withColumn("event_start", F.when(starts, 1).otherwise(0))
        .withColumn(
            "event_id",
            F.sum("event_start").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        )
    )


def run_bounds() -> list[Column]:
    return [F.min("timestamp").alias("start_timestamp"), F.max("timestamp").alias("end_timestamp")]


def lasts(params: StopParams) -> Column:
    return F.col("end_timestamp") - F.col("start_timestamp") >= F.lit(params.min_stop_duration)


def near_median(params: StopParams) -> Column:
    return haversine_m("latitude", "longitude", "median_latitude", "median_longitude") <= F.lit(
        params.distance_threshold
    )


STOP_COLUMNS = [
    "device_id", "stop_id", "start_timestamp", "end_timestamp",
    "median_latitude", "median_longitude", "stop_events",
]


# --- plan for ordinary devices ------------------------------------------------


def stops_by_device(pings: DataFrame, params: StopParams) -> DataFrame:
    """Stops of pings that are partitioned by device; no further shuffle.

    Both summaries are windows over one sort by run, and of each run's rows the
    first stays: an aggregate would sort and copy the rows once more.
    """
    runs = with_runs(pings, [DEVICE], params).where("stationary").select(*PING, "event_id")
    w = Window.partitionBy(DEVICE, "event_id")
    summary = [c.over(w).alias(n) for c, n in _window_summary()]
    kept = (
        runs.select(*PING, "event_id", *summary)
        .where(lasts(params) & near_median(params))
        .select(*PING, "event_id")
    )
    # A run comes as a whole before the next one, so its number orders stops as their start does.
    in_turn = Window.partitionBy(DEVICE).orderBy("event_id")
    first = ~F.col("event_id").eqNullSafe(F.lag("event_id").over(in_turn))
    stops = kept.select(DEVICE, "event_id", *summary, first.alias("first")).where(lasts(params) & F.col("first"))
    number = F.row_number().over(in_turn).cast("bigint").alias("stop_events")
    return stops.select("*", number).withColumnRenamed("event_id", "stop_id").select(*STOP_COLUMNS)


def _window_summary() -> list[tuple[Column, str]]:
    return [
        (F.min("timestamp"), "start_timestamp"),
        (F.max("timestamp"), "end_timestamp"),
        (middle_of("latitude"), "median_latitude"),
        (middle_of("longitude"), "median_longitude"),
    ]


# --- plan for devices too large for one task ----------------------------------


def runs_by_chunk(pings: DataFrame, params: StopParams, rows_per_chunk: int = CHUNK_ROWS) -> DataFrame:
    """The same runs, with a device's time line spread over many tasks; staged.

    Chunks are even slices of (device, time, place). Each gets a copy of the
    ping before and the ping after it, which is all its windows need to know
    about the outside; run numbers continue across chunks by a prefix sum over
    chunk counts.
    """
    key = [DEVICE, "chunk"]
    points = range_chunks(pings.distinct(), [DEVICE] + ORDER, rows_per_chunk)
    own = points.withColumn("own", F.lit(True))
    flagged = with_runs(own.unionByName(_neighbour_pings(points)), key, params, counts=F.col("own"))
    local = stage(flagged.where("own").drop("own"), "chunk-runs")
    # A chunk's number 0 continues the last run of the chunks before it.
    counts = local.groupBy(*key).agg(F.sum("event_start").alias("n"))
    numbered = local.join(offsets_before(counts, [DEVICE], "n"), key)
    return stage(
        numbered.withColumn("event_id", F.col("event_id") + F.col("offset")).select(*local.columns), "runs"
    )


def stops_by_chunk(pings: DataFrame, params: StopParams, rows_per_chunk: int = CHUNK_ROWS) -> DataFrame:
    """The same stops from chunked runs.

    A run may cover any number of chunks; its bounds are partial aggregates,
    its medians come from counts of values, and its summary travels back to the
    chunks it covers, so no join key holds more than a
    chunk's pings.
    """
    run = [DEVICE, "event_id"]

    points = runs_by_chunk(pings, params, rows_per_chunk).where("stationary").select(*PING, "chunk", "event_id")
    first = summarise_runs(points, params, rows_per_chunk)
    pieces = points.select(*run, "chunk").distinct().join(first, run)
    kept = points.join(pieces, run + ["chunk"]).where(near_median(params)).select(*PING, "event_id")
    stops = summarise_runs(kept, params, rows_per_chunk).withColumnRenamed("event_id", "stop_id")
    return number_rows(
        stops, [DEVICE], ["start_timestamp", "stop_id"], "stop_events", rows_per_chunk
    ).select(*STOP_COLUMNS)


def summarise_runs(points: DataFrame, params: StopParams, rows_per_chunk: int = CHUNK_ROWS) -> DataFrame:
    """Bounds and median position of the runs that last; a run may hold most of the pings."""
    run = [DEVICE, "event_id"]
    points = stage(points.select(*PING, "event_id"), "run-pings")
    bounds = stage(points.groupBy(*run).agg(*run_bounds(), F.count("*").alias("n")), "run-bounds")
    medians = middle_values(points, run, ["latitude", "longitude"], limit=rows_per_chunk, sizes=bounds)
    named = medians.withColumnsRenamed({"latitude": "median_latitude", "longitude": "median_longitude"})
    return bounds.where(lasts(params)).drop("n").join(named, run)


def _neighbour_pings(points: DataFrame) -> DataFrame:
    """For each device and chunk: the device's ping just before and just after it."""
    at = F.struct(*ORDER)
    edges = points.groupBy(DEVICE, "chunk").agg(F.min(at).alias("head"), F.max(at).alias("tail"))
    w = Window.partitionBy(DEVICE).orderBy("chunk")  # one row per chunk
    around = F.array(F.lag("tail").over(w), F.lead("head").over(w))
    return (
        edges.withColumn("around", around)
        .select(DEVICE, "chunk", F.explode("around").alias("p"))
        .where(F.col("p").isNotNull())
        .select(DEVICE, "p.*", "chunk", F.lit(False).alias("own"))
    )
