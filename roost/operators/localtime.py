"""Local time: clustered stops to localized stops.

Every stop gets the timezone of the polygon it lies in, or the country's
default, and the calendar fields of its start and end there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roost.functions.clock import is_weekend, local_datetime, round_to_bigint, weekday
from roost.operators.cover import MAX_BROADCAST_EDGES, zones_at
from roost.schemas import CLUSTERED, LOCAL
from roost.sources.tables import scan_tz_lookup


def localize_stops(
    clustered: DataFrame,
    tz_codes: DataFrame,
    country: str,
    default_tz: str,
    one_tz: str | None = None,
    max_broadcast_edges: int = MAX_BROADCAST_EDGES,
) -> DataFrame:
    """Stops with timezone and local calendar fields.

    Where polygons overlap a stop appears once per polygon; ``one_tz="min"``
    keeps the alphabetically first zone instead.
    """
    stops = whole_seconds(clustered)
    if one_tz not in (None, "min"):
        raise ValueError("one_tz is None or 'min'")
    zoned = with_timezone(stops, scan_tz_lookup(tz_codes, country), max_broadcast_edges, one_tz)
    return with_local_fields(zoned, default_tz)


def whole_seconds(clustered: DataFrame) -> DataFrame:
    times = ("start_timestamp", "end_timestamp", "stop_duration")
    return clustered.select(
        *[round_to_bigint(c).alias(c) if c in times else F.col(c) for c in CLUSTERED.fieldNames()]
    )


# --- timezone of a position -----------------------------------------------------


def with_timezone(
    stops: DataFrame,
    lookup: DataFrame,
    max_broadcast_edges: int = MAX_BROADCAST_EDGES,
    one_tz: str | None = None,
) -> DataFrame:
    """Add the timezone of each polygon that contains the stop, or NULL; ``one_tz="min"``: of the first by name."""
    turn = F.xxhash64("uid", "stop_event", "start_timestamp")
    found = zones_at(stops, "stop_latitude", "stop_longitude", lookup, turn, max_broadcast_edges)
    zone = F.array_min("zones") if one_tz else F.explode_outer("zones")
    return found.select(*stops.columns, zone.alias("timezone"))


# --- calendar fields --------------------------------------------------------------


def with_local_fields(zoned: DataFrame, default_tz: str) -> DataFrame:
    """Calendar fields of the local start and end time."""
    zone = F.coalesce("timezone", F.lit(default_tz))
    start, end = F.col("stop_datetime"), F.col("end_stop_datetime")
    return (
        zoned.withColumn("inputed_timezone", zone)
        .withColumn("stop_datetime", local_datetime("start_timestamp", F.col("inputed_timezone")))
        .withColumn("end_stop_datetime", local_datetime("end_timestamp", F.col("inputed_timezone")))
        .withColumns(
            {
                "date": F.to_date(start),
                "year": F.year(start).cast("bigint"),
                "month": F.month(start).cast("bigint"),
                "day": F.dayofmonth(start).cast("bigint"),
                "hour": F.hour(start).cast("bigint"),
                "weekday": weekday(start),
                # A weekday that is not known counts as no weekend.
                "weekend": F.coalesce(is_weekend(start), F.lit(False)),
                "end_date": F.to_date(end),
            }
        )
        .select(*LOCAL.fieldNames())
    )
