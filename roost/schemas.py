"""Explicit schemas of the stored tables, one per step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES = {
    "string": StringType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp_ntz": TimestampNTZType(),
}


def _columns(text: str) -> StructType:
    """Columns of simple types; needs no running session, unlike Spark's own parser."""
    pairs = (c.split() for c in text.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


PINGS = _columns(
    "device_id string, latitude double, longitude double, timestamp bigint"
)

CARRY = _columns(
    "device_id string, latitude double, longitude double, timestamp bigint, "
    "run_base bigint, stop_base bigint"
)

STOPS = _columns(
    "device_id string, stop_id bigint, start_timestamp bigint, end_timestamp bigint, "
    "median_latitude double, median_longitude double, stop_events bigint"
)

CLUSTERED = _columns(
    "uid string, stop_event bigint, start_timestamp double, end_timestamp double, "
    "stop_duration double, stop_latitude double, stop_longitude double, "
    "cluster_label bigint, cluster_counts bigint, "
    "cluster_latitude double, cluster_longitude double"
)

TZ_CODES = _columns("country_code string, tz string, geometry string")

LOCAL = _columns(
    "uid string, stop_event bigint, start_timestamp bigint, end_timestamp bigint, "
    "stop_duration bigint, stop_latitude double, stop_longitude double, "
    "cluster_label bigint, cluster_counts bigint, "
    "cluster_latitude double, cluster_longitude double, "
    "timezone string, inputed_timezone string, "
    "stop_datetime timestamp_ntz, end_stop_datetime timestamp_ntz, "
    "date date, year bigint, month bigint, day bigint, hour bigint, "
    "weekday bigint, weekend boolean, end_date date"
)

HW = StructType(LOCAL.fields + _columns("location_type string, location_label bigint").fields)

PAIRS = _columns(
    "uid string, home_latitude double, home_longitude double, "
    "work_latitude double, work_longitude double, year bigint"
)

# The per-country parameter document: {"countries": {"CO": {...}, ...}}.
CONFIG_DDL = (
    "countries map<string, struct<"
    "timezone: string, "
    "stops: struct<distance_threshold: double, time_threshold: double, min_stop_duration: bigint>, "
    "dbscan: struct<distance: double, min_points: int>, "
    "home_work: struct<home_min_days: int, home_hour_evening: int, home_hour_morning: int, "
    "work_min_days: int, work_hour_start: int, work_hour_end: int, min_distance_home_work: double>>>"
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns in order; fail on a missing column or another type."""
    found = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, found "
        f"{found[f.name].simpleString() if f.name in found else 'nothing'}"
        for f in schema.fields
        if found.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError("table does not have the expected columns: " + "; ".join(wrong))
    return df.select(*schema.fieldNames())
