"""Local time of an epoch second in a zone given per row.

The instant is built without a session time zone, so the result does not
depend on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to_bigint(c) -> Column:
    """Nearest integer, halves away from zero (a bare cast would truncate)."""
    return F.round(c).cast("bigint")


def utc_datetime(seconds: str) -> Column:
    return F.expr(
        f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds})"
    )


def local_datetime(seconds: str, zone) -> Column:
    """Wall-clock time (no zone) of an epoch second; an unknown zone is an error."""
    return F.convert_timezone(F.lit("UTC"), zone, utc_datetime(seconds))


def weekday(c) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(c).cast("bigint")


def is_weekend(c) -> Column:
    return F.dayofweek(c).isin(1, 7)
