"""Extraction: labelled stops to one home/work pair per device and year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roost.schemas import PAIRS


def extract_home_work(hw: DataFrame, keep_unmatched: bool = False, limit: int | None = None) -> DataFrame:
    """Home and work position of each device and year, in that order.

    Only devices with both places, unless ``keep_unmatched`` asks for every
    home. ``limit`` keeps that many rows, the first by device and year.
    """
    pairs = home_work_pairs(hw)
    if not keep_unmatched:
        pairs = pairs.where(F.col("home_latitude").isNotNull() & F.col("work_latitude").isNotNull())
    pairs = pairs.orderBy("uid", "year")
    return pairs if limit is None else pairs.limit(limit)


def distinct_places(hw: DataFrame, letter: str, name: str) -> DataFrame:
    return (
        hw.where(F.col("location_type") == F.lit(letter))
        .select(
            "uid",
            "year",
            F.col("cluster_latitude").alias(f"{name}_latitude"),
            F.col("cluster_longitude").alias(f"{name}_longitude"),
        )
        .distinct()
    )


def home_work_pairs(hw: DataFrame) -> DataFrame:
    homes = distinct_places(hw, "H", "home").where(F.col("uid").isNotNull())
    works = distinct_places(hw, "W", "work")
    return homes.join(works, ["uid", "year"], "left").select(*PAIRS.fieldNames())
