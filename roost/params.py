"""Parameters of the steps, and the per-country table that holds them."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roost.schemas import CONFIG_DDL


@dataclass(frozen=True)
class StopParams:
    distance_threshold: float = 20.0  # metres between consecutive pings
    time_threshold: float = 3600.0  # seconds between consecutive pings
    min_stop_duration: int = 300_000  # milliseconds


@dataclass(frozen=True)
class ClusterParams:
    distance: float = 20.0  # metres
    min_points: int = 2


@dataclass(frozen=True)
class HomeWorkParams:
    home_min_days: int = 14
    home_hour_evening: int = 19
    home_hour_morning: int = 8
    work_min_days: int = 8
    work_hour_start: int = 9
    work_hour_end: int = 18  # the whole hour counts
    min_distance_home_work: float = 50.0  # metres


@dataclass(frozen=True)
class CountryParams:
    timezone: str
    stops: StopParams = field(default_factory=StopParams)
    dbscan: ClusterParams = field(default_factory=ClusterParams)
    home_work: HomeWorkParams = field(default_factory=HomeWorkParams)


# The shipped country settings.
COUNTRIES = {
    "AR": CountryParams("America/Argentina/Buenos_Aires"),
    "BR": CountryParams("America/Sao_Paulo"),
    "CO": CountryParams("America/Bogota", home_work=HomeWorkParams(home_min_days=2, work_min_days=2)),
    "MX": CountryParams("America/Mexico_City"),
}


def default_config_json() -> str:
    return json.dumps({"countries": {code: asdict(p) for code, p in COUNTRIES.items()}})


def country_params(country: str, config_json: str | None = None) -> CountryParams:
    """One country's parameters. An unknown country or a missing key is an error."""
    try:
        raw = json.loads(config_json or default_config_json())["countries"][country]
        return CountryParams(
            timezone=raw["timezone"],
            stops=_complete(StopParams, raw["stops"]),
            dbscan=_complete(ClusterParams, raw["dbscan"]),
            home_work=_complete(HomeWorkParams, raw["home_work"]),
        )
    except KeyError as e:
        raise KeyError(f"no parameter {e} for country {country!r}") from None


def _complete(cls, raw: dict):
    return cls(**{name: raw[name] for name in cls.__dataclass_fields__})


def params_table(spark: SparkSession, config_json: str | None = None) -> DataFrame:
    """One row per configured country, for joining thresholds to data of many countries.

    A config has one entry per country of the world at most, so callers may
    broadcast it.
    """
    text = spark.range(1).select(F.lit(config_json or default_config_json()).alias("doc"))
    return text.select(
        F.explode(F.from_json("doc", CONFIG_DDL)["countries"]).alias("country", "p")
    ).select(
        "country",
        F.col("p.timezone").alias("default_timezone"),
        "p.stops.*",
        F.col("p.dbscan.distance").alias("dbscan_distance"),
        F.col("p.dbscan.min_points").alias("dbscan_min_points"),
        "p.home_work.*",
    )
