"""All steps for a country, each step's table stored before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roost.operators.carried import detect_stops_after, stops_still_open
from roost.operators.clusters import cluster_stops
from roost.operators.homework import classify_home_work
from roost.operators.localtime import localize_stops
from roost.operators.stops import detect_stops
from roost.params import CountryParams, country_params
from roost.schemas import CLUSTERED, TZ_CODES
from roost.sources import tables
from roost.sources.stage import discard, stage

STEPS = ("stops", "cluster", "local", "hw")


def run_steps(
    spark: SparkSession,
    root: str,
    country: str,
    year: int,
    params: CountryParams | None = None,
    timezone: str | None = None,
    steps: tuple[str, ...] = STEPS,
    dedup_keys: tuple[str, ...] = ("uid", "stop_event"),
    config_json: str | None = None,
    database: str | None = None,
    carried: bool = False,
    previous: int | None = None,
) -> DataFrame:
    """Run the chosen steps and return the last one's table (the labelled stops).

    A step left out is read from its stored table where the next one needs it.
    An explicit ``timezone`` or ``params`` wins over the settings of
    ``config_json``, those over the shipped ones. With a ``database`` the
    localized and the labelled stops get names there: ``<country>_local`` and
    ``<country>_hw``.

    ``carried``: stays go on from the export of the year ``previous`` (None for
    the first one), and stop numbers with them; what is open at the end of
    ``year`` counts as it stands. A later year needs this year's carry, and
    replaces what was open.

    Files of stops are by device, each in order; those of clustered and
    labelled stops are in order as a whole.
    """
    unknown = set(steps) - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    params = params or country_params(country, config_json)
    zone = timezone or params.timezone

    result = None
    if "stops" in steps:
        pings = tables.scan_pings(spark, root, country, year)
        path = f"{root}/stops/{country}/{year}"
        if carried:
            stops = carried_stops(spark, pings, root, country, year, previous, params)
        else:
            stops = detect_stops(pings, params.stops)
        result = tables.sink_clustered(stops, path, "device_id", "stop_events")
    if "cluster" in steps:
        stops = tables.scan_stops_all_years(spark, root, country, year if carried else None)
        clustered = cluster_stops(stops, params.dbscan, dedup_keys).select(*CLUSTERED.fieldNames())
        path = f"{root}/clustered/{country}"
        result = in_order(clustered, path, "uid", "cluster_label", "start_timestamp")
    if "local" in steps:
        clustered = tables.scan_clusters(spark, root, country)
        tz_codes = tables.scan(spark, f"{root}/tz_codes", TZ_CODES)
        local = localize_stops(clustered, tz_codes, country, zone)
        result = tables.sink_parquet(local, f"{root}/local/{country}")
        if database:
            tables.name_table(spark, f"{database}.{country}_local", f"{root}/local/{country}")
    if "hw" in steps:
        hw = classify_home_work(tables.scan_local(spark, root, country), params.home_work)
        path = f"{root}/hw/{country}"
        result = in_order(hw, path, "uid", "year", "date", "start_timestamp")
        if database:
            tables.name_table(spark, f"{database}.{country}_hw", path)
    return tables.scan_hw(spark, root, country) if result is None else result


def carried_stops(
    spark: SparkSession, pings: DataFrame, root: str, country: str, year: int, previous: int | None, params: CountryParams
) -> DataFrame:
    """The stops that end in this export; what it leaves open is stored."""
    if previous is not None and previous >= year:
        raise ValueError(f"year {previous} does not come before {year}")
    before = None if previous is None else tables.scan_carry(spark, root, country, previous)
    stops, carry = detect_stops_after(pings, before, params.stops)
    carry = tables.sink_parquet(carry, f"{root}/carry/{country}/{year}")
    tables.sink_parquet(stops_still_open(carry, params.stops), f"{root}/open_stops/{country}/{year}")
    return stops


def in_order(df: DataFrame, path: str, *order: str) -> DataFrame:
    """Store in global order; the step runs once, the sampling reads its staged rows."""
    staged = stage(df, "unsorted")
    out = tables.sink_sorted(staged, path, *order)
    discard(staged)
    return out


def run_countries(
    spark: SparkSession, root: str, countries: tuple[str, ...], year: int, config_json: str | None = None, **options
) -> dict[str, DataFrame]:
    """The full run for several countries, each with its own parameters of the configuration."""
    settings = {c: country_params(c, config_json) for c in countries}  # a missing country is found before any work
    return {c: run_steps(spark, root, c, year, params, **options) for c, params in settings.items()}
