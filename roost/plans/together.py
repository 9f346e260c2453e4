"""One run over many countries: parameters are columns, and no step runs once per country.

A device's key starts with its country, so equal names in two countries stay apart and
every row can look its country's parameters up. Tables are partitioned by country, stops
by year too; a run replaces the partitions it computes and leaves the others.

    <root>/pings/<country>/<year>/                                   read
    <root>/together/stops/country=<country>/src_year=<year>/         written and read
    <root>/together/{clustered,local,hw}/country=<country>/          written
"""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roost import schemas
from roost.operators.clusters import cluster_stops
from roost.operators.cover import MAX_BROADCAST_EDGES, zones_at
from roost.operators.homework import classify_home_work
from roost.operators.localtime import whole_seconds, with_local_fields
from roost.operators.stops import detect_stops
from roost.params import ClusterParams, CountryParams, HomeWorkParams, StopParams, country_params
from roost.sources import tables
from roost.sources.stage import discard, stage

MARK = "|"


def keyed(country: str, name: str) -> Column:
    return F.concat(F.col(country), F.lit(MARK), F.col(name))


def country_of(key: str) -> Column:
    return F.substring_index(key, MARK, 1)


def name_in(key: str) -> Column:
    return F.col(key).substr(F.length(country_of(key)) + F.lit(len(MARK) + 1), F.length(key))


def told_apart(df: DataFrame, key: str) -> DataFrame:
    """The country as a column of its own, the device under its own name again."""
    return df.withColumn("country", country_of(key)).withColumn(key, name_in(key))


def params_by_key(settings: dict[str, CountryParams], key: str) -> CountryParams:
    """Parameters whose values are columns: those of the country that ``key`` starts with.

    The lookup is a constant map with an entry for each configured country.
    """

    def value(of) -> Column:
        entries = [F.lit(x) for country, p in settings.items() for x in (country, of(p))]
        return F.element_at(F.create_map(*entries), country_of(key))

    def group(cls, part: str):
        return cls(**{f.name: value(lambda p, f=f: getattr(getattr(p, part), f.name)) for f in fields(cls)})

    return CountryParams(
        value(lambda p: p.timezone), group(StopParams, "stops"), group(ClusterParams, "dbscan"), group(HomeWorkParams, "home_work")
    )


def localize_together(
    clustered: DataFrame, tz_codes: DataFrame, default_tz: Column, max_broadcast_edges: int = MAX_BROADCAST_EDGES
) -> DataFrame:
    """``localize_stops`` of keyed devices: a stop takes zones of its own country's polygons only."""
    lookup = tz_codes.withColumn("tz", keyed("country_code", "tz"))
    stops = whole_seconds(clustered)
    turn = F.xxhash64("uid", "stop_event", "start_timestamp")
    found = zones_at(stops, "stop_latitude", "stop_longitude", lookup, turn, max_broadcast_edges)
    home = F.concat(country_of("uid"), F.lit(MARK))
    own = F.filter("zones", lambda z: F.startswith(z, home))
    names = F.transform(own, lambda z: z.substr(F.length(home) + F.lit(1), F.length(z)))
    return with_local_fields(found.select(*stops.columns, F.explode_outer(names).alias("timezone")), default_tz)


def scan_pings_of(spark: SparkSession, root: str, countries: list[str], year: int) -> DataFrame:
    """Pings of several countries with their ``country``, which the folder names."""
    found = spark.read.parquet(*[f"{root}/pings/{c}/{year}" for c in countries])
    country = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/\d+/[^/]*$", 1)
    schema = schemas.StructType([*schemas.PINGS.fields, schemas.StructField("country", schemas.StringType())])
    return schemas.conform(found.select("*", country.alias("country")), schema)


def sink_partitions(df: DataFrame, path: str, by: list[str], countries: list[str]) -> DataFrame:
    """Replace the partitions that ``df`` has rows of; read back those of ``countries`` only."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
    writer.partitionBy(*by).parquet(path)
    return scan_partitions(df.sparkSession, path, countries)


def scan_partitions(spark: SparkSession, path: str, countries: list[str]) -> DataFrame:
    return spark.read.parquet(path).where(F.col("country").isin(*countries))


def run_together(
    spark: SparkSession,
    root: str,
    countries: tuple[str, ...],
    year: int,
    config_json: str | None = None,
    dedup_keys: tuple[str, ...] = ("uid", "stop_event"),
    max_device_rows: dict[str, int] | None = None,
) -> DataFrame:
    """All steps for all ``countries`` in one run; the labelled stops with their ``country``.

    The same rows as ``run_steps`` for each country with its own parameters, but
    for stops of other years: those come from this run's own tables. An unknown
    country or a missing key is an error before any work. ``max_device_rows``
    overrides the steps' limits for crowded devices.
    """
    names = list(dict.fromkeys(countries))
    settings = {c: country_params(c, config_json) for c in names}
    if any(MARK in c for c in names):
        raise ValueError(f"a country's name has no {MARK}")
    limits = max_device_rows or {}
    base = f"{root}/together"
    of_device, of_uid = params_by_key(settings, "device_id"), params_by_key(settings, "uid")

    pings = scan_pings_of(spark, root, names, year).withColumn("device_id", keyed("country", "device_id"))
    stops = told_apart(detect_stops(pings, of_device.stops, **limits.get("stops", {})), "device_id")
    stops = stops.withColumn("src_year", F.lit(year)).sortWithinPartitions("country", "device_id", "stop_events")
    stops = sink_partitions(stops, f"{base}/stops", ["country", "src_year"], names)

    keys = stops.withColumn("device_id", keyed("country", "device_id"))
    clustered = cluster_stops(keys, of_device.dbscan, dedup_keys, **limits.get("cluster", {}))
    clustered = told_apart(clustered.select(*schemas.CLUSTERED.fieldNames()), "uid")
    clustered = _in_order(clustered, f"{base}/clustered", names, "country", "uid", "cluster_label", "start_timestamp")

    tz_codes = tables.scan(spark, f"{root}/tz_codes", schemas.TZ_CODES).where(F.col("country_code").isin(*names))
    local = localize_together(clustered.withColumn("uid", keyed("country", "uid")), tz_codes, of_uid.timezone)
    local = sink_partitions(told_apart(local, "uid"), f"{base}/local", ["country"], names)

    hw = classify_home_work(local.withColumn("uid", keyed("country", "uid")), of_uid.home_work)
    return _in_order(told_apart(hw, "uid"), f"{base}/hw", names, "country", "uid", "year", "date", "start_timestamp")


def _in_order(df: DataFrame, path: str, countries: list[str], *order: str) -> DataFrame:
    """Store by country, in order inside each; the step runs once, the sampling reads its staged rows."""
    staged = stage(df, "unsorted")
    ranged = staged.repartitionByRange(*order).sortWithinPartitions(*order)
    out = sink_partitions(ranged, path, ["country"], countries)
    discard(staged)
    return out
