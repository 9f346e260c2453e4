"""Spatial clustering: stops to clustered stops.

Each device's stops are clustered by density, clusters get numbers that depend
on their mean position only, and every stop receives its cluster's size and
median position.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from roost.operators.density import NOISE, label_pack
from roost.operators.density_spread import spread_labels
from roost.operators.selection import middle_values
from roost.operators.skew import CHUNK_ROWS, by_key, key_sizes, number_rows, split_hot, spread_join
from roost.params import ClusterParams
from roost.schemas import CLUSTERED
from roost.sources.ship import ship_package
from roost.sources.stage import stage

DEVICE = "device_id"
LAT, LON = "median_latitude", "median_longitude"
RAW = "raw_cluster_label"

# Stops of one device that a single task may cluster; stops per pack; stops per
# task of the statistics.
MAX_DEVICE_STOPS = 200_000
PACK_STOPS = 50_000
STOPS_PER_TASK = 250_000


def cluster_stops(
    stops: DataFrame,
    params: ClusterParams = ClusterParams(),
    dedup_keys: tuple[str, ...] = ("uid", "stop_event"),
    max_device_stops: int = MAX_DEVICE_STOPS,
    rows_per_chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """Stops with cluster label, size and position; one row per ``dedup_keys``.

    Stop numbers restart with each year's export. By default a later year's
    equal number is dropped; add ``src_year`` to the keys to keep it.

    Pass a stored table: a first look at device sizes reads it once more.
    """
    extra = [k for k in dedup_keys if k not in CLUSTERED.fieldNames()]
    stops = with_seconds(stops, extra)
    owned = F.col(DEVICE).isNotNull()
    total, largest, hot = key_sizes(stops.where(owned), DEVICE, max_device_stops)

    # A key's rows may lie on both sides of "has a place", never on both sides
    # of a device: parts are by device, so that the dedup sees whole keys.
    parts = []
    ordinary = stops.where(owned)
    if largest > max_device_stops:
        ordinary, crowded = split_hot(ordinary, DEVICE, hot)
        labelled = label_spread(crowded.where(placed_stop()), params, rows_per_chunk)
        unplaced = crowded.where(~placed_stop()).withColumn(RAW, F.lit(NOISE).cast("bigint"))
        parts.append(stats_by_join(labelled.unionByName(unplaced), extra, rows_per_chunk))
    # One shuffle by device serves all windows and the dedup below; left to
    # themselves the windows would shuffle once for each set of keys.
    labelled = by_key(label_by_pack(ordinary, params, total), DEVICE, total, STOPS_PER_TASK)
    parts.append(stats_by_device(labelled, extra))
    if not stops.where(~owned).isEmpty():
        # Stops without a device are never clustered; their keys spread them.
        parts.append(clustered_columns(stops.where(~owned), F.lit(NOISE), F.lit(1), F.col(LAT), F.col(LON), extra))
    result = [first_per_key(p, dedup_keys).select(*CLUSTERED.fieldNames(), *extra) for p in parts]
    out = result[0]
    for r in result[1:]:
        out = out.unionByName(r)
    return out


def with_seconds(stops: DataFrame, extra: list[str] = ()) -> DataFrame:
    return stops.select(
        DEVICE,
        "stop_events",
        (F.col("start_timestamp") / 1000).alias("start_timestamp"),
        (F.col("end_timestamp") / 1000).alias("end_timestamp"),
        LAT,
        LON,
        *extra,
    )


def placed_stop() -> Column:
    known = F.col(DEVICE).isNotNull() & F.col(LAT).isNotNull() & F.col(LON).isNotNull()
    return known & ~F.isnan(LAT) & ~F.isnan(LON)


# --- labels -------------------------------------------------------------------


def label_stops(
    stops: DataFrame,
    params: ClusterParams = ClusterParams(),
    max_device_stops: int = MAX_DEVICE_STOPS,
    rows_per_chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """Add a raw cluster number per device (-1 for noise) to stops that have a place."""
    stops = stops.where(placed_stop())
    total, largest, hot = key_sizes(stops, DEVICE, max_device_stops)
    if largest <= max_device_stops:
        return label_by_pack(stops, params, total)
    ordinary, crowded = split_hot(stops, DEVICE, hot)
    return label_by_pack(ordinary, params, total).unionByName(label_spread(crowded, params, rows_per_chunk))


def label_spread(crowded: DataFrame, params: ClusterParams, rows_per_chunk: int = CHUNK_ROWS) -> DataFrame:
    """Labels of crowded devices. Where the parameters are columns, devices of equal parameters go together.

    Columns hold at most as many different settings as there are configured countries.
    """
    if not isinstance(params.distance, Column):
        return spread_labels(crowded, params.distance, params.min_points, rows_per_chunk)
    settings = [F.lit(params.distance).alias("eps"), F.lit(params.min_points).alias("least")]
    out = None
    for eps, least in crowded.select(*settings).distinct().collect():
        own = crowded.where((params.distance == eps) & (params.min_points == least))
        labelled = spread_labels(own, eps, least, rows_per_chunk)
        out = labelled if out is None else out.unionByName(labelled)
    return out if out is not None else crowded.withColumn(RAW, F.lit(NOISE).cast("bigint"))


def label_by_pack(stops: DataFrame, params: ClusterParams, total: int) -> DataFrame:
    """Add a raw cluster number per device, clustering many devices per Python call.

    Stops without a position are noise.
    The parameters may be columns that are equal within a device. A pack is a hash slice of the devices with about PACK_STOPS stops, so the
    call overhead does not grow with the number of devices.
    """
    ship_package(stops.sparkSession)
    packs = max(-(-total // PACK_STOPS), stops.sparkSession.sparkContext.defaultParallelism)
    schema = StructType([*stops.schema.fields, StructField(RAW, LongType())])
    # Of columns, each device's own values; equal ones share a call.
    by_device = isinstance(params.distance, Column)
    settings = {"_eps": params.distance, "_least": params.min_points} if by_device else {}
    added = ["pack", *settings]
    eps_m, min_points = (None, None) if by_device else (params.distance, params.min_points)

    def label(pdf):
        placed = pdf[[LAT, LON]].notna().all(axis=1).to_numpy()
        labels = np.full(len(pdf), NOISE, dtype=np.int64)
        if not by_device:
            if placed.any():
                labels[placed] = label_pack(pdf[placed], eps_m, min_points)
        else:
            for (eps, least), rows in pdf.groupby(["_eps", "_least"]).indices.items():
                rows = rows[placed[rows]]
                if len(rows):
                    labels[rows] = label_pack(pdf.iloc[rows], eps, least)
        return pdf.drop(columns=added).assign(**{RAW: labels})

    return (
        stops.withColumns({"pack": F.pmod(F.xxhash64(DEVICE), F.lit(packs)), **settings})
        .groupBy("pack")
        .applyInPandas(label, schema)
    )


# --- statistics -----------------------------------------------------------------


def clustered_columns(
    df: DataFrame, label: Column, counts: Column, lat: Column, lon: Column, extra: list[str] = ()
) -> DataFrame:
    return df.select(
        F.col(DEVICE).alias("uid"),
        F.col("stop_events").alias("stop_event"),
        "start_timestamp",
        "end_timestamp",
        (F.col("end_timestamp") - F.col("start_timestamp")).alias("stop_duration"),
        F.col(LAT).alias("stop_latitude"),
        F.col(LON).alias("stop_longitude"),
        label.cast("bigint").alias("cluster_label"),
        counts.cast("bigint").alias("cluster_counts"),
        lat.alias("cluster_latitude"),
        lon.alias("cluster_longitude"),
        *extra,
    )


# Means only order the labels. They are taken in whole units of 1e-9 degree (a
# tenth of a millimetre) as decimals, so they are the same for any order of rows.
UNITS_PER_DEG = 1e9


def mean_units(c: str) -> Column:
    # Noise may have no position; not a number is none either.
    value = F.when(~F.isnan(c), F.round(F.col(c) * UNITS_PER_DEG))
    return F.avg(value.cast("decimal(20,0)"))


def stats_by_device(labelled: DataFrame, extra: list[str] = ()) -> DataFrame:
    """Labels and statistics of stops that are partitioned by device; no further shuffle."""
    raw = Window.partitionBy(DEVICE, RAW)
    clustered = F.col(RAW) >= 0
    # Noise is ranked apart, so it takes no label.
    rank = F.dense_rank().over(
        Window.partitionBy(DEVICE, "clustered").orderBy("centroid_lat", "centroid_lon")
    )
    ranked = (
        labelled.withColumn("clustered", clustered)
        .withColumn("centroid_lat", mean_units(LAT).over(raw))
        .withColumn("centroid_lon", mean_units(LON).over(raw))
        .withColumn("cluster_label", F.when(F.col("clustered"), rank - 1).otherwise(NOISE))
    )
    own = Window.partitionBy(DEVICE, "cluster_label")
    noise = F.col("cluster_label") == NOISE

    def unless_noise(value: Column, instead: Column) -> Column:
        return F.when(noise, instead).otherwise(value)

    return clustered_columns(
        ranked,
        F.col("cluster_label"),
        unless_noise(F.count("*").over(own), F.lit(1)),
        unless_noise(F.percentile(LAT, F.lit(0.5)).over(own), F.col(LAT)),
        unless_noise(F.percentile(LON, F.lit(0.5)).over(own), F.col(LON)),
        extra,
    )


def stats_by_join(labelled: DataFrame, extra: list[str], rows_per_chunk: int) -> DataFrame:
    """The same for devices too large for one task: aggregates and joins only.

    Medians are exact at any size (``selection``).
    """
    labelled = stage(labelled, "labelled")
    noise = labelled.where(F.col(RAW) == NOISE)
    raw_key = [DEVICE, RAW]
    centroids = stage(
        labelled.where(F.col(RAW) >= 0)
        .groupBy(*raw_key)
        .agg(mean_units(LAT).alias("centroid_lat"), mean_units(LON).alias("centroid_lon")),
        "centroids",
    )
    at = ["centroid_lat", "centroid_lon"]
    ranks = number_rows(
        centroids.select(DEVICE, *at).distinct(), [DEVICE], at, "position", rows_per_chunk
    )
    labels = centroids.join(ranks, [DEVICE] + at).select(
        *raw_key, (F.col("position") - 1).alias("cluster_label")
    )
    tie = ["start_timestamp", "stop_events"]
    rows = stage(
        spread_join(labelled, labels, raw_key, tie, rows_per_chunk=rows_per_chunk, staged=True), "relabelled"
    )

    key = [DEVICE, "cluster_label"]
    sizes = stage(rows.groupBy(*key).agg(F.count("*").alias("n")), "cluster-sizes")
    medians = middle_values(rows, key, [LAT, LON], observed=False, limit=rows_per_chunk, sizes=sizes)
    named = medians.withColumnsRenamed({LAT: "cluster_latitude", LON: "cluster_longitude"})
    stats = stage(sizes.join(named, key), "cluster-stats")
    full = spread_join(rows, stats, key, tie, rows_per_chunk=rows_per_chunk, staged=True)
    return clustered_columns(
        full, F.col("cluster_label"), F.col("n"), F.col("cluster_latitude"), F.col("cluster_longitude"), extra
    ).unionByName(clustered_columns(noise, F.lit(NOISE), F.lit(1), F.col(LAT), F.col(LON), extra))


def first_per_key(df: DataFrame, keys: tuple[str, ...] = ("uid", "stop_event")) -> DataFrame:
    """The earliest row per key; Spark drops the others before any shuffle."""
    order = ["start_timestamp", "end_timestamp", "stop_latitude", "stop_longitude"]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("row_num", F.row_number().over(w)).where("row_num = 1").drop("row_num")
