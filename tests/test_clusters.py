import numpy as np
import pytest
from conftest import rows, same_rows

from roost import ClusterParams, cluster_stops
from roost.schemas import CLUSTERED, STOPS

M = 1 / 111_194.9


def stops(spark, *points, device="a"):
    """Stops of a device from metres north; numbered in order, an hour apart."""
    data = [
        (device, i, i * 3_600_000, i * 3_600_000 + 600_500, 10 + m * M if m is not None else None, 20.0, i)
        for i, m in enumerate(points, 1)
    ]
    return spark.createDataFrame(data, STOPS)


def labels(df):
    return [v for _, v in rows(df, "stop_event", "cluster_label")]


def test_labels_follow_position_not_input_order(spark):
    df = cluster_stops(stops(spark, 500, 505, 0, 5, 250))
    assert labels(df) == [1, 1, 0, 0, -1]
    assert df.schema.fieldNames() == CLUSTERED.fieldNames()
    assert {f.name: f.dataType for f in df.schema} == {f.name: f.dataType for f in CLUSTERED}


def test_statistics(spark):
    df = cluster_stops(stops(spark, 0, 4, 6, 300))
    found = rows(df, "stop_event", "cluster_counts", "stop_duration", "start_timestamp")
    assert found == [(1, 3, 600.5, 3600.0), (2, 3, 600.5, 7200.0), (3, 3, 600.5, 10800.0), (4, 1, 600.5, 14400.0)]
    lat = [round((y - 10) / M, 3) for _, y in rows(df, "stop_event", "cluster_latitude")]
    assert lat == [4, 4, 4, 300]  # the median of a cluster, a noise stop's own place


def test_core_border_noise_at_four_points(spark):
    # 0..6 are core; 24 touches 6 only; 70 touches nothing.
    df = cluster_stops(stops(spark, 0, 2, 4, 6, 24, 70), ClusterParams(20, 4))
    assert labels(df) == [0, 0, 0, 0, 0, -1]


def test_border_joins_the_cluster_with_the_earliest_core_stop(spark):
    # 18 m from a core point on either side, itself not core.
    south, north = (0, -2, -4, -6), (36, 38, 40, 42)
    points = ClusterParams(18.5, 4)
    assert labels(cluster_stops(stops(spark, 18, *north, *south), points))[0] == 1
    assert labels(cluster_stops(stops(spark, 18, *south, *north), points))[0] == 0


def test_devices_are_apart(spark):
    df = cluster_stops(stops(spark, 0).union(stops(spark, 0, device="b")))
    assert rows(df, "uid", "cluster_label") == [("a", -1), ("b", -1)]


def test_later_year_is_dropped_unless_its_year_is_a_key(spark):
    from pyspark.sql import functions as F

    first = stops(spark, 0, 5).withColumn("src_year", F.lit(2023))
    second = first.withColumn("start_timestamp", F.col("start_timestamp") + 31_536_000_000).withColumn(
        "src_year", F.lit(2024)
    )
    both = first.union(second)
    kept = cluster_stops(both)
    assert rows(kept, "stop_event", "start_timestamp") == [(1, 3600.0), (2, 7200.0)]
    # Statistics come before the dedup, so the dropped rows still count.
    assert {c for (c,) in rows(kept, "cluster_counts")} == {4}
    by_year = cluster_stops(both, dedup_keys=("uid", "stop_event", "src_year"))
    assert by_year.count() == 4


def test_stops_without_place_are_noise(spark):
    df = cluster_stops(stops(spark, 0, None, 5))
    assert labels(df) == [0, -1, 0]
    assert cluster_stops(stops(spark, None)).count() == 1
    assert cluster_stops(stops(spark).where("false")).count() == 0


@pytest.mark.parametrize("min_points", [2, 4])
def test_crowded_devices_give_the_same_clusters(spark, min_points):
    r = np.random.default_rng(min_points)
    data = []
    for device, n in (("big", 160), ("mid", 45), ("small", 12)):
        y = np.round(r.integers(0, 5, n) * 30.0 + r.normal(0, 6, n), 1)
        x = np.round(r.normal(0, 25, n), 1)
        for i in range(n):
            t = int(i * 3_600_000)
            data.append((device, i, t, t + 400_000, 10 + float(y[i]) * M, 179.9 + float(x[i]) * M, i))
        data += [data[-1][:1] + (n, (n + 1) * 3_600_000, (n + 1) * 3_600_000 + 400_000) + data[-1][4:6] + (n,)]
    df = spark.createDataFrame(data, STOPS)
    params = ClusterParams(20, min_points)
    split = cluster_stops(df, params, max_device_stops=40, rows_per_chunk=30)
    assert same_rows(cluster_stops(df, params), split)


def test_two_shuffles_serve_the_whole_step(spark):
    df = stops(spark, 0, 4, 300)
    for conf, value in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(conf, value)
    try:
        plan = cluster_stops(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 2


@pytest.mark.parametrize("limit", [100, 2])
def test_a_key_with_and_without_a_place_is_one_row(spark, limit):
    placed, nowhere = stops(spark, 0, 1, 2, 3), stops(spark, None)
    df = cluster_stops(placed.union(nowhere), max_device_stops=limit, rows_per_chunk=2)
    assert rows(df, "uid", "stop_event") == [("a", 1), ("a", 2), ("a", 3), ("a", 4)]
    other = cluster_stops(stops(spark, 0, 1, 2, 3).union(stops(spark, None, 5, device="b")), max_device_stops=limit, rows_per_chunk=2)
    assert rows(other, "uid", "stop_event")[-2:] == [("b", 1), ("b", 2)]


def test_a_bent_chain_takes_few_rounds(spark):
    from roost.operators.components import connected

    n = 1000
    ids = [i if i < n // 2 else 3 * n - 2 * i for i in range(n)]  # an arch: small numbers on one leg only
    links = spark.createDataFrame([("a", *sorted(p)) for p in zip(ids, ids[1:], strict=False)], "device_id string, u long, v long")
    found = connected(links, ["device_id"])
    assert found.rounds <= 20
    assert found.select("root").distinct().count() == 1 and found.count() == len(set(ids))
