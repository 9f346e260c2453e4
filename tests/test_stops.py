import random

import numpy as np
import pytest
from conftest import rows, same_rows
from pyspark.sql import functions as F

from roost import StopParams, detect_stops
from roost.operators.skew import by_key
from roost.operators.stops import by_device_size, ping_runs, stops_by_device
from roost.schemas import PINGS

M = 1 / 111_194.9  # degrees of latitude per metre
MIN = 60_000


def track(spark, device, *points):
    """Pings of a device from (minutes, metres north) pairs."""
    return spark.createDataFrame([(device, 10 + m * M, 20.0, int(t * MIN)) for t, m in points], PINGS)


def spans(stops):
    return [(d, s // MIN, e // MIN) for d, s, e in rows(stops, "device_id", "start_timestamp", "end_timestamp")]


def test_last_ping_of_a_run_is_left_out(spark):
    pings = track(spark, "a", (0, 0), (5, 1), (10, 2), (15, 3))
    assert spans(detect_stops(pings)) == [("a", 0, 10)]


def test_one_ping_makes_no_stop(spark):
    assert spans(detect_stops(track(spark, "a", (0, 0)))) == []


def test_run_ends_by_distance_and_by_gap(spark):
    by_distance = [(0, 0), (6, 0), (12, 0), (13, 500), (20, 500), (27, 500)]
    assert spans(detect_stops(track(spark, "a", *by_distance))) == [("a", 0, 6), ("a", 13, 20)]
    by_gap = [(0, 0), (6, 0), (12, 0), (12 + 61, 0), (80, 0), (87, 0)]
    assert spans(detect_stops(track(spark, "a", *by_gap))) == [("a", 0, 6), ("a", 73, 80)]


def test_bounds_are_inclusive(spark):
    exact_gap = track(spark, "a", (0, 0), (60, 0), (61, 0))
    assert spans(detect_stops(exact_gap)) == [("a", 0, 60)]
    longer = track(spark, "a", (0, 0), (60 + 1 / 60, 0), (62, 0))
    assert spans(detect_stops(longer)) == []
    for ms, found in ((299_999, 0), (300_000, 1)):
        df = spark.createDataFrame([("a", 1.0, 1.0, t) for t in (0, ms, ms + 1000)], PINGS)
        assert detect_stops(df).count() == found


def test_trimmed_run_must_still_last(spark):
    # The median sits with the crowd at the start; the drift is trimmed away.
    drift = [(0, 0), (1, 0), (2, 0), (3, 0), (4, 15), (5, 30), (6, 45), (7, 60)]
    assert spans(detect_stops(track(spark, "a", *drift))) == []


def test_copies_change_nothing(spark):
    pings = track(spark, "a", (0, 0), (5, 1), (10, 2), (11, 900), (15, 901))
    assert same_rows(detect_stops(pings), detect_stops(pings.union(pings).union(pings)))


def test_null_positions_break_runs_and_null_devices_make_none(spark):
    data = [("a", 1.0, 1.0, t * MIN) for t in (0, 6, 12)]
    hole = [*data[:1], ("a", None, 1.0, 6 * MIN), *data[2:]]
    assert detect_stops(spark.createDataFrame(data, PINGS)).count() == 1
    assert detect_stops(spark.createDataFrame(hole, PINGS)).count() == 0
    unknown = [(None, *r[1:]) for r in data]
    assert detect_stops(spark.createDataFrame(unknown, PINGS)).count() == 0


def walk(seed=1, devices=("big", "b", "c"), n=400):
    r = random.Random(seed)
    out = []
    for d in devices:
        lat, t = 10.0, 0
        for _ in range(n if d == "big" else 40):
            t += r.choice([0, 30_000, 90_000, 240_000, 4_000_000])
            lat += r.choice([0, 0, 0, 3, 8, 15, 40]) * M
            out.append((d, round(lat, 6), 20.0, t))
            if r.random() < 0.1:
                out.append(out[-1])
    r.shuffle(out)
    return out


@pytest.mark.parametrize("chunk", [7, 60])
def test_crowded_devices_give_the_same_stops(spark, chunk):
    pings = spark.createDataFrame(walk(), PINGS).cache()
    params = StopParams(distance_threshold=20, min_stop_duration=60_000)
    whole = detect_stops(pings, params)
    ordinary, crowded, total = by_device_size(pings, 100)
    assert total == ordinary.count() + crowded.count()
    assert rows(crowded.select("device_id").distinct(), "device_id") == [("big",)]
    split = detect_stops(pings, params, max_device_pings=100, rows_per_chunk=chunk)
    assert whole.count() > 10
    assert same_rows(whole, split)
    runs = ["device_id", "timestamp", "latitude", "stationary", "event_id"]
    assert rows(ping_runs(pings, params), *runs) == rows(ping_runs(pings, params, 100, chunk), *runs)


def test_a_run_over_many_chunks_stays_one_stop(spark):
    pings = track(spark, "a", *[(t, 0) for t in range(200)], (205, 900), (206, 900))
    split = detect_stops(pings, max_device_pings=10, rows_per_chunk=9)
    assert spans(split) == spans(detect_stops(pings)) == [("a", 0, 198)]


def test_stop_numbers_are_dense_and_order_free(spark):
    data = walk(seed=3)
    params = StopParams(min_stop_duration=60_000)
    a = detect_stops(spark.createDataFrame(data, PINGS), params)
    b = detect_stops(spark.createDataFrame(sorted(data), PINGS).repartition(7), params)
    assert same_rows(a, b)
    for device in ("big", "b"):
        numbers = [n for d, n in rows(a, "device_id", "stop_events") if d == device]
        assert sorted(numbers) == list(range(1, len(numbers) + 1))


def test_one_shuffle_serves_the_whole_step(spark):
    pings = spark.createDataFrame(walk(), PINGS)
    conf = "spark.sql.adaptive.enabled"
    spark.conf.set(conf, "false")
    try:
        plan = stops_by_device(by_key(pings, "device_id", 0, 1), StopParams())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(conf, "true")
    assert plan.count("Exchange") == 1


def test_medians_do_not_depend_on_the_plan(spark):
    """More than ten thousand distinct values in one run."""
    rng = np.random.default_rng(4)
    n = 12_000
    points = [("a", 10 + float(y) * 1e-5, 20 + float(x) * 1e-5, i * 1000) for i, (y, x) in enumerate(rng.random((n, 2)))]
    pings = spark.createDataFrame(points, PINGS)
    plain = detect_stops(pings)
    chunked = detect_stops(pings, max_device_pings=10, rows_per_chunk=3000)
    assert rows(plain, *plain.columns) == rows(chunked, *plain.columns)
    first = plain.first()
    lats = sorted(p[1] for p in points[:-1])
    assert first["median_latitude"] == lats[(len(lats) - 1) // 2]


def test_counted_rows_fix_the_number_of_partitions(spark):
    pings = spark.createDataFrame(walk(seed=3), PINGS)

    def shuffle(total):
        return by_key(pings, "device_id", total, 100)._jdf.queryExecution().executedPlan().toString()

    # Within the configured partitions too: merged by size, a task's rows grow with the input.
    assert "hashpartitioning(device_id#" in shuffle(300) and "REPARTITION_BY_NUM" in shuffle(300)
    assert by_key(pings, "device_id", 1_000, 100).rdd.getNumPartitions() == 10
    assert "REPARTITION_BY_COL" in shuffle(100)


def test_stops_of_a_device_need_no_aggregate(spark):
    pings = spark.createDataFrame(walk(seed=3), PINGS)
    plan = stops_by_device(by_key(pings, "device_id", 0, 1), StopParams())._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan
    assert plan.count("Sort [") == 2


def test_events_are_dealt_evenly(spark, tmp_path):
    from roost.plans.fixture import spread

    path = str(tmp_path / "events")
    spark.range(1000).coalesce(1).write.parquet(path)
    events = spark.read.parquet(path)
    dealt = spread(events, 100)
    sizes = [n for (n,) in rows(dealt.groupBy(F.spark_partition_id()).count(), "count")]
    assert len(sizes) == 10 and max(sizes) < 200
    assert rows(dealt, "id") == rows(events, "id")
    assert spread(events, 1000) is events
