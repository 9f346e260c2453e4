import pytest
from conftest import rows, same_rows
from pyspark.sql import functions as F
from test_stops import MIN, spans, track, walk

from roost import StopParams, detect_stops, detect_stops_after, run_steps, stops_still_open
from roost.plans.fixture import fixture_tz_codes
from roost.schemas import PINGS, STOPS
from roost.sources import tables


def in_exports(exports, params, **limits):
    carry, found = None, []
    for pings in exports:
        ended, carry = detect_stops_after(pings, carry, params, **limits)
        found.append(ended)
    out = stops_still_open(carry, params, **limits)
    for ended in found:
        out = out.unionByName(ended)
    return out, found, carry


@pytest.mark.parametrize("n, limits", [(5, {}), (2, {"max_device_pings": 60, "rows_per_chunk": 97})])
def test_exports_equal_one_run(spark, n, limits):
    pings = spark.createDataFrame(walk(seed=5), PINGS).cache()
    params = StopParams(distance_threshold=20, min_stop_duration=60_000)
    times = sorted(t for (t,) in rows(pings.where("device_id = 'big'"), "timestamp"))
    cuts = [0, *(times[len(times) * i // n] for i in range(1, n)), times[-1] * 10]
    exports = [pings.where((F.col("timestamp") >= a) & (F.col("timestamp") < b)) for a, b in zip(cuts, cuts[1:], strict=False)]
    out, found, carry = in_exports(exports, params, **limits)
    assert same_rows(out, detect_stops(pings, params))
    assert all(f.count() for f in found[:-1])
    assert carry.count() < pings.count() / 2


def test_a_stay_over_the_end_is_one_stop(spark):
    whole = [(0, 0), (6, 0), (7, 0), (8, 500), (12, 500), (16, 500), (22, 500), (23, 900), (24, 1400)]
    parts = [track(spark, "a", *whole[:6]), track(spark, "a", *whole[6:])]
    out, found, _ = in_exports(parts, StopParams())
    assert spans(found[0]) == [("a", 0, 6)]
    assert spans(found[1]) == [("a", 8, 16)]
    assert rows(out, "stop_id", "stop_events") == [(1, 1), (2, 2)]
    # Cut off, the stay would have been too short on both sides.
    assert sum(len(spans(detect_stops(p))) for p in parts) == 1


def test_devices_that_pause_leave_and_come(spark):
    a, b = [(0, 0), (6, 0), (12, 0)], [(3, 9), (9, 9), (15, 9)]
    first = track(spark, "a", *a)
    nothing = first.where("false")
    later = track(spark, "b", *b).unionByName(track(spark, "a", (18, 0), (19, 700)))
    out, found, _ = in_exports([first, nothing, later], StopParams())
    assert [f.count() for f in found] == [0, 0, 1]
    assert same_rows(out, detect_stops(first.unionByName(later)))


def test_copies_of_the_last_ping_pass_and_earlier_pings_do_not(spark):
    first = track(spark, "a", (0, 0), (6, 0), (12, 0))
    out, _, carry = in_exports([first, track(spark, "a", (12, 0), (18, 0))], StopParams())
    assert spans(out) == [("a", 0, 12)]
    with pytest.raises(ValueError, match="before the carried"):
        detect_stops_after(track(spark, "a", (17, 0)), carry)


def test_no_device_no_time_no_rows(spark):
    data = [(None, 1.0, 1.0, 5), ("a", 1.0, 1.0, None), ("b", None, 1.0, 7)]
    ended, carry = detect_stops_after(spark.createDataFrame(data, PINGS))
    assert ended.count() == 0
    assert rows(carry, *carry.columns) == [("b", None, 1.0, 7, 0, 0)]
    ended, carry = detect_stops_after(spark.createDataFrame([], PINGS))
    assert (ended.count(), carry.count()) == (0, 0)
    assert stops_still_open(carry).schema.fieldNames() == STOPS.fieldNames()


def test_a_run_over_two_years(spark, tmp_path):
    root = str(tmp_path)
    new_year = 1_704_067_200_000
    days = [(new_year + (i * 5 - 60) * MIN, 0 if i < 20 else 800) for i in range(40)]
    pings = spark.createDataFrame([("a", 10 + m / 111_194.9, 20.0, t) for t, m in days], PINGS)
    tables.sink_parquet(pings.where(F.col("timestamp") < new_year), f"{root}/pings/CO/2023")
    tables.sink_parquet(pings.where(F.col("timestamp") >= new_year), f"{root}/pings/CO/2024")
    tables.sink_parquet(fixture_tz_codes(spark, "/root/testdata/sf0.001"), f"{root}/tz_codes")
    run_steps(spark, root, "CO", 2023, carried=True)
    open_then = tables.scan_stops_all_years(spark, root, "CO", 2023)
    assert rows(open_then, "stop_events", "src_year") == [(1, 2023)]
    hw = run_steps(spark, root, "CO", 2024, carried=True, previous=2023)
    stops = tables.scan_stops_all_years(spark, root, "CO", 2024)
    want = detect_stops(pings)
    assert same_rows(stops.select(*want.columns), want)
    assert rows(hw, "stop_event") == [(1,), (2,)]
    with pytest.raises(ValueError):
        run_steps(spark, root, "CO", 2023, carried=True, previous=2024, steps=("stops",))


def test_one_shuffle_tells_stops_and_what_stays_open(spark):
    from roost.operators.carried import stops_and_open
    from roost.operators.skew import by_key

    pings = spark.createDataFrame(walk(seed=7), PINGS)
    params = StopParams(distance_threshold=20, min_stop_duration=60_000)
    told = stops_and_open(by_key(pings, "device_id", 0, 1), params)
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.count("Sort [") == 2
    want = detect_stops(pings, params)
    assert same_rows(told.where("is_stop").select(*want.columns), want)
    lasting = told.where("is_open AND timestamp IS NOT NULL").groupBy("device_id").agg(F.max("timestamp").alias("t"))
    assert rows(lasting, "device_id", "t") == rows(pings.groupBy("device_id").agg(F.max("timestamp").alias("t")), "device_id", "t")
