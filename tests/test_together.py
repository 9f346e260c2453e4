import json

import pytest
from conftest import rows, same_rows
from pyspark.sql import functions as F

from roost import run_steps, run_together
from roost.params import default_config_json
from roost.plans.fixture import fixture_pings, fixture_tz_codes
from roost.plans.together import MARK, country_of, name_in
from roost.schemas import HW
from roost.sources import tables

SF = "/root/testdata/sf0.001"


def config():
    """Two countries that differ in every step."""
    doc = json.loads(default_config_json())
    mx = doc["countries"]["MX"]
    mx["timezone"] = "Asia/Tokyo"
    mx["stops"] |= {"distance_threshold": 17.0, "min_stop_duration": 400_000}
    mx["dbscan"] |= {"distance": 35.0, "min_points": 3}
    mx["home_work"] |= {"home_min_days": 1, "work_min_days": 1, "home_hour_evening": 17, "work_hour_end": 15}
    return json.dumps(doc)


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("together"))
    pings = fixture_pings(spark, SF)
    # The same device names in both countries; an eleventh of the pings of one are missing in the other.
    tables.sink_parquet(pings, f"{path}/pings/CO/2024")
    tables.sink_parquet(pings.where("timestamp % 11 <> 0"), f"{path}/pings/MX/2024")
    tables.sink_parquet(fixture_tz_codes(spark, SF), f"{path}/tz_codes")
    return path


@pytest.fixture(scope="module")
def alone(spark, root):
    return {c: run_steps(spark, root, c, 2024, config_json=config()) for c in ("CO", "MX")}


def test_one_run_equals_a_run_for_each_country(spark, root, alone):
    hw = run_together(spark, root, ("CO", "MX"), 2024, config())
    for country, want in alone.items():
        got = hw.where(F.col("country") == country).select(*HW.fieldNames())
        assert want.count() > 100 and same_rows(got, want), country
    kinds = rows(hw.groupBy("country", "location_type").count(), "country", "location_type")
    assert {c for c, _ in kinds} == {"CO", "MX"}

    # A later run replaces its own country's partitions only, and reads no other's.
    before = rows(hw.groupBy("country").count(), "country", "count")
    again = run_together(spark, root, ("MX",), 2024, config())
    assert rows(again.groupBy("country").count(), "country", "count") == [b for b in before if b[0] == "MX"]
    stored = spark.read.parquet(f"{root}/together/hw")
    assert rows(stored.groupBy("country").count(), "country", "count") == before
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(country" in plan


def test_crowded_devices_take_their_countrys_parameters(spark, root, alone):
    limits = {"stops": {"max_device_pings": 100, "rows_per_chunk": 500}}
    hw = run_together(spark, root, ("CO", "MX"), 2024, config(), max_device_rows=limits)
    for country, want in alone.items():
        assert same_rows(hw.where(F.col("country") == country).select(*HW.fieldNames()), want), country


def test_keys_come_apart_again(spark):
    df = spark.createDataFrame([("CO|a|b",), ("MX|",), ("AR|d1",)], "k string").select(country_of("k").alias("c"), name_in("k").alias("n"))
    assert rows(df, "c", "n") == [("AR", "d1"), ("CO", "a|b"), ("MX", "")]
    assert MARK == "|"


def test_an_unknown_country_is_found_before_any_work(spark, root):
    with pytest.raises(KeyError):
        run_together(spark, root, ("CO", "XX"), 2024, config())


def test_crowded_clusters_by_column_parameters(spark):
    from roost import ClusterParams, cluster_stops
    from roost.params import CountryParams
    from roost.plans.together import params_by_key
    from roost.schemas import STOPS

    settings = {"CO": CountryParams("UTC", dbscan=ClusterParams(20.0, 2)), "MX": CountryParams("UTC", dbscan=ClusterParams(60.0, 3))}
    north = [0, 15, 55, 100, 110, 300, 350, 390]
    data = [
        (f"{c}|a", i, i * 3_600_000, i * 3_600_000 + 600_000, 10 + m / 111_194.9, 20.0, i)
        for c in settings for i, m in enumerate(north, 1)
    ]
    stops = spark.createDataFrame(data, STOPS)
    got = cluster_stops(stops, params_by_key(settings, "device_id").dbscan, max_device_stops=4)
    for c, p in settings.items():
        want = cluster_stops(stops.where(country_of("device_id") == c), p.dbscan)
        assert same_rows(got.where(country_of("uid") == c), want), c
