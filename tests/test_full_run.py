import json

import pytest
from conftest import rows

from roost import run_countries, run_steps
from roost.params import COUNTRIES, country_params, default_config_json, params_table
from roost.plans.fixture import fixture_pings, fixture_tz_codes
from roost.schemas import HW, PINGS, STOPS, conform
from roost.sources import tables
from roost.sources.stage import shared_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("root"))
    tables.sink_parquet(fixture_pings(spark, SF), f"{path}/pings/CO/2024")
    tables.sink_parquet(fixture_tz_codes(spark, SF), f"{path}/tz_codes")
    return path


def test_steps_store_their_tables(spark, root):
    hw = run_steps(spark, root, "CO", 2024)
    assert hw.schema.fieldNames() == HW.fieldNames()
    assert tables.scan_stops_all_years(spark, root, "CO").count() == 860
    assert {t for (t,) in rows(hw.select("location_type").distinct(), "location_type")} == {"H", "W", "O"}
    before = rows(hw, *HW.fieldNames())
    again = run_steps(spark, root, "CO", 2024, steps=("hw",))
    assert rows(again, *HW.fieldNames()) == before
    assert run_steps(spark, root, "CO", 2024, steps=()).count() == len(before)


def test_a_second_year_adds_to_the_stops(spark, root):
    tables.sink_parquet(tables.scan_pings(spark, root, "CO", 2024), f"{root}/pings/CO/2023")
    run_steps(spark, root, "CO", 2023, steps=("stops",))
    by_year = tables.scan_stops_all_years(spark, root, "CO").groupBy("src_year").count()
    assert rows(by_year, "src_year", "count") == [(2023, 860), (2024, 860)]


def test_explicit_timezone_wins(spark, root):
    local = run_steps(spark, root, "CO", 2024, timezone="Asia/Tokyo", steps=("local",))
    assert local.where("timezone IS NULL AND inputed_timezone <> 'Asia/Tokyo'").count() == 0


def test_unknown_step_country_or_key_is_an_error(spark, root):
    with pytest.raises(ValueError):
        run_steps(spark, root, "CO", 2024, steps=("stop",))
    with pytest.raises(KeyError):
        country_params("XX")
    config = json.loads(default_config_json())
    del config["countries"]["CO"]["dbscan"]["distance"]
    with pytest.raises(KeyError):
        country_params("CO", json.dumps(config))


def test_config_and_table_agree(spark):
    assert country_params("CO") == COUNTRIES["CO"]
    found = rows(params_table(spark), "country", "default_timezone", "home_min_days", "dbscan_distance")
    assert found == sorted(
        (c, p.timezone, p.home_work.home_min_days, p.dbscan.distance) for c, p in COUNTRIES.items()
    )


def test_wrong_table_is_refused(spark):
    with pytest.raises(ValueError, match="timestamp"):
        conform(spark.range(1).selectExpr("'a' device_id", "0d latitude", "0d longitude", "'0' timestamp"), PINGS)


def test_scans_prune_columns(spark, root):
    scan = tables.scan_pings(spark, root, "CO", 2024).select("device_id").where("device_id = 'd1'")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<device_id:string>" in plan
    assert "EqualTo(device_id,d1)" in plan


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_sorted_sink_is_in_global_order(spark, root):
    order = ["device_id", "stop_events"]
    df = tables.sink_sorted(tables.scan_stops_all_years(spark, root, "CO").drop("src_year"), f"{root}/sorted", *order)
    per_file = df.selectExpr("_metadata.file_name AS f", *order).groupBy("f").agg(
        {"device_id": "min", "stop_events": "count"}
    )
    assert per_file.count() >= 1
    spans = sorted(
        (min(v), max(v))
        for v in (
            [tuple(r)[1:] for r in df.selectExpr("_metadata.file_name AS f", *order).where(f"f = '{f}'").collect()]
            for (f,) in rows(per_file, "f")
        )
    )
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_order_names_and_configuration(spark, root):
    config = json.loads(default_config_json())
    config["countries"]["CO"]["timezone"] = "Asia/Tokyo"
    found = run_countries(spark, root, ("CO",), 2024, json.dumps(config), steps=("cluster", "local", "hw"), database="default")
    hw = found["CO"]
    assert hw.where("timezone IS NULL AND inputed_timezone <> 'Asia/Tokyo'").count() == 0
    assert spark.table("default.co_hw").count() == hw.count() == spark.table("default.co_local").count()
    from pyspark.sql import functions as F

    for path in ("hw/CO", "clustered/CO"):
        files = spark.read.parquet(f"{root}/{path}").groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min("uid"), F.max("uid"))
        spans = sorted((r[1], r[2]) for r in files.collect())
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    with pytest.raises(KeyError):
        run_countries(spark, root, ("CO", "XX"), 2024)
    for name in ("co_hw", "co_local"):
        spark.sql(f"DROP TABLE default.{name}")


def test_a_missing_column_is_refused(spark, tmp_path):
    stops = spark.createDataFrame([], STOPS).drop("median_latitude")
    tables.sink_parquet(stops, f"{tmp_path}/stops/CO/2024")
    with pytest.raises(ValueError):
        tables.scan_stops_all_years(spark, str(tmp_path), "CO")
