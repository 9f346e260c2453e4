"""Time the five steps on stored inputs, and the full run. Prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS choose the data, the cores and the
number of timed runs (after one warm-up; the median counts).
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from roost import ClusterParams, cluster_stops  # noqa: E402
from roost.operators.localtime import with_timezone  # noqa: E402
from roost.params import CountryParams  # noqa: E402
from roost.plans.catalog import QUERIES, stored_root  # noqa: E402
from roost.plans.fixture import COUNTRY, DEFAULT_ZONE  # noqa: E402
from roost.plans.full_run import run_steps  # noqa: E402
from roost.plans.inputs import Inputs  # noqa: E402
from roost.sources.stage import stage  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "detect_stops",
    "cluster_stops",
    "join_timezone_pip",
    "localize_stops",
    "classify_home_work",
    "extract_home_work",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def crowded(stops: DataFrame) -> DataFrame:
    """A third of the stops moved to one device, staged by the caller's inputs."""
    device = F.when(F.col("stop_id") % 3 == 0, F.lit("crowd")).otherwise(F.col("device_id"))
    return stops.withColumn("device_id", device)


def dense_polygons(spark: SparkSession, vertices: int = 50_000) -> DataFrame:
    """Two round outlines of so many vertices over the test area."""
    angle = F.radians(F.col("i") * 360.0 / vertices)
    point = F.concat_ws(" ", F.round(F.col("x") + 2 * F.cos(angle), 7), F.round(4.6 + 2 * F.sin(angle), 7))
    rows = spark.createDataFrame([("America/Bogota", -74.0), ("America/Lima", -70.0)], "tz string, x double")
    points = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(vertices - 1)))).select("tz", "i", point.alias("p"))
    ring = points.groupBy("tz").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "p"))), lambda s: s["p"]).alias("r"))
    text = F.concat(F.lit("POLYGON (("), F.array_join("r", ", "), F.lit(", "), F.get("r", F.lit(0)), F.lit("))"))
    return ring.select(F.lit(COUNTRY).alias("country_code"), "tz", text.alias("geometry"))


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("roost-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    inputs = Inputs.of(spark, SF_DIR)
    for table in ("pings", "stops", "clustered", "local", "hw"):
        getattr(inputs, table)
    jobs = {name: lambda q=QUERIES[name]: run(q.build(inputs)) for name in HEADLINE}
    stops, polygons = crowded(inputs.stops), stage(dense_polygons(spark), "dense-polygons")
    limit = inputs.stops.count() // 10
    jobs["cluster_crowded"] = lambda: run(cluster_stops(stops, ClusterParams(), max_device_stops=limit))
    jobs["dense_polygons"] = lambda: run(with_timezone(inputs.clustered, polygons))
    root = stored_root(inputs)
    # Stored pings to stored home and work labels, all tables written and read back.
    jobs["full_run"] = lambda: run_steps(spark, root, COUNTRY, 2024, CountryParams(DEFAULT_ZONE))
    seconds = {}
    for name, job in jobs.items():
        job()
        spent = []
        for _ in range(RUNS):
            start = time.perf_counter()
            job()
            spent.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(spent), 3)
    spark.stop()
    sf = Path(SF_DIR).name.removeprefix("sf")
    print(
        json.dumps(
            {"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": float(sf)}
        )
    )


if __name__ == "__main__":
    main()
