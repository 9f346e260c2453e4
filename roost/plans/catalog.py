"""Every operator as a query over the test tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roost import schemas
from roost.functions.clock import local_datetime, round_to_bigint, utc_datetime
from roost.functions.geo import with_wkt_edges
from roost.operators import carried, clusters, density_spread, homework, localtime, places, stops
from roost.operators.selection import middle_values
from roost.operators.skew import number_rows, spread_join
from roost.params import ClusterParams, HomeWorkParams, StopParams, params_table
from roost.plans import oracle
from roost.plans.fixture import COUNTRY, DEFAULT_ZONE
from roost.plans.full_run import run_steps
from roost.plans.inputs import Inputs
from roost.sources import tables
from roost.sources.stage import stage

STOP, CLUSTER, HOME_WORK = StopParams(), ClusterParams(), HomeWorkParams()
CORE4 = ClusterParams(min_points=4)


@dataclass(frozen=True)
class Query:
    build: Callable[[Inputs], DataFrame]
    sql: str


QUERIES: dict[str, Query] = {}


def query(level: str | None, columns: str, source: str):
    """Register a query: its columns, and the SQL ``FROM ...`` part over ``level``'s tables."""
    names = columns.split()

    def register(build: Callable[[Inputs], DataFrame]):
        sql = oracle.chain(level, f"SELECT {oracle.shown_sql(names)} FROM {source}")
        QUERIES[build.__name__] = Query(lambda t: shown(build(t), names), sql)
        return build

    return register


def shown(df: DataFrame, names: list[str]) -> DataFrame:
    """Round positions and distances, show times as text, widen counts."""

    def show(c: str) -> Column:
        if c in oracle.POSITIONS:
            return F.round(c, 7).alias(c)
        if c in oracle.MEANS:
            return F.round(F.col(c) + 1.3e-9, 7).alias(c)
        if c in oracle.SECONDS:
            return F.round(c, 3).alias(c)
        if c in oracle.CLOCK:
            return F.col(c).cast("string").alias(c)
        if c in oracle.COUNTS:
            return F.col(c).cast("bigint").alias(c)
        return F.col(c)

    return df.select(*[show(c) for c in names])


PING = "device_id latitude longitude timestamp"
STOPS = "device_id stop_id start_timestamp end_timestamp median_latitude median_longitude stop_events"
CLUSTERED = " ".join(schemas.CLUSTERED.fieldNames())
LOCAL = " ".join(schemas.LOCAL.fieldNames())
HW = " ".join(schemas.HW.fieldNames())
PAIRS = " ".join(schemas.PAIRS.fieldNames())


def runs_of(t: Inputs) -> DataFrame:
    return stops.ping_runs(t.pings, STOP)


def run_points(t: Inputs) -> DataFrame:
    return runs_of(t).where("stationary").select(*stops.PING, "event_id")


def first_stops(t: Inputs) -> DataFrame:
    return stops.summarise_runs(run_points(t), STOP).withColumnRenamed("event_id", "stop_id")


def raw_labels(t: Inputs, params: ClusterParams = CLUSTER) -> DataFrame:
    return clusters.label_stops(t.stops, params)


def by_first_stop(labelled: DataFrame) -> DataFrame:
    """Replace arbitrary cluster numbers by the cluster's first stop, to compare them."""
    labelled = stage(labelled, "labelled")
    noise = labelled.where("raw_cluster_label < 0")
    in_cluster = labelled.where("raw_cluster_label >= 0")
    key = ["device_id", "raw_cluster_label"]
    first = in_cluster.groupBy(*key).agg(F.min("stop_events").alias("first_stop"))
    joined = spread_join(in_cluster, first, key, ["start_timestamp", "stop_events"])
    named = joined.withColumn("raw_cluster_label", F.col("first_stop")).select(*labelled.columns)
    return named.unionByName(noise)


def visits_of(t: Inputs) -> DataFrame:
    return homework.cluster_visits(t.local, HOME_WORK)


def homes_of(t: Inputs) -> DataFrame:
    return homework.home_locations(visits_of(t), HOME_WORK)


# --- whole steps -------------------------------------------------------------------


@query("stops", STOPS, "stops")
def detect_stops(t):
    return stops.detect_stops(t.pings, STOP)


# Three exports that end in the middle of stays, in ms since 1970.
EXPORT_ENDS = (1_704_900_000_000, 1_705_700_000_000)


@query("stops", STOPS, "stops")
def stops_across_exports(t):
    """The three exports one after the other; the twin sees one export."""
    bounds = [F.lit(None), *map(F.lit, EXPORT_ENDS), F.lit(None)]
    carry, found = None, []
    for low, high in zip(bounds, bounds[1:], strict=False):
        inside = F.coalesce(F.col("timestamp") >= low, F.lit(True)) & F.coalesce(F.col("timestamp") < high, F.lit(True))
        ended, carry = carried.detect_stops_after(t.pings.where(inside), carry, STOP)
        found.append(ended)
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(carried.stops_still_open(carry, STOP))


@query("clustered", CLUSTERED, "clustered")
def cluster_stops(t):
    return clusters.cluster_stops(t.stops, CLUSTER)


@query("local", LOCAL, "local")
def localize_stops(t):
    return localtime.localize_stops(t.clustered, t.tz_codes, COUNTRY, DEFAULT_ZONE)


@query("hw", HW, "hw")
def classify_home_work(t):
    return homework.classify_home_work(t.local, HOME_WORK)


@query("pairs", PAIRS, "pairs WHERE work_latitude IS NOT NULL ORDER BY uid, year LIMIT 1000")
def extract_home_work(t):
    return places.extract_home_work(t.hw, limit=1000)


def stored_root(t: Inputs) -> str:
    """A fresh folder that holds the inputs of a full run."""
    root = t.path("root")
    tables.sink_parquet(t.pings, f"{root}/pings/{COUNTRY}/2024")
    tables.sink_parquet(t.tz_codes, f"{root}/tz_codes")
    return root


@query("hw", HW, "hw")
def run_pipeline(t):
    from roost.params import CountryParams

    params = CountryParams(DEFAULT_ZONE, STOP, CLUSTER, HOME_WORK)
    return run_steps(t.spark, stored_root(t), COUNTRY, 2024, params)


# --- sources and sinks ----------------------------------------------------------------


@query("pings", PING, "pings")
def scan_pings(t):
    root = t.path("root")
    tables.sink_parquet(t.pings, f"{root}/pings/{COUNTRY}/2024")
    return tables.scan_pings(t.spark, root, COUNTRY, 2024)


def two_years(t: Inputs) -> str:
    root = t.path("root")
    for year, odd in ((2023, 1), (2024, 0)):
        part = t.stops.where(F.col("stop_id") % 2 == odd)
        tables.sink_parquet(part, f"{root}/stops/{COUNTRY}/{year}")
    return root


@query("stops", STOPS + " src_year", "(SELECT *, 2024 - stop_id % 2 AS src_year FROM stops)")
def scan_stops_all_years(t):
    df = tables.scan_stops_all_years(t.spark, two_years(t), COUNTRY)
    return df.withColumn("src_year", F.col("src_year").cast("bigint"))


@query("clustered", CLUSTERED, "clustered")
def scan_clusters(t):
    root = t.path("root")
    tables.sink_parquet(t.clustered, f"{root}/clustered/{COUNTRY}")
    return tables.scan_clusters(t.spark, root, COUNTRY)


@query("local", LOCAL, "local")
def scan_local(t):
    root = t.path("root")
    tables.sink_parquet(t.local, f"{root}/local/{COUNTRY}")
    return tables.scan_local(t.spark, root, COUNTRY)


@query("hw", HW, "hw")
def scan_hw(t):
    root = t.path("root")
    tables.sink_parquet(t.hw, f"{root}/hw/{COUNTRY}")
    return tables.scan_hw(t.spark, root, COUNTRY)


@query("stops", STOPS, "stops")
def scan_table(t):
    path = t.path("sink")
    name = "roost_scan_" + path[-8:]
    tables.sink_table(t.stops, name, path)
    found = stage(t.spark.table(name), "scanned")
    t.spark.sql(f"DROP TABLE {name}")
    return found


@query("areas", "country_code tz geometry", "tz_codes WHERE country_code = 'CO'")
def scan_tz_lookup(t):
    path = t.path("root") + "/tz_codes"
    tables.sink_parquet(t.areas, path)
    return tables.scan_tz_lookup(tables.scan(t.spark, path, schemas.TZ_CODES), COUNTRY)


@query("stops", STOPS, "stops")
def sink_parquet(t):
    return tables.sink_parquet(t.stops, t.path("sink"))


@query("stops", STOPS, "stops")
def sink_table(t):
    path = t.path("sink")
    name = "roost_sink_" + path[-8:]
    saved = stage(tables.sink_table(t.stops, name, path), "read-back")
    t.spark.sql(f"DROP TABLE {name}")
    return saved


CONFIG_COLUMNS = (
    "device_id country default_timezone distance_threshold time_threshold min_stop_duration dbscan_distance "
    "dbscan_min_points home_min_days home_hour_evening home_hour_morning work_min_days work_hour_start work_hour_end "
    "min_distance_home_work"
)


@query(
    None,
    CONFIG_COLUMNS,
    """(SELECT 'd' || user_id AS device_id, ['AR', 'BR', 'CO', 'MX'][user_id % 4 + 1] AS country,
      ['America/Argentina/Buenos_Aires', 'America/Sao_Paulo', 'America/Bogota', 'America/Mexico_City'][user_id % 4 + 1]
        AS default_timezone,
      20.0::DOUBLE AS distance_threshold, 3600.0::DOUBLE AS time_threshold, 300000 AS min_stop_duration,
      20.0::DOUBLE AS dbscan_distance, 2 AS dbscan_min_points,
      CASE WHEN user_id % 4 = 2 THEN 2 ELSE 14 END AS home_min_days, 19 AS home_hour_evening,
      8 AS home_hour_morning, CASE WHEN user_id % 4 = 2 THEN 2 ELSE 8 END AS work_min_days,
      9 AS work_hour_start, 18 AS work_hour_end, 50.0::DOUBLE AS min_distance_home_work
    FROM (SELECT DISTINCT user_id FROM events))""",
)
def source_config(t):
    devices = t.table("events").select("user_id").distinct()
    countries = F.array(*[F.lit(c) for c in ("AR", "BR", "CO", "MX")])
    placed = devices.select(
        F.concat(F.lit("d"), "user_id").alias("device_id"),
        F.get(countries, (F.col("user_id") % 4).cast("int")).alias("country"),
    )
    return placed.join(F.broadcast(params_table(t.spark)), "country")


# --- projections, filters, predicates ----------------------------------------------------


@query(
    "stops",
    "uid stop_event stop_latitude stop_longitude",
    """(SELECT device_id AS uid, stop_events AS stop_event, median_latitude AS stop_latitude,
      median_longitude AS stop_longitude FROM stops)""",
)
def project_rename(t):
    return t.stops.withColumnsRenamed(
        {
            "device_id": "uid",
            "stop_events": "stop_event",
            "median_latitude": "stop_latitude",
            "median_longitude": "stop_longitude",
        }
    )


@query("stops", STOPS + " duration_ms", "(SELECT *, end_timestamp - start_timestamp AS duration_ms FROM stops)")
def project_star_plus(t):
    return t.stops.select("*", (F.col("end_timestamp") - F.col("start_timestamp")).alias("duration_ms"))


@query("stops", STOPS.replace("stop_id ", ""), "stops")
def project_except(t):
    return t.stops.drop("stop_id")


@query("hw", "uid stop_event timezone location_type location_label", "hw")
def case_searched(t):
    return t.hw.withColumn("location_label", homework.location_label())


@query("local", "uid stop_event timezone weekday weekend", "local")
def if_in_list(t):
    return t.local.withColumn("weekend", F.col("weekday").isin(1, 7))


@query("local", "uid stop_event timezone inputed_timezone", "local")
def null_default(t):
    return t.local.withColumn("inputed_timezone", F.coalesce("timezone", F.lit(DEFAULT_ZONE)))


@query(
    "runs",
    PING + " has_next last_ping",
    "(SELECT *, next_latitude IS NOT NULL AS has_next, next_timestamp IS NULL AS last_ping FROM numbered)",
)
def null_test(t):
    return runs_of(t).select(
        *stops.PING,
        F.col("next_latitude").isNotNull().alias("has_next"),
        F.col("next_timestamp").isNull().alias("last_ping"),
    )


@query(
    "runs",
    PING + " within_radius within_time",
    "(SELECT *, distance <= 20 AS within_radius, time_diff <= 3600 AS within_time FROM numbered)",
)
def threshold_cmp(t):
    return runs_of(t).select(
        *stops.PING,
        (stops.distance_to_next() <= F.lit(STOP.distance_threshold)).alias("within_radius"),
        (stops.gap_to_next_s() <= F.lit(STOP.time_threshold)).alias("within_time"),
    )


@query("runs", PING + " stationary", "numbered")
def bool3_logic(t):
    return runs_of(t).withColumn("stationary", stops.stationary_flag(STOP))


@query("hw", "uid stop_event timezone location_type cluster_label", "hw WHERE location_type = 'H'")
def filter_eq(t):
    return t.hw.where(F.col("location_type") == F.lit("H"))


@query("clustered", CLUSTERED, "clustered WHERE cluster_label >= 0")
def filter_clustered(t):
    return t.clustered.where(homework.clustered_only())


@query(
    "local",
    "uid stop_event timezone weekend hour",
    "local WHERE weekend OR (NOT weekend AND (hour >= 19 OR hour < 8))",
)
def filter_home_hours(t):
    return t.local.where(homework.home_hours(HOME_WORK))


@query("local", "uid stop_event timezone weekend hour", "local WHERE NOT weekend AND hour >= 9 AND hour <= 18")
def filter_work_hours(t):
    return t.local.where(homework.work_hours(HOME_WORK))


@query("stops", "device_id stop_id start_timestamp end_timestamp", "first_stops")
def filter_having(t):
    return first_stops(t)


@query("stops", STOPS, "stops WHERE end_timestamp - start_timestamp >= 600000 AND median_latitude <= 4.65")
def params_bind(t):
    return t.spark.sql(
        "SELECT * FROM {stops} WHERE end_timestamp - start_timestamp >= :least_ms AND median_latitude <= :north",
        args={"least_ms": 600_000, "north": 4.65},
        stops=t.stops,
    )


@query("stops", "device_id stop_id start_timestamp end_timestamp median_latitude median_longitude", "first_stops")
def cte_chain(t):
    return (
        t.pings.transform(stops.ping_runs, STOP)
        .transform(lambda r: r.where("stationary"))
        .transform(stops.summarise_runs, STOP)
        .transform(lambda s: s.withColumnRenamed("event_id", "stop_id"))
    )


# --- joins ----------------------------------------------------------------------------------


@query("stops", PING + " event_id", "near_points")
def join_outlier_refilter(t):
    first = first_stops(t).withColumnRenamed("stop_id", "event_id")
    joined = spread_join(run_points(t), first, ["device_id", "event_id"], stops.ORDER)
    return joined.where(stops.near_median(STOP))


@query("clustered", "device_id stop_events cluster_label", "told")
def join_label_back(t):
    raw = stage(raw_labels(t), "raw")
    labels = deterministic_labels(raw).select("device_id", "raw_cluster_label", "cluster_label")
    key = ["device_id", "raw_cluster_label"]
    joined = spread_join(raw, labels, key, ["start_timestamp", "stop_events"], "left", staged=True)
    return joined.withColumn("cluster_label", F.coalesce("cluster_label", F.lit(-1)))


@query("local", "uid stop_event timezone", "zoned")
def join_timezone_pip(t):
    lookup = tables.scan_tz_lookup(t.tz_codes, COUNTRY)
    return localtime.with_timezone(t.clustered, lookup)


@query(
    "homes",
    "uid cluster_label home_time_visits home_time_unique_days unique_days_visited",
    "eligible_homes",
)
def join_home_daycount(t):
    return visits_of(t).where(
        (F.col("home_time_visits") > 0) & (F.col("unique_days_visited") >= HOME_WORK.home_min_days)
    )


@query("works", "uid cluster_label home_cluster_label distance_from_home is_valid", "work_home")
def join_work_home(t):
    candidates = homework.work_candidates(visits_of(t), homes_of(t))
    return candidates.withColumn("is_valid", homework.valid_work(HOME_WORK))


@query("hw", "uid stop_event timezone location_type", "hw")
def join_assign_types(t):
    visits = stage(visits_of(t), "visits")
    homes = homework.home_locations(visits, HOME_WORK)
    return homework.assign_types(t.local, homes, homework.work_locations(visits, homes, HOME_WORK))


@query("pairs", PAIRS, "pairs")
def join_hw_pairs(t):
    return places.home_work_pairs(t.hw)


@query(
    "core4",
    "device_id stop_events is_core",
    """(SELECT s.device_id, s.stop_events, c.stop_events IS NOT NULL AS is_core
      FROM stops s LEFT JOIN cores_raw4 c ON s.device_id = c.device_id AND s.stop_events = c.stop_events)""",
)
def join_eps_neighbors(t):
    """Which stops have enough neighbours: the range self-join, with busy cells settled by count."""
    sites, pieces = density_spread.sites_and_cells(t.stops, CORE4.distance)
    near = density_spread.sparse_neighbours(sites, pieces, CORE4.distance, CORE4.min_points)
    core = density_spread.core_sites(sites, pieces, near, CORE4.min_points)
    marks = core.select(*density_spread.SITE, F.lit(True).alias("is_core"))
    tie = ["start_timestamp", "stop_events"]
    joined = spread_join(t.stops, marks, density_spread.SITE, tie, "left")
    return joined.withColumn("is_core", F.coalesce("is_core", F.lit(False)))


# --- aggregations -----------------------------------------------------------------------------


@query(
    "stops",
    "device_id event_id start_timestamp end_timestamp",
    """(SELECT device_id, event_id, min(timestamp) AS start_timestamp, max(timestamp) AS end_timestamp
      FROM points GROUP BY ALL)""",
)
def agg_time_bounds(t):
    return run_points(t).groupBy("device_id", "event_id").agg(*stops.run_bounds())


@query(
    None,
    "user_id median_value",
    "(SELECT user_id, quantile_disc(value, 0.5) AS median_value FROM events GROUP BY ALL)",
)
def agg_approx_median(t):
    return middle_values(t.table("events"), ["user_id"], ["value"]).withColumnRenamed("value", "median_value")


@query("stops", "device_id stop_id start_timestamp end_timestamp median_latitude median_longitude", "first_stops")
def agg_stop(t):
    return first_stops(t)


@query(
    "clustered",
    "device_id first_stop centroid_lat centroid_lon cluster_size",
    "(SELECT *, middle[1] AS centroid_lat, middle[2] AS centroid_lon FROM middles)",
)
def agg_centroid(t):
    return centroids(raw_labels(t))


def centroids(labelled: DataFrame) -> DataFrame:
    return (
        labelled.where("raw_cluster_label >= 0")
        .groupBy("device_id", "raw_cluster_label")
        .agg(
            (clusters.mean_units(clusters.LAT) / clusters.UNITS_PER_DEG).alias("centroid_lat"),
            (clusters.mean_units(clusters.LON) / clusters.UNITS_PER_DEG).alias("centroid_lon"),
            F.count("*").alias("cluster_size"),
            F.min("stop_events").alias("first_stop"),
        )
    )


def deterministic_labels(labelled: DataFrame) -> DataFrame:
    """Centroids ranked across tasks: a device may have very many; equal positions share a label."""
    found = stage(centroids(labelled), "centroids")
    at = ["device_id", "centroid_lat", "centroid_lon"]
    ranks = number_rows(found.select(*at).distinct(), at[:1], at[1:], "position")
    label = (F.col("position") - 1).cast("int")
    return found.join(ranks, at).withColumn("cluster_label", label).drop("position")


@query("homes", "uid cluster_label unique_days_visited", "visits")
def agg_days_visited(t):
    return visits_of(t)


@query("homes", "uid cluster_label home_time_visits home_time_unique_days", "visits WHERE home_time_visits > 0")
def agg_home_candidates(t):
    return visits_of(t).where("home_time_visits > 0")


@query("works", "uid cluster_label work_time_visits work_time_unique_days", "visits WHERE work_time_visits > 0")
def agg_work_candidates(t):
    return visits_of(t).where("work_time_visits > 0")


@query("runs", PING, "hops")
def distinct_pings(t):
    return t.pings.select(*stops.PING).distinct()


@query("stops", STOPS, "stops")
def distinct_stops(t):
    return t.stops.dropDuplicates()


@query("pairs", "uid year home_latitude home_longitude", "pairs")
def distinct_places(t):
    return places.distinct_places(t.hw, "H", "home")


# --- windows -------------------------------------------------------------------------------------


@query("runs", PING + " next_latitude next_longitude next_timestamp", "hops")
def win_lead_ping(t):
    return runs_of(t)


@query("runs", PING + " stationary event_start", "numbered")
def win_lag_flag(t):
    return runs_of(t)


@query("runs", PING + " event_id", "numbered")
def win_running_sum(t):
    return runs_of(t)


@query("stops", "device_id start_timestamp stop_events", "stops")
def win_stop_number(t):
    return number_rows(t.stops.drop("stop_events"), ["device_id"], ["start_timestamp", "stop_id"], "stop_events")


@query("clustered", "device_id stop_events raw_cluster_label", "raw")
def win_dbscan(t):
    return by_first_stop(raw_labels(t))


@query(
    "clustered",
    "device_id centroid_lat centroid_lon cluster_size cluster_label",
    "(SELECT *, middle[1] AS centroid_lat, middle[2] AS centroid_lon FROM numbered_middles)",
)
def win_dense_rank(t):
    return deterministic_labels(raw_labels(t))


@query("clustered", "uid stop_event cluster_label cluster_counts", "clustered")
def win_cluster_count(t):
    return clusters.cluster_stops(t.stops, CLUSTER)


@query("clustered", "uid stop_event cluster_label cluster_latitude cluster_longitude", "clustered")
def win_median(t):
    return clusters.cluster_stops(t.stops, CLUSTER)


TWICE = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid, stop_event ORDER BY start_timestamp) AS row_num
  FROM (SELECT * FROM clustered UNION ALL
        SELECT * REPLACE (start_timestamp + 31536000 AS start_timestamp) FROM clustered)) WHERE row_num = 1)"""


@query("clustered", CLUSTERED, TWICE)
def win_dedup(t):
    later = t.clustered.withColumn("start_timestamp", F.col("start_timestamp") + 31_536_000)
    return clusters.first_per_key(t.clustered.unionByName(later))


@query(
    "homes",
    "uid cluster_label home_time_visits home_time_unique_days unique_days_visited",
    "homes",
)
def win_home_rank(t):
    visits = stage(visits_of(t), "visits")
    best = homework.home_locations(visits, HOME_WORK).withColumnRenamed("home_cluster_label", "cluster_label")
    days = visits.select(*homework.PLACE, "home_time_unique_days")
    return best.join(days, homework.PLACE)


@query("works", "uid work_cluster_label work_time_visits", "(SELECT *, cluster_label AS work_cluster_label FROM works)")
def win_work_rank(t):
    visits = stage(visits_of(t), "visits")
    return homework.work_locations(visits, homework.home_locations(visits, HOME_WORK), HOME_WORK)


@query(
    "stops",
    "device_id stop_events previous_end next_start",
    """(SELECT device_id, stop_events, lag(end_timestamp) OVER w AS previous_end, lead(start_timestamp) OVER w AS next_start
      FROM stops WINDOW w AS (PARTITION BY device_id ORDER BY start_timestamp))""",
)
def win_named(t):
    """Neighbours in time by number: no task needs a device's whole time line."""
    numbered = stage(number_rows(t.stops, ["device_id"], ["start_timestamp", "stop_id"], "turn"), "numbered")
    before = numbered.select("device_id", (F.col("turn") + 1).alias("turn"), F.col("end_timestamp").alias("previous_end"))
    after = numbered.select("device_id", (F.col("turn") - 1).alias("turn"), F.col("start_timestamp").alias("next_start"))
    at = ["device_id", "turn"]
    return numbered.join(before, at, "left").join(after, at, "left")


# --- sorts, limits, top-k, set operations -----------------------------------------------------------


@query("hw", HW, "hw ORDER BY uid, year, date, start_timestamp")
def sort_output(t):
    return tables.sink_sorted(t.hw, t.path("sorted"), "uid", "year", "date", "start_timestamp")


@query("pairs", "uid year home_latitude", "pairs ORDER BY uid, year LIMIT 100")
def topk_limit(t):
    return places.extract_home_work(t.hw, keep_unmatched=True, limit=100)


@query("homes", "uid cluster_label home_time_visits", "homes")
def topk_per_group(t):
    return homes_of(t).withColumnRenamed("home_cluster_label", "cluster_label")


@query("stops", STOPS, "stops")
def union_years(t):
    root = f"{two_years(t)}/stops/{COUNTRY}"
    years = [tables.scan(t.spark, f"{root}/{y}", schemas.STOPS) for y in (2023, 2024)]
    return years[0].unionByName(years[1])


# --- scalar functions ----------------------------------------------------------------------------------


@query("stops", "device_id stop_events x y", "(SELECT *, median_longitude AS x, median_latitude AS y FROM stops)")
def geo_point(t):
    point = F.struct(F.col("median_longitude").alias("x"), F.col("median_latitude").alias("y"))
    return t.stops.select("device_id", "stop_events", point.alias("point")).select("*", "point.*")


@query("runs", PING + " distance", "numbered")
def geo_distance(t):
    return runs_of(t).withColumn("distance", stops.distance_to_next())


@query(
    "local",
    "uid stop_event polygons",
    "(SELECT uid, stop_event, count(*) AS polygons FROM hits GROUP BY ALL)",
)
def geo_within(t):
    """Number of polygons of the country around each stop that is in any."""
    lookup = tables.scan_tz_lookup(t.tz_codes, COUNTRY)
    inside = localtime.with_timezone(t.clustered, lookup).where("timezone IS NOT NULL")
    return inside.groupBy("uid", "stop_event").agg(F.count("*").alias("polygons"))


@query(
    "areas",
    "country_code tz geometry edges",
    """(SELECT z.country_code, z.tz, z.geometry, e.edges
      FROM tz_codes z LEFT JOIN (SELECT k, count(*) AS edges FROM edges GROUP BY ALL) e ON z.k = e.k)""",
)
def geo_from_wkt_safe(t):
    parsed = with_wkt_edges(t.areas, "geometry", "outline")
    return parsed.withColumn("edges", F.when(F.col("outline").isNotNull(), F.size("outline")).cast("bigint"))


@query(
    "core4",
    "device_id stop_events raw_cluster_label",
    """(SELECT device_id, stop_events, CASE WHEN raw_cluster_label = -1 THEN -1
      ELSE min(stop_events) OVER (PARTITION BY device_id, raw_cluster_label) END AS raw_cluster_label FROM raw4)""",
)
def geo_dbscan(t):
    return by_first_stop(raw_labels(t, CORE4))


@query(
    "local",
    "uid stop_event timezone utc_datetime",
    "(SELECT *, make_timestamp(start_timestamp * 1000000) AS utc_datetime FROM local)",
)
def ts_from_seconds(t):
    return t.local.withColumn("utc_datetime", utc_datetime("start_timestamp"))


@query("local", "uid stop_event timezone stop_datetime end_stop_datetime", "local")
def ts_to_local(t):
    zone = F.col("inputed_timezone")
    return t.local.withColumn("stop_datetime", local_datetime("start_timestamp", zone)).withColumn(
        "end_stop_datetime", local_datetime("end_timestamp", zone)
    )


@query("local", "uid stop_event timezone inputed_timezone", "local")
def tz_fallback(t):
    lookup = tables.scan_tz_lookup(t.tz_codes, COUNTRY)
    zoned = localtime.with_timezone(localtime.whole_seconds(t.clustered), lookup)
    return zoned.withColumn("inputed_timezone", F.coalesce("timezone", F.lit(DEFAULT_ZONE)))


@query("local", "uid stop_event timezone date end_date", "local")
def dt_date(t):
    return t.local.withColumn("date", F.to_date("stop_datetime")).withColumn(
        "end_date", F.to_date("end_stop_datetime")
    )


@query("local", "uid stop_event timezone year month day hour", "local")
def dt_parts(t):
    d = F.col("stop_datetime")
    return t.local.withColumns(
        {"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d), "hour": F.hour(d)}
    )


@query("local", "uid stop_event timezone weekday", "local")
def dt_dayofweek(t):
    return t.local.withColumn("weekday", F.dayofweek("stop_datetime"))


@query("local", "uid stop_event timezone weekend", "local")
def dt_weekend(t):
    return t.local.withColumn("weekend", F.dayofweek("stop_datetime").isin(1, 7))


@query("runs", PING + " time_diff", "numbered")
def math_ms_to_s(t):
    return runs_of(t).withColumn("time_diff", stops.gap_to_next_s())


@query("clustered", "uid stop_event stop_duration_s", "(SELECT *, stop_duration AS stop_duration_s FROM clustered)")
def math_duration(t):
    return t.clustered.withColumn("stop_duration_s", F.col("end_timestamp") - F.col("start_timestamp"))


@query(
    None,
    "event_id half_up doubled",
    """(SELECT event_id, CAST(round(event_id / 2 - 1000) AS BIGINT) AS half_up,
      CAST(round(value * 2) AS BIGINT) AS doubled FROM events)""",
)
def cast_round_int(t):
    return t.table("events").select(
        "event_id",
        round_to_bigint(F.col("event_id") / 2 - 1000).alias("half_up"),
        round_to_bigint(F.col("value") * 2).alias("doubled"),
    )


@query(
    None,
    "user_id middle low high",
    """(SELECT user_id, quantile_disc(value, 0.5) AS middle, min(value) AS low, max(value) AS high
      FROM events GROUP BY ALL)""",
)
def array_element(t):
    cuts = F.array(*[F.lit(i / 100) for i in range(101)])
    q = t.table("events").groupBy("user_id").agg(F.percentile_approx("value", cuts, F.lit(10_000)).alias("q"))
    return q.select(
        "user_id", F.get("q", F.lit(50)).alias("middle"), F.get("q", F.lit(0)).alias("low"), F.get("q", F.lit(100)).alias("high")
    )


@query(None, "event_id k", "(SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)")
def json_path(t):
    return t.table("events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


# --- registry ----------------------------------------------------------------------------------------------


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(q: Query):
        return lambda spark, sf_dir: q.build(Inputs.of(spark, sf_dir))

    return {name: bind(q) for name, q in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in QUERIES.items()}
