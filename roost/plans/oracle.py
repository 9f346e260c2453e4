"""The steps in DuckDB SQL, written independently of the Spark plans.

Each level is a chain of common table expressions; ``chain(level)`` is
everything up to it. Doubles are compared rounded, dates and times as text.
"""

from __future__ import annotations

from roost.functions.geo import EARTH_RADIUS_M
from roost.plans.fixture import COUNTRY, DEFAULT_ZONE, ZONES


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    known = " AND ".join(f"{c} IS NOT NULL" for c in (lat1, lon1, lat2, lon2))
    return (
        f"CASE WHEN {known} THEN 2 * {EARTH_RADIUS_M}::DOUBLE * asin(sqrt(least(1.0::DOUBLE, "
        f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * "
        f"pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))) END"
    )


PINGS = """
ev AS (SELECT event_id, user_id, epoch_us(ts) // 1000 AS ms, ts - INTERVAL 5 HOUR AS lt FROM events),
kinds AS (
  SELECT *, CASE WHEN isodow(lt) BETWEEN 1 AND 5 AND hour(lt) BETWEEN 9 AND 18 THEN 'W'
                 WHEN hour(lt) >= 19 OR hour(lt) < 8 THEN 'H' ELSE 'O' END AS kind
  FROM ev),
bursts AS (SELECT k.*, i FROM kinds k, range(0, 7) t(i) WHERE i < 6 OR event_id % 13 = 0),
pings AS MATERIALIZED (
  SELECT 'd' || user_id AS device_id,
    4.60e0 + (user_id % 15) * 0.01e0
      + CASE kind WHEN 'H' THEN 0e0 WHEN 'W' THEN 0.004e0 ELSE 0.002e0 + (event_id % 5) * 0.0007e0 END
      + ((event_id * 7 + i * 3) % 11 - 5) * 0.00001e0
      + CASE WHEN event_id % 17 = 0 AND i = 3 THEN 0.0005e0
             WHEN event_id % 19 = 0 THEN i * 0.00009e0 ELSE 0e0 END AS latitude,
    -74.08e0 + (user_id // 15) * 0.01e0
      + CASE kind WHEN 'H' THEN 0e0 WHEN 'W' THEN 0.003e0 ELSE 0.001e0 + (event_id % 3) * 0.0009e0 END
      + ((event_id * 5 + i * 2) % 11 - 5) * 0.00001e0 AS longitude,
    ms + i * 120000 AS timestamp
  FROM bursts
  UNION ALL
  SELECT 'd' || user_id, 4.6e0, -74.0e0, ms + 3 FROM ev, range(0, 2) t(i) WHERE event_id % 97 = 0)"""

def summary(points: str) -> str:
    return f"""SELECT device_id, event_id AS stop_id, min(timestamp) AS start_timestamp, max(timestamp) AS end_timestamp,
    quantile_disc(latitude, 0.5) AS median_latitude, quantile_disc(longitude, 0.5) AS median_longitude
  FROM {points} GROUP BY ALL HAVING end_timestamp - start_timestamp >= 300000"""


RUNS = f"""
hops AS (
  SELECT *, lead(latitude) OVER w AS next_latitude, lead(longitude) OVER w AS next_longitude,
    lead(timestamp) OVER w AS next_timestamp,
    {hav('latitude', 'longitude', 'next_latitude', 'next_longitude')} AS distance,
    (next_timestamp - timestamp) / 1000 AS time_diff,
    distance <= 20 AND coalesce(time_diff, 0) <= 3600 AS stationary
  FROM (FROM pings GROUP BY ALL) WINDOW w AS (PARTITION BY device_id ORDER BY timestamp, latitude, longitude)),
turns AS (
  -- Rows of one state in a row have the same difference of their two row numbers.
  SELECT *, coalesce(stationary, FALSE) AS rests,
    row_number() OVER w - row_number() OVER (w2 ORDER BY timestamp, latitude, longitude) AS stretch
  FROM hops
  WINDOW w AS (PARTITION BY device_id ORDER BY timestamp, latitude, longitude), w2 AS (PARTITION BY device_id, rests)),
heads AS (
  SELECT *, (rests AND row_number() OVER (PARTITION BY device_id, rests, stretch
    ORDER BY timestamp, latitude, longitude) = 1)::INT AS event_start
  FROM turns),
numbered AS MATERIALIZED (
  SELECT *, (sum(event_start) OVER (PARTITION BY device_id ORDER BY timestamp, latitude, longitude
    ROWS UNBOUNDED PRECEDING))::BIGINT AS event_id
  FROM heads)"""

STOPS = f"""
points AS (SELECT device_id, timestamp, latitude, longitude, event_id FROM numbered WHERE rests),
near_points AS MATERIALIZED (
  FROM points WINDOW r AS (PARTITION BY device_id, event_id)
  QUALIFY max(timestamp) OVER r - min(timestamp) OVER r >= 300000 AND {hav(
      'latitude', 'longitude', 'quantile_disc(latitude, 0.5) OVER r', 'quantile_disc(longitude, 0.5) OVER r')} <= 20),
first_stops AS ({summary('points')}),
stops AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY start_timestamp) AS stop_events
  FROM ({summary('near_points')}))"""


def dbscan(min_points: int, name: str) -> str:
    """Brute force: all pairs, cores, closure of core links, border by earliest core."""
    return f"""
pairs_{name} AS MATERIALIZED (
  SELECT a.device_id, a.stop_events AS a, b.stop_events AS b
  FROM stops a JOIN stops b ON a.device_id = b.device_id
  WHERE {hav('a.median_latitude', 'a.median_longitude', 'b.median_latitude', 'b.median_longitude')} <= 20),
cores_{name} AS (
  SELECT device_id, a AS stop_events FROM pairs_{name} GROUP BY ALL HAVING count(*) >= {min_points}),
links_{name} AS MATERIALIZED (
  SELECT p.* FROM pairs_{name} p
  JOIN cores_{name} x ON p.device_id = x.device_id AND p.a = x.stop_events
  JOIN cores_{name} y ON p.device_id = y.device_id AND p.b = y.stop_events),
reach_{name} AS (
  SELECT device_id, stop_events AS a, stop_events AS b FROM cores_{name}
  UNION
  SELECT r.device_id, r.a, l.b FROM reach_{name} r JOIN links_{name} l ON r.device_id = l.device_id AND r.b = l.a),
comps_{name} AS MATERIALIZED (
  SELECT device_id, b AS stop_events, min(a) AS first_stop FROM reach_{name} GROUP BY ALL),
{name} AS MATERIALIZED (
  SELECT s.*, coalesce(c.first_stop, n.first_stop, -1) AS raw_cluster_label
  FROM stops s
  LEFT JOIN comps_{name} c ON s.device_id = c.device_id AND s.stop_events = c.stop_events
  LEFT JOIN (
    SELECT p.device_id, p.a AS stop_events, min(c.first_stop) AS first_stop
    FROM pairs_{name} p JOIN comps_{name} c ON p.device_id = c.device_id AND p.b = c.stop_events GROUP BY ALL) n
    ON s.device_id = n.device_id AND s.stop_events = n.stop_events)"""


# A cluster's label is the place of its mean among the device's sorted means; noise is united at the end.
CLUSTERED = (
    dbscan(2, "raw")
    + """,
middles AS MATERIALIZED (
  SELECT device_id, raw_cluster_label AS first_stop, count(*) AS cluster_size,
    [avg(median_latitude), avg(median_longitude)] AS middle
  FROM raw WHERE raw_cluster_label >= 0 GROUP BY ALL),
numbered_middles AS MATERIALIZED (
  SELECT m.*, list_position(o.sorted, m.middle) - 1 AS cluster_label
  FROM middles m JOIN (SELECT device_id, list_sort(list(DISTINCT middle)) AS sorted FROM middles GROUP BY device_id) o
  USING (device_id)),
members AS MATERIALIZED (
  SELECT raw.*, m.cluster_label FROM raw
  JOIN numbered_middles m ON raw.device_id = m.device_id AND raw.raw_cluster_label = m.first_stop),
places AS (
  SELECT device_id, cluster_label, count(*) AS cluster_counts,
    median(median_latitude) AS cluster_latitude, median(median_longitude) AS cluster_longitude
  FROM members GROUP BY ALL),
told AS (
  SELECT * FROM members JOIN places USING (device_id, cluster_label)
  UNION ALL BY NAME
  SELECT *, -1 AS cluster_label, 1 AS cluster_counts, median_latitude AS cluster_latitude,
    median_longitude AS cluster_longitude
  FROM raw WHERE raw_cluster_label < 0),
clustered AS MATERIALIZED (
  SELECT device_id AS uid, stop_events AS stop_event, start_timestamp / 1000 AS start_timestamp,
    end_timestamp / 1000 AS end_timestamp, end_timestamp / 1000 - start_timestamp / 1000 AS stop_duration,
    median_latitude AS stop_latitude, median_longitude AS stop_longitude, cluster_label::BIGINT AS cluster_label,
    cluster_counts::BIGINT AS cluster_counts, cluster_latitude, cluster_longitude
  FROM told)"""
)

_ZONE_LIST = "[" + ", ".join(f"'{z}'" for z in ZONES) + "]"


def _deg(v: str, sign: str = "") -> str:
    return f"'{sign}' || ({v}) // 10000000 || '.' || lpad((({v}) % 10000000)::VARCHAR, 7, '0')"


def _ring(w: str, s: str, e: str, n: str) -> str:
    corners = [(w, s), (e, s), (e, n), (w, n), (w, s)]
    return "'(' || " + " || ', ' || ".join(f"{_deg(x, '-')} || ' ' || {_deg(y)}" for x, y in corners) + " || ')'"


def tz_codes(keys: str) -> str:
    """Polygons per key, and the edges of those that are well formed."""
    return f"""
board AS (
  SELECT k, region, 45950003 + (k % 5) * 300000 AS s, 740850003 - (k // 5) % 1000 * 200000 AS w
  FROM ({keys})),
rings AS (
  SELECT *, {_ring('w', 's', 'w - 200000', 's + 300000')} AS whole,
    {_ring('w - 50000', 's + 100000', 'w - 150000', 's + 200000')} AS hole,
    {_ring('w', 's', 'w - 200000', 's + 120000')} AS lower_part,
    {_ring('w', 's + 180000', 'w - 200000', 's + 300000')} AS upper_part,
    {_ring('w + 50000', 's - 50000', 'w - 250000', 's + 350000')} AS grown
  FROM board),
tz_codes AS MATERIALIZED (
  SELECT k, CASE WHEN k % 7 = 6 THEN 'MX' ELSE 'CO' END AS country_code,
    {_ZONE_LIST}[region + 1] AS tz,
    CASE WHEN k % 11 = 10 THEN NULL
         WHEN k % 5 = 1 THEN 'POLYGON (' || whole || ', ' || hole || ')'
         WHEN k % 5 = 2 THEN 'MULTIPOLYGON ((' || lower_part || '), (' || upper_part || '))'
         WHEN k % 5 = 3 THEN 'POLYGON (' || whole
         WHEN k % 5 = 4 THEN 'POLYGON (' || grown || ')'
         ELSE 'POLYGON (' || whole || ')' END AS geometry
  FROM rings),
wkt_rings AS (
  SELECT k, country_code, tz, string_split(unnest(regexp_extract_all(geometry, '\\(([-0-9. ,]+)\\)', 1)), ', ') AS p
  FROM tz_codes
  WHERE regexp_full_match(geometry, 'POLYGON \\(\\([-0-9. ,]+\\)(, \\([-0-9. ,]+\\))*\\)')
     OR regexp_full_match(geometry, 'MULTIPOLYGON \\(\\(\\([-0-9. ,]+\\)\\)(, \\(\\([-0-9. ,]+\\)\\))*\\)')),
edges AS MATERIALIZED (
  SELECT k, country_code, tz,
    split_part(p[i], ' ', 1)::DOUBLE AS x0, split_part(p[i], ' ', 2)::DOUBLE AS y0,
    split_part(p[i + 1], ' ', 1)::DOUBLE AS x1, split_part(p[i + 1], ' ', 2)::DOUBLE AS y1
  FROM (SELECT *, unnest(range(1, len(p))) AS i FROM wkt_rings))"""


TZ_CODES = tz_codes("SELECT n_nationkey AS k, n_regionkey AS region FROM nation")
AREAS = tz_codes("SELECT DISTINCT user_id AS k, user_id % 5 AS region FROM events")

LOCAL = f"""
hits AS (
  SELECT s.uid, s.stop_event, e.k, any_value(e.tz) AS tz
  FROM clustered s JOIN edges e
    ON e.country_code = '{COUNTRY}' AND (e.y0 > s.stop_latitude) <> (e.y1 > s.stop_latitude)
   AND s.stop_longitude < (e.x1 - e.x0) * (s.stop_latitude - e.y0) / (e.y1 - e.y0) + e.x0
  GROUP BY s.uid, s.stop_event, e.k HAVING count(*) % 2 = 1),
zoned AS MATERIALIZED (
  SELECT s.* REPLACE (
      CAST(round(s.start_timestamp) AS BIGINT) AS start_timestamp,
      CAST(round(s.end_timestamp) AS BIGINT) AS end_timestamp,
      CAST(round(s.stop_duration) AS BIGINT) AS stop_duration),
    h.tz AS timezone, coalesce(h.tz, '{DEFAULT_ZONE}') AS inputed_timezone
  FROM clustered s LEFT JOIN hits h ON s.uid = h.uid AND s.stop_event = h.stop_event),
clocked AS (
  SELECT *,
    timezone(inputed_timezone, timezone('UTC', make_timestamp(start_timestamp * 1000000))) AS stop_datetime,
    timezone(inputed_timezone, timezone('UTC', make_timestamp(end_timestamp * 1000000))) AS end_stop_datetime
  FROM zoned),
local AS MATERIALIZED (
  SELECT *, CAST(stop_datetime AS DATE) AS date, year(stop_datetime) AS year, month(stop_datetime) AS month,
    day(stop_datetime) AS day, hour(stop_datetime) AS hour, dayofweek(stop_datetime) + 1 AS weekday,
    dayofweek(stop_datetime) IN (0, 6) AS weekend, CAST(end_stop_datetime AS DATE) AS end_date
  FROM clocked)"""

RANKED = "QUALIFY row_number() OVER (PARTITION BY uid ORDER BY {0}_time_visits DESC, {0}_time_unique_days DESC, cluster_label) = 1"

HOMES = f"""
visits AS MATERIALIZED (
  SELECT uid, cluster_label, count(DISTINCT date) AS unique_days_visited,
    count(*) FILTER (rest) AS home_time_visits, count(DISTINCT date) FILTER (rest) AS home_time_unique_days,
    count(*) FILTER (duty) AS work_time_visits, count(DISTINCT date) FILTER (duty) AS work_time_unique_days,
    avg(cluster_latitude) AS cluster_latitude, avg(cluster_longitude) AS cluster_longitude
  FROM (SELECT *, weekend OR hour NOT BETWEEN 8 AND 18 AS rest, NOT weekend AND hour BETWEEN 9 AND 18 AS duty
        FROM local WHERE cluster_label >= 0)
  GROUP BY ALL),
eligible_homes AS (FROM visits WHERE home_time_visits > 0 AND unique_days_visited >= 14),
homes AS MATERIALIZED (FROM eligible_homes {RANKED.format('home')})"""

WORKS = f"""
work_home AS (
  SELECT v.*, h.cluster_label AS home_cluster_label,
    {hav('v.cluster_latitude', 'v.cluster_longitude', 'h.cluster_latitude', 'h.cluster_longitude')} AS distance_from_home,
    coalesce(v.cluster_label <> h.cluster_label, FALSE) AND v.work_time_unique_days >= 8 AS is_valid
  FROM visits v LEFT JOIN homes h USING (uid) WHERE v.work_time_visits > 0),
works AS MATERIALIZED (FROM work_home WHERE is_valid AND distance_from_home >= 50 {RANKED.format('work')})"""

HW = """
hw AS MATERIALIZED (
  SELECT l.*,
    CASE l.cluster_label WHEN -1 THEN 'O' WHEN h.cluster_label THEN 'H' WHEN w.cluster_label THEN 'W' ELSE 'O' END
      AS location_type,
    CASE WHEN location_type = 'O' THEN -1 ELSE 1 END AS location_label
  FROM local l LEFT JOIN homes h USING (uid) LEFT JOIN works w USING (uid))"""

# A device has one home and one work, so any of their rows tells the place.
PAIRS = """
pairs AS (
  SELECT uid, year,
    any_value(cluster_latitude) FILTER (location_type = 'H') AS home_latitude,
    any_value(cluster_longitude) FILTER (location_type = 'H') AS home_longitude,
    any_value(cluster_latitude) FILTER (location_type = 'W') AS work_latitude,
    any_value(cluster_longitude) FILTER (location_type = 'W') AS work_longitude
  FROM hw GROUP BY uid, year HAVING count_if(location_type = 'H') > 0)"""

LEVELS = {
    "pings": [PINGS],
    "runs": [PINGS, RUNS],
    "stops": [PINGS, RUNS, STOPS],
    "core4": [PINGS, RUNS, STOPS, dbscan(4, "raw4")],
    "clustered": [PINGS, RUNS, STOPS, CLUSTERED],
    "areas": [AREAS],
    "local": [PINGS, RUNS, STOPS, CLUSTERED, TZ_CODES, LOCAL],
    "homes": [PINGS, RUNS, STOPS, CLUSTERED, TZ_CODES, LOCAL, HOMES],
    "works": [PINGS, RUNS, STOPS, CLUSTERED, TZ_CODES, LOCAL, HOMES, WORKS],
    "hw": [PINGS, RUNS, STOPS, CLUSTERED, TZ_CODES, LOCAL, HOMES, WORKS, HW],
    "pairs": [PINGS, RUNS, STOPS, CLUSTERED, TZ_CODES, LOCAL, HOMES, WORKS, HW, PAIRS],
}


def chain(level: str | None, select: str) -> str:
    """A full query: the steps up to ``level``, then ``select``."""
    if level is None:
        return select.strip()
    return "WITH RECURSIVE" + ",".join(LEVELS[level]) + "\n" + select.strip()


# --- select lists that match the Spark side's ``shown`` columns ------------------

POSITIONS = {
    "latitude", "longitude", "median_latitude", "median_longitude", "next_latitude", "next_longitude",
    "stop_latitude", "stop_longitude", "cluster_latitude", "cluster_longitude",
    "home_latitude", "home_longitude", "work_latitude", "work_longitude", "x", "y",
}
MEANS = {"centroid_lat", "centroid_lon"}
SECONDS = {"distance", "time_diff", "distance_from_home", "stop_duration_s"}
CLOCK = {"stop_datetime", "end_stop_datetime", "date", "end_date", "utc_datetime"}
COUNTS = {
    "stop_events", "stop_id", "stop_event", "event_id", "event_start", "cluster_label", "cluster_counts",
    "raw_cluster_label", "year", "month", "day", "hour", "weekday", "location_label", "cluster_size",
}


def shown_sql(columns: list[str]) -> str:
    """Round, stringify or widen by column name, as ``catalog.shown`` does in Spark."""
    out = []
    for c in columns:
        if c in POSITIONS:
            out.append(f"round({c}, 7) AS {c}")
        elif c in MEANS:
            out.append(f"round({c} + 1.3e-9, 7) AS {c}")
        elif c in SECONDS:
            out.append(f"round({c}, 3) AS {c}")
        elif c in CLOCK:
            out.append(f"CAST({c} AS VARCHAR) AS {c}")
        elif c in COUNTS:
            out.append(f"CAST({c} AS BIGINT) AS {c}")
        else:
            out.append(c)
    return ", ".join(out)
