"""Pings and timezone polygons derived from the test tables by arithmetic.

Every event of a user becomes a burst of pings near the user's home, work or
another place, depending on the local hour; nations become polygons over the
same area. No randomness: SQL can derive the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# One zone per region key.
ZONES = [
    "America/Bogota",
    "America/Mexico_City",
    "America/Sao_Paulo",
    "America/Argentina/Buenos_Aires",
    "America/New_York",
]
COUNTRY = "CO"
DEFAULT_ZONE = "America/Bogota"

# Events that one task turns into pings.
EVENTS_PER_TASK = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spread(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"))
    base = e.select(
        "event_id",
        "user_id",
        # Whole milliseconds since the epoch, rounded down, in any session zone.
        (
            F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86_400_000
            + F.hour("ts") * 3_600_000
            + F.minute("ts") * 60_000
            + F.floor(F.expr("extract(SECOND FROM ts)") * 1000).cast("bigint")
        ).alias("ms"),
        F.expr("ts - INTERVAL 5 HOURS").alias("local"),
    )
    hour, day = F.hour("local"), F.dayofweek("local")
    kind = (
        F.when(day.between(2, 6) & hour.between(9, 18), "W")
        .when((hour >= 19) | (hour < 8), "H")
        .otherwise("O")
    )
    event, user, i = F.col("event_id"), F.col("user_id"), F.col("i")
    # The far pings have negative numbers, so that the events are read once for all.
    steps = F.when(event % 13 == 0, F.sequence(F.lit(0), F.lit(6))).otherwise(F.sequence(F.lit(0), F.lit(5)))
    twice = F.when(event % 97 == 0, F.array(F.lit(-1), F.lit(-2))).otherwise(F.array().cast("array<int>"))
    bursts = base.withColumn("kind", kind).withColumn("i", F.explode(F.concat(steps, twice)))
    far = i < 0

    def place(home: float, work: float, other) -> F.Column:
        return F.when(F.col("kind") == "H", home).when(F.col("kind") == "W", work).otherwise(other)

    def jitter(a: int, b: int):
        return ((event * a + i * b) % 11 - 5) * 0.00001

    shift = (
        F.when((event % 17 == 0) & (i == 3), 0.0005)
        .when(event % 19 == 0, i * 0.00009)
        .otherwise(0.0)
    )
    latitude = 4.60 + (user % 15) * 0.01 + place(0.0, 0.004, 0.002 + (event % 5) * 0.0007) + jitter(7, 3) + shift
    longitude = -74.08 + F.floor(user / 15) * 0.01 + place(0.0, 0.003, 0.001 + (event % 3) * 0.0009) + jitter(5, 2)
    return bursts.select(
        F.concat(F.lit("d"), user.cast("string")).alias("device_id"),
        F.when(far, 4.6).otherwise(latitude).alias("latitude"),
        F.when(far, -74.0).otherwise(longitude).alias("longitude"),
        (F.col("ms") + F.when(far, 3).otherwise(i * 120000)).alias("timestamp"),
    )


def spread(events: DataFrame, per_task: int = EVENTS_PER_TASK) -> DataFrame:
    """Even slices of the events: a file's row groups are compressed, and one may hold most of the events."""
    pieces = -(-events.count() // per_task)
    return events if pieces <= 1 else events.repartition(pieces, *events.columns)


def fixture_tz_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A timezone polygon per nation."""
    n = table(spark, sf_dir, "nation")
    return polygons(n.select(F.col("n_nationkey").cast("bigint").alias("k"), F.col("n_regionkey").alias("region")))


def fixture_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A polygon per user, in the same form."""
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("k")).distinct()
    return polygons(users.withColumn("region", (F.col("k") % 5).cast("int")))


def polygons(keys: DataFrame) -> DataFrame:
    """A polygon per key on a board five high: plain, with a hole, in two parts,
    malformed, missing, or overlapping its neighbours."""
    k = F.col("k")
    south = 45_950_003 + (k % 5) * 300_000  # units of 1e-7 degree
    west = 740_850_003 - F.floor(k / 5) % 1000 * 200_000  # degrees west

    def deg(v, sign: str = ""):
        frac = F.lpad((v % 10_000_000).cast("string"), 7, "0")
        return F.concat(F.lit(sign), F.floor(v / 10_000_000).cast("string"), F.lit("."), frac)

    def ring(w, s, e, nth):
        corners = [(w, s), (e, s), (e, nth), (w, nth), (w, s)]
        points = [F.concat_ws(" ", deg(x, "-"), deg(y)) for x, y in corners]
        return F.concat(F.lit("("), F.concat_ws(", ", *points), F.lit(")"))

    whole = ring(west, south, west - 200_000, south + 300_000)
    hole = ring(west - 50_000, south + 100_000, west - 150_000, south + 200_000)
    lower = ring(west, south, west - 200_000, south + 120_000)
    upper = ring(west, south + 180_000, west - 200_000, south + 300_000)
    grown = ring(west + 50_000, south - 50_000, west - 250_000, south + 350_000)
    wkt = (
        F.when(k % 11 == 10, F.lit(None).cast("string"))
        .when(k % 5 == 1, F.concat(F.lit("POLYGON ("), whole, F.lit(", "), hole, F.lit(")")))
        .when(k % 5 == 2, F.concat(F.lit("MULTIPOLYGON (("), lower, F.lit("), ("), upper, F.lit("))")))
        .when(k % 5 == 3, F.concat(F.lit("POLYGON ("), whole))
        .when(k % 5 == 4, F.concat(F.lit("POLYGON ("), grown, F.lit(")")))
        .otherwise(F.concat(F.lit("POLYGON ("), whole, F.lit(")")))
    )
    zones = F.array(*[F.lit(z) for z in ZONES])
    return keys.select(
        F.when(k % 7 == 6, "MX").otherwise(COUNTRY).alias("country_code"),
        F.get(zones, F.col("region")).alias("tz"),
        wkt.alias("geometry"),
    )
