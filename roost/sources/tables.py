"""Stored tables: one Parquet folder per step under a common root.

    <root>/pings/<country>/<year>/      <root>/clustered/<country>/
    <root>/stops/<country>/<year>/      <root>/local/<country>/
    <root>/tz_codes/                    <root>/hw/<country>/
    <root>/carry/<country>/<year>/      <root>/open_stops/<country>/<year>/
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from roost import schemas


def scan(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a table by its declared schema (no inference), checked on read."""
    return schemas.conform(spark.read.parquet(path), schema)


def scan_pings(spark: SparkSession, root: str, country: str, year: int) -> DataFrame:
    return scan(spark, f"{root}/pings/{country}/{year}", schemas.PINGS)


def scan_stops_all_years(spark: SparkSession, root: str, country: str, open_year: int | None = None) -> DataFrame:
    """All years' stops of a country, with the year of the export as ``src_year``.

    ``open_year``: with those that the export of that year has left open.
    """
    folders = [f"{root}/stops/{country}"]
    if open_year is not None:
        folders.append(f"{root}/open_stops/{country}/{open_year}")
    found = spark.read.option("recursiveFileLookup", "true").parquet(*folders)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d+)/[^/]*$", 1).cast("int")
    dated = found.select("*", folder.alias("src_year"))
    return schemas.conform(dated, StructType([*schemas.STOPS.fields, StructField("src_year", IntegerType())]))


def scan_carry(spark: SparkSession, root: str, country: str, year: int) -> DataFrame:
    """What the export of ``year`` has left for the next one."""
    return scan(spark, f"{root}/carry/{country}/{year}", schemas.CARRY)


def scan_clusters(spark: SparkSession, root: str, country: str) -> DataFrame:
    return scan(spark, f"{root}/clustered/{country}", schemas.CLUSTERED)


def scan_local(spark: SparkSession, root: str, country: str) -> DataFrame:
    return scan(spark, f"{root}/local/{country}", schemas.LOCAL)


def scan_hw(spark: SparkSession, root: str, country: str) -> DataFrame:
    return scan(spark, f"{root}/hw/{country}", schemas.HW)


def scan_tz_lookup(tz_codes: DataFrame, country: str) -> DataFrame:
    """The timezone polygons of one country."""
    return tz_codes.where(F.col("country_code") == F.lit(country))


def sink_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write Parquet with Snappy, replacing the folder, and read it back."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sink_clustered(df: DataFrame, path: str, *order: str) -> DataFrame:
    """Write with the rows of each file in order, keeping the step's own partitioning.

    For steps that end partitioned by device, whose rows stay together; no
    further shuffle, and no sampling pass that would compute the step twice.
    """
    return sink_parquet(df.sortWithinPartitions(*order), path)


def sink_sorted(df: DataFrame, path: str, *order: str) -> DataFrame:
    """Write a stored table to files that together are in global order, without a global sort task.

    Range partitioning gives each task a slice of the order; sorting inside the
    slices finishes it and gives the files narrow min/max statistics. The whole
    order is the range key, so one frequent leading value is split too. Spark
    samples the input first: pass a stored table.
    """
    return sink_parquet(df.repartitionByRange(*order).sortWithinPartitions(*order), path)


def name_table(spark: SparkSession, name: str, path: str) -> None:
    """Give a stored folder a name in the catalog; the name moves if it was another folder's."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path, source="parquet")


def sink_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Save as a named table over ``path``; a rerun replaces it rather than appending."""
    df.write.mode("overwrite").option("path", path).option("compression", "snappy").saveAsTable(name)
    return df.sparkSession.table(name)
