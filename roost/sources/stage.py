"""Intermediate tables in the folder the cluster shares.

An iterative or re-read intermediate result is written as Parquet and read
back: that cuts lineage, survives lost executors, keeps columns prunable and
gives the planner real sizes.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Unset, a local session gets a temporary folder; a cluster has no folder
    that all executors see unless it names one, so there it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="roost-")
    spark.sparkContext.setCheckpointDir(path)
    return shared_dir(spark)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/roost/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write the result once and continue from the written table."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "snappy").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stage_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stage`` returned, once nothing reads them any more."""
    for table in tables:
        jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(table.stage_path)
        path.getFileSystem(conf).delete(path, True)
