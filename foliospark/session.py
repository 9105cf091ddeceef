"""Session settings, table access and the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "foliospark", master: str | None = None) -> SparkSession:
    """A session with the settings the engine is made for; a cluster's own settings win elsewhere."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    return (builder.master(master) if master else builder).getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, the folder that driver and executors share; one's own only on one machine without that setting."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoints-"))
    return f"{sc.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written to the shared folder and read back, with its lineage cut."""
    path, schema = fresh_path(df.sparkSession, name), df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)
