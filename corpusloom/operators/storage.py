"""Where long lineages end: tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, `spark.checkpoint.dir`; a temporary one only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="corpusloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def save_point(df: DataFrame) -> DataFrame:
    """Write to the folder that all executors share and read back, so that a long lineage ends."""
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
