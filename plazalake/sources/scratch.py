"""The shared folder for checkpoints and tables between jobs."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """Below ``spark.checkpoint.dir`` if the cluster names one. Only where it is unset (tests, a
    laptop) a temporary folder is made and remembered in the session."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="plazalake-")
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/plazalake-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage and outlives lost executors."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
