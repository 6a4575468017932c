"""Folders that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="ledgerhub-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder name below the shared folder."""
    return f"{shared_folder(spark)}/ledgerhub-{purpose}-{uuid.uuid4().hex}"


def written_once(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` stored in the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    folder = run_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
