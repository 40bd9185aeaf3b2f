"""Where intermediate and test tables go: the folder every executor can reach."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _local_test_folder() -> str:
    folder = tempfile.mkdtemp(prefix="goldpan-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; for a local master a temporary one, removed at exit."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return _local_test_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nobody has written to yet."""
    return f"{shared_folder(spark)}/goldpan/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that several branches of one plan need, and read it back.

    The written table cuts the lineage: a lost executor re-reads files instead of repeating
    the joins and the deduplication behind them.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
