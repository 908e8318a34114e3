"""Intermediate tables that several steps read."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a local session gets a temporary folder; a cluster must name one that all its nodes share.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder shared by the cluster's nodes")
    return _local_folder(spark.sparkContext.applicationId)


@lru_cache
def _local_folder(application: str) -> str:
    """One temporary folder per local session, gone when the program ends."""
    folder = tempfile.mkdtemp(prefix=f"remitlens-{application}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder now and return a frame that reads it.

    This cuts the lineage and survives the loss of executors; unlike a checkpoint the copy is columnar, so later steps
    read only the columns they use.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
