"""Session settings for scripts and tests. Operators never change the session they are given.

Clusters gain from one of them too: ``spark.sql.codegen.hugeMethodLimit=8000``. The wide projections here can generate
methods above the size the JVM compiles; Spark then does better without whole-stage code for that stage.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", memory: str = "16g", shuffle_partitions: int = 8) -> SparkSession:
    """Single-node session for tests and the benchmark. On a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("remitlens")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", memory))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
