"""Session settings the operators rely on. A cluster's own settings always win."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, memory: str = "20g", app: str = "tidemark") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
        # List aggregates keep hashing small groups instead of falling back to sorting at 128.
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "65536")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a local one only where none is configured."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder on a cluster")
    root = os.path.join(tempfile.mkdtemp(prefix="spark-", dir="/tmp"), "checkpoint")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def staged(df: DataFrame) -> DataFrame:
    """The same rows read back from a written table in the shared checkpoint folder.

    For a result several later plans read: it is computed once, its lineage is cut, and a lost
    executor costs a re-read rather than a recomputation.
    """
    path = f"{checkpoint_root(df.sparkSession).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_by_one(parts: list[DataFrame]) -> DataFrame:
    """The union of small results, each computed and written before the next begins.

    One plan of them all would hold the broadcasts and generated code of every part in the driver
    and the shuffle files of every part on disk at once. After each the JVM is asked to collect
    garbage: only that lets Spark remove what the finished part left.
    """
    written = []
    for part in parts:
        written.append(staged(part))
        part.sparkSession.sparkContext._jvm.System.gc()
    return reduce(DataFrame.unionByName, written)
