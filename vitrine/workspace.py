"""Intermediate tables in the folder that every executor shares.

A table written here survives the loss of any executor and cuts the lineage of
what is built on it. Because Spark knows the exact byte size of the files, joins
against a staged table are planned from that size: a small one is broadcast,
a large one is shuffled and left to adaptive skew handling. No join in this
library forces a broadcast of anything whose size depends on the data.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only for local sessions without it."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="vitrine-")
    return _local_roots[app]


def scratch(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{root(spark)}/vitrine/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and return a scan of the written table."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from the place where the driver found it."""
    here = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if here not in known:
        env["PYTHONPATH"] = os.pathsep.join([here, *filter(None, known)])


UNKNOWN_BYTES = 1 << 60


def _input_bytes(df: DataFrame) -> int:
    """Bytes of everything the plan reads. Rows handed over without a size, as from a local list,
    are reported by Spark with the largest possible number and count as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(size for size in sizes if size < UNKNOWN_BYTES)


def partitions_for(df: DataFrame, input_bytes: int = 128 << 20) -> int:
    """Partitions so that each stands for about `input_bytes` of the files read, never below the session's setting."""
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(configured, _input_bytes(df) // input_bytes + 1)



def partitions_for_files(df: DataFrame, rows_per_file: int = 1, files: int = 500) -> int:
    """Partitions so that a task writes about `files` files: small files cost by their number, not their bytes."""
    return df.count() // (rows_per_file * files) + 1
