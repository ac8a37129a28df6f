"""A local session for tests and benchmarks; on a cluster the caller's own session is used as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str = "8", app: str = "vitrine", memory: str = "12g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a run over `input_bytes` of files on `cores` cores, to be given when the session is built.

    Shuffle partitions start near 256 MB of input each, at least three waves of tasks, and are
    merged by adaptive execution where a shuffle turns out smaller. Skewed join partitions are split.
    """
    partitions = max(3 * cores, input_bytes // (256 << 20))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # rows that go to a Python worker at a time: whole texts, of which a few are very long
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # a filter on the partitions of a joined table is worth a small job of its own where its side is too large to broadcast
        "spark.sql.optimizer.dynamicPartitionPruning.reuseBroadcastOnly": "false",
        "spark.sql.session.timeZone": "UTC",
    }
