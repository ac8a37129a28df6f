"""Splitting a URL list into chunks, slicing it, and handing the chunks out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_SIZE = 5000


def chunk_file_name(chunk_id: Column) -> Column:
    return F.format_string("urls_chunk_%04d.txt", chunk_id)


def chunk_number(container_name: Column, prefix: str = "chunk-") -> Column:
    """The chunk id in a container name that ends in '<prefix><id>'."""
    return F.regexp_extract(container_name, f"{prefix}(.*)$", 1)


def assign_chunks(positioned: DataFrame, size: int = CHUNK_SIZE, position: str = "position") -> DataFrame:
    """Add chunk_id, 1-based, from the 0-based position in the list."""
    return positioned.withColumn("chunk_id", (F.floor(F.col(position) / size) + 1).cast("long"))


def manifest(urls: DataFrame, size: int = CHUNK_SIZE) -> DataFrame:
    """One row per chunk. Chunk bounds follow from the number of URLs alone, so only that is counted."""
    total = urls.count()
    n_chunks = -(-total // size)
    start = (F.col("id") - 1) * size
    end = F.least(F.col("id") * size, F.lit(total))
    return urls.sparkSession.range(1, n_chunks + 1).select(
        F.col("id").alias("chunk_id"),
        chunk_file_name(F.col("id")).alias("filename"),
        (end - start).alias("url_count"),
        start.alias("start_index"),
        end.alias("end_index"),
    )


def manifest_of(chunked: DataFrame, position: str = "position") -> DataFrame:
    """The manifest as counted from chunked rows, for checking written chunks."""
    return chunked.groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("url_count"),
        F.min(position).alias("start_index"),
        (F.max(position) + 1).alias("end_index"),
    )


def numbered(spark: SparkSession, names: Sequence[str], column: str) -> DataFrame:
    """A parameter list, such as instances or regions, as a table with 0-based index."""
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], f"slot long, {column} string")


def round_robin(chunks: DataFrame, names: Sequence[str], column: str = "instance") -> DataFrame:
    """Chunk i goes to names[(i - 1) mod n]. The list is a parameter, so it is a literal array."""
    pool = F.array(*[F.lit(n) for n in names])
    return chunks.withColumn(column, F.get(pool, F.pmod(F.col("chunk_id") - 1, F.lit(len(names))).cast("int")))


def assign_names(chunks: DataFrame, pool: DataFrame) -> DataFrame:
    """Chunk i gets the i-th usable name of the pool table (slot, name); null beyond its end."""
    usable = pool.where(F.col("name").rlike("^[a-z]{3,10}$"))
    return chunks.join(usable.withColumn("chunk_id", F.col("slot") + 1).drop("slot"), "chunk_id", "left")


def deployment_status(chunks: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Each chunk with the status of its deployment; chunks without an outcome are pending."""
    return chunks.join(outcomes, "chunk_id", "left").withColumn("status", F.coalesce("status", F.lit("pending")))
