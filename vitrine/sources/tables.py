"""Readers. Text and JSON are read once and then kept as Parquet; only Parquet scans prune and push down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions import text
from vitrine.operators.ordering import with_position

DOCUMENT_FILE = r"/extracted/[^/]+\.json$"
INSTANCE_IN_PATH = r"/instance_=?([^/]+)/"
CHUNK_IN_PATH = r"/chunk_=?([^/]+)/"
LOG_LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:,\d+)?) - (\S+) - ([A-Z]+) - (.*)$"
LINK = r"https://[^ ]+"

MANIFEST_SCHEMA = (
    "total_urls long, chunk_size long, num_chunks long, "
    "chunks array<struct<chunk_id:long,filename:string,url_count:long,start_index:long,end_index:long>>"
)
CHECKPOINT_SCHEMA = "container_id string, timestamp string, processed long, stats struct<success:long,failed:long>"


def read_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_url_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per non-blank line, stripped, with the keys that give its order in the files."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        text.strip(F.col("value")).alias("url"),
    )
    return lines.where(F.col("url") != "")


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """URLs with their exact 0-based position over all lines of all files."""
    ordered = with_position(read_url_lines(spark, path), ["file", "block", "line"], name="line_no")
    return ordered.select("line_no", "url")


def path_columns(file: Column) -> dict[str, Column]:
    """Instance and chunk as written in the directory names."""
    return {
        "instance": F.regexp_extract(file, INSTANCE_IN_PATH, 1),
        "chunk": F.regexp_extract(file, CHUNK_IN_PATH, 1),
    }


def read_documents(spark: SparkSession, folder: str, pattern: str = DOCUMENT_FILE, one_per_file: bool = True) -> DataFrame:
    """Collected JSON documents as text, one per file or one per line, with instance and chunk."""
    reader = spark.read.option("recursiveFileLookup", True)
    docs = reader.text(folder, wholetext=one_per_file).select("value", F.col("_metadata.file_path").alias("file"))
    return docs.where(F.col("file").rlike(pattern)).withColumns(path_columns(F.col("file")))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path, size, instance and chunk of every file. Only the listing is read, not the content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(F.col("path").alias("file"), F.col("length").alias("bytes")).withColumns(path_columns(F.col("file")))


def read_html(spark: SparkSession, folder: str) -> DataFrame:
    """One row per page file, plain or gzip; the product id is the file's base name."""
    pages = spark.read.option("recursiveFileLookup", True).text(folder, wholetext=True)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)\.html(?:\.gz)?$", 1)
    return pages.select(name.alias("product_id"), F.col("value").alias("html"))


def read_table(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    """A training table as csv, tsv, json lines or parquet, with a declared schema."""
    if kind in ("csv", "tsv"):
        # Text with quotes and line breaks comes back as it was written.
        return spark.read.csv(
            path, schema=schema, header=True, sep="\t" if kind == "tsv" else ",", quote='"', escape='"', multiLine=True,
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
    if kind == "json":
        return spark.read.schema(schema).json(path)
    return spark.read.schema(schema).parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    whole = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path)
    return whole.select("total_urls", "chunk_size", "num_chunks", F.inline("chunks"))


def read_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHECKPOINT_SCHEMA).option("multiLine", True).json(path).select(
        "container_id", "timestamp", "processed", F.col("stats.success").alias("success"),
        F.col("stats.failed").alias("failed"),
    )


def parse_log_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Time, logger, level, message and every link of each log line."""
    v = F.col(value)
    return lines.withColumns(
        {
            "logged_at": F.regexp_extract(v, LOG_LINE, 1),
            "logger": F.regexp_extract(v, LOG_LINE, 2),
            "level": F.regexp_extract(v, LOG_LINE, 3),
            "message": F.regexp_extract(v, LOG_LINE, 4),
            "links": F.regexp_extract_all(v, F.lit(LINK), F.lit(0)),
        }
    )


def failed_links(lines: DataFrame, word: str = "Failed", value: str = "value") -> DataFrame:
    """Every link on the lines that hold `word`."""
    hits = lines.where(F.contains(F.col(value), F.lit(word)))
    return hits.select(F.explode(F.regexp_extract_all(F.col(value), F.lit(LINK), F.lit(0))).alias("url"))
