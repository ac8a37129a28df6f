"""Row-wise work on whole texts in Arrow batches, and small helpers that several operators share."""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Callable, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Turns the texts of a batch (None for null) into one list of values for each result column.
Process = Callable[[list], Sequence[list]]


_remembering: dict[str, Callable[[], None]] = {}


def only(operator: str, forget: Callable[[], None]) -> None:
    """Called by an operator before it uses what it remembers between the batches of a Python worker: what others remember there goes.

    Workers live on after a stage, and so would the memory of every operator that has run in them.
    """
    if operator not in _remembering:
        for other in _remembering.values():
            other()
        _remembering.clear()
        _remembering[operator] = forget


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from the place where the driver found it."""
    here = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if here not in known:
        env["PYTHONPATH"] = os.pathsep.join([here, *filter(None, known)])


def with_columns(df: DataFrame, text: str, fields: list[tuple[str, T.DataType]], process: Process) -> DataFrame:
    """`df` with result columns computed from one text column, batch by batch, without a shuffle.

    Every input row gives one row, repeated rows included. An input column that has the name of a
    result column, in any letter case as Spark compares them, is replaced by it. `process` runs in the Python workers.
    """
    importable(df.sparkSession)
    names = {name.lower() for name, _ in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    schema = T.StructType(kept + [T.StructField(name, kind) for name, kind in fields])
    arrow = to_arrow_schema(schema)
    keep = [f.name for f in kept]

    def run(batches):
        for batch in batches:
            results = process(batch.column(text).to_pylist())
            columns = [batch.column(name) for name in keep]
            columns += [pa.array(values, type=arrow.field(len(keep) + i).type) for i, values in enumerate(results)]
            fields_out = [batch.schema.field(name) for name in keep] + [arrow.field(len(keep) + i) for i in range(len(results))]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields_out))

    source = df if text in keep else df.withColumn("__text", F.col(text))
    if text not in keep:
        raise ValueError(f"the text column {text} has the name of a result column")
    return source.mapInArrow(run, schema)


def filtered(df: DataFrame, text: str, keep: Callable[[list], Sequence[bool]]) -> DataFrame:
    """The rows of `df`, all columns as they are, whose text passes."""
    importable(df.sparkSession)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(keep(batch.column(text).to_pylist()), type=pa.bool_()))

    return df.mapInArrow(run, df.schema)


def replaced(df: DataFrame, text: str, change: Callable[[list], list]) -> DataFrame:
    """`df` with one text column changed, all other columns as they are."""
    importable(df.sparkSession)

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            values = pa.array(change(batch.column(at).to_pylist()), type=batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), values)

    return df.mapInArrow(run, df.schema)


def sha256(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def crc_of_id(doc_id) -> int:
    """crc32 of an id written as text; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def crc_column(doc_id: str):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
