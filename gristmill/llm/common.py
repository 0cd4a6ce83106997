"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.session import ready_for_python

#: Rows of a batch that are turned to Python objects together.
ROWS = 1000
#: ASCII lower-casing of bytes, and nothing else.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, through Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", binary: bool = True) -> DataFrame:
    """(doc_id, text) of every row, null texts as empty; other columns and their names don't matter."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), (text.cast("binary") if binary else text).alias("text"))


def fold(key: Column, parts: int, held: int) -> Column:
    """Whether crc32(key as text) mod parts is held; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == held, F.lit(False))


def give_back() -> None:
    """Hand freed memory back to the system, as workers live on between tasks beside executors that need it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in parts of so many rows, whose Python objects are few; at the end memory goes back."""
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            yield whole.slice(at, rows)
    give_back()


def map_rows(df: DataFrame, make: Callable[[], Callable[[list], tuple]], schema: str) -> DataFrame:
    """Rows from rows: make() gives, once a task, a function from a batch's columns (lists) to the result's columns."""
    ready_for_python(df.sparkSession)
    kinds = pa.schema([(f.name, _arrow(f.dataType)) for f in _struct(df.sparkSession, schema)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        act = make()
        for b in slices(batches):
            cols = act([c.to_pylist() for c in b.columns])
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(cols, kinds, strict=True)], schema=kinds)

    return df.mapInArrow(run, schema)


def _struct(spark: SparkSession, schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema) if hasattr(StructType, "fromDDL") else spark.createDataFrame([], schema).schema


def _arrow(kind):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
