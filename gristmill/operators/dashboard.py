"""What a dashboard asks of tables: search, JSON paths, pages, column overviews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.parse import json_path


def search(df: DataFrame, term: str, columns: list[str] | None = None) -> DataFrame:
    """Rows with term in any column as text, ignoring case; % and _ are plain characters."""
    plain = term.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return df.filter(reduce(lambda a, b: a | b, (F.col(c).cast("string").ilike(f"%{plain}%") for c in columns or df.columns)))


def project(df: DataFrame, paths: dict[str, str]) -> DataFrame:
    """Columns by name: a column, or column.path for a value inside JSON text."""
    cols = []
    for name, path in paths.items():
        top, _, rest = path.partition(".")
        cols.append((json_path(F.col(top), rest) if rest else F.col(top)).alias(name))
    return df.select(*cols)


def page(df: DataFrame, order: list[str], number: int, size: int) -> DataFrame:
    """One page (from 1) in a declared order, which has to be unique for stable pages; size is at most 1000."""
    if not 1 <= size <= 1000 or number < 1 or not order:
        raise ValueError("pages start at 1, hold 1 to 1000 rows and need an order")
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def page_count(df: DataFrame, size: int) -> DataFrame:
    return df.agg(F.count("*").alias("total"), F.ceil(F.count("*") / size).alias("pages"))


def column_types(df: DataFrame) -> DataFrame:
    """(column, type) of a table."""
    return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")


def filled_columns(df: DataFrame) -> DataFrame:
    """(column, filled): rows with a value in each column, in one pass."""
    counts = df.agg(*(F.count(c).alias(c) for c in df.columns))
    return counts.unpivot([], counts.columns, "column", "filled")


def json_shape(df: DataFrame, column: str) -> DataFrame:
    """(shape): one schema for all JSON texts of a column."""
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("shape"))


def tables(spark: SparkSession, filled: bool = True) -> list[str]:
    """Names of tables and views, those with rows only if asked for."""
    names = sorted(t.name for t in spark.catalog.listTables())
    return [n for n in names if not filled or not spark.table(n).isEmpty()]


def displayed(df: DataFrame, column: str) -> DataFrame:
    """df with JSON text in one canonical form, other text as it is, and time stamps in ISO form."""
    out = df.withColumn(column, F.coalesce(F.to_json(F.try_parse_json(column)), F.col(column)))
    times = [c for c, kind in df.dtypes if kind.startswith("timestamp")]
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss") for c in times})
