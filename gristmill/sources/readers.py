"""Readers of rows: JSON lines, JSON documents, Parquet, text lists, paged rows and PDF files."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from gristmill.functions.text import unit_interval

READERS: dict[str, Callable[..., DataFrame]] = {}


def reader(*suffixes: str):
    def put(f):
        READERS.update(dict.fromkeys(suffixes, f))
        return f

    return put


@reader("jsonl", "ndjson")
def json_lines(spark: SparkSession, path: str, schema: StructType | str, strict: bool = True) -> DataFrame:
    """Rows of JSON lines; blank lines are skipped. A bad line stops a strict read and is skipped by another."""
    shape = spark.createDataFrame([], schema).schema
    if strict:
        return spark.read.schema(shape).option("mode", "FAILFAST").json(path)
    marked = StructType(list(shape.fields)).add("_bad", "string")
    lines = spark.read.text(path).filter(F.trim("value") != "")
    rows = lines.select(F.from_json("value", marked, {"columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return rows.filter("r._bad IS NULL").select(*(f"r.{c}" for c in shape.fieldNames()))


@reader("json")
def json_document(spark: SparkSession, path: str, schema: StructType | str, wrappers: tuple[str, ...] = ("data", "records", "rows")) -> DataFrame:
    """Rows of a JSON array, of an array inside an object under one of wrappers, or a single object."""
    shape = spark.createDataFrame([], schema).schema
    whole = spark.read.option("wholetext", True).text(path)
    kind = f"array<{shape.simpleString()}>"
    inner = F.coalesce(*(F.get_json_object("value", f"$.{w}") for w in wrappers), F.col("value"))
    text = F.trim(F.when(F.ltrim("value").startswith("["), F.col("value")).otherwise(inner))
    rows = F.from_json(F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]"))), kind)
    return whole.select(F.explode(rows).alias("r")).select("r.*")


@reader("parquet")
def parquet(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def read(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """By the path's suffix; an unknown one raises."""
    kind = path.rstrip("/").rpartition(".")[2].lower()
    if kind not in READERS:
        raise ValueError(f"no reader for .{kind}; known: {', '.join(sorted(READERS))}")
    return READERS[kind](spark, path, schema)


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """(id): trimmed lines that aren't blank."""
    return spark.read.text(path).select(F.trim("value").alias("id")).filter("id <> ''").distinct()


def passages(rows: DataFrame) -> DataFrame:
    """(text): a row's text, or its positive where that is missing or empty."""
    some = [F.nullif(F.col(c), F.lit("")) for c in ("text", "positive") if c in rows.columns]
    return rows.select(F.coalesce(*some).alias("text")).filter("text IS NOT NULL")


def eval_texts(queries: DataFrame, corpus: DataFrame) -> DataFrame:
    """(text): every string of evaluation queries, and the first of text, passage, positive of their corpus."""
    own = [c for c, kind in queries.dtypes if kind == "string"]
    one = queries.select(F.explode(F.array(*own)).alias("text")) if own else queries.sparkSession.createDataFrame([], "text string")
    some = [F.nullif(F.col(c), F.lit("")) for c in ("text", "passage", "positive") if c in corpus.columns]
    two = corpus.select(F.coalesce(*some, F.lit(None)).alias("text"))
    return one.unionByName(two).filter("text IS NOT NULL AND text <> ''")


def shuffled(rows: DataFrame, key: str, seed: int) -> DataFrame:
    """Rows in an order that the seed fixes, the same however the table is dealt."""
    return rows.orderBy(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), key)


def sampled(rows: DataFrame, key: str, share: float) -> DataFrame:
    """About a share of rows, those whose key's hash is small; the same rows whatever the layout."""
    return rows.filter(unit_interval(F.col(key).cast("string")) < share)


def mapped(rows: DataFrame, fields: dict[str, str], kinds: dict[str, str] | None = None) -> DataFrame:
    """Target columns from source columns; a source that a table lacks gives nulls."""
    kinds = kinds or {}
    return rows.select(*((F.col(s) if s in rows.columns else F.lit(None).cast(kinds.get(t, "string"))).alias(t) for t, s in fields.items()))


def with_rest(rows: DataFrame, used: list[str], name: str = "metadata") -> DataFrame:
    """The used columns, and all others as one JSON object."""
    rest = [c for c in rows.columns if c not in used]
    return rows.select(*used, (F.to_json(F.struct(*rest)) if rest else F.lit("{}")).alias(name))


def window(rows: DataFrame, order: list[str], offset: int = 0, limit: int | None = None, zero_means_all: bool = False) -> DataFrame:
    """Rows from offset on in a declared order. A limit of 0 gives none, or all where zero_means_all."""
    out = rows.orderBy(*order).offset(offset)
    return out if limit is None or (zero_means_all and limit == 0) else out.limit(limit)


class PagedRows(DataSource):
    """Rows of a paged source, a partition a page. Options: pages, page_size, fetch (module:function of offset and length).

    The function gives a list of tuples; it is called in the tasks, so it has to be importable there.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_rows"

    def schema(self) -> str:
        return self.options["schema"]

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagedReader(self.options)


class Page(InputPartition):
    def __init__(self, offset: int, length: int):
        self.offset, self.length = offset, length


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.total, self.size, self.fetch = int(options["total"]), int(options.get("page_size", 100)), options["fetch"]

    def partitions(self) -> list[Page]:
        return [Page(at, min(self.size, self.total - at)) for at in range(0, self.total, self.size)]

    def read(self, page: Page) -> Iterator[tuple]:
        import importlib

        module, _, name = self.fetch.partition(":")
        yield from getattr(importlib.import_module(module), name)(page.offset, page.length)


def paged(spark: SparkSession, fetch: str, total: int, schema: str, page_size: int = 100) -> DataFrame:
    spark.dataSource.register(PagedRows)
    return spark.read.format("paged_rows").option("fetch", fetch).option("total", str(total)).option("page_size", str(page_size)).option("schema", schema).load()


def numbered_rows(offset: int, length: int) -> list[tuple]:
    """A source for trials: (id, text)."""
    return [(i, f"row {i}") for i in range(offset, offset + length)]


def pdf_pages(spark: SparkSession, path: str) -> DataFrame:
    """(path, pages array of page and text) of PDF files, non-empty pages only; null for a file that can't be read. Needs the
    optional pypdf package."""
    import pandas as pd

    @F.pandas_udf("array<struct<page:int,text:string>>")
    def pages(x: pd.Series) -> pd.Series:
        import io

        from pypdf import PdfReader

        def one(b):
            try:
                return [{"page": i, "text": t} for i, p in enumerate(PdfReader(io.BytesIO(b)).pages, 1) if (t := (p.extract_text() or "").strip())]
            except Exception:  # a broken file is a value, not the end of the job
                return None

        return x.map(one)

    return spark.read.format("binaryFile").load(path).select("path", pages("content").alias("pages"))
