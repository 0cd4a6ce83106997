"""Every query with SQL gives what DuckDB gives; the others run."""

import datetime
import decimal
import os
from pathlib import Path

import duckdb
import pytest

from gristmill.plans import catalog

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    rows = [tuple(plain(r[c]) for c in cols) for r in df.collect()]
    if name not in ORACLES:
        assert rows
        return
    rel = duck.sql(ORACLES[name])
    at = [rel.columns.index(c) for c in cols]
    assert sorted(rel.columns) == cols
    assert sorted(map(repr, rows)) == sorted(repr(tuple(plain(r[i]) for i in at)) for r in rel.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["doc_id", "n_shingles", "n_hits", "share"]
    assert set(e.oracle_sql()) <= set(e.queries())


def test_whole_texts_are_compared(spark, tmp_path):
    from difflib import SequenceMatcher

    a, b = "same words " * 60 + "an end", "same words " * 60 + "another one altogether"
    spark.createDataFrame([(1, 0, "human", a), (1, 1, "gpt", b)], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame([(2, "word " * 100 + "https://example.com/a")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["sequence_similarity"](spark, str(tmp_path)).first()["ratio"] == pytest.approx(SequenceMatcher(None, a, b).ratio(), abs=1e-6)
    assert QUERIES["translation_scores"](spark, str(tmp_path)).first()["protected"] < 0.7
    from gristmill.plans import parsing

    assert "https://example.com/a</think>" in parsing._marked(spark, str(tmp_path)).first()["t"]


def test_every_document_has_a_key(spark):
    import unicodedata

    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r[0], " ".join(unicodedata.normalize("NFC", r[1]).split()).casefold()) for r in docs)
    assert any("ß" in r[1] for r in docs) and sorted(map(tuple, QUERIES["normalize_key"](spark, DATA).select("doc_id", "key").collect())) == want


def test_every_event_is_split_and_generated(spark):
    events = {r[0]: r[1:] for r in spark.read.parquet(f"{DATA}/events.parquet").select("event_id", "user_id", "event_type").collect()}
    low = {}

    def root(x):
        while low.setdefault(x, x) != x:
            x = low[x]
        return x

    doc = {i: f"document:{u // 3}" for i, (u, _) in events.items()}
    for i, (u, _) in events.items():
        a, b = sorted((root(doc[i]), root(f"query:{i % 97 // 2 * 10 + u // 30}")))
        low[b] = a
    got = {r["event_id"]: r["split_group"] for r in QUERIES["component_split"](spark, DATA).collect()}
    assert got == {i: root(x) for i, x in doc.items()}
    made = QUERIES["generation"](spark, DATA).collect()
    said = {"click": "Final Answer: yes", "error": None}
    assert len(made) == 3 * len(events) and all(r["output"] == said.get(events[r["event_id"]][1], "no") for r in made)


def same_as_sql(spark, name, folder, **tables):
    """A query's rows on tables written to folder are those of its SQL."""
    c = duckdb.connect()
    for t, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{t}.parquet")
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    rel, df = c.sql(ORACLES[name]), QUERIES[name](spark, str(folder))
    want = sorted(map(repr, rel.fetchall()))
    assert want and sorted(map(repr, map(tuple, df.select(*rel.columns).collect()))) == want


DOC = "doc_id long, text string, lang string, source string, n_chars long"


def filled(spark, n):
    """n ids with a kilobyte of text each that does not compress: more partitions than their ids alone."""
    from pyspark.sql import functions as F

    text = F.concat(*(F.sha2(F.concat_ws("-", "id", F.lit(k)), 256) for k in range(16)))
    return spark.range(n).withColumn("text", text)


def test_problems_are_numbered_whole(spark, tmp_path):
    same_as_sql(spark, "task_math", tmp_path, documents=filled(spark, 8000).selectExpr("id AS doc_id", "text", "'en' AS lang", "'s' AS source", "id AS n_chars"))
    odd = [(5, "a", "en", "s", 3), (None, "no id", None, None, None), (-3, "b", "de", 'x"y', 1), (6, "", "en", "z", 2), (7, None, "fr", "q", 1), (9, " ", "fr", None, 1)]
    same_as_sql(spark, "task_math", tmp_path, documents=spark.createDataFrame(odd, DOC))


def test_passages_are_numbered_whole(spark, tmp_path):
    item = "item_id long, text string"
    said = filled(spark, 20000).selectExpr("id DIV 4 AS conv_id", "id % 4 AS turn", "'user' AS role", "text")
    same_as_sql(spark, "pool_union", tmp_path, conversations=said, benchmark=spark.createDataFrame([(1, "z"), (0, "y")], item))
    odd = [(1, 0, "x", " a  b "), (1, None, "x", "z"), (2, 5, "x", "z"), (0, 1, "x", "a b"), (0, 2, "x", ""), (0, 3, "x", None), (None, 1, "x", "late"), (-1, 1, "x", "c")]
    same_as_sql(spark, "pool_union", tmp_path, conversations=spark.createDataFrame(odd, said.schema), benchmark=spark.createDataFrame([(1, "z"), (0, "y"), (None, "x")], item))


def test_instructions_are_numbered_whole(spark, tmp_path):
    same_as_sql(spark, "task_instructions", tmp_path, documents=spark.range(-20, 600_000).withColumnRenamed("id", "doc_id"))
