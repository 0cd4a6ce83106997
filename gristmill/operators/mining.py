"""Retrieval data: the passage pool, candidates and their checks, paraphrases, and the rows that come out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gristmill.functions import lang as L
from gristmill.functions import text as T
from gristmill.operators.tasks import numbered


def pool(positives: DataFrame, extras: DataFrame, text_col: str = "text", order: str = "place") -> DataFrame:
    """(passage, index): normalized texts of positives and then of extras, each once, numbered by where it first occurs.

    Both have a text and a place to order by. Null and blank texts are left out; empty tables are fine. A null place comes after
    the others of its table, and passages of one place are in the order of their text.
    """
    rows = positives.select(F.lit(0).alias("part"), F.col(order).alias("at"), T.normalize_text(text_col).alias("passage"))
    rows = rows.unionByName(extras.select(F.lit(1).alias("part"), F.col(order).alias("at"), T.normalize_text(text_col).alias("passage")))
    first = rows.filter("passage <> ''").groupBy("passage").agg(F.min(F.struct("part", F.col("at").isNull().alias("none"), "at")).alias("first"))
    return numbered(first.select("passage", "first.part", "first.at"), ["part", "at", "passage"]).select("passage", F.col("index").cast("long").alias("index"))


def without_positives(candidates: DataFrame, rows: DataFrame, id_col: str = "id", text_col: str = "passage") -> DataFrame:
    """candidates (id, passage, ...) without the positives of all rows (id, query, positive) that ask the same, cases ignored."""
    asked = rows.select(F.col(id_col).alias("__id"), T.normalize_key("query").alias("__q"), T.normalize_text("positive").alias("__p"))
    banned = asked.select("__q", "__p").distinct()
    named = candidates.join(asked.select("__id", "__q"), F.col(id_col) == F.col("__id")).drop("__id")
    return named.join(banned, (named["__q"] == banned["__q"]) & (named[text_col] == banned["__p"]), "left_anti").drop("__q")


def capped(seed: Column, mined: Column, most: int) -> Column:
    """Candidates of a row: its own negatives first, then mined ones that aren't among them, at most `most` more than its own."""
    seed = F.coalesce(seed, F.array().cast("array<string>"))
    return F.slice(F.concat(seed, F.filter(mined, lambda t: ~F.array_contains(seed, t))), 1, F.size(seed) + most)


def kinds(kept: Column, seed: Column) -> Column:
    """Where kept negatives come from."""
    return F.transform(kept, lambda t: F.when(F.array_contains(seed, t), "seed_verified").otherwise("mined_verified"))


def gated(variants: DataFrame, script: str, least: float, key: str = "id", order: str = "place") -> DataFrame:
    """variants (id, place, seed, text) with variant (normalized) and reason, why a paraphrase is refused, null if it isn't."""
    rows = variants.withColumn("variant", T.normalize_text("text"))
    share = L.script_share(F.col("variant"), script)
    wrong = F.coalesce((share == 0) | (share < least), F.lit(False))
    own = (
        F.when(F.col("text").isNull(), "candidate is not text")
        .when(F.length("variant") < 3, "candidate is too short")
        .when(T.normalize_key("text") == T.normalize_key("seed"), "candidate duplicates the seed query")
    )
    script_fails = f"candidate does not meet {script} script ratio"
    again = F.row_number().over(Window.partitionBy(key, "variant").orderBy(order)) > 1
    # Equal texts fare alike up to here, so an earlier one was accepted unless all fail by their script.
    return rows.withColumn("reason", own).withColumn("reason", F.when(F.col("reason").isNull() & wrong, script_fails).when(F.col("reason").isNull() & again, "candidate duplicates another variant").otherwise(F.col("reason")))


def retrieval_rows(tasks: DataFrame) -> DataFrame:
    """A row for the seed query of each task and one for each accepted paraphrase.

    tasks: id, seed_query, positive, negatives, split, accepted (array of query and score; null is none).
    """
    seed = F.struct(F.lit("seed").alias("key"), F.col("seed_query").alias("query"), F.lit("seed").alias("label_source"), F.lit(None).cast("double").alias("semantic_score"))
    made = F.transform("accepted", lambda a: F.struct(a["query"].alias("key"), a["query"].alias("query"), F.lit("generated_paraphrase").alias("label_source"), a["score"].cast("double").alias("semantic_score")))
    rows = tasks.select("*", F.explode(F.concat(F.array(seed), F.coalesce(made, F.array().cast("array<struct<key:string,query:string,label_source:string,semantic_score:double>>")))).alias("__r"))
    return rows.select(T.stable_id(F.col("id").cast("string"), F.col("__r.key")).alias("id"), "__r.query", "positive", "negatives", "__r.label_source", "split", "__r.semantic_score")


def answered(results: DataFrame, tasks: DataFrame, id_col: str = "id") -> DataFrame:
    """Results with their tasks; a result without a task is left out."""
    return results.join(tasks, id_col)
