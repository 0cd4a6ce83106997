"""Queries over what sinks and sources make."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.sources import readers, sinks
from gristmill.plans.registry import query, table


@query("SELECT event_id AS id, CASE WHEN event_id % 4 = 0 THEN '{\"error\":\"{bad\"}' ELSE '{\"a\":' || event_id || '}' END AS request FROM events")
def safe_json(spark, d):
    x = F.when(F.col("event_id") % 4 == 0, "{bad").otherwise(F.concat(F.lit('{ "a": '), F.col("event_id").cast("string"), F.lit("}")))
    return table(spark, d, "events").select(F.col("event_id").alias("id"), sinks.safe_json(x).alias("request"))


@query("SELECT event_id AS id, 0.5::DOUBLE AS temperature, 2 AS n_messages, event_type AS content, (event_id % 100)::INT AS total_tokens FROM events")
def request_views(spark, d):
    e = table(spark, d, "events")
    req = F.to_json(F.struct(F.lit(0.5).alias("temperature"), F.array(F.struct(F.lit("system").alias("role")), F.struct(F.lit("user").alias("role"))).alias("messages")))
    res = F.to_json(F.struct(F.array(F.struct(F.struct(F.col("event_type").alias("content")).alias("message"))).alias("choices"), F.struct((F.col("event_id") % 100).alias("total_tokens")).alias("usage")))
    v = sinks.request_views(e.select(F.col("event_id").alias("id"), F.lit("m").alias("model"), req.alias("raw_request"), res.alias("raw_response")))
    return v["llm_requests"].drop("model").join(v["llm_responses"].drop("model"), "id")


@query("SELECT user_id, max(event_id) FILTER (k = 1) AS event_id, max(event_type) FILTER (k = 1) AS event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) GROUP BY user_id")
def upsert_latest(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type")
    return sinks.upserted(e.filter("event_id % 5 = 0").groupBy("user_id").agg(F.max("event_id").alias("event_id"), F.max_by("event_type", "event_id").alias("event_type")), e, "user_id", "event_id")


@query("SELECT user_id AS trajectory_id, turn_index, event_type AS role FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS turn_index FROM events)")
def normalized_turns(spark, d):
    e = table(spark, d, "events")
    turn = F.struct("event_id", F.col("event_type").alias("role"), F.array(F.struct(F.lit(True).alias("success"))).alias("executions"))
    t = e.groupBy(F.col("user_id").alias("id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    out = sinks.normalized_tables(t)["turns"]
    return out.select("trajectory_id", F.col("turn_index").cast("long").alias("turn_index"), "role")


@query("SELECT item_id AS doc_id, text AS body, NULL::VARCHAR AS title FROM benchmark")
def field_mapping(spark, d):
    return readers.mapped(table(spark, d, "benchmark"), {"doc_id": "item_id", "body": "text", "title": "no_such_column"})


@query()
def provenance_rest(spark, d):
    return readers.with_rest(table(spark, d, "documents").drop("text"), ["doc_id"])


@query("SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 20 OFFSET 10")
def offset_limit(spark, d):
    return readers.window(table(spark, d, "documents").select("doc_id", "lang"), ["doc_id"], 10, 20)


@query("SELECT range AS id, 'row ' || range AS text FROM range(250)")
def paged_source(spark, d):
    return readers.paged(spark, "gristmill.sources.readers:numbered_rows", 250, "id long, text string")


@query("SELECT DISTINCT text FROM benchmark WHERE text <> ''")
def eval_texts(spark, d):
    b = table(spark, d, "benchmark")
    return readers.eval_texts(b.select("text"), b.select(F.lit("").alias("text"), F.col("text").alias("passage"))).distinct()
