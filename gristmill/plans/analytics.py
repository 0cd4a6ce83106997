"""Dashboard and conversation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.operators import conversations as V
from gristmill.operators import dashboard as D
from gristmill.plans.registry import query, table


@query("SELECT event_id, event_type FROM events WHERE event_type ILIKE '%cli%' OR props ILIKE '%cli%'")
def search_ilike(spark, d):
    return D.search(table(spark, d, "events"), "cli", ["event_type", "props"]).select("event_id", "event_type")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_path_projection(spark, d):
    return D.project(table(spark, d, "events"), {"event_id": "event_id", "k": "props.k"})


@query("SELECT doc_id, lang, source FROM documents ORDER BY lang, doc_id LIMIT 25 OFFSET 50")
def paginate(spark, d):
    return D.page(table(spark, d, "documents").select("doc_id", "lang", "source"), ["lang", "doc_id"], 3, 25)


@query("SELECT count(*) AS total, ceil(count(*) / 25)::BIGINT AS pages FROM documents")
def page_total(spark, d):
    return D.page_count(table(spark, d, "documents"), 25)


@query("SELECT unnest(['doc_id', 'quality', 'toxic']) AS column, unnest([count(doc_id), count(quality), count(toxic)]) AS filled FROM (SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN quality END AS quality, CASE WHEN doc_id % 5 > 0 THEN toxic END AS toxic FROM labels)")
def filled_columns(spark, d):
    x = table(spark, d, "labels").select("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("quality")).alias("quality"), F.when(F.col("doc_id") % 5 > 0, F.col("toxic")).alias("toxic"))
    return D.filled_columns(x)


@query()
def json_overview(spark, d):
    """One schema for all JSON texts; its spelling is Spark's own."""
    return D.json_shape(table(spark, d, "events"), "props")


_ROLE = "CASE lower(trim(role)) WHEN 'system' THEN 'system' WHEN 'user' THEN 'human' WHEN 'human' THEN 'human' WHEN 'assistant' THEN 'gpt' WHEN 'gpt' THEN 'gpt' WHEN 'tool' THEN 'tool' WHEN 'function' THEN 'tool' END"


@query(f"SELECT conv_id, string_agg(({_ROLE}) || ': ' || text, chr(10) ORDER BY turn) AS conversation FROM conversations GROUP BY conv_id")
def sharegpt_build(spark, d):
    c = V.gathered(table(spark, d, "conversations"))
    return c.select("conv_id", F.array_join(F.transform("conversation", lambda m: F.concat(m["from"], F.lit(": "), m["value"])), "\n").alias("conversation"))


@query(f"""SELECT conv_id, CASE WHEN bool_or(r IS NULL) THEN 'unsupported role' WHEN count(*) < 2 THEN 'fewer than two messages' WHEN NOT (bool_or(coalesce(r, '') = 'human') AND bool_or(coalesce(r, '') = 'gpt')) THEN 'needs human and gpt messages' END AS problem,
  bool_or(coalesce(r = p, false)) AS repeats FROM (SELECT conv_id, {_ROLE} AS r, lag({_ROLE}) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) GROUP BY conv_id""")
def role_alternation(spark, d):
    c = V.gathered(table(spark, d, "conversations"))
    return c.select("conv_id", V.problem(F.col("conversation")).alias("problem"), V.repeats_role(F.col("conversation")).alias("repeats"))


@query("SELECT conv_id, turn, CASE lower(trim(role)) WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' WHEN 'function' THEN 'tool' ELSE lower(trim(role)) END AS role, length(text) AS n FROM conversations")
def openai_roles(spark, d):
    c = V.gathered(table(spark, d, "conversations")).select("conv_id", F.posexplode(V.as_messages(F.col("conversation"))).alias("turn", "m"))
    return c.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("m.role").alias("role"), F.length("m.content").cast("long").alias("n"))


@query("""SELECT conv_id, prompt, n_history FROM (SELECT conv_id, last(text ORDER BY turn) FILTER (role = 'user') AS prompt, max(turn) FILTER (role = 'user') AS m FROM conversations GROUP BY conv_id)
  JOIN (SELECT c.conv_id, count(*) FILTER (c.turn < x.m) AS n_history FROM conversations c JOIN (SELECT conv_id, max(turn) AS m FROM conversations WHERE role = 'user' GROUP BY 1) x USING (conv_id) GROUP BY 1) USING (conv_id)""")
def chat_history(spark, d):
    return V.prompt_and_history(table(spark, d, "conversations"))


@query()
def sharegpt_from_turns(spark, d):
    """Trajectory turns as a conversation, with corrections left out; an order-dependent fold."""
    t = table(spark, d, "conversations").filter("role <> 'system'")
    g = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"), F.lit(None).cast("string").alias("reasoning")))).alias("t"))
    return g.select("conv_id", V.built(F.col("t"), F.lit("You answer questions.")).alias("c")).select("conv_id", F.to_json("c").alias("conversation"))


@query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn_index FROM conversations")
def turn_indexes(spark, d):
    from pyspark.sql.window import Window

    return table(spark, d, "conversations").select("conv_id", "turn", (F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1).cast("long").alias("turn_index"))
