"""Source rows as tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.operators import tasks as T
from gristmill.plans.registry import query, table


@query("""SELECT (row_number() OVER (ORDER BY doc_id) - 1)::VARCHAR AS id, 't' || doc_id AS prompt, CASE WHEN doc_id % 3 = 0 THEN '{}' ELSE '{"N":' || doc_id || '}' END AS ground_truth FROM documents WHERE doc_id % 5 > 0""")
def task_instructions(spark, d):
    i = F.col("doc_id").cast("string")
    rows = table(spark, d, "documents").select(
        "doc_id", F.array(F.struct(F.when(F.col("doc_id") % 5 > 0, F.concat(F.lit(" t"), i)).otherwise(" ").alias("content"), F.lit("user").alias("role"))).alias("messages"),
        F.when(F.col("doc_id") % 3 == 0, "{bad").otherwise(F.concat(F.lit('{"N": '), i, F.lit("}"))).alias("ground_truth"), F.lit("c").alias("constraint"), F.lit("k").alias("constraint_type"),
    )
    return T.instructions(rows, ["doc_id"]).drop("constraint", "constraint_type")


@query("""SELECT doc_id::VARCHAR AS id, 'q' AS prompt, 'f' AS name, '{"a": ' || doc_id || '}' AS arguments FROM documents WHERE doc_id % 4 > 0 ORDER BY doc_id LIMIT 50""")
def task_function_calls(spark, d):
    i = F.col("doc_id").cast("string")
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.lit("q").alias("query"), F.lit('[{"name": "f", "parameters": {}}]').alias("tools"), F.when(F.col("doc_id") % 4 > 0, F.concat(F.lit('[{"name": "f", "arguments": {"a": '), i, F.lit("}}]"))).alias("answers"))
    out = T.function_calls(rows, ["id"], 50)
    return out.select("id", "prompt", F.col("expected")[0]["name"].alias("name"), F.col("expected")[0]["arguments"].alias("arguments"))


@query("SELECT conv_id::VARCHAR AS id, first(text ORDER BY turn) FILTER (role = 'user') AS prompt FROM conversations GROUP BY conv_id HAVING count(*) FILTER (role = 'user') > 0")
def task_conversations(spark, d):
    from gristmill.operators.conversations import gathered

    rows = gathered(table(spark, d, "conversations")).withColumnRenamed("conv_id", "id")
    return T.conversation_calls(rows).select("id", "prompt")


@query("""SELECT doc_id::VARCHAR AS id, '[{"filename":"doc_00_' || lang || '.txt","title":"' || lang || '","content":"a\\nb"}]' AS context FROM documents""")
def task_multi_hop(spark, d):
    ctx = F.struct(F.array("lang").alias("title"), F.array(F.array(F.lit("a"), F.lit("b"))).alias("sentences"))
    return T.multi_hop(table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.lit("q").alias("question"), F.lit("x").alias("answer"), ctx.alias("context"))).select("id", "context")


@query("SELECT doc_id::VARCHAR AS id, lang AS prompt, text AS context, '{\"source\":\"' || source || '\",\"context_length\":' || length(text) || '}' AS metadata FROM documents")
def task_long_context(spark, d):
    return T.long_context(table(spark, d, "documents").select("doc_id", "lang", "text", "source"), "doc_id", "lang", "text")


@query()
def task_chunks(spark, d):
    return T.source_chunks(table(spark, d, "documents"), "doc_id", "text", 1000, 100, least=200, most=5)


@query("SELECT doc_id AS id, CASE WHEN doc_id % 2 = 0 THEN 'a' || chr(10) || chr(10) || lang ELSE lang END AS prompt FROM documents")
def system_prompts(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), T.system_prompt(F.when(F.col("doc_id") % 2 == 0, "a").otherwise(" "), F.lit(None).cast("string"), F.col("lang")).alias("prompt"))
