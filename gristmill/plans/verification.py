"""Verifier and metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.functions import rewards as R
from gristmill.functions import verify as V
from gristmill.operators import generate as G
from gristmill.plans.registry import query, table


@query("SELECT event_id, CASE WHEN event_id % 4 > 0 THEN lower(event_type) = CASE WHEN event_id % 2 = 0 THEN 'click' ELSE 'error' END END AS ok FROM events")
def equality_verifier(spark, d):
    want = F.when(F.col("event_id") % 4 > 0, F.when(F.col("event_id") % 2 == 0, " Click").otherwise("ERROR "))
    return table(spark, d, "events").select("event_id", V.equal_answer(want, F.array(F.upper("event_type"))).alias("ok"))


@query("SELECT event_id, event_id % 5 IN (0, 3) AS ok FROM events")
def math_verifier(spark, d):
    i = F.col("event_id")
    want = F.concat(F.lit("\\frac{"), (2 * i + 1).cast("string"), F.lit("}{2}"))
    got = F.when(i % 5 == 0, F.concat((i).cast("string"), F.lit(".5"))).when(i % 5 == 3, F.concat(F.lit("$("), (2 * i + 1).cast("string"), F.lit(")/2$"))).otherwise(F.concat(F.lit("x"), i.cast("string")))
    return table(spark, d, "events").select("event_id", V.math_match(want, got).alias("ok"))


@query("SELECT event_id, event_id % 3 <> 1 AS numeric_ok, event_id % 3 = 0 AS exact_ok FROM events")
def qa_verifiers(spark, d):
    i = F.col("event_id").cast("string")
    answer = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("2 + 3 is not it, but "), i)).when(F.col("event_id") % 3 == 1, F.concat(i, F.lit(" or -7"))).otherwise(F.concat(F.lit("\\boxed{"), i, F.lit(".0}!")))
    words = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("the token"), i, F.lit(" it is"))).otherwise(F.concat(F.lit("token"), i, F.lit("x")))
    return table(spark, d, "events").select("event_id", V.numeric_match(i, answer).alias("numeric_ok"), V.exact_match(F.concat(F.lit("token"), i), words).alias("exact_ok"))


_VERDICTS = "SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, event_type = 'click' AS rel FROM events"


@query(f"SELECT user_id, round(avg(rel::INT), 9) AS relevance, round(coalesce(sum(CASE WHEN rel THEN h / (i + 1) END) / nullif(sum(rel::INT), 0), 0), 9) AS precision, avg(rel::INT) >= 0.2 AS relevant FROM (SELECT *, sum(rel::INT) OVER (PARTITION BY user_id ORDER BY i) AS h FROM ({_VERDICTS})) GROUP BY user_id")
def rag_contexts(spark, d):
    from pyspark.sql.window import Window

    e = table(spark, d, "events").withColumn("context_index", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1)
    g = e.groupBy("user_id").agg(F.collect_list(F.struct("context_index", (F.col("event_type") == "click").alias("relevant"))).alias("v"))
    n = F.size("v")
    return g.select("user_id", F.round(V.context_relevance(F.col("v"), n)["score"], 9).alias("relevance"), F.round(V.context_precision(F.col("v"), n)["score"], 9).alias("precision"), V.context_relevance(F.col("v"), n, 0.2)["passed"].alias("relevant"))


@query("SELECT user_id, round(CASE WHEN user_id % 7 = 0 THEN 0 ELSE avg((event_type <> 'error')::INT) END, 9) AS faithfulness, CASE WHEN user_id % 7 = 0 THEN 'no claims' END AS problem FROM events GROUP BY user_id")
def rag_faithfulness(spark, d):
    g = table(spark, d, "events").groupBy("user_id").agg(F.collect_list(F.struct((F.col("event_type") != "error").alias("supported"))).alias("c"))
    claims = F.when(F.col("user_id") % 7 == 0, F.slice("c", 1, 0)).otherwise(F.col("c"))
    return g.select("user_id", V.faithfulness(claims).alias("r")).select("user_id", F.round("r.score", 9).alias("faithfulness"), "r.problem")


@query("SELECT event_id, CASE WHEN event_id % 4 < 3 THEN (event_id % 4) / 2 ELSE 0.0 END AS score, event_id % 4 IN (1, 2) AS passed, CASE WHEN event_id % 4 = 3 THEN 'score outside 0, 0.5, 1' END AS problem FROM events")
def rag_graded(spark, d):
    return table(spark, d, "events").select("event_id", V.graded((F.col("event_id") % 4) / 2).alias("r")).select("event_id", "r.score", "r.passed", "r.problem")


@query("SELECT user_id, round(min(value), 9) AS score FROM events GROUP BY user_id")
def conversation_score(spark, d):
    g = table(spark, d, "events").groupBy("user_id").agg(F.collect_list("value").alias("v"), F.collect_list(F.col("event_id").cast("string")).alias("q"), F.collect_list(F.lit(True)).alias("a"))
    return g.select("user_id", F.round(V.conversation_passed(F.col("v"), F.col("q"), F.col("a"))["score"], 9).alias("score"))


@query("""SELECT event_id, list_filter([CASE WHEN event_id % 2 = 0 THEN 'subcategory_mismatch' END, CASE WHEN event_id % 3 = 0 THEN 'missing_visible_context' END,
  CASE WHEN event_id % 5 = 0 THEN 'answer_type_verifier_mismatch' END], lambda x: x IS NOT NULL)::VARCHAR AS issues FROM events""")
def draft_issues(spark, d):
    i = F.col("event_id")
    draft = F.struct(
        F.lit("Why?").alias("question"), F.when(i % 3 == 0, "").otherwise("some text").alias("visible_context"), F.lit("x").alias("reference_answer"), F.array(F.lit("text")).alias("evidence"),
        F.lit("exact").alias("answer_type"), F.when(i % 5 == 0, "numeric").otherwise("exact").alias("verifier"), F.when(i % 2 == 0, "b").otherwise("a").alias("subcategory"), F.lit(True).alias("standalone"),
    )
    out = V.draft_issues(draft, F.lit("a"), F.lit("inline_excerpt"), F.lit("source text here"))
    return table(spark, d, "events").select("event_id", F.concat(F.lit("["), F.array_join(out, ", "), F.lit("]")).alias("issues"))


@query("SELECT event_id, event_id % 3 = 0 OR event_id % 20 >= 15 AS done, CASE WHEN event_id % 3 = 0 THEN event_id::VARCHAR END AS final_answer, CASE WHEN event_id % 3 = 0 THEN 1.0::DOUBLE WHEN event_type = 'error' THEN -0.05::DOUBLE ELSE 0.0::DOUBLE END AS reward FROM events")
def step_rewards(spark, d):
    i = F.col("event_id")
    out = F.when(i % 3 == 0, F.concat(F.lit("ok FINAL("), i.cast("string"), F.lit(") x"))).otherwise("working")
    s = R.step_reward(out, F.when(F.col("event_type") == "error", "boom"), F.lit(False), i % 20, 15)
    return table(spark, d, "events").select("event_id", s.alias("s")).select("event_id", "s.done", "s.final_answer", "s.reward")


@query("SELECT user_id, CAST(sum((event_type = 'click')::INT) AS BIGINT) AS run, max(event_id % 9) AS passed, max(event_id % 4) + CAST(sum((event_type = 'error')::INT) AS BIGINT) AS failed FROM events GROUP BY user_id")
def test_logs(spark, d):
    i = F.col("event_id")
    text = F.concat((i % 9).cast("string"), F.lit(" passed, "), (i % 4).cast("string"), F.lit(" failed "), F.when(F.col("event_type") == "click", "PASSED").when(F.col("event_type") == "error", "ERROR").otherwise(""))
    g = table(spark, d, "events").groupBy("user_id").agg(F.collect_list(text).alias("t"))
    return g.select("user_id", R.test_counts(F.col("t")).alias("c")).select("user_id", "c.run", "c.passed", "c.failed")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE round((event_id % 10 + 7) / 2, 2) END AS score FROM events")
def judge_panel(spark, d):
    i = F.col("event_id")
    fails = i % 3 == 0
    return table(spark, d, "events").select("event_id", V.judge_average(F.array(F.when(~fails, (i % 10).cast("double")), F.when(~fails, F.lit(7.0)), F.lit(None).cast("double"))).alias("score"))


def _client():
    return G.Scripted({"error": RuntimeError("down"), "click": "Final Answer: yes"}, "no")


@query("SELECT event_id, r AS rollout_index, substr(sha256(event_id || chr(10) || r), 1, 24) AS rollout_id, CASE event_type WHEN 'click' THEN 'Final Answer: yes' WHEN 'error' THEN NULL ELSE 'no' END AS output, CASE event_type WHEN 'error' THEN 'RuntimeError: down' END AS output_error FROM events, (SELECT unnest([0, 1, 2])::INT AS r)")
def generation(spark, d):
    """Three rollouts of every event."""
    events = table(spark, d, "events")
    rows = G.rollout_rows(events.select("event_id", "event_type"), 3, "event_id")
    return G.generated(rows, _client, F.concat(F.lit("type: "), F.col("event_type"))).drop("event_type")
