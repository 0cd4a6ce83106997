"""Retrieval data, export and session queries: conversations as dialogues and paraphrases, documents as passages, events as executions."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.functions import lang as L
from gristmill.operators import exports as X
from gristmill.operators import mining as M
from gristmill.operators import rollouts as O
from gristmill.operators import tasks as TK
from gristmill.operators.conversations import gathered
from gristmill.plans.registry import query, table
from gristmill.plans.rollout_queries import BASE, rollouts

_NORM = "trim(regexp_replace(nfc_normalize({x}), '\\s+', ' ', 'g'))"


@query(f"""WITH r AS (SELECT 0 AS part, conv_id * 1000 + turn AS pos, {_NORM.format(x='text')} AS passage FROM conversations UNION ALL SELECT 1, item_id, {_NORM.format(x='text')} FROM benchmark),
f AS (SELECT passage, part, pos, row_number() OVER (PARTITION BY passage ORDER BY part, pos) AS k FROM r WHERE passage <> '')
SELECT passage, row_number() OVER (ORDER BY part, pos) - 1 AS index FROM f WHERE k = 1""")
def pool_union(spark, d):
    """Passages in first-seen order: messages, then benchmark texts."""
    messages = table(spark, d, "conversations").select("text", (F.col("conv_id") * 1000 + F.col("turn")).alias("place"))
    return M.pool(messages, table(spark, d, "benchmark").select("text", F.col("item_id").alias("place")))


@query("""WITH r AS (SELECT doc_id, lower(source) AS q, lang AS positive FROM documents), p AS (SELECT DISTINCT lang AS passage FROM documents)
SELECT doc_id, passage FROM r, p WHERE NOT EXISTS (SELECT 1 FROM r AS o WHERE o.q = r.q AND o.positive = p.passage)""")
def excluded_positives(spark, d):
    """Languages as passages and sources as queries: a document's candidates are the languages that its source has not."""
    docs = table(spark, d, "documents")
    rows = docs.select("doc_id", F.col("source").alias("query"), F.col("lang").alias("positive"))
    known = [r[0] for r in docs.select("lang").distinct().orderBy("lang").collect()]  # a handful
    candidates = docs.select("doc_id", F.explode(F.array(*map(F.lit, known))).alias("passage"))
    return M.without_positives(candidates, rows, "doc_id")


@query("""WITH g AS (SELECT user_id, list_sort(list(DISTINCT event_type) FILTER (event_id % 2 = 0)) AS seed, list_sort(list(DISTINCT event_type)) AS mined FROM events GROUP BY user_id),
c AS (SELECT user_id, coalesce(seed, []) AS seed, list_concat(coalesce(seed, []), list_filter(mined, lambda t: NOT list_contains(coalesce(seed, []), t)))[1:len(coalesce(seed, [])) + 1] AS c FROM g)
SELECT user_id, array_to_string(c, ',') AS candidates, array_to_string(list_transform(c, lambda t: CASE WHEN list_contains(seed, t) THEN 'seed_verified' ELSE 'mined_verified' END), ',') AS kinds FROM c""")
def candidate_cap(spark, d):
    """Own negatives first, then one more at most, and where each comes from."""
    g = table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_set(F.when(F.col("event_id") % 2 == 0, F.col("event_type")))).alias("seed"), F.array_sort(F.collect_set("event_type")).alias("mined"))
    c = g.select("user_id", "seed", M.capped(F.col("seed"), F.col("mined"), 1).alias("c"))
    return c.select("user_id", F.array_join("c", ",").alias("candidates"), F.array_join(M.kinds(F.col("c"), F.col("seed")), ",").alias("kinds"))


@query(f"""WITH v AS (SELECT conv_id, turn, {_NORM.format(x='text')} AS variant, {_NORM.format(x="first_value(text) OVER (PARTITION BY conv_id ORDER BY turn)")} AS seed FROM conversations),
s AS (SELECT *, len(regexp_extract_all(variant, '\\p{{Latin}}')) / greatest(1, len(regexp_extract_all(variant, '\\pL'))) AS share, row_number() OVER (PARTITION BY conv_id, variant ORDER BY turn) AS k FROM v)
SELECT conv_id, turn, CASE WHEN length(variant) < 3 THEN 'candidate is too short' WHEN lower(variant) = lower(seed) THEN 'candidate duplicates the seed query' WHEN share < 0.6 THEN 'candidate does not meet en-Latn script ratio'
  WHEN k > 1 THEN 'candidate duplicates another variant' END AS reason FROM s""")
def paraphrase_gate(spark, d):
    """Messages as paraphrases of their conversation's first."""
    c = table(spark, d, "conversations")
    seeds = c.groupBy("conv_id").agg(F.min_by("text", "turn").alias("seed"))
    return M.gated(c.join(seeds, "conv_id"), "en-Latn", 0.6, "conv_id", "turn").select("conv_id", "turn", "reason")


@query("""WITH t AS (SELECT conv_id, min_by(text, turn) AS q, count(*) AS n FROM conversations GROUP BY conv_id)
SELECT substr(sha256(conv_id || chr(10) || 'seed'), 1, 24) AS id, q AS query, conv_id % 3 AS positive, 'seed' AS label_source, NULL::DOUBLE AS semantic_score FROM t
UNION ALL SELECT substr(sha256(conv_id || chr(10) || text), 1, 24), text, conv_id % 3, 'generated_paraphrase', turn / 10 FROM conversations WHERE turn > 0""")
def retrieval_rows(spark, d):
    """A seed row and a row for each further message of a conversation."""
    c = table(spark, d, "conversations")
    g = c.groupBy("conv_id").agg(F.min_by("text", "turn").alias("seed_query"), F.collect_list(F.when(F.col("turn") > 0, F.struct(F.col("text").alias("query"), (F.col("turn") / 10).alias("score")))).alias("accepted"))
    rows = g.select(F.col("conv_id").alias("id"), "seed_query", (F.col("conv_id") % 3).alias("positive"), F.array().cast("array<string>").alias("negatives"), F.lit("train").alias("split"), "accepted")
    return M.retrieval_rows(rows).select("id", "query", "positive", "label_source", "semantic_score")


@query("SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id)")
def results_with_tasks(spark, d):
    return M.answered(table(spark, d, "labels").select("doc_id", "quality"), table(spark, d, "documents").select("doc_id", "lang"), "doc_id")


_SAID = "'[' || string_agg('{\"from\": ' || to_json(CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END) || ', \"value\": ' || to_json(text) || '}', ', ' ORDER BY turn) || ']'"


@query(f"SELECT conv_id, CASE WHEN conv_id % 2 = 0 THEN conv_id::VARCHAR ELSE 'sharegpt-' || substr(sha256({_SAID}), 1, 20) END AS id FROM conversations GROUP BY conv_id")
def record_ids(spark, d):
    """Even conversations have an id of their own, the others one by their JSON text."""
    c = gathered(table(spark, d, "conversations"))
    return c.select("conv_id", X.record_id(F.col("conversation"), F.lit(" "), F.when(F.col("conv_id") % 2 == 0, F.col("conv_id"))).alias("id"))


@query("""WITH g AS (SELECT conv_id, count(*) AS n, bool_or(role = 'user') AND bool_or(role = 'assistant') AS duo FROM conversations GROUP BY conv_id)
SELECT conv_id, CASE conv_id % 4 WHEN 0 THEN CASE WHEN n < 2 THEN 'fewer than two messages' WHEN NOT duo THEN 'needs human and gpt messages' END WHEN 1 THEN 'output is fenced' WHEN 2 THEN 'output has other fields' ELSE 'output is not JSON' END AS issue,
  CASE WHEN conv_id % 4 = 0 AND n >= 2 AND duo THEN n END AS messages FROM g""")
def translation_outputs(spark, d):
    """Conversations as a model's output: as it should be, fenced, with another field, and cut short."""
    c = gathered(table(spark, d, "conversations"))
    good = F.to_json(F.struct(F.col("conversation").alias("conversations")))
    k = F.col("conv_id") % 4
    said = F.when(k == 0, F.concat(F.lit("\n "), good)).when(k == 1, F.concat(F.lit("```json\n"), good, F.lit("\n```"))).when(k == 2, F.concat(F.substring(good, F.lit(1), F.length(good) - 1), F.lit(', "note": 1}'))).otherwise(F.substring(good, F.lit(1), F.length(good) - 1))
    return c.select("conv_id", X.translation_output(said).alias("x")).select("conv_id", "x.issue", F.when(F.col("x.issue").isNull(), F.size("x.conversation")).cast("long").alias("messages"))


@query("""WITH g AS (SELECT conv_id, count(*) AS n, bool_or(role = 'user') AND bool_or(role = 'assistant') AS duo, bool_or(trim(text) = '') AS blank FROM conversations GROUP BY conv_id)
SELECT conv_id, CASE conv_id % 4 WHEN 0 THEN 'sharegpt' WHEN 1 THEN 'openai-messages' WHEN 2 THEN 'hermes-instruction-response' END AS input_format,
  CASE conv_id % 4 WHEN 3 THEN 'no known form' WHEN 2 THEN NULL ELSE CASE WHEN n < 2 THEN 'fewer than two messages' WHEN NOT duo THEN 'needs human and gpt messages' WHEN blank THEN 'empty message' END END AS issue FROM g""")
def normalized_records(spark, d):
    """Conversations in one of three input forms, or in none."""
    c = gathered(table(spark, d, "conversations"))
    k, who = F.col("conv_id") % 4, lambda m: F.when(m["from"] == "human", "user").when(m["from"] == "gpt", "assistant").otherwise(m["from"])
    one = F.when(k == 0, F.to_json("conversation"))
    two = F.when(k == 1, F.to_json(F.transform("conversation", lambda m: F.struct(who(m).alias("role"), F.array(F.struct(m["value"].alias("text"))).alias("content")))))
    x = X.normalized_record(one, two, F.when(k == 2, "do this"), F.when(k == 2, "done"), F.lit(" "))
    return c.select("conv_id", x.alias("x")).select("conv_id", "x.input_format", "x.issue")


@query("SELECT doc_id, quality = 1 AND toxic = 0 AND doc_id % 10 / 10 >= 0.5 AS goes FROM labels")
def qa_exports(spark, d):
    return table(spark, d, "labels").select("doc_id", X.qa_exportable(F.col("quality") == 1, F.when(F.col("toxic") == 0, True), F.col("doc_id") % 10 / 10, 0.5).alias("goes"))


@query("""WITH g AS (SELECT conv_id, string_agg(CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END, ',' ORDER BY turn) AS roles FROM conversations GROUP BY conv_id)
SELECT conv_id, coalesce(conv_id % 3 = 0 AND roles = 'human,gpt', false) AS goes FROM g""")
def translation_exports(spark, d):
    """Translations of two messages go out where the source is a question and an answer."""
    c = gathered(table(spark, d, "conversations"))
    made = F.struct(F.array(F.struct(F.lit("human").alias("from"), F.lit("a").alias("value")), F.struct(F.lit("gpt").alias("from"), F.lit("b").alias("value"))).alias("conversation"))
    return c.select("conv_id", X.translation_exportable(made, F.col("conversation"), F.lit(True), F.lit(0.9), F.when(F.col("conv_id") % 3 == 0, 0.8).otherwise(0.79)).alias("goes"))


@query("SELECT doc_id AS id, '[{\"type\":\"function\",\"function\":{\"name\":\"' || source || '\"}}]' AS tools, lang AS category, n_chars AS extra FROM documents")
def flattened_exports(spark, d):
    """Documents as export rows: tools from the system prompt, the language out of the provenance."""
    docs = table(spark, d, "documents")
    system = F.concat(F.lit("Use <tools>no list</tools><tools>\n[{\"name\":\""), F.col("source"), F.lit('"}]</tools>'))
    talk = F.array(F.struct(F.lit("system").alias("from"), system.alias("value")), F.struct(F.lit("human").alias("from"), F.col("text").alias("value")))
    rows = docs.select(F.col("doc_id").alias("id"), talk.alias("conversations"), F.lit("[]").alias("tools"), F.create_map(F.lit("category"), F.col("lang"), F.lit("id"), F.lit("x")).alias("source_provenance"), F.col("n_chars").alias("extra"))
    return X.flattened(rows, ["category"]).drop("conversations")


@query("""SELECT user_id AS session_id, count(*) AS total_executions, count(*) FILTER (event_type <> 'error') AS successful_executions, sum(event_id % 100)::BIGINT AS total_execution_time_ms, count(*) FILTER (length(props) > 40) AS truncation_count,
round(avg(event_id % 100), 6) AS avg_execution_time_ms, round(count(*) FILTER (event_type <> 'error') / count(*), 6) AS success_rate, round(sum(value), 4) AS total_reward, array_to_string(list(event_id ORDER BY event_id), ',') AS steps FROM events GROUP BY user_id""")
def session_metrics(spark, d):
    """A user is a session and an event an execution; the rewards' order shows in the events' numbers."""
    e = table(spark, d, "events")
    steps = lambda reward: e.select(F.col("user_id").alias("session_id"), F.col("event_id").alias("step"), (F.col("event_type") != "error").alias("success"), (F.col("event_id") % 100).alias("execution_time_ms"), F.length("props").alias("output_chars"), (F.length("props") > 40).alias("truncated"), reward.alias("reward"))
    m = O.session_metrics(steps(F.col("value")))
    order = O.session_metrics(steps(F.col("event_id").cast("double"))).select("session_id", F.array_join(F.transform("step_rewards", lambda x: x.cast("long").cast("string")), ",").alias("steps"))
    return m.join(order, "session_id").select("session_id", "total_executions", "successful_executions", "total_execution_time_ms", "truncation_count", F.round("avg_execution_time_ms", 6).alias("avg_execution_time_ms"), F.round("success_rate", 6).alias("success_rate"), F.round("total_reward", 4).alias("total_reward"), "steps")


@query(BASE + "SELECT count(*) AS total_standalone, round(avg(reward), 6) AS avg_reward, count(*) FILTER (answer_correct) AS correct_answers, count(*) FILTER (NOT answer_correct) AS incorrect_answers, count(*) FILTER (answer_correct IS NULL) AS unknown_answers, round(avg(num_turns), 6) AS avg_turns, round(avg(num_code_blocks), 6) AS avg_code_blocks FROM rollouts WHERE group_id % 3 = 1")
def standalone_trajectories(spark, d):
    """Every third user's rollouts are in no group."""
    t = rollouts(spark, d).withColumn("group_id", F.when(F.col("group_id") % 3 != 1, F.col("group_id")))
    return O.standalone(t).select("total_standalone", F.round("avg_reward", 6).alias("avg_reward"), "correct_answers", "incorrect_answers", "unknown_answers", F.round("avg_turns", 6).alias("avg_turns"), F.round("avg_code_blocks", 6).alias("avg_code_blocks"))


@query(BASE + "SELECT group_id, count(*) FILTER (status = 'failed') AS n_failed, count(*) FILTER (status = 'error') AS n_error, count(*) FILTER (status = 'timeout') AS n_timeout, sum(num_errors)::BIGINT AS sum_errors FROM rollouts GROUP BY group_id HAVING n_failed > 0 OR n_error > 0 OR n_timeout > 0 OR sum_errors > 0")
def troubled_groups(spark, d):
    return O.troubled(rollouts(spark, d))


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 0 ELSE value END AS total_reward, CASE WHEN event_id % 2 = 0 THEN 2 ELSE 1 END AS steps FROM events")
def scored_results(spark, d):
    """A null reward counts as 0; results without steps have the total as the only one."""
    steps = F.when(F.col("event_id") % 2 == 0, F.array(F.col("value"), F.lit(1.0))).otherwise(F.array().cast("array<double>"))
    x = O.scored(F.when(F.col("event_type") != "error", F.col("value")), steps)
    return table(spark, d, "events").select("event_id", x.alias("x")).select("event_id", "x.total_reward", F.size("x.step_rewards").alias("steps"))


@query("SELECT (row_number() OVER (ORDER BY doc_id) - 1)::VARCHAR AS id, text AS prompt, lang AS context, json_object('source', source, 'expected_answer', n_chars::VARCHAR)::VARCHAR AS metadata FROM documents WHERE text <> ''")
def task_math(spark, d):
    """Documents as problems, their length as the answer."""
    rows = table(spark, d, "documents").select("doc_id", "text", "lang", "source", F.col("n_chars").cast("string").alias("answer"))
    return TK.math_rows(rows, ["doc_id"], None, "text", "answer", "lang").select("id", "prompt", "context", F.to_json(F.struct(F.get_json_object("metadata", "$.source").alias("source"), F.get_json_object("metadata", "$.expected_answer").alias("expected_answer")), {"ignoreNullFields": "false"}).alias("metadata"))


@query("SELECT doc_id, source AS repo FROM documents WHERE source IN (SELECT min(source) FROM documents)")
def task_repositories(spark, d):
    """Documents as repair rows; those of one source."""
    docs = table(spark, d, "documents").select("doc_id", F.col("source").alias("repo"))
    return TK.of_repositories(docs, [docs.agg(F.min("repo")).first()[0]])


@query(f"SELECT conv_id, turn, coalesce(array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(text, '[\\w.+-]+@[\\w.-]+\\.[A-Za-z]{{2,}}|https?://[^\\s<>]+|www\\.[^\\s<>]+'), lambda t: t <> ''))), ','), '') AS lost FROM conversations")
def lost_links(spark, d):
    """Links of messages that a translation without any has lost."""
    links = L.links(F.col("text"))
    return table(spark, d, "conversations").select("conv_id", "turn", F.array_join(L.lost(links, F.array().cast("array<string>")), ",").alias("lost"))
