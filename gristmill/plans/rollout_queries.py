"""Rollout accounting on the events table.

An event is a rollout: user_id its group, event_id its id, value its reward, its place by time in the group its index. Errors
are errors, views timeouts, signups failures, all else is completed; purchases are correct, errors wrong, others unknown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gristmill.functions import rewards as R
from gristmill.operators import rollouts as O
from gristmill.plans.registry import query, table

BASE = """WITH rollouts AS (SELECT user_id AS group_id, event_id AS rollout_id, event_id + 1000000 AS trajectory_id, ts,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rollout_index,
  CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'timeout' WHEN 'signup' THEN 'failed' ELSE 'completed' END AS status,
  value AS reward, event_type IN ('click', 'purchase') AS success,
  CASE event_type WHEN 'purchase' THEN true WHEN 'error' THEN false END AS answer_correct,
  event_id % 7 AS num_turns, event_id % 5 AS num_code_blocks, event_id % 3 AS num_errors, event_type AS termination_reason FROM events)
"""


def rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    return e.select(
        F.col("user_id").alias("group_id"), F.col("event_id").alias("rollout_id"), (F.col("event_id") + 1000000).alias("trajectory_id"), "ts",
        (F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1).cast("long").alias("rollout_index"),
        F.when(t == "error", "error").when(t == "view", "timeout").when(t == "signup", "failed").otherwise("completed").alias("status"),
        F.col("value").alias("reward"), t.isin("click", "purchase").alias("success"), F.when(t == "purchase", True).when(t == "error", False).alias("answer_correct"),
        (F.col("event_id") % 7).alias("num_turns"), (F.col("event_id") % 5).alias("num_code_blocks"), (F.col("event_id") % 3).alias("num_errors"), t.alias("termination_reason"),
    )


GROUPS = """, groups AS (SELECT group_id, count(*) + CASE WHEN group_id % 10 = 0 THEN 1 ELSE 0 END AS num_rollouts,
  count(*) FILTER (status = 'completed') AS num_completed, count(*) FILTER (status = 'failed') + CASE WHEN group_id % 9 = 0 THEN 1 ELSE 0 END AS num_failed,
  count(*) FILTER (status = 'error') AS num_error, count(*) FILTER (status = 'timeout') AS num_timeout,
  avg(reward) + CASE WHEN group_id % 8 = 0 THEN 0.01 ELSE 0 END AS reward_mean, stddev_samp(reward) AS reward_std, min(reward) AS reward_min,
  CASE WHEN group_id % 11 = 0 THEN NULL WHEN group_id % 6 = 0 THEN -1 ELSE max(b_id) END AS best_rollout_id, max(reward) AS best_reward
  FROM (SELECT *, first_value(rollout_id) OVER (PARTITION BY group_id ORDER BY reward DESC, rollout_index) AS b_id FROM rollouts) GROUP BY group_id)
"""


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored group rows with planted faults, for the integrity checks."""
    r = rollouts(spark, sf_dir)
    g, mod = F.col("group_id"), lambda n, yes, no=0: F.when(F.col("group_id") % n == 0, yes).otherwise(no)
    s = O.status_counts(r).join(O.reward_stats(r).drop("n"), "group_id").join(O.best_of(r, by_success=False), "group_id")
    return s.select(
        g, (F.col("n") + mod(10, 1)).alias("num_rollouts"), F.col("n_completed").alias("num_completed"), (F.col("n_failed") + mod(9, 1)).alias("num_failed"), F.col("n_error").alias("num_error"),
        F.col("n_timeout").alias("num_timeout"), (F.col("reward_mean") + mod(8, 0.01, 0.0)).alias("reward_mean"), "reward_std", "reward_min",
        F.when(g % 11 == 0, None).when(g % 6 == 0, -1).otherwise(F.col("best_rollout_id")).alias("best_rollout_id"), F.col("reward_max").alias("best_reward"),
    )


@query(BASE + "SELECT group_id, count(*) AS n, round(avg(reward), 6) AS reward_mean, round(coalesce(stddev_samp(reward), 0), 6) AS reward_std, min(reward) AS reward_min, max(reward) AS reward_max FROM rollouts GROUP BY group_id")
def group_reward_stats(spark, d):
    return O.reward_stats(rollouts(spark, d)).withColumns({c: F.round(c, 6) for c in ("reward_mean", "reward_std")})


@query(BASE + "SELECT group_id, rollout_id AS best_rollout_id, reward AS best_reward FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY coalesce(reward, 0) DESC, success DESC, rollout_index) AS k FROM rollouts) WHERE k = 1")
def best_of_n(spark, d):
    return O.best_of(rollouts(spark, d))


@query(BASE + "SELECT group_id, rollout_id, reward FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY reward DESC, rollout_index) AS k FROM rollouts) WHERE k = 1")
def best_by_reward(spark, d):
    return O.ranked(rollouts(spark, d)).filter("rn = 1").select("group_id", "rollout_id", "reward")


@query(BASE + "SELECT group_id, count(*) AS n, " + ", ".join(f"count(*) FILTER (status = '{s}') AS n_{s}" for s in O.STATUSES) + " FROM rollouts GROUP BY group_id")
def status_counts(spark, d):
    return O.status_counts(rollouts(spark, d))


@query(BASE + """SELECT count(*) AS total, count(*) FILTER (success) AS successful, count(*) FILTER (NOT success) AS failed, count(*) FILTER (answer_correct) AS correct,
  count(*) FILTER (NOT answer_correct) AS incorrect, count(*) FILTER (answer_correct IS NULL) AS unknown, round(avg(num_turns), 6) AS avg_turns, round(avg(num_code_blocks), 6) AS avg_code_blocks,
  round(count(*) FILTER (success) / count(*), 6) AS success_rate, round(count(*) FILTER (answer_correct) / count(answer_correct), 6) AS accuracy FROM rollouts""")
def pipeline_stats(spark, d):
    return O.run_stats(rollouts(spark, d)).withColumns({c: F.round(c, 6) for c in ("avg_turns", "avg_code_blocks", "success_rate", "accuracy")})


@query(BASE + "SELECT termination_reason AS reason, count(*) AS n FROM rollouts WHERE status = 'failed' GROUP BY 1")
def termination_hist(spark, d):
    return O.reason_histogram(rollouts(spark, d))


@query(BASE + """SELECT rollout_id, CAST(sum(CASE WHEN status = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY group_id, island ORDER BY rollout_index) AS BIGINT) AS streak FROM
  (SELECT *, sum(CASE WHEN status = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY group_id ORDER BY rollout_index) AS island FROM rollouts)""")
def consecutive_errors(spark, d):
    return O.streaks(rollouts(spark, d), "group_id", ["rollout_index"], F.col("status") == "error").select("rollout_id", "streak")


@query(BASE + """SELECT rollout_id, reason IS NOT NULL AS stop, reason FROM (SELECT rollout_id, CASE WHEN v >= 3 THEN 'Format violation: ' || v || '/3' WHEN c >= 2 THEN 'Consecutive errors: ' || c || '/2'
  WHEN e >= 6 THEN 'Total errors: ' || e || '/6' WHEN t >= 49 AND b = 0 THEN 'Max turns (50) reached without any successful code execution' END AS reason FROM (
  SELECT rollout_id, num_errors + num_code_blocks - 2 AS v, num_turns - 3 AS c, num_errors * 3 AS e, rollout_index AS t, num_code_blocks AS b FROM rollouts))""")
def termination_policy(spark, d):
    r = rollouts(spark, d).select("rollout_id", R.termination(F.col("num_errors") + F.col("num_code_blocks") - 2, F.col("num_turns") - 3, F.col("num_errors") * 3, F.col("rollout_index"), F.col("num_code_blocks"), max_consecutive=2, max_errors=6, max_turns=50).alias("t"))
    return r.select("rollout_id", "t.stop", "t.reason")


@query(BASE + GROUPS + "SELECT g.group_id, num_rollouts AS expected, n AS actual FROM groups g JOIN (SELECT group_id, count(*) AS n FROM rollouts GROUP BY 1) USING (group_id) WHERE num_rollouts <> n")
def integrity_counts(spark, d):
    return O.count_mismatches(groups(spark, d), rollouts(spark, d))


@query(BASE + "SELECT t.trajectory_id, t.rollout_id, r.trajectory_id AS back FROM (SELECT trajectory_id, CASE WHEN rollout_id % 13 = 0 THEN rollout_id + 1 WHEN rollout_id % 17 = 0 THEN -rollout_id - 1 ELSE rollout_id END AS rollout_id FROM rollouts) t LEFT JOIN rollouts r ON r.rollout_id = t.rollout_id WHERE r.trajectory_id IS NULL OR r.trajectory_id <> t.trajectory_id")
def integrity_links(spark, d):
    r, i = rollouts(spark, d), F.col("rollout_id")
    return O.broken_links(r.select("trajectory_id", F.when(i % 13 == 0, i + 1).when(i % 17 == 0, -i - 1).otherwise(i).alias("rollout_id")), r)


@query(BASE + GROUPS + """SELECT group_id, num_completed, num_failed, num_error, num_timeout, n_completed, n_failed, n_error, n_timeout FROM groups JOIN (SELECT group_id,
  """ + ", ".join(f"count(*) FILTER (status = '{s}') AS n_{s}" for s in O.STATUSES) + " FROM rollouts GROUP BY 1) USING (group_id) WHERE num_completed <> n_completed OR num_failed <> n_failed OR num_error <> n_error OR num_timeout <> n_timeout")
def integrity_status(spark, d):
    return O.status_mismatches(groups(spark, d), rollouts(spark, d))


@query(BASE + GROUPS + """SELECT group_id, best_rollout_id, rollout_id AS actual_id FROM groups LEFT JOIN (SELECT group_id, rollout_id, reward, row_number() OVER (PARTITION BY group_id ORDER BY reward DESC, rollout_index) AS k FROM rollouts) b USING (group_id)
  WHERE k = 1 AND (best_rollout_id <> rollout_id OR abs(best_reward - reward) > 1e-4)""")
def integrity_best(spark, d):
    return O.best_mismatches(groups(spark, d), rollouts(spark, d))


@query(BASE + GROUPS + """SELECT group_id FROM groups JOIN (SELECT group_id, avg(reward) AS m, coalesce(stddev_samp(reward), 0) AS s, min(reward) AS l FROM rollouts GROUP BY 1) USING (group_id)
  WHERE abs(reward_mean - m) > 1e-3 OR abs(coalesce(reward_std, 0) - s) > 1e-3 OR abs(reward_min - l) > 1e-3""")
def integrity_stats(spark, d):
    return O.stat_mismatches(groups(spark, d), rollouts(spark, d))


_TRAJ = BASE + GROUPS + ", trajectories AS (SELECT group_id, rollout_id, trajectory_id, num_errors FROM rollouts WHERE num_turns > 1)\n"
_SUMS = "SELECT count(DISTINCT g.group_id) AS n_groups, count(DISTINCT r.rollout_id) AS n_rollouts, count(DISTINCT t.trajectory_id) AS n_trajectories, round(avg(g.reward_mean), 6) AS avg_reward_mean, CAST(sum(t.num_errors) AS BIGINT) AS sum_errors FROM groups g LEFT JOIN rollouts r ON r.group_id = g.group_id LEFT JOIN trajectories t ON "


@query(_TRAJ + _SUMS + "t.rollout_id = r.rollout_id")
def summary_report(spark, d):
    r = rollouts(spark, d)
    return O.report(groups(spark, d), r, r.filter("num_turns > 1")).withColumn("avg_reward_mean", F.round("avg_reward_mean", 6))


@query(BASE + """, steps AS (SELECT rollout_id, answer_correct, success, num_errors, num_turns, num_code_blocks, 5 AS max_turns, reward AS steps FROM rollouts)
SELECT rollout_id, round(coalesce(steps, 0) + CASE WHEN answer_correct THEN 1.0 WHEN NOT answer_correct THEN -0.5 ELSE 0.0 END, 6) AS simple,
  round(coalesce(steps, 0) + CASE WHEN answer_correct THEN 1.0 + 0.5 * greatest(0.0, 1 - num_code_blocks / 5) - 0.1 * num_errors WHEN NOT answer_correct THEN -0.5 - 0.3 * num_code_blocks / 5 ELSE 0.0 END, 6) AS efficiency,
  round((coalesce(steps, 0) + CASE WHEN answer_correct THEN 1.0 WHEN NOT answer_correct THEN -0.5 ELSE 0.0 END) / greatest(1, num_turns), 6) AS per_turn,
  round(CASE WHEN success THEN coalesce(steps, 0) + greatest(0.0, 0.3 + 0.2 * greatest(0.0, 1 - num_turns / 5) - 0.03 * num_errors + CASE WHEN num_errors = 0 AND num_code_blocks >= 3 THEN 0.7 WHEN num_errors <= 2 AND num_code_blocks >= 5 THEN 0.3 ELSE 0 END) ELSE -0.2 END, 6) AS swe_test_based,
  round(coalesce(steps, 0) + CASE WHEN success THEN greatest(0.0, 0.5 + 0.3 * greatest(0.0, 1 - num_turns / 5) - 0.05 * num_errors) ELSE -0.3 END, 6) AS swe_completion,
  round(coalesce(steps, 0) + greatest(0.0, 0.2 + least(0.05 * num_code_blocks, 0.3) + CASE WHEN success THEN 0.5 ELSE 0 END - 0.03 * num_errors), 6) AS swe_progress FROM steps""")
def reward_functions(spark, d):
    m = F.struct("answer_correct", "success", "num_errors", "num_turns", "num_code_blocks", F.lit(5).alias("max_turns"), F.col("reward").alias("steps"))
    r = rollouts(spark, d).select("rollout_id", "num_turns", m.alias("m"))
    names = ("simple", "efficiency", "swe_test_based", "swe_completion", "swe_progress")
    totals = {n: F.round(R.total_reward(n, F.col("m")), 6) for n in names}
    return r.select("rollout_id", *(c.alias(n) for n, c in totals.items()), F.round(R.per_unit(R.total_reward("normalized", F.col("m")), F.col("num_turns")), 6).alias("per_turn"))


@query(BASE + "SELECT group_id, rollout_id FROM rollouts WHERE success AND CASE WHEN num_errors > 0 THEN answer_correct IS DISTINCT FROM false ELSE reward > 0.5 END")
def export_filter(spark, d):
    r = rollouts(spark, d)
    return r.filter(O.exportable(F.col("success"), F.lit("x"), F.when(F.col("num_errors") > 0, "y"), F.col("answer_correct"), F.col("reward"))).select("group_id", "rollout_id")


@query(BASE + "SELECT count(*) AS processed, count(*) FILTER (success) AS accepted, count(*) FILTER (NOT success AND status <> 'error') AS rejected, count(*) FILTER (status = 'error') AS errors, round(count(*) FILTER (success) / count(*), 6) AS acceptance_rate, round(avg(reward), 6) AS mean_reward FROM rollouts")
def run_summary(spark, d):
    r = rollouts(spark, d).select(F.col("success").alias("accepted"), (F.col("status") == "error").alias("errored"), "reward")
    return O.run_summary(r).withColumns({c: F.round(c, 6) for c in ("acceptance_rate", "mean_reward")})


@query("""SELECT source, count(*) AS n, count(*) FILTER (quality = 1) AS correct, count(*) FILTER (quality = 0) AS incorrect, count(*) FILTER (quality IS NULL) AS unknown,
  round(count(*) FILTER (quality = 1) / nullif(count(quality), 0), 6) AS accuracy FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""")
def summary_tri_state(spark, d):
    j = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id", "left")
    yes, no = F.count_if(F.col("quality") == 1), F.count_if(F.col("quality") == 0)
    return j.groupBy("source").agg(F.count("*").alias("n"), yes.alias("correct"), no.alias("incorrect"), F.count_if(F.col("quality").isNull()).alias("unknown"), F.round(F.try_divide(yes, yes + no), 6).alias("accuracy"))


@query(BASE + """SELECT group_id, round(v, 6) AS violation_rate, list_filter([CASE WHEN v > 0.1 THEN 'reduce format violations' END, CASE WHEN f > 0.2 THEN 'reduce failures' END, CASE WHEN a < 0.5 THEN 'improve accuracy' END], lambda x: x IS NOT NULL)::VARCHAR AS advice
  FROM (SELECT group_id, avg(CASE WHEN num_errors = 2 THEN 1.0 ELSE 0 END) AS v, avg(CASE WHEN status = 'failed' THEN 1.0 ELSE 0 END) AS f, count(*) FILTER (answer_correct) / nullif(count(answer_correct), 0) AS a FROM rollouts GROUP BY 1)""")
def recommendations(spark, d):
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    g = rollouts(spark, d).groupBy("group_id").agg(share(F.col("num_errors") == 2).alias("v"), share(F.col("status") == "failed").alias("f"), F.try_divide(F.count_if("answer_correct"), F.count("answer_correct")).alias("a"))
    return g.select("group_id", F.round("v", 6).alias("violation_rate"), F.concat(F.lit("["), F.array_join(O.recommendations(F.col("v"), F.col("f"), F.col("a")), ", "), F.lit("]")).alias("advice"))


@query(BASE + "SELECT group_id, n, n_error FROM (SELECT group_id, count(*) AS n, count(*) FILTER (status = 'error') AS n_error FROM rollouts GROUP BY 1) WHERE n_error > 0 AND n > 10")
def groups_with_errors(spark, d):
    return O.status_counts(rollouts(spark, d)).filter("n_error > 0 AND n > 10").select("group_id", "n", "n_error")
