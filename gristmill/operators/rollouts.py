"""Accounting of rollout groups: statistics, best of N, runs of errors, reports and integrity checks.

Rollouts have group_id, rollout_id, rollout_index, status, reward, success, answer_correct (null: unknown), num_turns,
num_code_blocks, num_errors. Null rewards count as no reward in statistics and as 0 in best-of-N.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

STATUSES = ("completed", "failed", "error", "timeout")


def status_counts(rollouts: DataFrame, key: str = "group_id") -> DataFrame:
    return rollouts.groupBy(key).agg(F.count("*").alias("n"), *(F.count_if(F.col("status") == s).alias(f"n_{s}") for s in STATUSES))


def reward_stats(rollouts: DataFrame, key: str = "group_id") -> DataFrame:
    """Mean, sample deviation (0 for a single rollout), least and largest reward of each group."""
    r = F.col("reward")
    return rollouts.groupBy(key).agg(F.count("*").alias("n"), F.avg(r).alias("reward_mean"), F.coalesce(F.stddev_samp(r), F.lit(0.0)).alias("reward_std"), F.min(r).alias("reward_min"), F.max(r).alias("reward_max"))


def best_of(rollouts: DataFrame, key: str = "group_id", by_success: bool = True) -> DataFrame:
    """(key, rollout_id, reward) of the best by reward, then success; the first index wins ties. Partial aggregates, no sort."""
    order = [F.coalesce("reward", F.lit(0.0)).alias("r"), *([F.coalesce(F.col("success").cast("int"), F.lit(0)).alias("s")] if by_success else []), (-F.col("rollout_index")).alias("i")]
    return rollouts.groupBy(key).agg(F.max_by(F.struct("rollout_id", "reward"), F.struct(*order)).alias("b")).select(key, F.col("b.rollout_id").alias("best_rollout_id"), F.col("b.reward").alias("best_reward"))


def ranked(rollouts: DataFrame, key: str = "group_id") -> DataFrame:
    """rollouts with rn, 1 for the largest reward of the group; ties by index."""
    return rollouts.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("reward"), "rollout_index")))


def run_stats(rollouts: DataFrame) -> DataFrame:
    """One row over all rollouts: counts by outcome and correctness, means and rates (null on no rows)."""
    correct, wrong = F.count_if("answer_correct"), F.count_if(~F.col("answer_correct"))
    return rollouts.agg(
        F.count("*").alias("total"), F.count_if("success").alias("successful"), F.count_if(~F.coalesce("success", F.lit(False))).alias("failed"), correct.alias("correct"), wrong.alias("incorrect"),
        F.count_if(F.col("answer_correct").isNull()).alias("unknown"), F.avg("num_turns").alias("avg_turns"), F.avg("num_code_blocks").alias("avg_code_blocks"),
        F.try_divide(F.count_if("success"), F.count("*")).alias("success_rate"), F.try_divide(correct, correct + wrong).alias("accuracy"),
    )


def reason_histogram(rollouts: DataFrame) -> DataFrame:
    """Reasons of failed rollouts, most frequent first, then by name."""
    return rollouts.filter("status = 'failed'").groupBy(F.coalesce("termination_reason", F.lit("unknown")).alias("reason")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")


def streaks(events: DataFrame, key: str, order: list[str], bad: Column) -> DataFrame:
    """events with streak, the number of bad rows in a row up to here (0 on a good one)."""
    w = Window.partitionBy(key).orderBy(*order)
    out = events.withColumn("__bad", F.coalesce(bad, F.lit(False))).withColumn("__island", F.sum((~F.col("__bad")).cast("int")).over(w))
    island = Window.partitionBy(key, "__island").orderBy(*order)
    return out.withColumn("streak", F.sum(F.col("__bad").cast("long")).over(island)).drop("__bad", "__island")


def count_mismatches(groups: DataFrame, rollouts: DataFrame) -> DataFrame:
    """Groups whose number of rollouts isn't num_rollouts."""
    n = rollouts.groupBy("group_id").agg(F.count("*").alias("actual"))
    return groups.join(n, "group_id", "left").select("group_id", F.col("num_rollouts").alias("expected"), F.coalesce("actual", F.lit(0)).alias("actual")).filter("expected <> actual")


def broken_links(trajectories: DataFrame, rollouts: DataFrame) -> DataFrame:
    """Trajectories with a rollout that is missing or names another trajectory."""
    r = rollouts.select(F.col("rollout_id"), F.col("trajectory_id").alias("back"))
    return trajectories.filter("rollout_id IS NOT NULL").join(r, "rollout_id", "left").filter("back IS NULL OR back <> trajectory_id").select("trajectory_id", "rollout_id", "back")


def status_mismatches(groups: DataFrame, rollouts: DataFrame) -> DataFrame:
    """Groups whose stored counts by status aren't the actual ones."""
    a = status_counts(rollouts).drop("n")
    cols = [(f"num_{s}", F.coalesce(f"n_{s}", F.lit(0)).alias(f"n_{s}")) for s in STATUSES]
    out = groups.join(a, "group_id", "left").select("group_id", *(c for c, _ in cols), *(a for _, a in cols))
    return out.filter(" OR ".join(f"num_{s} <> n_{s}" for s in STATUSES))


def best_mismatches(groups: DataFrame, rollouts: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """Groups whose stored best isn't the actual one; a stored null id isn't compared."""
    best = ranked(rollouts).filter("rn = 1").select("group_id", F.col("rollout_id").alias("actual_id"), F.col("reward").alias("actual_reward"))
    out = groups.join(best, "group_id", "left").filter((F.col("best_rollout_id") != F.col("actual_id")) | (F.abs(F.col("best_reward") - F.col("actual_reward")) > tolerance))
    return out.select("group_id", "best_rollout_id", "actual_id")


def stat_mismatches(groups: DataFrame, rollouts: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Groups whose stored mean, deviation or least reward is off."""
    s = reward_stats(rollouts).select("group_id", F.col("reward_mean").alias("m"), F.col("reward_std").alias("s"), F.col("reward_min").alias("l"))
    off = lambda a, b: F.abs(F.col(a) - F.col(b)) > tolerance
    return groups.withColumn("reward_std", F.coalesce("reward_std", F.lit(0.0))).join(s, "group_id").filter(off("reward_mean", "m") | off("reward_std", "s") | off("reward_min", "l")).select("group_id")


def recommendations(violation_rate: Column, failure_rate: Column, accuracy: Column) -> Column:
    """What a report advises: rates over 10 % and 20 %, accuracy under 50 %."""
    return F.array_compact(F.array(F.when(violation_rate > 0.1, "reduce format violations"), F.when(failure_rate > 0.2, "reduce failures"), F.when(accuracy < 0.5, "improve accuracy")))


def report(groups: DataFrame, rollouts: DataFrame, trajectories: DataFrame, fan_out: bool = False) -> DataFrame:
    """Counts, mean group reward and sums over groups with rollouts and trajectories.

    fan_out joins rollouts and trajectories to groups independently of each other, which weights sums by the product of both.
    """
    r = groups.join(rollouts.select("group_id", "rollout_id"), "group_id", "left")
    t = trajectories.select(*(["group_id"] if fan_out else []), "rollout_id", "trajectory_id", "num_errors")
    j = r.join(t.drop("rollout_id"), "group_id", "left") if fan_out else r.join(t, "rollout_id", "left")
    return j.agg(F.countDistinct("group_id").alias("n_groups"), F.countDistinct("rollout_id").alias("n_rollouts"), F.countDistinct("trajectory_id").alias("n_trajectories"), F.avg("reward_mean").alias("avg_reward_mean"), F.sum("num_errors").alias("sum_errors"))


def exportable(success: Column, answer: Column, expected: Column, answer_correct: Column, reward: Column) -> Column:
    """Whether a result goes out: success with an answer, and not known wrong; without an expected answer, a reward above 0.5."""
    known = ~answer_correct.eqNullSafe(F.lit(False))
    return F.coalesce(success, F.lit(False)) & (F.coalesce(answer, F.lit("")) != "") & F.when(expected.isNotNull(), known).otherwise(F.coalesce(reward > 0.5, F.lit(False)))


def session_metrics(steps: DataFrame, key: str = "session_id", order: str = "step") -> DataFrame:
    """Of each session's executions (success, execution_time_ms, output_chars, truncated, reward): counts, sums, the mean time,
    the share of successes, and the rewards in order. A null reward is none, a null success a failure."""
    ok, r = F.coalesce(F.col("success"), F.lit(False)), F.coalesce(F.col("reward"), F.lit(0.0))
    return steps.groupBy(key).agg(
        F.count("*").alias("total_executions"), F.count_if(ok).alias("successful_executions"), F.count_if(~ok).alias("failed_executions"), F.sum("execution_time_ms").alias("total_execution_time_ms"),
        F.sum("output_chars").alias("total_output_chars"), F.count_if("truncated").alias("truncation_count"), F.avg("execution_time_ms").alias("avg_execution_time_ms"),
        (F.count_if(ok) / F.count("*")).alias("success_rate"), F.sum(r).alias("total_reward"), F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), r.alias("r")))), lambda x: x["r"]).alias("step_rewards"),
    )


def standalone(trajectories: DataFrame) -> DataFrame:
    """One row over trajectories that are in no group: how many, their means, and answers by correctness."""
    c = F.col("answer_correct")
    return trajectories.filter("group_id IS NULL").agg(
        F.count("*").alias("total_standalone"), F.avg("reward").alias("avg_reward"), F.count_if(c).alias("correct_answers"), F.count_if(~c).alias("incorrect_answers"),
        F.count_if(c.isNull()).alias("unknown_answers"), F.avg("num_turns").alias("avg_turns"), F.avg("num_code_blocks").alias("avg_code_blocks"),
    )


def troubled(rollouts: DataFrame, key: str = "group_id") -> DataFrame:
    """Groups with any rollout that failed, broke off, timed out or made an error, with the four sums."""
    sums = status_counts(rollouts, key).drop("n", "n_completed").join(rollouts.groupBy(key).agg(F.sum("num_errors").alias("sum_errors")), key)
    return sums.filter("n_failed > 0 OR n_error > 0 OR n_timeout > 0 OR sum_errors > 0")


def scored(reward: Column, steps: Column, enabled: bool = True) -> Column:
    """(total_reward, step_rewards): nothing where rewards are off, a null reward as 0, and the total as the only step where
    there are none."""
    total = F.coalesce(reward, F.lit(0.0)) if enabled else F.lit(0.0)
    none = F.array().cast("array<double>")
    return F.struct(total.alias("total_reward"), (F.when(F.size(F.coalesce(steps, none)) == 0, F.array(total)).otherwise(steps) if enabled else none).alias("step_rewards"))


def run_summary(results: DataFrame) -> DataFrame:
    """processed, accepted, rejected, errors, acceptance_rate and mean_reward (0 on no rows) of (accepted, errored, reward)."""
    return results.agg(
        F.count("*").alias("processed"), F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted") & ~F.col("errored")).alias("rejected"), F.count_if("errored").alias("errors"),
        F.coalesce(F.try_divide(F.count_if("accepted"), F.count("*")), F.lit(0.0)).alias("acceptance_rate"), F.coalesce(F.avg("reward"), F.lit(0.0)).alias("mean_reward"),
    )
