"""Rewards and termination rules as columns over per-rollout metrics.

Metrics are columns of a struct: answer_correct (null: unknown), success, num_errors, num_turns, num_code_blocks, max_turns and
steps (the sum of rewards on the way).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

REWARDS: dict[str, Callable[[Column], Column]] = {}


def reward(name: str):
    """Register a function from metrics to the reward of the last step under a normalized name; names are unique."""
    key = name.strip().lower().replace("-", "_")

    def put(f):
        if key in REWARDS:
            raise ValueError(f"a reward named {key} exists")
        REWARDS[key] = f
        return f

    return put


def _by_answer(m: Column, yes: Column, no: Column) -> Column:
    return F.when(m["answer_correct"], yes).when(~m["answer_correct"], no).otherwise(F.lit(0.0))


def _share(n: Column, of: Column) -> Column:
    return F.when(of > 0, n / F.when(of > 0, of)).otherwise(0.0)


def _spare(n: Column, of: Column) -> Column:
    return F.when(of > 0, F.greatest(F.lit(0.0), 1 - n / F.when(of > 0, of))).otherwise(0.0)


@reward("simple")
def simple(m: Column) -> Column:
    return _by_answer(m, F.lit(1.0), F.lit(-0.5))


@reward("efficiency")
def efficiency(m: Column) -> Column:
    yes = 1.0 + 0.5 * _spare(m["num_code_blocks"], m["max_turns"]) - 0.1 * m["num_errors"]
    return _by_answer(m, yes, -0.5 + -0.3 * _share(m["num_code_blocks"], m["max_turns"]))


@reward("normalized")
def normalized(m: Column) -> Column:
    return simple(m)


@reward("swe_test_based")
def swe_test_based(m: Column) -> Column:
    likely = (m["num_errors"] == 0) & (m["num_code_blocks"] >= 3)
    partly = (m["num_errors"] <= 2) & (m["num_code_blocks"] >= 5)
    done = 0.3 + 0.2 * _spare(m["num_turns"], m["max_turns"]) - 0.03 * m["num_errors"] + F.when(likely, 0.7).when(partly, 0.3).otherwise(0.0)
    return F.when(m["success"], F.greatest(F.lit(0.0), done)).otherwise(-0.2)


@reward("swe_completion")
def swe_completion(m: Column) -> Column:
    done = 0.5 + 0.3 * _spare(m["num_turns"], m["max_turns"]) - 0.05 * m["num_errors"]
    return F.when(m["success"], F.greatest(F.lit(0.0), done)).otherwise(-0.3)


@reward("swe_progress")
def swe_progress(m: Column) -> Column:
    return F.greatest(F.lit(0.0), 0.2 + F.least(0.05 * m["num_code_blocks"], F.lit(0.3)) + F.when(m["success"], 0.5).otherwise(0.0) - 0.03 * m["num_errors"])


def total_reward(name: str, m: Column) -> Column:
    """Rewards on the way and of the last step; an incomplete test-based run has its penalty alone."""
    last = REWARDS[name](m)
    whole = F.coalesce(m["steps"], F.lit(0.0)) + last
    return F.when(~m["success"], last).otherwise(whole) if name == "swe_test_based" else whole


def per_unit(total: Column, n: Column) -> Column:
    """Reward a turn or code block, of at least one."""
    return total / F.greatest(F.lit(1), n)


def termination(violations: Column, consecutive: Column, errors: Column, turn: Column, code_blocks: Column, *, at_once: bool = False, max_violations: int = 3, max_consecutive: int = 3, max_errors: int = 10, max_turns: int | None = None) -> Column:
    """(stop, reason): the first of format violations, consecutive errors, all errors and the last turn that applies."""
    limit = 1 if at_once else max(1, max_violations)
    said = lambda label, n, most: F.concat(F.lit(f"{label}: "), n.cast("string"), F.lit(f"/{most}"))
    reason = F.when((violations > 0) & (violations >= limit), said("Format violation", violations, limit))
    reason = reason.when(consecutive >= max_consecutive, said("Consecutive errors", consecutive, max_consecutive))
    reason = reason.when(errors >= max_errors, said("Total errors", errors, max_errors))
    if max_turns is not None:
        reason = reason.when((turn >= max_turns - 1) & (code_blocks == 0), F.lit(f"Max turns ({max_turns}) reached without any successful code execution"))
    return F.struct(reason.isNotNull().alias("stop"), reason.alias("reason"))


def final_status(concluded: Column) -> Column:
    return F.when(F.coalesce(concluded, F.lit(False)), "completed").otherwise("timeout")


def step_reward(output: Column, error: Column, ready: Column, iteration: Column, cap: int, *, success: float = 1.0, failure: float = -0.05, step: float = 0.0) -> Column:
    """(done, final_answer, reward) of one execution: a final answer ends an episode, and so does the last iteration."""
    answer = F.nullif(F.regexp_extract(output, r"(?s)FINAL(?:_VAR)?\((.*?)\)", 1), F.lit(""))
    final = answer.isNotNull() | F.coalesce(ready, F.lit(False))
    value = F.when(final, success).when(error.isNotNull() & (error != ""), failure).otherwise(step)
    return F.struct((final | (iteration >= cap)).alias("done"), answer.alias("final_answer"), value.alias("reward"))


def test_counts(turns: Column) -> Column:
    """(run, passed, failed, all_passed) from the texts of turns."""
    most = lambda p: F.coalesce(F.array_max(F.transform(turns, lambda t: F.coalesce(F.nullif(F.regexp_extract(t, p, 1), F.lit("")).cast("long"), F.lit(0)))), F.lit(0))
    count = lambda w: F.aggregate(turns, F.lit(0).cast("long"), lambda a, t: a + F.regexp_count(t, F.lit(w)))
    run, failed = count("PASSED"), most(r"(\d+) failed") + count("FAILED|ERROR")
    return F.struct(run.alias("run"), most(r"(\d+) passed").alias("passed"), failed.alias("failed"), ((run > 0) & (failed == 0)).alias("all_passed"))
