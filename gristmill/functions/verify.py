"""Verifiers and metrics over answers, verdicts and judges, as columns."""

from __future__ import annotations

import ast
import operator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions import lang
from gristmill.functions.udf import pandas_column


def equal_answer(expected: Column, candidates: Column) -> Column:
    """Whether a candidate is the expected answer, trimmed and ignoring case; null without either."""
    same = F.exists(candidates, lambda c: F.lower(F.trim(c)) == F.lower(F.trim(expected)))
    return F.when(expected.isNotNull() & (F.size(candidates) > 0), same)


def share_true(x: Column) -> Column:
    """Share of true among booleans; 0 for none."""
    return F.coalesce(F.try_divide(F.size(F.filter(x, lambda v: v)), F.size(x)), F.lit(0.0))


def average_precision(relevant: Column) -> Column:
    """Mean precision at the ranks of relevant entries of a ranked array of booleans; 0 without any."""
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("hits"), F.lit(0).alias("rank"))
    step = lambda a, r: F.struct((a["sum"] + F.when(r, (a["hits"] + 1) / (a["rank"] + 1)).otherwise(0.0)).alias("sum"), (a["hits"] + r.cast("int")).alias("hits"), (a["rank"] + 1).alias("rank"))
    return F.aggregate(relevant, start, step, lambda a: F.when(a["hits"] > 0, a["sum"] / a["hits"]).otherwise(0.0))


def rag_result(score: Column, problem: Column, threshold: float = 0.5) -> Column:
    """(score, passed, problem): scores within 0 and 1; with a problem 0 and not passed."""
    s = F.when(problem.isNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))).otherwise(0.0)
    return F.struct(s.alias("score"), (problem.isNull() & (s >= threshold)).alias("passed"), problem.alias("problem"))


def faithfulness(claims: Column, threshold: float = 0.5) -> Column:
    """Supported claims (structs with supported) among all; none is a problem."""
    return rag_result(share_true(F.transform(claims, lambda c: c["supported"])), F.when(F.coalesce(F.size(claims), F.lit(0)) <= 0, "no claims"), threshold)


def graded(value: Column, threshold: float = 0.5) -> Column:
    """A verdict of 0, 0.5 or 1 (groundedness, response relevance); other values are a problem."""
    return rag_result(value, F.when(value.isNull() | ~value.isin(0.0, 0.5, 1.0), "score outside 0, 0.5, 1"), threshold)


def _indexed(verdicts: Column, n: Column) -> Column:
    """A problem if verdicts (context_index, relevant) don't name each of n contexts exactly once."""
    at = F.array_sort(F.transform(verdicts, lambda v: v["context_index"]))
    wanted = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.when(n <= 0, "no contexts").when(~at.eqNullSafe(wanted), "verdicts don't match contexts")


def context_relevance(verdicts: Column, n: Column, threshold: float = 0.5) -> Column:
    return rag_result(share_true(F.transform(verdicts, lambda v: v["relevant"])), _indexed(verdicts, n), threshold)


def context_precision(verdicts: Column, n: Column, threshold: float = 0.5) -> Column:
    """Average precision over contexts in their order."""
    ordered = F.transform(F.array_sort(F.transform(verdicts, lambda v: F.struct(v["context_index"].alias("i"), v["relevant"].alias("r")))), lambda v: v["r"])
    return rag_result(average_precision(ordered), _indexed(verdicts, n), threshold)


def judge_average(scores: Column) -> Column:
    """Mean of the judges' scores that aren't null, to two places half even; null if all failed."""
    good = F.filter(scores, lambda s: s.isNotNull())
    return F.bround(F.try_divide(F.aggregate(good, F.lit(0.0), lambda a, s: a + s), F.size(good)), 2)


def close(a: Column, b: Column, tolerance: float = 1e-6) -> Column:
    return F.abs(a - b) <= F.greatest(tolerance * F.greatest(F.abs(a), F.abs(b)), F.lit(tolerance))


def numeric_match(expected: Column, answer: Column, tolerance: float = 1e-6) -> Column:
    """Whether the answer's last number is close to any number of the expected text."""
    got = F.try_element_at(lang.numbers(answer), F.lit(-1))
    return F.coalesce(F.exists(lang.numbers(expected), lambda e: close(e, got, tolerance)), F.lit(False))


def exact_match(expected: Column, answer: Column) -> Column:
    """Whether normalized texts are equal, or the answer has the expected text as a token."""
    return F.coalesce((expected != "") & ((answer == expected) | lang.has_token(answer, expected)), F.lit(False))


def option_match(expected: Column, answer: Column) -> Column:
    """Whether the first option letter of an answer is the expected one (normalized, lower case)."""
    first = F.regexp_extract(answer, r"(?<![\p{L}\p{N}_])\(?([a-h])\)?(?![\p{L}\p{N}_'])", 1)
    return F.coalesce((expected != "") & ((answer == expected) | (first == expected)), F.lit(False))


def draft_issues(d: Column, subcategory: Column, policy: Column, source: Column, max_context: int = 4000) -> Column:
    """Reason codes against a drafted question (struct of the draft's fields), empty if it can be used."""
    inline, blank = policy == "inline_excerpt", F.coalesce(d["visible_context"], F.lit("")) == ""
    no_evidence = F.coalesce(F.size(d["evidence"]), F.lit(0)) <= 0
    found = F.exists(d["evidence"], lambda e: (F.trim(e) != "") & F.lower(source).contains(F.lower(e)))
    fits = {"exact": ("exact", "rubric"), "multiple_choice": ("multiple_choice",), "numeric": ("numeric",), "symbolic": ("symbolic",), "source_grounded": ("source_grounded",), "rubric": ("rubric",)}
    fit = F.lit(False)
    for kind, tests in fits.items():
        fit = fit | ((d["answer_type"] == kind) & d["verifier"].isin(*tests))
    followup = policy == "conversation_grounded"
    return F.array_compact(
        F.array(
            F.when(F.coalesce(d["question"], F.lit("")) == "", "empty_text"),
            F.when(~d["subcategory"].eqNullSafe(subcategory), "subcategory_mismatch"),
            F.when(F.length(d["visible_context"]) > max_context, "visible_context_too_long"),
            F.when(inline & blank, "missing_visible_context"),
            F.when((inline | (d["answer_type"] == "source_grounded")) & no_evidence, "missing_source_evidence"),
            F.when(inline & ~no_evidence & ~found, "evidence_not_found_in_source"),
            F.when(~inline & ~blank, "unexpected_visible_context"),
            F.when(followup & d["standalone"], "followup_incorrectly_marked_standalone"),
            F.when(~followup & ~d["standalone"], "initial_question_not_standalone"),
            F.when(~fit, "answer_type_verifier_mismatch"),
            F.when(d["answer_type"].isin("exact", "multiple_choice", "numeric", "symbolic") & (F.coalesce(d["reference_answer"], F.lit("")) == ""), "missing_reference_answer"),
        )
    )


def turn_passed(score: Column, grounding: Column, sufficiency: Column, issues: Column, threshold: float = 0.5) -> Column:
    """(passed, reasons): judge gates (at least 2 each), the score's threshold and earlier issues."""
    more = F.array_compact(F.array(F.when(grounding < 2, "weak_grounding"), F.when(sufficiency < 2, "weak_sufficiency"), F.when(score < threshold, "low_score")))
    reasons = F.concat(issues, more)
    return F.struct((F.size(reasons) == 0).alias("passed"), reasons.alias("reasons"))


def conversation_passed(scores: Column, questions: Column, accepted: Column) -> Column:
    """(score, passed): the least turn score (0 on none); all turns accepted and no question twice."""
    least = F.coalesce(F.array_min(scores), F.lit(0.0))
    twice = F.size(F.array_distinct(questions)) != F.size(questions)
    return F.struct(least.alias("score"), (F.forall(accepted, lambda a: a) & (F.size(accepted) > 0) & ~twice).alias("passed"))


_OPS = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv, ast.USub: operator.neg, ast.UAdd: operator.pos}


def arithmetic(text: str) -> float | None:
    """Value of a plain arithmetic expression, with simple LaTeX; null for all else. Parsed, never executed."""
    t = text.strip().strip("$").replace("\\left", "").replace("\\right", "").replace("\\cdot", "*").replace("\\times", "*").replace(",", "").replace("^", "**").replace("\\%", "/100").replace("%", "/100")
    import re

    t = re.sub(r"\\d?frac\{([^{}]*)\}\{([^{}]*)\}", r"((\1)/(\2))", t).replace("\\pi", "3.141592653589793")
    t = re.sub(r"\\sqrt\{([^{}]*)\}", r"((\1)**0.5)", t)
    if len(t) > 200:
        return None

    def value(n) -> float:
        if isinstance(n, ast.Constant) and isinstance(n.value, (int, float)) and not isinstance(n.value, bool):
            return float(n.value)
        if isinstance(n, ast.UnaryOp) and type(n.op) in _OPS:
            return _OPS[type(n.op)](value(n.operand))
        if isinstance(n, ast.BinOp):
            a, b = value(n.left), value(n.right)
            if isinstance(n.op, ast.Pow) and abs(b) <= 64 and abs(a) <= 1e6 and (a >= 0 or b == int(b)):
                return a**b
            if type(n.op) in _OPS:
                return _OPS[type(n.op)](a, b)
        raise ValueError

    try:
        return float(value(ast.parse(t, mode="eval").body))
    except (ValueError, SyntaxError, ZeroDivisionError, OverflowError, TypeError, RecursionError, MemoryError):
        return None


@pandas_column("boolean")
def math_match(expected: pd.Series, candidate: pd.Series) -> pd.Series:
    """Whether two mathematical answers are equal to one in a million, or else as text without spaces and case."""

    def one(a: str | None, b: str | None) -> bool | None:
        if a is None or b is None:
            return None
        x, y = arithmetic(a), arithmetic(b)
        if x is not None and y is not None:
            return abs(x - y) <= 1e-6 * max(1.0, abs(x), abs(y))
        return "".join(a.split()).strip("$").lower() == "".join(b.split()).strip("$").lower()

    return pd.Series([one(a, b) for a, b in zip(expected, candidate)], dtype="boolean")
