"""Instruction constraints as boolean columns. A missing parameter passes; parameters are columns or Python values."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.text import WS
from gristmill.functions.udf import pandas_column


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.array(*map(F.lit, x)) if isinstance(x, (list, tuple)) else F.lit(x)


def _given(test: Column, *params) -> Column:
    """test, or true where a parameter is missing."""
    missing = F.lit(False)
    for p in params:
        missing = missing | _col(p).isNull()
    return F.when(missing, True).otherwise(test)


def _strip(t: Column) -> Column:
    return F.regexp_replace(t, r"(?U)^\s+|\s+$", "")


def _compare(n: Column, target, quantifier) -> Column:
    n, target, q = n.cast("long"), _col(target).cast("long"), _col(quantifier).cast("string")
    return F.when(q == "at least", n >= target).when(q == "at most", n <= target).otherwise(n == target)


def _occurrences(t: Column, part: Column) -> Column:
    """Occurrences of a substring that don't overlap, ignoring case."""
    t, part = F.lower(t), F.lower(part)
    return F.when(part == "", F.length(t) + 1).otherwise(((F.length(t) - F.length(F.replace(t, part, F.lit("")))) / F.length(part)).cast("long"))


def _parts(t: Column, splitter: str) -> Column:
    return F.size(F.filter(F.split(t, splitter), lambda p: _strip(p) != ""))


def _words(t: Column) -> Column:
    return F.filter(F.split(t, WS), lambda w: w != "")


@pandas_column("boolean")
def _is_json(x: pd.Series) -> pd.Series:
    def ok(t: str) -> bool:
        s = t.strip()
        for fence in ("```json", "```"):
            if s.startswith(fence) and s.endswith("```"):
                s = s[len(fence) : -3].strip()
                break
        try:
            json.loads(s)
        except ValueError:
            return False
        return True

    return x.map(ok, na_action="ignore").astype("boolean")


def lowercase(t: Column, **_) -> Column:
    return ~t.rlike(r"\p{Lu}")


def no_commas(t: Column, **_) -> Column:
    return ~t.contains(",")


def quotation(t: Column, **_) -> Column:
    return _strip(t).startswith('"') & _strip(t).endswith('"')


def paragraph_count(t: Column, N=None, **_) -> Column:
    return _given(_parts(t, r"\*\*\*") == _col(N).cast("int"), N)


def paragraphs(t: Column, N=None, **_) -> Column:
    return _given(_parts(t, "\n\n") == _col(N).cast("int"), N)


def highlighted_sections(t: Column, N=None, **_) -> Column:
    return _given(F.regexp_count(t, F.lit(r"\*([^*]+)\*")) >= _col(N).cast("int"), N)


def keyword_frequency(t: Column, keyword_list=None, word=None, N=None, **_) -> Column:
    keys = F.coalesce(F.when(F.size(_col(keyword_list).cast("array<string>")) > 0, _col(keyword_list).cast("array<string>")), F.when(F.coalesce(_col(word), F.lit("")) != "", F.array(_col(word).cast("string"))), F.array().cast("array<string>"))
    return _given(F.forall(keys, lambda k: _occurrences(t, k) == _col(N).cast("long")), N)


def letter_frequency(t: Column, letter=None, N=None, quantifier=None, **_) -> Column:
    return F.when(F.coalesce(_col(letter).cast("string"), F.lit("")) == "", True).otherwise(_given(_compare(_occurrences(t, _col(letter).cast("string")), N, quantifier), N))


def frequency_capital_words(t: Column, N=None, quantifier=None, **_) -> Column:
    capital = F.filter(_words(t), lambda w: w.rlike(r"^\p{L}+$") & w.rlike(r"\p{Lu}") & ~w.rlike(r"[\p{Ll}\p{Lt}]"))
    return _given(_compare(F.size(capital), N, quantifier), N)


def json_format(t: Column, **_) -> Column:
    return _is_json(t)


def repeat_prompt(t: Column, original_prompt=None, **_) -> Column:
    p = F.coalesce(_col(original_prompt).cast("string"), F.lit(""))
    return F.when(p == "", True).otherwise(_strip(t).startswith(_strip(p)))


def postscript(t: Column, postscript_marker=None, **_) -> Column:
    m, lines = F.coalesce(_col(postscript_marker).cast("string"), F.lit("")), F.split(_strip(t), "\n")
    last = F.slice(lines, F.greatest(F.size(lines) - 2, F.lit(1)), F.lit(3))
    return F.when(m == "", True).otherwise(F.exists(last, lambda x: _strip(x).startswith(m)))


def forbidden_words(t: Column, forbidden_words=None, **_) -> Column:
    w = _col(forbidden_words).cast("array<string>")
    return _given(~F.exists(w, lambda x: F.lower(t).contains(F.lower(x))), w)


def end_checker(t: Column, end_phrase=None, **_) -> Column:
    p = F.coalesce(_col(end_phrase).cast("string"), F.lit(""))
    return F.when(p == "", True).otherwise(_strip(t).endswith(p))


def word_constraint(t: Column, word=None, **_) -> Column:
    w = F.coalesce(_col(word).cast("string"), F.lit(""))
    return F.when(w == "", True).otherwise(F.lower(t).contains(F.lower(w)))


def number_of_words(t: Column, N=None, quantifier=None, **_) -> Column:
    return _given(_compare(F.size(_words(t)), N, quantifier), N)


def sections(t: Column, N=None, section_splitter=None, **_) -> Column:
    s = F.coalesce(F.nullif(_col(section_splitter).cast("string"), F.lit("")), F.lit("\n\n"))
    parts = F.split(t, F.concat(F.lit(r"\Q"), s, F.lit(r"\E")))
    return _given(F.size(F.filter(parts, lambda p: _strip(p) != "")) == _col(N).cast("int"), N)


def choice(t: Column, options=None, **_) -> Column:
    o = _col(options).cast("array<string>")
    return F.when(F.coalesce(F.size(o), F.lit(0)) <= 0, True).otherwise(F.array_contains(o, _strip(t)))


def placeholders(t: Column, N=None, **_) -> Column:
    return _given(F.regexp_count(t, F.lit(r"\[([^\]]+)\]")) >= _col(N).cast("int"), N)


def title(t: Column, **_) -> Column:
    return F.exists(F.split(t, "\n"), lambda x: _strip(x).startswith("#"))


def two_responses(t: Column, **_) -> Column:
    numbered = t.rlike(r"(?i)1\.|Response 1") & t.rlike(r"(?i)2\.|Response 2")
    return numbered | t.contains("***") | t.contains("\n\n")


def bullet_points(t: Column, N=None, **_) -> Column:
    marked = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"(?U)^\s*[-*•]\s+"))
    return _given(F.size(marked) >= _col(N).cast("int"), N)


def keywords(t: Column, forbidden_words=None, **_) -> Column:
    w = _col(forbidden_words).cast("array<string>")
    return _given(F.forall(w, lambda x: F.lower(t).contains(F.lower(x))), w)


#: By the names that datasets give.
VALIDATORS: dict[str, Callable[..., Column]] = {
    "validate_lowercase": lowercase,
    "validate_no_capital_letters": lowercase,
    "validate_no_commas": no_commas,
    "validate_quotation": quotation,
    "verify_paragraph_count": paragraph_count,
    "validate_paragraphs": paragraphs,
    "validate_highlighted_sections": highlighted_sections,
    "verify_keyword_frequency": keyword_frequency,
    "verify_letter_frequency": letter_frequency,
    "validate_frequency_capital_words": frequency_capital_words,
    "validate_json_format": json_format,
    "validate_repeat_prompt": repeat_prompt,
    "validate_postscript": postscript,
    "validate_forbidden_words": forbidden_words,
    "validate_end_checker": end_checker,
    "validate_word_constraint": word_constraint,
    "validate_number_of_words": number_of_words,
    "validate_sections": sections,
    "validate_choice": choice,
    "validate_placeholders": placeholders,
    "validate_title": title,
    "validate_two_responses": two_responses,
    "verify_bullet_points": bullet_points,
    "verify_keywords": keywords,
}
#: Shape of a constraint as JSON text.
CONSTRAINT = "func_name string, N string, word string, keyword_list array<string>, letter string, quantifier string, forbidden_words array<string>, end_phrase string, options array<string>, original_prompt string, postscript_marker string, section_splitter string, first_word string"


def verified(text: Column, constraint: Column) -> Column:
    """Whether text meets a constraint (struct of CONSTRAINT): null without a name or for an unknown one."""
    names = [f.split()[0] for f in CONSTRAINT.split(", ") if not f.startswith("func_name")]
    params = {k: F.try_to_number(constraint[k], F.lit("999999999")).cast("long") if k == "N" else constraint[k] for k in names}
    out = None
    for name, test in VALIDATORS.items():
        is_it = constraint["func_name"] == name
        out = F.when(is_it, test(text, **params)) if out is None else out.when(is_it, test(text, **params))
    return out


def constraint_reward(text: Column, constraint: Column) -> Column:
    """1 for a constraint that is met; 0 if it isn't, can't be checked or there is no text."""
    return F.when(F.coalesce(text, F.lit("")) == "", 0.0).otherwise(F.when(F.coalesce(verified(text, constraint), F.lit(False)), 1.0).otherwise(0.0))
