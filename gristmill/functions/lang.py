"""Language gates, protected spans, similarity and translation scores."""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.udf import pandas_column

DEVANAGARI = r"[ऀ-ॿ]"


@dataclass(frozen=True)
class Language:
    """Checks of one target language and script."""

    code: str
    script: str | None = None
    least_share: float = 0.45
    forbidden: str | None = None
    markers: frozenset[str] = field(default_factory=frozenset)
    least_markers: int = 2


# Frequent words of romanized text.
ROMANIZED = frozenset({
    "chha", "chhan", "cha", "ho", "huncha", "garchha", "garna", "ko", "ka", "ki", "le", "lai", "ma", "ra", "bhaneko", "bhane", "yo",
    "tyo", "kina", "kasari", "nepal", "nepali", "uttar", "prashna",
})
LANGUAGES = {x.code: x for x in (Language("en"), Language("ne-Deva", DEVANAGARI), Language("ne-Latn", forbidden=DEVANAGARI, markers=ROMANIZED))}


def language(code: str, extra: dict[str, Language] | None = None) -> Language:
    known = LANGUAGES | (extra or {})
    if code not in known:
        raise ValueError(f"unknown language {code!r}; known: {', '.join(sorted(known))}")
    return known[code]


def language_issue(x: Column, spec: Language) -> Column:
    """The first check that a text fails, null if none: empty, forbidden script, too little of the script, too few markers."""
    out = F.when(F.trim(F.regexp_replace(x, r"(?U)\s+", " ")) == "", "empty_text")
    if spec.forbidden:
        out = F.coalesce(out, F.when(x.rlike(spec.forbidden), f"forbidden_script:{spec.code}"))
    if spec.script:
        share = F.regexp_count(x, F.lit(spec.script)) / F.greatest(F.lit(1), F.regexp_count(x, F.lit(r"\p{L}")))
        few = lambda v: F.when(v < spec.least_share, F.concat(F.lit(f"insufficient_script_ratio:{spec.code}:"), F.format_string("%.3f", v)))
        out = F.coalesce(out, _once(share, few))
    if spec.markers:
        words = F.array_distinct(F.regexp_extract_all(F.lower(x), F.lit(r"(\p{L}+)"), 1))
        hits = F.size(F.array_intersect(words, F.array(*map(F.lit, sorted(spec.markers)))))
        few = lambda v: F.when(v < spec.least_markers, F.concat(F.lit(f"insufficient_marker_words:{spec.code}:"), v.cast("string")))
        out = F.coalesce(out, _once(hits, few))
    return out


def _once(x: Column, use) -> Column:
    """use(x) with x computed once: a name inside a lambda isn't replaced by its expression."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def script_share(x: Column, script: str) -> Column:
    """Letters of a script among all letters, by the end of its name (Deva, Latn); 0 without letters, null for other names."""
    kind = {"deva": r"\p{IsDevanagari}", "latn": r"\p{IsLatin}"}.get(script.casefold()[-4:])
    if kind is None:
        return F.lit(None).cast("double")
    letters = F.regexp_count(x, F.lit(r"\p{L}"))
    return F.when(letters == 0, 0.0).otherwise(F.regexp_count(x, F.lit(f"(?=\\p{{L}}){kind}")) / F.when(letters > 0, letters))


def has_devanagari(x: Column) -> Column:
    return x.rlike(DEVANAGARI)


# What a translation has to keep as it is.
PROTECTED = (
    r"```[^\n]*\n.*?```|`[^`\n]+`|\\\[.*?\\\]|\\\(.*?\\\)|\$\$.*?\$\$|(?<!\\)\$[^$\n]+(?<!\\)\$|https?://[^\s<>]+|www\.[^\s<>]+"
    r"|[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}|</?[A-Za-z][^>]*>|(?<![\w])[-+]?\d+(?:[.,:/-]\d+)*(?:%|°[CF]?|[A-Za-z]{1,4})?"
)
_PROTECTED = re.compile(PROTECTED, re.S)
_SPANS = "(?sU)" + PROTECTED


def protected_spans(x: Column) -> Column:
    """Code, mathematics, links, addresses, tags and numbers with units, in order."""
    return F.regexp_extract_all(x, F.lit(_SPANS), 0)


@pandas_column("double")
def protected_score(source: pd.Series, target: pd.Series) -> pd.Series:
    """Share of the source's protected spans that the target keeps, as bags; 1 without any."""

    def one(a: str | None, b: str | None) -> float:
        want, got = (Counter(_PROTECTED.findall(t or "")) for t in (a, b))
        return sum((want & got).values()) / sum(want.values()) if want else 1.0

    return pd.Series([one(a, b) for a, b in zip(source, target)], dtype=float)


@pandas_column("double")
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-block ratio of case-folded texts with single spaces. Not symmetric; null if either is."""
    fold = lambda t: " ".join(t.casefold().split())
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, fold(x), fold(y)).ratio() for x, y in zip(a, b)], dtype="float64")


MESSAGES = "array<struct<from:string,value:string>>"


@pandas_column("double")
def kept_share(want: pd.Series, got: pd.Series) -> pd.Series:
    """Share of an array's values that another has too, as bags; 1 without any."""

    def one(a, b) -> float:
        wanted, there = (Counter(() if x is None else x) for x in (a, b))
        return (wanted & there).total() / wanted.total() if wanted else 1.0

    return pd.Series([one(a, b) for a, b in zip(want, got)], dtype=float)


@pandas_column("double")
def mean_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Mean of similarity() over two arrays of texts, place by place; 0 without any, null texts are empty."""
    fold = lambda t: " ".join((t or "").casefold().split())
    ratios = [[SequenceMatcher(None, fold(x), fold(y)).ratio() for x, y in zip(p, q)] if p is not None and q is not None else [] for p, q in zip(a, b)]
    return pd.Series([sum(r) / len(r) if r else 0.0 for r in ratios], dtype=float)


def translation(source: Column | str, target: Column | str, reference: Column | str) -> Column:
    """Scores of translated conversations (arrays of from, value): structure, nonempty, script, protected and reference (null
    without one), and score, their weighted sum with caps for broken ones.

    Null conversations have no messages, and null values are empty texts.
    """
    none = F.array().cast(MESSAGES)
    s, t = (F.coalesce(F.col(x) if isinstance(x, str) else x, none) for x in (source, target))
    ref = F.col(reference) if isinstance(reference, str) else reference
    shared, longest = F.least(F.size(s), F.size(t)), F.greatest(F.size(s), F.size(t), F.lit(1))
    head = lambda x: F.slice(x, 1, shared)
    count = lambda flags: F.size(F.filter(flags, lambda x: x))
    values = lambda x: F.transform(x, lambda m: F.coalesce(m["value"], F.lit("")))
    share = lambda n, of, otherwise: F.when(of > 0, n / F.when(of > 0, of)).otherwise(otherwise)

    same_roles = count(F.zip_with(head(s), head(t), lambda a, b: a["from"].eqNullSafe(b["from"])))
    structure = F.when(F.size(s) > 0, (shared / longest + same_roles / longest) / 2).otherwise(0.0)
    filled = share(count(F.transform(values(t), lambda v: F.trim(v) != "")), F.size(t), 0.0)

    def script(a: Column, b: Column) -> Column:
        before, after = (F.regexp_replace(F.coalesce(m["value"], F.lit("")), _SPANS, " ") for m in (a, b))

        def of(x: Column) -> Column:
            native, latin = F.regexp_count(x["after"], F.lit(DEVANAGARI)), F.regexp_count(x["after"], F.lit("[A-Za-z]"))
            copied = F.lower(F.trim(x["before"])) == F.lower(F.trim(x["after"]))
            return F.when(F.regexp_count(x["before"], F.lit("[A-Za-z]")) >= 4, F.when(copied, 0.0).otherwise(share(native, native + latin, 0.0)))

        return F.when(~a["from"].eqNullSafe(F.lit("tool")), _once(F.struct(before.alias("before"), after.alias("after")), of))

    shares = F.filter(F.zip_with(head(s), head(t), script), lambda x: x.isNotNull())
    in_script = _once(shares, lambda x: share(F.aggregate(x, F.lit(0.0), lambda a, v: a + v), F.size(x), 1.0))
    spans = lambda x: F.flatten(F.transform(values(x), protected_spans))
    protected = kept_share(spans(s), spans(t))
    roles = lambda x: F.transform(x, lambda m: m["from"])
    near = F.when(ref.isNotNull(), F.when(roles(ref).eqNullSafe(roles(t)), mean_similarity(values(t), values(F.coalesce(ref, none)))).otherwise(0.0))

    def scored(x: Column) -> Column:
        # The weights of the parts without and with a reference, and the caps.
        text = F.when(x["reference"].isNull(), 0.55 * x["script"] + 0.25 * x["protected"]).otherwise(0.25 * x["script"] + 0.20 * x["protected"] + 0.35 * x["reference"])
        score = 0.05 + 0.10 * x["structure"] + 0.05 * x["nonempty"] + text
        score = F.when((x["structure"] < 1) | (x["nonempty"] < 1), F.least(score, F.lit(0.49))).when(x["protected"] < 1, F.least(score, F.lit(0.79))).otherwise(score)
        return F.struct(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)).alias("score"), *(x[n].alias(n) for n in names))

    names = ("structure", "nonempty", "script", "protected", "reference")
    return _once(F.struct(*(c.alias(n) for c, n in zip((structure, filled, in_script, protected, near), names))), scored)


def translation_reward(score: Column, structure: Column, reference: Column, judge: Column) -> Column:
    """The final reward: nothing for a broken structure, else the least of the scores there are; no judge where one is due gives 0."""
    return F.when(structure < 1, 0.0).otherwise(F.coalesce(F.least(score, reference, judge), F.lit(0.0)))


# What a request keeps, and what makes an argument look like code.
CODE_LIKE = r"(?U)\d|[_@/\\]|\w[-.]\w|(?<=\w)[A-Z]|^[A-Z]{2,}"
_LINKS = r"(?U)https?://[^\s<>]+|www\.[^\s<>]+|[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}"


def links(x: Column) -> Column:
    """Links and mail addresses of a text, without signs at their ends."""
    return F.transform(F.regexp_extract_all(x, F.lit(_LINKS), 0), lambda t: F.regexp_replace(F.trim(t), r"""[.,;:!?)\]}"'`]+$""", ""))


def lost(want: Column, got: Column) -> Column:
    """Values that an array has more often than another, each once, in order."""
    often = lambda x, v: F.size(F.filter(x, lambda y: y == v))
    return F.array_sort(F.filter(F.array_distinct(want), lambda v: often(want, v) > often(got, v)))


@pandas_column("array<string>")
def leaves(x: pd.Series) -> pd.Series:
    """Strings and numbers at the leaves of JSON text, numbers as text (whole ones without a fraction); none if it doesn't parse."""

    def walk(v) -> list[str]:
        if isinstance(v, dict):
            v = list(v.values())
        if isinstance(v, list):
            return [t for w in v for t in walk(w)]
        if isinstance(v, float) and v.is_integer():
            v = int(v)
        return [str(v)] if isinstance(v, (str, int, float)) and not isinstance(v, bool) else []

    def one(t: str | None) -> list[str]:
        try:
            return walk(json.loads(t or "null"))
        except ValueError:
            return []

    return x.map(one)


def literals(arguments: Column, source: Column, code: str | None = None, least: int = 2) -> Column:
    """Argument values that a text spells out, in order: with a word character, of at least so many characters unless digits.
    With code (a pattern), only values in which it is found and single capitalized words."""
    found = F.filter(F.transform(leaves(arguments), F.trim), lambda v: v.rlike(r"(?U)\w") & ((F.length(v) >= least) | v.rlike(r"(?U)^\d+$")))
    if code is not None:
        found = F.filter(found, lambda v: v.rlike(code) | v.rlike("^[A-Z][a-z]+$"))
    return F.array_distinct(F.filter(found, lambda v: F.lower(source).contains(F.lower(v))))


def localization_issues(source: Column, localized: Column, arguments: Column, spec: Language, code: str = CODE_LIKE) -> Column:
    """Why a localized request is refused, an empty array if it isn't: empty, unchanged, not in the language (values and links
    left out), links lost, or argument values lost. arguments is JSON text of all expected arguments."""
    t = F.trim(F.coalesce(localized, F.lit("")))
    bare = F.aggregate(F.sort_array(F.transform(literals(arguments, source), lambda v: F.struct(F.length(v).alias("n"), v.alias("v"))), False), t, lambda a, x: F.regexp_replace(a, F.concat(F.lit(r"(?i)\Q"), x["v"], F.lit(r"\E")), F.lit(" ")))
    bare = F.regexp_replace(bare, _LINKS, " ")
    prose = F.when(F.trim(bare) != "", bare).otherwise(t)
    gone = F.filter(literals(arguments, source, code), lambda v: ~F.lower(t).contains(F.lower(v)))
    named = lambda p, x: F.transform(x, lambda v: F.concat(F.lit(p), v))
    more = F.concat(F.array_compact(F.array(language_issue(prose, spec))), named("missing_protected_token:", lost(links(source), links(t))), named("missing_argument_literal:", gone))
    return F.when(t == "", F.array(F.lit("empty_localization"))).when(F.lower(t) == F.lower(F.trim(source)), F.array(F.lit("not_localized"))).otherwise(more)


def has_token(x: Column, needle: Column) -> Column:
    """Whether needle stands in x with no word character on either side."""
    word = r"[\p{L}\p{N}_]"
    pattern = F.concat(F.lit(rf"(?<!{word})\Q"), needle, F.lit(rf"\E(?!{word})"))
    return (F.coalesce(needle, F.lit("")) != "") & F.regexp(x, pattern)


def numbers(x: Column) -> Column:
    """Numbers of a text as doubles, those in boxed expressions only if there are any; either script's digits, commas dropped."""
    t = F.translate(x, "०१२३४५६७८९", "0123456789")
    boxed = F.array_join(F.regexp_extract_all(t, F.lit(r"\\boxed\{([^{}]*)\}"), 1), " ")
    found = F.regexp_extract_all(F.when(boxed != "", boxed).otherwise(t), F.lit(r"([-+]?\d[\d,]*(?:\.\d+)?(?:[eE][-+]?\d+)?)"), 1)
    return F.transform(found, lambda n: F.replace(n, F.lit(","), F.lit("")).try_cast("double"))


@pandas_column("string")
def nfc_fold(x: pd.Series) -> pd.Series:
    return x.map(lambda t: unicodedata.normalize("NFC", t).casefold(), na_action="ignore")


def english_heavy(terms: Column) -> Column:
    """Terms with Latin letters."""
    return F.filter(terms, lambda t: t.rlike("[A-Za-z]{2,}"))


def tidy_spacing(x: Column) -> Column:
    """Single spaces, none before closing or after opening punctuation."""
    for p, r in ((r"[ \t]+", " "), (r" +([,.;:!?)\]}।])", "$1"), (r"([(\[{]) +", "$1"), (r" *\n *", "\n")):
        x = F.regexp_replace(x, p, r)
    return F.trim(x)
