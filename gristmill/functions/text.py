"""Text normalization, tokens, shingles, ids and splits as columns."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.udf import pandas_column

#: White space by Unicode, as a regular expression.
WS = r"(?U)\s+"


def squeeze(x: Column) -> Column:
    """Trimmed, with runs of white space as one space. Composition (NFC) is nfc()'s part."""
    return F.trim(F.regexp_replace(x, WS, " "))


@pandas_column("string")
def nfc(x: pd.Series) -> pd.Series:
    """Canonical composition; null stays null."""
    return x.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


@pandas_column("string")
def normalize_text(x: pd.Series) -> pd.Series:
    """Composed, trimmed, white space collapsed."""
    return x.map(lambda t: " ".join(unicodedata.normalize("NFC", t).split()), na_action="ignore")


@pandas_column("string")
def normalize_key(x: pd.Series) -> pd.Series:
    """normalize_text and case folding, for comparisons."""
    return x.map(lambda t: " ".join(unicodedata.normalize("NFC", t).split()).casefold(), na_action="ignore")


@pandas_column("string")
def normalize_answer(x: pd.Series) -> pd.Series:
    """Composed, nasal sign folded, joiners dropped, case folded, white space collapsed."""
    table = {0x0901: 0x0902, 0x200C: None, 0x200D: None}
    return x.map(lambda t: " ".join(unicodedata.normalize("NFC", t).translate(table).casefold().split()), na_action="ignore")


@pandas_column("string")
def normalize_message(x: pd.Series) -> pd.Series:
    """Composed, without byte order marks, with line feeds only, trimmed."""
    return x.map(lambda t: unicodedata.normalize("NFC", t).replace("﻿", "").replace("\r\n", "\n").replace("\r", "\n").strip(), na_action="ignore")


def tokens(x: Column) -> Column:
    """Lower-cased words without punctuation and symbols at their ends; empty ones dropped."""
    bare = F.transform(F.split(F.lower(x), WS), lambda w: F.regexp_replace(w, r"^[\p{P}\p{S}]+|[\p{P}\p{S}]+$", ""))
    return F.filter(bare, lambda w: w != "")


def shingles(words: Column, n: int = 5) -> Column:
    """Distinct runs of n words; all words as one run where there are fewer; none for none. words should be a stored column."""
    runs = F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))
    short = F.when(F.size(words) > 0, F.array(F.array_join(words, " "))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.when(F.size(words) >= n, runs).otherwise(short))


def stable_id(*parts: Column) -> Column:
    """First 24 hex digits of the SHA-256 of the parts in lines."""
    return F.substring(F.sha2(F.concat_ws("\n", *parts), 256), 1, 24)


def unit_interval(key: Column) -> Column:
    """The first 16 hex digits of SHA-256 as a share of their largest value."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(float(2**64 - 1))


def split_for(key: Column, train: float = 0.8, validation: float = 0.1) -> Column:
    """train, validation or test by hash of a group's key."""
    u = unit_interval(key)
    return F.when(u < train, "train").when(u < train + validation, "validation").otherwise("test")


def weighted_choice(key: Column, weights: dict[str, float]) -> Column:
    """A name by cumulative weight at the key's place in the unit interval; the last one past the end."""
    u, total, out, names = unit_interval(key) * sum(weights.values()), 0.0, None, list(weights)
    for name in names:
        total += weights[name]
        out = F.when(u <= total, name) if out is None else out.when(u <= total, name)
    return out.otherwise(names[-1])


def bucket_of(key: Column, names: list[str]) -> Column:
    """One of names by the first 8 digest hex digits of the key."""
    at = (F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long") % len(names)).cast("int")
    return F.element_at(F.array(*map(F.lit, names)), at + 1)


def slug(x: Column, longest: int = 60) -> Column:
    """Letters and digits of ASCII, all else as single underscores, trimmed and cut."""
    return F.substring(F.regexp_replace(F.regexp_replace(x, "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""), 1, longest)


def file_name(position: Column, title: Column) -> Column:
    """doc_NN_title.txt."""
    return F.concat(F.lit("doc_"), F.lpad(position.cast("string"), 2, "0"), F.lit("_"), slug(title), F.lit(".txt"))


def preview(x: Column, head: int = 100, tail: int = 50) -> Column:
    """Head and tail of long texts."""
    return F.when(F.length(x) <= head + tail, x).otherwise(F.concat(F.substring(x, 1, head), F.lit(" ... "), F.right(x, F.lit(tail))))


def pieces(x: Column, size: int = 10_000) -> Column:
    """A text in slices of size characters."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(x)), F.lit(size)), lambda i: F.substring(x, i, F.lit(size)))


def truncated(x: Column, lines: int = 500, chars: int = 8192) -> Column:
    """At most so many lines, then characters; a mark says what was left out."""
    split = F.split(x, "\n")
    by_line = F.when(F.size(split) > lines, F.concat(F.array_join(F.slice(split, 1, lines), "\n"), F.lit("\n... ["), F.size(split) - lines, F.lit(" more lines]"))).otherwise(x)
    return F.when(F.length(by_line) > chars, F.concat(F.substring(by_line, 1, chars), F.lit("\n... [truncated]"))).otherwise(by_line)


def matching_lines(x: Column, pattern: str, most: int = 20, width: int = 200) -> Column:
    """(line, text) of the first lines that match, ignoring case."""
    numbered = F.transform(F.split(x, "\n"), lambda t, i: F.struct((i + 1).alias("line"), F.substring(F.trim(t), 1, width).alias("text"), t.alias("whole")))
    return F.transform(F.slice(F.filter(numbered, lambda r: r["whole"].rlike(f"(?i){pattern}")), 1, most), lambda r: F.struct(r["line"].alias("line"), r["text"].alias("text")))


def front_matter(title: Column) -> Column:
    """Whether a title is front matter, a preface or chapter 0."""
    return F.coalesce(F.lower(title).rlike(r"frontmatter|front matter|preface|\bchapter\s*0\b"), F.lit(False))


def digits_latin(x: Column) -> Column:
    """Devanagari digits as ASCII ones."""
    return F.translate(x, "०१२३४५६७८९", "0123456789")


def document_date(x: Column) -> Column:
    """The first full date, else a marked year, else a lone year from 1800 to 2199; digits of either script."""
    t = digits_latin(x)
    year = r"(?:1[89]|20|21)[0-9]{2}"
    full = F.regexp_extract(t, rf"(?<![0-9])({year}[-/.][0-9]{{1,2}}[-/.][0-9]{{1,2}})(?![0-9])", 1)
    marked = F.regexp_extract(t, rf"(?i)(?:साल|वि\.सं\.|b\.s\.|a\.d\.)\s*({year})(?![0-9])|(?<![0-9])({year})\s*(?:साल|वि\.सं\.|b\.s\.|a\.d\.)", 1)
    lone = F.regexp_extract(t, rf"(?<![0-9])({year})(?![0-9])", 1)
    empty = lambda c: F.nullif(c, F.lit(""))
    return F.coalesce(empty(full), empty(marked), empty(lone))


def pdf_title(path: Column, position: Column) -> Column:
    """A path's last part without a query, decoded; else document-N.pdf."""
    name = F.url_decode(F.regexp_extract(path, r"([^/?#]+)(?:[?#].*)?$", 1))
    return F.coalesce(F.nullif(name, F.lit("")), F.concat(F.lit("document-"), position.cast("string"), F.lit(".pdf")))


def keyword_route(x: Column, routes: list[tuple[str, list[str]]], fallback: Column, width: int = 1200) -> Column:
    """The first route one of whose words occurs in the lower-cased head of a text."""
    t, out = F.lower(F.substring(x, 1, width)), None
    for name, words in routes:
        hit = F.lit(False)
        for w in words:
            hit = hit | t.contains(w)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(fallback)
