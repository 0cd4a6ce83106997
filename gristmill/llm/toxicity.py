"""Toxicity from a weighted lexicon, matched by Aho-Corasick in folded texts.

Folding lower-cases, maps lookalike letters to Latin ones and reads digits and signs inside words as the letters they
stand for. The lexicon holds words and word beginnings with the log odds of toxic documents, learned from a bounded
sample of labelled documents; each toxic document votes for the few terms that explain it best, so what else copies
share isn't learned. Matches inside an exception phrase don't count. The sum of weights and the length go through a
logistic curve fitted on the same sample, which sets how much length takes off.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import fold, map_rows, texts
from gristmill.session import cut, ready_for_python

HELD_PARTS, HELD, CUT = 5, 0, 0.5
#: Documents of each label that the lexicon and the curve are fitted on, those with the smallest hashes of their ids.
SAMPLE = 10_000
MIN_SUPPORT, MIN_ODDS, VOTES, LEXICON, PREFIXES = 3, 2.5, 3, 50_000, (5, 6)
# Lookalike letters (Cyrillic, Greek, full width by rule) and the letters that digits and signs stand for.
LOOKALIKES = dict(zip("аеорсухіјѕһԁԛԝкмнтвгαεοριυκντχ", "aeopcyxijshdqwkmhtbraeopiukvtx")) | {chr(0xFF41 + i): chr(97 + i) for i in range(26)} | {chr(0xFF21 + i): chr(97 + i) for i in range(26)}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}
EXCEPTIONS = ("trash can", "trash cans", "trash bin", "trash bins", "trash bag", "trash bags", "clown fish", "pond scum")
_FOLD = {ord(k): v for k, v in LOOKALIKES.items()} | {0x200B: "", 0x200C: "", 0x200D: "", 0xAD: ""}
_MIXED = re.compile(r"[^\W\d_][0-9@$!|]\w|[0-9@$!|][^\W\d_]|[^\W\d_][0-9@$]")
_SIGNS = str.maketrans(SUBSTITUTES)
_LETTER_L = str.maketrans(SUBSTITUTES | {"1": "l", "!": "l", "|": "l"})
_BREAKS = re.compile(r"[\W\d_]+")
#: Of Latin-1 bytes: letters as they are, all else a space.
_LATIN = bytes(c if chr(c).isalpha() else 32 for c in range(256))


def folded(text: str) -> str:
    """Words of letters, between single spaces, with a space at both ends; words with substitutes also read as with l for 1."""
    low = text.lower()
    raw = _latin(low)
    if raw is None:
        low = low.translate(_FOLD)
        raw = _latin(low)
    if any(c in low for c in SUBSTITUTES) and _MIXED.search(low):
        low = " ".join(_plain(w) if _MIXED.search(w) else w for w in low.split())
        raw = _latin(low)
    if raw is None:
        return f" {_BREAKS.sub(' ', low).strip()} "
    return f" {b' '.join(raw.translate(_LATIN, b'\xad').split()).decode('latin-1')} "


def _latin(text: str) -> bytes | None:
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        return None


def _plain(word: str) -> str:
    word = word.rstrip("!.,;:?)")
    a, b = word.translate(_SIGNS), word.translate(_LETTER_L)
    return a if a == b else f"{a} {b}"


def terms(words: list[str]) -> set[str]:
    """What may be learned from a text: ' word ' and ' beginning'."""
    out = {f" {w} " for w in words if len(w) > 2}
    for n in PREFIXES:
        out |= {f" {w[:n]}" for w in words if len(w) > n}
    return out


class Lexicon:
    """Weighted terms with exception phrases, and the curve from their sum and the length to a score."""

    def __init__(self, weights: dict[str, float], curve: tuple[float, float, float] = (-3.0, 3.0, -0.2), exceptions: tuple[str, ...] = EXCEPTIONS, default: float = 0.0):
        self.weights, self.curve, self.exceptions, self.default = weights, curve, exceptions, default

    def __reduce__(self):
        return Lexicon, (self.weights, self.curve, self.exceptions, self.default)

    def matcher(self) -> ahocorasick.Automaton:
        auto = ahocorasick.Automaton()
        for term, w in self.weights.items():
            auto.add_word(term, (len(term), w))
        for phrase in self.exceptions:
            auto.add_word(f" {phrase} ", (len(phrase) + 2, None))
        if len(auto):
            auto.make_automaton()
        return auto

    def total(self, text: str, auto: ahocorasick.Automaton) -> tuple[float, int]:
        """Summed weights, the strongest term of each word counting, and the number of words."""
        t = folded(text)
        found: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        if len(auto):
            for end, (n, w) in auto.iter(t):
                at = end - n + 1
                if w is None:
                    spared.append((at, end))
                else:
                    found[at] = max(w, found.get(at, w))
        starts, ends, up = [a for a, _ in sorted(spared)], [], -1
        for _, b in sorted(spared):
            up = max(up, b)
            ends.append(up)
        free = lambda at: not spared or (k := bisect_right(starts, at) - 1) < 0 or ends[k] <= at
        return sum(w for at, w in found.items() if free(at)), t.count(" ") - 1

    def scores(self, sums: np.ndarray) -> np.ndarray:
        """Scores of (summed weights, words) rows."""
        if not self.weights:
            return np.full(len(sums), self.default)
        a, b, c = self.curve
        z = a + b * np.log1p(sums[:, 0]) + c * np.log1p(sums[:, 1])
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        return np.where(sums[:, 0] > 0, p, np.minimum(p, self.default))


def _sample(labels: DataFrame, id_col: str, label_col: str, size: int) -> DataFrame:
    """(doc_id, y): at most size training documents of each label, by hash of the id."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).filter("y IN (0, 1) AND doc_id IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.max("y").alias("y")).filter(~fold(F.col("doc_id"), HELD_PARTS, HELD))
    some = [known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size) for y in (0, 1)]
    return cut(some[0].unionByName(some[1]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Lexicon:
    """A lexicon and curve from at most sample documents of each label. Without both labels it has no terms."""
    chosen = _sample(labels, id_col, label_col, sample)
    own = cut(texts(docs, id_col, text_col, binary=False).join(F.broadcast(chosen), "doc_id"))
    sizes = {r["y"]: r["n"] for r in own.groupBy("y").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return Lexicon({}, default=0.5)
    ready_for_python(docs.sparkSession)

    def counted(batches):
        import pyarrow as pa

        hits: tuple[Counter, Counter] = (Counter(), Counter())
        for b in batches:
            for t, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist()):
                hits[y].update(terms(folded(t).split()))
        both = list(set(hits[0]) | set(hits[1]))
        yield pa.RecordBatch.from_arrays([pa.array(both, pa.string()), pa.array([hits[1][x] for x in both], pa.int64()), pa.array([hits[0][x] for x in both], pa.int64())], ["term", "bad", "good"])

    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    table = own.select("text", "y").mapInArrow(counted, "term string, bad long, good long").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    likely = table.withColumn("w", odds).filter((F.col("bad") >= MIN_SUPPORT) & (F.col("w") >= MIN_ODDS)).orderBy(F.desc(F.col("bad") * F.col("w")), "term").limit(LEXICON).collect()
    worth, weights = {r["term"]: r["bad"] * r["w"] for r in likely}, {r["term"]: float(r["w"]) for r in likely}

    def votes(c: list) -> tuple:
        best = [sorted((x for x in terms(folded(t).split()) if x in worth), key=lambda x: (-worth[x], x))[:VOTES] for t in c[0]]
        return (best,)

    voted = map_rows(own.filter("y = 1").select("text"), lambda: votes, "best array<string>")
    tally = {r["term"]: r["n"] for r in voted.select(F.explode("best").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()}
    lexicon = Lexicon({t: w for t, w in weights.items() if tally.get(t, 0) >= MIN_SUPPORT})

    def summed():
        auto = lexicon.matcher()
        return lambda c: (*map(list, zip(*(lexicon.total(t, auto) for t in c[0]))), c[1])

    rows = np.array([(r["total"], r["words"], r["y"]) for r in map_rows(own.select("text", "y"), summed, "total double, words long, y int").toLocalIterator()], float)
    lexicon.curve = _logistic(np.log1p(rows[:, :2]), rows[:, 2])
    none = rows[rows[:, 0] == 0]
    lexicon.default = min(0.49, float((none[:, 2].sum() + 0.5) / (len(none) + 1))) if len(none) else 0.01
    return lexicon


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, float, float]:
    """Logistic regression by Newton's steps."""
    x, w = np.hstack([np.ones((len(x), 1)), x]), np.zeros(x.shape[1] + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1]), float(w[2])


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Null and empty texts have no words and get the score of texts without matches, 0.5 if nothing could be learned. Null
    ids are never held out and have no label. Repeated rows are repeated; an empty table gives no rows; extra columns are
    ignored.
    """
    lexicon = fit(docs, labels, id_col, text_col)

    def scorer():
        auto = lexicon.matcher()
        return lambda c: (c[0], lexicon.scores(np.array([lexicon.total(t, auto) for t in c[1]], float)))

    scored = map_rows(texts(docs, id_col, text_col, binary=False), scorer, "doc_id long, score double")
    return scored.select("doc_id", fold(F.col("doc_id"), HELD_PARTS, HELD).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
