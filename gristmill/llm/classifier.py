"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

The features approximate a Gaussian kernel over the statistics of a text. Every task sums its part of the normal
equations, by fold of the training rows; the driver gets the summed matrices only, (FEATURES + 1) squared a fold. A row's
score for calibration comes from the equations without its own fold. Calibration pools adjacent violators over a
histogram of those scores, which is as small however many rows there are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import fold, map_rows, slices, texts
from gristmill.session import cut, ready_for_python

FEATURES, RIDGE, FOLDS, BINS, SEED, CUT = 256, 1.0, 4, 2000, 7, 0.7
HELD_PARTS, HELD = 4, 2
#: Statistics of a text, in order.
STATS = "log_words word_len upper digit symbol bang comma_stop other_punct non_ascii distinct repeat distinct_pairs dup_lines log_line inner_case pipe".split()
_ASCII = np.arange(256)
_CLASSES = np.array([
    (_ASCII >= 65) & (_ASCII <= 90),
    (_ASCII >= 48) & (_ASCII <= 57),
    np.isin(_ASCII, list(b"#*$%&|<>")),
    np.isin(_ASCII, list(b"!?")),
    np.isin(_ASCII, list(b".,;:")),
    np.isin(_ASCII, list(b"\"'()[]{}/\\@^_~`+=-")),
    _ASCII >= 128,
    _ASCII == 124,
], float)


def statistics(text: bytes) -> list[float]:
    """STATS of a text; all zero for one without words."""
    w = text.split()
    n = len(w)
    if not n:
        return [0.0] * len(STATS)
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = max(1, n - 1 + int(hist.sum() - hist[[32, 9, 10, 11, 12, 13]].sum()))
    upper, digit, symbol, bang, stop, other, high, pipe = (_CLASSES @ hist / chars).tolist()
    lines = [x for x in text.split(b"\n") if x.strip()]
    pairs = max(1, n - 1)
    shouted = sum(map(bytes.isupper, w)) / n
    return [
        float(np.log1p(n)), (chars - n + 1) / n, upper, digit, symbol, bang, stop, other, high, len(set(w)) / n,
        sum(map(bytes.__eq__, w, w[1:])) / pairs, len(set(zip(w, w[1:]))) / pairs if n > 1 else 1.0,
        1 - len(set(lines)) / len(lines), float(np.log1p(n / len(lines))), shouted, pipe,
    ]


def stats_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, stats array<double>) of every row."""
    return map_rows(texts(docs, id_col, text_col), lambda: lambda c: (c[0], [statistics(t) for t in c[1]]), "doc_id long, stats array<double>")


@dataclass
class Model:
    """A fitted classifier; knots and heights are empty where nothing could be learned."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    heights: np.ndarray
    default: float = 0.5

    def features(self, stats: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        d = stats.shape[1]
        w, b = rng.normal(0, 1 / np.sqrt(d), (d, FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((stats - self.mean) / self.scale, -6, 6) @ w + b
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z), np.ones((len(stats), 1))])

    def raw(self, stats: np.ndarray, fold: int = 0) -> np.ndarray:
        """Ridge scores; fold 0 is the model of all folds, k the one without fold k - 1."""
        return self.features(stats) @ self.weights[fold]

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(stats), self.default)
        return np.clip(np.interp(self.raw(stats), self.knots, self.heights), 0, 1)


def isotonic(x: np.ndarray, hits: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: block means of x, and the non-decreasing rates of hits at them. x ascends."""
    blocks: list[list[float]] = []
    for a, h, n in zip(x, hits, counts):
        blocks.append([a * n, h, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.array([s / n for s, _, n in blocks]), np.array([h / n for _, h, n in blocks])


def fit(labelled: DataFrame) -> Model:
    """A model of labelled (doc_id, stats, y 0 or 1). Without rows of both classes it scores everything alike."""
    width = len(STATS)
    moments = labelled.agg(F.count("*").alias("n"), F.sum("y").alias("ones"), *(f(F.col("stats")[i]).alias(f"{k}{i}") for i in range(width) for k, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    n, ones = moments["n"], moments["ones"] or 0
    empty = Model(np.zeros(width), np.ones(width), np.zeros((1, FEATURES + 1)), np.array([]), np.array([]), ones / n if n else 0.5)
    if not 0 < ones < n:
        return empty
    model = Model(np.array([moments[f"m{i}"] for i in range(width)]), np.array([moments[f"s{i}"] or 1.0 for i in range(width)]), np.zeros((1, FEATURES + 1)), np.array([]), np.array([]))
    model.weights = _solve(_equations(labelled, model))
    ready_for_python(labelled.sparkSession)

    def placed(batches):
        for b in batches:
            x, k = _matrix(b), np.array(b.column("fold"))
            raw = np.choose(k, [model.raw(x, f + 1) for f in range(FOLDS)]) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.floor(np.clip(raw, -1, 2) * BINS).astype("int64")), b.column("y")], ["bin", "y"])

    bins = _folds(labelled).mapInArrow(placed, "bin long, y int").groupBy("bin").agg(F.sum("y").alias("hits"), F.count("*").alias("n")).orderBy("bin").toPandas()
    model.knots, model.heights = isotonic((bins.bin.to_numpy() + 0.5) / BINS, bins.hits.to_numpy(float), bins.n.to_numpy(float))
    return model


def _folds(labelled: DataFrame) -> DataFrame:
    return labelled.select(F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold"), "stats", F.col("y").cast("int").alias("y"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    col = batch.column("stats")
    return np.asarray(col.flatten()).reshape(len(col), -1)


def _equations(labelled: DataFrame, model: Model) -> np.ndarray:
    """Summed Z'Z and Z'y of each fold: [fold, row, column], y as the last column."""
    ready_for_python(labelled.sparkSession)

    def parts(batches):
        from pyspark import TaskContext

        sums = np.zeros((FOLDS, FEATURES + 1, FEATURES + 2))
        for b in batches:
            z, y, k = model.features(_matrix(b)), np.array(b.column("y"), float), np.array(b.column("fold"))
            for f in np.unique(k):
                m = k == f
                sums[f] += z[m].T @ np.hstack([z[m], y[m, None]])
        task, rows = TaskContext.get().partitionId(), FOLDS * (FEATURES + 1)
        yield pa.RecordBatch.from_arrays([pa.array([task] * rows), pa.array(range(rows)), pa.array(list(sums.reshape(rows, -1)), pa.list_(pa.float64()))], ["task", "row", "sums"])

    def total(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for row, x in zip(b.column("row").to_pylist(), np.asarray(b.column("sums").flatten()).reshape(b.num_rows, -1)):
                sums[row] = sums[row] + x if row in sums else x.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.list_(pa.float64()))], ["row", "sums"])

    # Each task adds its rows as they come, in the order of the tasks that made them.
    made = _folds(labelled).mapInArrow(parts, "task long, row long, sums array<double>").repartition("row").sortWithinPartitions("row", "task")
    got = {r["row"]: r["sums"] for r in made.mapInArrow(total, "row long, sums array<double>").toLocalIterator()}
    return np.array([got[i] for i in range(FOLDS * (FEATURES + 1))]).reshape(FOLDS, FEATURES + 1, FEATURES + 2)


def _solve(folds: np.ndarray) -> np.ndarray:
    """Ridge weights of all folds, then without each."""
    every, damp = folds.sum(0), RIDGE * np.eye(FEATURES + 1)
    damp[-1, -1] = 0
    return np.array([np.linalg.solve(a[:, :-1] + damp + 1e-9 * np.eye(FEATURES + 1), a[:, -1]) for a in (every, *(every - f for f in folds))])


def training(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(doc_id, stats, y): statistics of documents with a label outside the held-out fold. One label a document (the largest)."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).filter("y IN (0, 1) AND doc_id IS NOT NULL")
    return stats.filter(~fold(F.col("doc_id"), HELD_PARTS, HELD)).join(known.groupBy("doc_id").agg(F.max("y").alias("y")), "doc_id").select("doc_id", "stats", "y")


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Null and empty texts are scored as texts without words. Null ids are never held out and have no label. Repeated rows
    are repeated; an empty table gives no rows; extra columns are ignored. Without usable labels every score is the share
    of label 1 among them, or 0.5.
    """
    stats = cut(stats_table(docs, id_col, text_col))
    model = fit(cut(training(stats, labels)))
    scored = map_rows(stats, lambda: lambda c: (c[0], model.score(np.array(c[1], float))), "doc_id long, score double")
    return scored.select("doc_id", fold(F.col("doc_id"), HELD_PARTS, HELD).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that the classifier accepts, with their own columns.

    Without usable labels all rows stay. Null and empty texts are scored as texts without words; null ids have no label;
    repeated rows are judged alike; an empty table gives no rows; no column can clash, as none is added.
    """
    model = fit(cut(training(cut(stats_table(docs, id_col, text_col)), labels)))
    if not len(model.knots):
        return docs
    ready_for_python(docs.sparkSession)
    at = docs.columns.index(text_col)

    def keep(batches):
        for b in slices(batches):
            rows = [statistics((t or "").encode()) for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(model.score(np.array(rows)) >= CUT))

    return docs.mapInArrow(keep, docs.schema)
