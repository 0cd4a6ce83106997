"""Approximate nearest neighbours with an inverted multi-index.

A vector's two halves are quantised separately, by k-means centroids fitted on a bounded sample; its cell is the pair of
centroids. A query visits cells in order of the summed squared distances of its halves to the centroids, with a heap, and
stops once the cells visited hold a share of all entries, and ENOUGH at least. All entries of those cells are ranked again by
their distance in double precision on the original vectors. The share is measured: ASKED vectors of the sample are searched
in it by brute force, and it is what has to be visited until TARGET of their neighbours are met. Vectors without structure,
whose neighbours no partition of the space keeps together, need a large share, clustered ones a small one. Neighbours in a
sample are farther than those in the table, so the share is rather too large.

Entries are grouped by their first centroid; a group of more than GROUP entries is dealt over several by salts. Every group
gives its own best k of each query that visits it, and only those are shuffled.
"""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gristmill.session import cut, ready_for_python

#: Vectors that the centroids are fitted on (by hash of the id), rounds, what a query sees at least, entries a group has at most.
SAMPLE, ROUNDS, ENOUGH, GROUP, SEED = 20_000, 12, 500, 20_000, 5
#: Vectors of the sample that measure the share, the neighbours that they should meet, and the smallest share.
ASKED, TARGET, LEAST = 200, 0.94, 0.02


def centroids_for(n: int) -> int:
    """Centroids of a half for so many vectors: about two entries a pair of them, 256 at most."""
    return int(min(256, max(4, round((n / 2) ** 0.5))))


def kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Lloyd's centroids, from distinct rows of x; fewer than k if x has fewer distinct rows."""
    x = np.unique(x, axis=0)
    c = x[np.sort(np.random.default_rng(seed).permutation(len(x))[:k])].copy()
    for _ in range(rounds):
        near = np.argmin((c * c).sum(1) - 2 * x @ c.T, axis=1)
        for j in range(len(c)):
            if (near == j).any():
                c[j] = x[near == j].mean(0)
    return c


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<double>): rows with an id and a vector that isn't null, empty, zero, or with null or non-finite parts."""
    v = F.col(vector_col).cast("array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ok = F.forall("v", fine) & F.exists("v", lambda x: x != 0)
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & F.coalesce(ok, F.lit(False)))


class Index:
    """Centroids of both halves and the numbers of entries of the cells."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second

    def distances(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = self.first.shape[1]
        far = lambda x, c: (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)
        return far(v[:, :h], self.first), far(v[:, h:], self.second)

    def cells(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.distances(v)
        return a.argmin(1), b.argmin(1)

    def visited(self, a: np.ndarray, b: np.ndarray, sizes: dict[int, int], enough: float) -> list[int]:
        """Cells with entries by summed distance, until they hold enough."""
        order_a, order_b, width = a.argsort(kind="stable"), b.argsort(kind="stable"), len(self.second)
        heap, got, out = [(float(a[order_a[0]] + b[order_b[0]]), 0, 0)], 0, []
        while heap and got < enough:
            _, i, j = heappop(heap)
            cell = int(order_a[i]) * width + int(order_b[j])
            if n := sizes.get(cell, 0):
                got += n
                out.append(cell)
            if j + 1 < len(order_b):
                heappush(heap, (float(a[order_a[i]] + b[order_b[j + 1]]), i, j + 1))
            if j == 0 and i + 1 < len(order_a):
                heappush(heap, (float(a[order_a[i + 1]] + b[order_b[0]]), i + 1, 0))
        return out


    def share(self, x: np.ndarray, k: int) -> float:
        """The share of x that has to be visited until ASKED of them have met TARGET of their k nearest others."""
        first, second = self.cells(x)
        need = []
        for i, (a, b) in enumerate(zip(*self.distances(x[:ASKED]))):
            far = ((x - x[i]) ** 2).sum(1)
            far[i] = np.inf
            near = np.argsort(far, kind="stable")[: min(k, len(x) - 1)]
            cell = a[first] + b[second]
            need.append(np.searchsorted(np.sort(cell), cell[near], "right") / len(x))
        need = np.concatenate(need)
        return max(LEAST, float(np.quantile(need, TARGET))) if len(need) else 1.0


def fit(vectors: DataFrame, sample: int = SAMPLE, k: int = 10) -> tuple[Index, float] | None:
    """Centroids and the share to visit from at most sample rows of (id, v); None without rows."""
    n = vectors.count()
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toPandas().v
    if not n:
        return None
    x = np.vstack(rows.to_list())
    half = (x.shape[1] + 1) // 2
    index = Index(kmeans(x[:, :half], centroids_for(n)), kmeans(x[:, half:], centroids_for(n)) if x.shape[1] > 1 else np.zeros((1, 0)))
    return index, index.share(x, k)


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, share: float | None = None, enough: int = ENOUGH, group: int = GROUP, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): of each row whose id is divisible by every, its k nearest others by Euclidean distance.

    Ties go to the smaller id; with fewer than k other rows there are fewer results. Rows with a null id, or a vector that
    is null, empty, zero or has null or non-finite components, take no part, nor do vectors of another width than the most
    common one. Rows that repeat an id are one candidate each, but none of them is a candidate of a query of that id; a
    repeated query is asked once, with the smallest of its vectors. An empty table gives no rows; extra columns are ignored.
    """
    spark = vectors.sparkSession
    ready_for_python(spark)
    own = cut(usable(vectors, id_col, vector_col))
    widths = own.groupBy(F.size("v").alias("w")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").first()
    if widths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    own = own.filter(F.size("v") == widths["w"])
    index, measured = fit(own, k=k)
    share = measured if share is None else share

    def celled(batches):
        for pdf in batches:
            if len(pdf):
                pdf["first"], pdf["second"] = index.cells(np.vstack(pdf.v.to_list()))
                yield pdf

    entries = cut(own.mapInPandas(celled, "id long, v array<double>, first int, second int"))
    sizes: dict[int, int] = {}
    firsts: dict[int, int] = {}
    for r in entries.groupBy("first", "second").agg(F.count("*").alias("n")).toLocalIterator():  # at most 256 squared
        sizes[r["first"] * len(index.second) + r["second"]] = r["n"]
        firsts[r["first"]] = firsts.get(r["first"], 0) + r["n"]
    salts = {c: -(-n // group) for c, n in firsts.items()}
    spread = F.element_at(F.create_map(*(F.lit(x).cast("int") for p in salts.items() for x in p)), F.col("first"))
    entries = entries.withColumn("salt", F.pmod(F.xxhash64("id"), spread.cast("long")))
    wanted = max(enough + 1, share * sum(sizes.values()))

    def probes(batches):
        width = len(index.second)
        for pdf in batches:
            rows = []
            if len(pdf):
                for q, x, a, b in zip(pdf.id, pdf.v, *index.distances(np.vstack(pdf.v.to_list()))):
                    by: dict[int, list[int]] = {}
                    for c in index.visited(a, b, sizes, wanted):
                        by.setdefault(c // width, []).append(c % width)
                    rows += [(q, x, first, s, second) for first, second in by.items() for s in range(salts[first])]
            yield pd.DataFrame(rows, columns=["id", "v", "first", "salt", "seconds"])

    queries = own.filter(F.pmod("id", F.lit(every)) == 0).groupBy("id").agg(F.min("v").alias("v"))
    queries = cut(queries).repartition(2 * spark.sparkContext.defaultParallelism)  # dealt out evenly, as each takes long
    asked = queries.mapInPandas(probes, "id long, v array<double>, first int, salt long, seconds array<int>")

    def ranked(q: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(e):
            x, ids, second = np.vstack(e.v.to_list()), e.id.to_numpy(), e.second.to_numpy()
            for i, v, seconds in zip(q.id, q.v, q.seconds):
                seen = np.zeros(second.max() + 1 + max(seconds), bool)
                seen[np.asarray(seconds)] = True
                rows = np.flatnonzero(seen[second] & (ids != i))
                far = np.sqrt(((x[rows] - np.asarray(v)) ** 2).sum(1))
                out += [(i, int(ids[rows[j]]), float(far[j])) for j in _best(far, ids[rows], k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = asked.groupBy("first", "salt").cogroup(entries.groupBy("first", "salt")).applyInPandas(ranked, "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best(far: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k smallest by distance, then id."""
    near = np.flatnonzero(far <= np.partition(far, k - 1)[k - 1]) if len(far) > k else np.arange(len(far))
    return near[np.lexsort((ids[near], far[near]))][:k]
