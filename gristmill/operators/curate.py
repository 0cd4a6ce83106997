"""Curation of retrieval data: decontamination, pair dedup, leakage-safe splits, negatives, merging and alignment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gristmill.functions import text as T
from gristmill.operators.components import connected_components


def eval_shingles(texts: DataFrame, text_col: str = "text", n: int = 5) -> DataFrame:
    """(shingle): distinct word n-grams of evaluation texts."""
    words = texts.select(T.tokens(F.col(text_col)).alias("w"))
    # The outer form: for the inner one the optimizer tests the array's size further down, where its parts aren't stored.
    return words.select(F.explode_outer(T.shingles(F.col("w"), n)).alias("shingle")).filter("shingle IS NOT NULL").distinct()


def overlap(rows: DataFrame, index: DataFrame, id_col: str, text_col: str, n: int = 5) -> DataFrame:
    """(id, n_shingles, n_hits, share): how many of a text's distinct n-grams are in index (shingle).

    Texts are read and cut once: the n-grams carry their number, meet the index by a hash join that Spark chooses (a broadcast
    while the index is under its limit), and are counted by text before anything is shuffled. Ids are unique; null texts have no
    n-grams and a share of 0.
    """
    words = rows.select(F.col(id_col).alias("id"), T.tokens(F.coalesce(F.col(text_col), F.lit(""))).alias("w"))
    grams = words.select("id", T.shingles(F.col("w"), n).alias("g")).select("id", F.size("g").cast("long").alias("n_shingles"), F.explode_outer("g").alias("shingle"))
    hits = grams.join(index.select("shingle", F.lit(1).alias("hit")), "shingle", "left").groupBy("id").agg(F.first("n_shingles").alias("n_shingles"), F.count("hit").alias("n_hits"))
    return hits.withColumn("share", F.coalesce(F.try_divide(F.col("n_hits"), F.col("n_shingles")), F.lit(0.0)))


def decontaminated(rows: DataFrame, index: DataFrame, id_col: str, fields: list[str], threshold: float = 0.5, n: int = 5) -> DataFrame:
    """rows with hit_field (the first of fields whose share reaches the threshold, null: kept) and hit_share, rounded half even."""
    out, hit = rows, None
    for k, f in enumerate(fields):
        s = overlap(rows, index, id_col, f, n).select(F.col("id").alias(id_col), F.col("share").alias(f"__s{k}"))
        out = out.join(s, id_col, "left")
        over = F.col(f"__s{k}") >= threshold
        found = F.struct(F.lit(f).alias("field"), F.bround(F.col(f"__s{k}"), 3).alias("share"))
        hit = F.when(over, found) if hit is None else hit.when(over, found)
    return out.withColumn("__hit", hit).select(*rows.columns, F.col("__hit.field").alias("hit_field"), F.col("__hit.share").alias("hit_share"))


def pruned_negatives(rows: DataFrame, index: DataFrame, id_col: str, threshold: float = 0.5, target: int | None = None, n: int = 5) -> DataFrame:
    """rows (id, negatives, negative_types) without negatives whose share reaches the threshold; with negatives_pruned and below_target."""
    each = rows.select(id_col, F.posexplode("negatives").alias("pos", "t")).withColumn("key", F.struct(id_col, "pos"))
    bad = overlap(each, index, "key", "t", n).filter(F.col("share") >= threshold).groupBy(F.col(f"id.{id_col}").alias(id_col)).agg(F.collect_set("id.pos").alias("bad"))
    keep = lambda c: F.filter(c, lambda _, i: ~F.array_contains(F.coalesce("bad", F.array().cast("array<int>")), i))
    out = rows.join(bad, id_col, "left").withColumns({"__n": keep(F.col("negatives")), "__t": keep(F.col("negative_types")), "negatives_pruned": F.coalesce(F.size("bad"), F.lit(0))})
    out = out.drop("negatives", "negative_types", "bad").withColumnsRenamed({"__n": "negatives", "__t": "negative_types"})
    return out if target is None else out.withColumn("below_target", F.size("negatives") < target)


def first_by(rows: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each key in a declared order, as an aggregate (combined before the shuffle), not a window."""
    picked = rows.groupBy(*(k.alias(f"__k{i}") for i, k in enumerate(keys))).agg(F.min_by(F.struct(*rows.columns), F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)))).alias("__row"))
    return picked.select("__row.*")


def split_groups(rows: DataFrame, document: Column, query: Column, train: float = 0.8, validation: float = 0.1) -> DataFrame:
    """rows with split_group and split: rows that share a document or a query, directly or by way of others, go together.

    Nodes are "document:..." and "query:..." strings; a group's name is its smallest node.
    """
    edges = rows.select(F.concat(F.lit("document:"), document).alias("src"), F.concat(F.lit("query:"), query).alias("dst"))
    comp = connected_components(edges).select(F.col("node").alias("__d"), F.col("component").alias("split_group"))
    return rows.withColumn("__d", F.concat(F.lit("document:"), document)).join(comp, "__d").drop("__d").withColumn("split", T.split_for(F.col("split_group"), train, validation))


def cleaned_negatives(negatives: Column, query: Column, positive: Column, most: int = 5) -> Column:
    """Squeezed negatives without repeats, the query and the positive (cases ignored), at most so many."""
    texts = F.filter(F.transform(negatives, T.squeeze), lambda x: (x != "") & ~F.lower(x).isin(F.lower(query), F.lower(positive)))
    fresh = F.filter(texts, lambda x, i: ~F.exists(F.slice(texts, 1, i), lambda y: F.lower(y) == F.lower(x)))
    return F.slice(fresh, 1, most)


def select_negatives(candidates: Column, positive_score: Column, most: int = 5, absolute: float = 0.5, margin: float = 0.1) -> Column:
    """(kept, rejected) of ranked candidates (array of structs with score): likely false negatives are rejected, the first others kept."""
    false = lambda c: (c["score"] >= absolute) | (c["score"] >= positive_score - margin)
    return F.struct(F.slice(F.filter(candidates, lambda c: ~false(c)), 1, most).alias("kept"), F.filter(candidates, false).alias("rejected"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def top_k(queries: DataFrame, pool: DataFrame, k: int, query_col: str = "vec_id", vector_col: str = "embedding", block: int = 512) -> DataFrame:
    """(query_id, rank, vec_id, score): of a stated query set, the k pool rows of largest cosine; ties to the smaller id.

    Queries come in blocks; a block meets the pool in matrix products on the pool's own partitions, each of which gives its own
    best k, so what is shuffled is queries x partitions x k at most. Nothing is joined pair by pair.
    """
    import numpy as np
    import pandas as pd

    from gristmill.session import ready_for_python

    spark = pool.sparkSession
    ready_for_python(spark)
    parts: list[DataFrame] = []
    rows = [(r[0], r[1]) for r in queries.filter(F.col(query_col).isNotNull()).select(query_col, vector_col).toLocalIterator()]
    for at in range(0, len(rows), block):
        ids = np.array([i for i, _ in rows[at : at + block]])
        q = np.array([v for _, v in rows[at : at + block]], float)
        shared = spark.sparkContext.broadcast((ids, q / np.linalg.norm(q, axis=1, keepdims=True)))

        def best(batches, shared=shared):
            ids, q = shared.value
            for pdf in batches:
                if len(pdf):
                    x = np.vstack(pdf.v.to_list()).astype(float)
                    sims = np.round(q @ (x / np.linalg.norm(x, axis=1, keepdims=True)).T, 9)
                    own = pdf.id.to_numpy()
                    out = []
                    for i, s in zip(ids, sims):
                        s = np.where(own == i, -np.inf, s)
                        keep = np.lexsort((own, -s))[:k]
                        out += [(int(i), int(own[j]), float(s[j])) for j in keep if np.isfinite(s[j])]
                    yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

        parts.append(pool.select(F.col(query_col).alias("id"), F.col(vector_col).alias("v")).mapInPandas(best, "query_id long, vec_id long, score double"))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def aligned(parts: dict[str, DataFrame]) -> DataFrame:
    """Splits with the union of their columns; missing strings empty, other missing values null; with split."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.withColumn("split", F.lit(s)) for s, df in parts.items()))
    return out.fillna("", [c for c, kind in out.dtypes if kind == "string"])


def resumed(tasks: DataFrame, audit: DataFrame, id_col: str = "id") -> DataFrame:
    """Tasks whose id has no audited row without an error."""
    return tasks.join(audit.filter(~F.coalesce("errored", F.lit(False))).select(id_col).distinct(), id_col, "left_anti")


def allowed(rows: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    return rows.join(ids.select(id_col).distinct(), id_col, "left_semi")


def page_spans(pages: Column, start: Column, end: Column) -> Column:
    """First and last page of spans (page, start, end) that overlap an interval."""
    hit = F.filter(pages, lambda p: (p["end"] > start) & (p["start"] < end))
    return F.struct(F.array_min(F.transform(hit, lambda p: p["page"])).alias("first"), F.array_max(F.transform(hit, lambda p: p["page"])).alias("last"))
