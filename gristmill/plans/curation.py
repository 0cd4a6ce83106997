"""Curation queries: documents as passages, their source as the document they come from, benchmark items as evaluation texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.functions import text as T
from gristmill.operators import curate as C
from gristmill.plans.registry import query, table

_TOKENS = "list_filter(list_transform(regexp_split_to_array(lower({x}), '\\s+'), lambda w: regexp_replace(w, '^[\\pP\\pS]+|[\\pP\\pS]+$', '', 'g')), lambda w: w <> '')"
_SHINGLES = "list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)"
_SHARES = f"""WITH idx AS (SELECT DISTINCT unnest({_SHINGLES}) AS s FROM (SELECT {_TOKENS.format(x='text')} AS w FROM benchmark)),
g AS (SELECT doc_id, {_SHINGLES} AS g FROM (SELECT doc_id, {_TOKENS.format(x='text')} AS w FROM documents)),
h AS (SELECT doc_id, count(*) AS hits FROM (SELECT doc_id, unnest(g) AS s FROM g) JOIN idx USING (s) GROUP BY 1),
shares AS (SELECT doc_id, len(g) AS n_shingles, coalesce(hits, 0) AS n_hits, CASE WHEN len(g) > 0 THEN coalesce(hits, 0) / len(g) ELSE 0.0 END AS share FROM g LEFT JOIN h USING (doc_id))
"""


def _shares(spark, d):
    return C.overlap(table(spark, d, "documents"), C.eval_shingles(table(spark, d, "benchmark")), "doc_id", "text")


@query(_SHARES + "SELECT doc_id, n_shingles, n_hits, round(share, 9) AS share FROM shares")
def decontam_overlap(spark, d):
    return _shares(spark, d).select(F.col("id").alias("doc_id"), "n_shingles", "n_hits", F.round("share", 9).alias("share"))


def _decided(spark, d):
    return C.decontaminated(table(spark, d, "documents").select("doc_id", "text"), C.eval_shingles(table(spark, d, "benchmark")), "doc_id", ["text"], threshold=0.1)


@query(_SHARES + "SELECT doc_id FROM shares WHERE share < 0.1")
def decontam_kept(spark, d):
    return _decided(spark, d).filter("hit_field IS NULL").select("doc_id")


@query(_SHARES + "SELECT doc_id, 'text' AS hit_field FROM shares WHERE share >= 0.1")
def decontam_dropped(spark, d):
    return _decided(spark, d).filter("hit_field IS NOT NULL").select("doc_id", "hit_field")


@query("SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY lower(source), lower(text) ORDER BY doc_id) AS k FROM documents) WHERE k = 1")
def pair_dedup_first(spark, d):
    docs = table(spark, d, "documents")
    return C.first_by(docs.select("doc_id", "source", F.sha2(F.lower("text"), 256).alias("h")), [F.lower("source"), F.col("h")], [F.col("doc_id")]).select("doc_id", "source")


@query("SELECT doc_id, substr(sha256(source || chr(10) || text), 1, 24) AS stable_id FROM documents")
def stable_id(spark, d):
    return table(spark, d, "documents").select("doc_id", T.stable_id(F.col("source"), F.col("text")).alias("stable_id"))


_U = "(('0x' || substr(sha256({k}), 1, 16))::UBIGINT::DOUBLE / 18446744073709551615.0)"


@query(f"SELECT doc_id, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'validation' ELSE 'test' END AS split FROM (SELECT doc_id, {_U.format(k='doc_id::VARCHAR')} AS u FROM documents)")
def hash_split(spark, d):
    return table(spark, d, "documents").select("doc_id", T.split_for(F.col("doc_id").cast("string")).alias("split"))


@query(f"""WITH RECURSIVE n AS (SELECT DISTINCT 'document:' || user_id // 3 AS a, 'query:' || (event_id % 97) // 2 * 10 + (user_id // 30) AS b FROM events),
e AS (SELECT a, b FROM n UNION SELECT b, a FROM n), c(x, low) USING KEY (x) AS (SELECT DISTINCT a, a FROM e
  UNION (SELECT c.x, min(o.low) FROM recurring.c AS o JOIN e ON e.a = o.x JOIN recurring.c AS c ON c.x = e.b WHERE o.low < c.low GROUP BY c.x))
SELECT event_id, low AS split_group, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'validation' ELSE 'test' END AS split FROM (SELECT event_id, low, {_U.format(k='low')} AS u
  FROM events JOIN c ON c.x = 'document:' || user_id // 3)""")
def component_split(spark, d):
    """Rows that share a document or a query share a split."""
    events = table(spark, d, "events")
    e = events.select("event_id", F.expr("cast(user_id div 3 as string)").alias("doc"), F.expr("cast((event_id % 97) div 2 * 10 + user_id div 30 as string)").alias("q"))
    return C.split_groups(e, F.col("doc"), F.col("q")).select("event_id", "split_group", "split")


@query("""WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 20 = 0), p AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
s AS (SELECT query_id, vec_id, round(list_cosine_similarity(q.e, p.e), 9) AS score FROM q JOIN p ON query_id <> vec_id)
SELECT query_id, rank::INT AS rank, vec_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10""")
def negatives_topk(spark, d):
    e = table(spark, d, "embeddings")
    return C.top_k(e.filter("vec_id % 20 = 0"), e, 10).drop("score")


_SEL = """WITH q AS (SELECT vec_id AS query_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 20 = 0), p AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
s AS (SELECT query_id, vec_id, p.label = q.label AS same, round(list_cosine_similarity(q.e, p.e), 9) AS score FROM q JOIN p ON query_id <> vec_id),
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 30),
"""


@query(_SEL + """k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS place FROM t WHERE NOT (score >= 0.3 OR score >= 0.35 - 0.1))
SELECT query_id, vec_id, place::INT AS place FROM k WHERE place <= 5""")
def select_negatives(spark, d):
    e = table(spark, d, "embeddings")
    top = C.top_k(e.filter("vec_id % 20 = 0"), e, 30)
    ranked = top.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("c"))
    chosen = ranked.select("query_id", C.select_negatives(F.col("c"), F.lit(0.35), 5, absolute=0.3).alias("s"))
    return chosen.select("query_id", F.posexplode("s.kept").alias("pos", "k")).select("query_id", F.col("k.vec_id").alias("vec_id"), (F.col("pos") + 1).alias("place"))


@query(_SEL + "r AS (SELECT query_id, vec_id, same, rank, sum(same::INT) OVER (PARTITION BY query_id ORDER BY rank) AS hits FROM t WHERE rank <= 10) SELECT query_id, round(coalesce(sum(CASE WHEN same THEN hits / rank END) / nullif(sum(same::INT), 0), 0), 9) AS average_precision, round(avg(same::INT), 9) AS relevance FROM r GROUP BY 1")
def rag_precision(spark, d):
    """Average precision and relevance of the ten nearest vectors, those with the query's label being relevant."""
    from gristmill.functions.verify import average_precision, share_true

    e = table(spark, d, "embeddings")
    top = C.top_k(e.filter("vec_id % 20 = 0"), e, 10)
    labels = e.select("vec_id", "label")
    j = top.join(labels, "vec_id").join(labels.select(F.col("vec_id").alias("query_id"), F.col("label").alias("own")), "query_id")
    rel = j.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", (F.col("label") == F.col("own")).alias("same")))), lambda x: x["same"]).alias("r"))
    return rel.select("query_id", F.round(average_precision(F.col("r")), 9).alias("average_precision"), F.round(share_true(F.col("r")), 9).alias("relevance"))


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 0)")
def anti_resume(spark, d):
    audit = table(spark, d, "labels").select("doc_id", (F.col("toxic") == 1).alias("errored"))
    return C.resumed(table(spark, d, "documents").select("doc_id", "lang"), audit, "doc_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def semi_allowlist(spark, d):
    return C.allowed(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels").filter("quality = 1"), "doc_id")


@query("SELECT lang, source, min(doc_id) AS doc_id FROM documents GROUP BY lang, source")
def merge_first(spark, d):
    return C.first_by(table(spark, d, "documents").select("lang", "source", "doc_id"), [F.col("lang"), F.col("source")], [F.col("doc_id")])


@query("SELECT doc_id AS id, lang, source, '' AS title, 'train' AS split FROM documents UNION ALL SELECT item_id, '', '', left(text, 20), 'test' FROM benchmark")
def align_union(spark, d):
    train = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang", "source")
    test = table(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.substring("text", 1, 20).alias("title"))
    return C.aligned({"train": train, "test": test})


@query("SELECT conv_id, len(list(text ORDER BY turn)) - len(list_distinct(list(text ORDER BY turn))) AS repeats FROM conversations GROUP BY conv_id")
def repeated_messages(spark, d):
    g = table(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list("text").alias("t"))
    return g.select("conv_id", (F.size("t") - F.size(F.array_distinct("t"))).cast("long").alias("repeats"))


@query("SELECT lang, count(*) AS rows, count(*) FILTER (n < 3) AS below_target, CAST(sum(n) AS BIGINT) AS candidates FROM (SELECT lang, doc_id % 7 AS n FROM documents) GROUP BY lang")
def mining_stats(spark, d):
    m = table(spark, d, "documents").select("lang", (F.col("doc_id") % 7).alias("n"))
    return m.groupBy("lang").agg(F.count("*").alias("rows"), F.count_if(F.col("n") < 3).alias("below_target"), F.sum("n").alias("candidates"))
