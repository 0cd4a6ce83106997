"""Language gates and similarity on documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.functions import lang as L
from gristmill.functions import text as T
from gristmill.operators.chunks import chunked
from gristmill.plans.registry import query, table


@query("""SELECT doc_id, CASE WHEN trim(text) = '' THEN 'empty_text' ELSE 'insufficient_script_ratio:ne-Deva:' || printf('%.3f', len(regexp_extract_all(text, '[ऀ-ॿ]')) / greatest(1, len(regexp_extract_all(text, '\\pL')))) END AS native,
  CASE WHEN trim(text) = '' THEN 'empty_text' WHEN h < 2 THEN 'insufficient_marker_words:ne-Latn:' || h END AS roman FROM (SELECT doc_id, text, len(list_intersect(list_distinct(regexp_extract_all(lower(text), '\\pL+')),
  ['""" + "', '".join(sorted(L.ROMANIZED)) + """'])) AS h FROM documents)""")
def language_gate(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", L.language_issue(t, L.language("ne-Deva")).alias("native"), L.language_issue(t, L.language("ne-Latn")).alias("roman"))


@query("SELECT doc_id, round(len(regexp_extract_all(text, '\\p{Latin}')) / greatest(1, len(regexp_extract_all(text, '\\pL'))), 9) AS latin FROM documents WHERE regexp_matches(text, '\\pL')")
def script_share(spark, d):
    docs = table(spark, d, "documents").filter(F.col("text").rlike(r"\p{L}"))
    return docs.select("doc_id", F.round(L.script_share(F.col("text"), "ne-Latn"), 9).alias("latin"))


@query()
def protected_spans(spark, d):
    """Spans that a translation keeps; a pattern with look-behind, which the other engine lacks."""
    return table(spark, d, "documents").select("doc_id", F.array_join(L.protected_spans(F.col("text")), "\n").alias("spans"))


@query()
def sequence_similarity(spark, d):
    c = table(spark, d, "conversations")
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("after"))
    j = c.join(nxt, ["conv_id", "turn"])
    return j.select("conv_id", "turn", F.round(L.similarity(F.col("text"), F.col("after")), 9).alias("ratio"))


@query()
def translation_scores(spark, d):
    m = lambda *t: F.array(*(F.struct(F.lit(r).alias("from"), x.alias("value")) for r, x in zip(("human", "gpt"), t)))
    c = table(spark, d, "documents").select("doc_id", m(F.col("text"), F.lit("See https://example.org/x and 5 kg")).alias("s"), m(F.lit("नेपाल राम्रो छ"), F.when(F.col("doc_id") % 2 == 0, "हेर्नुहोस् https://example.org/x र 5 kg").otherwise("")).alias("t"))
    return c.select("doc_id", L.translation("s", "t", F.lit(None).cast(L.MESSAGES)).alias("x")).select("doc_id", F.round("x.score", 9).alias("score"), F.round("x.protected", 9).alias("protected"))


@query()
def chunk_text(spark, d):
    """Overlapping windows that end at spaces; each begins where the one before it tells."""
    return chunked(table(spark, d, "documents"), "doc_id", "text", 1000, 100)


@query("SELECT doc_id, CASE WHEN y <> '' THEN y END AS year FROM (SELECT doc_id, regexp_extract('in ' || (1700 + doc_id % 700) || ' it', '(^|[^0-9])((?:1[89]|20|21)[0-9]{2})([^0-9]|$)', 2) AS y FROM documents)")
def document_year(spark, d):
    x = F.concat(F.lit("in "), (1700 + F.col("doc_id") % 700).cast("string"), F.lit(" it"))
    return table(spark, d, "documents").select("doc_id", T.document_date(x).alias("year"))


@query("SELECT doc_id, list_transform(regexp_extract_all(text, '[-+]?\\d[\\d,]*(?:\\.\\d+)?(?:[eE][-+]?\\d+)?'), lambda x: TRY_CAST(replace(x, ',', '') AS DOUBLE))[-1] AS last_number FROM documents")
def last_numbers(spark, d):
    return table(spark, d, "documents").select("doc_id", F.try_element_at(L.numbers(F.col("text")), F.lit(-1)).alias("last_number"))
