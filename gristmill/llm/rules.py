"""Quality rules from SQL functions alone: repetition rules and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over BUCKETS hashed word n-grams: trusted documents (a bounded sample of those with a
trusted label) against the raw corpus (every document). A document's ratio is the mean over its n-grams, so it doesn't
grow with length, and a fixed threshold decides on every document.

THRESHOLD is the largest multiple of 0.05 that rejects no held-out document of label 1 which the base rules keep, on sf0.1 and
check_s, both over all documents and over those that the classifier accepts. Trusted counts came from ids with an even crc32,
the other half was judged. Rejected of label 0 and label 1: 153 of 161 and 0 of 1591; 645 of 676 and 0 of 8403. With few
trusted documents the ratio is noisy: on sf0.01 (half of its labels) 9 of 9, but also 41 of 174.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.session import cut

BUCKETS, ORDERS, SMOOTHING, THRESHOLD = 1 << 14, (1, 2), 1.0, -0.1
#: At most so many trusted documents fit the trusted multinomial, those with the smallest hashes of their ids.
TRUSTED_LIMIT = 20_000
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
SPACE = " \t\n\x0b\x0c\r"
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _words(df: DataFrame, text: Column) -> DataFrame:
    """df and __words, the words of text."""
    df = df.withColumn("__trim", F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(SPACE)))
    return df.withColumn("__words", F.when(F.col("__trim") == "", F.array().cast("array<string>")).otherwise(F.split("__trim", r"[ \t-\r]+")))


def _hash(words: str, i: Column, order: int) -> Column:
    """Hash of the run of so many words from place i on."""
    return F.xxhash64(*(F.get(F.col(words), i + k) for k in range(order)))


def _bucket(words: str, i: Column, order: int) -> Column:
    return F.pmod(_hash(words, i, order) + order, F.lit(BUCKETS)).cast("int")


def _each(words: str, order: int, act) -> Column:
    """act of the place (a column) of every run of so many words, as an array; empty where there are fewer words."""
    # A function of one parameter: transform() gives a second one, even with a default, the place in the array.
    runs = F.transform(F.sequence(F.lit(0), F.size(words) - order), lambda i: act(words, i, order))
    return F.when(F.size(words) >= order, runs).otherwise(F.filter(runs, lambda x: F.lit(False)))


def _buckets(words: str) -> Column:
    """The hashed n-grams of all orders as buckets."""
    return F.concat(*(_each(words, n, _bucket) for n in ORDERS))


def measured(df: DataFrame, text: Column) -> DataFrame:
    """df with __words and the counts of _COUNTS (long), each under its name with two underscores in front."""
    df = _words(df, text)
    lines = F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1), lambda x: x.rlike(r"[^ \t-\r]"))
    df = df.withColumns({"__lines": lines, "__h": _each("__words", 3, _hash)})
    twice = F.size("__h") > F.size(F.array_distinct("__h"))
    sorted_runs = F.sort_array(F.transform("__h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = df.withColumn("__runs", F.when(twice, sorted_runs))
    same = lambda x, k: F.get(F.col("__runs"), k)["h"].eqNullSafe(x["h"])
    again = F.filter("__runs", lambda x, k: F.when(k > 0, same(x, k - 1)).otherwise(False) | same(x, k + 1))
    df = df.withColumn("__at", F.sort_array(F.transform(again, lambda x: x["i"])))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    covered = F.aggregate("__at", start, lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")), lambda a: a["n"])
    counts = {
        "n_words": F.size("__words"),
        "word_chars": F.length(F.array_join("__words", "")),
        "n_symbols": F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[#*$%&|<>]")), F.lit(0)),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
    }
    return df.withColumns({f"__{k}": v.cast("long") for k, v in counts.items()}).drop("__trim", "__lines", "__h", "__runs", "__at")


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", limit: int = TRUSTED_LIMIT) -> DataFrame:
    """(id): at most limit ids with label 1, by hash, so the choice doesn't depend on how the table is dealt."""
    ids = labels.filter(F.col(label_col) == 1).select(F.col(id_col).cast("long").alias("id")).filter("id IS NOT NULL").distinct()
    return ids.orderBy(F.xxhash64("id"), "id").limit(limit)


def fit(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (weights array<float>): each bucket's log ratio of trusted against raw. All zero without trusted documents.

    trusted (id) is broadcast; trusted_ids bounds it to TRUSTED_LIMIT rows. The counts are summed before the shuffle and
    have at most BUCKETS rows, whatever the corpus.
    """
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    own = own.join(F.broadcast(trusted.withColumn("in", F.lit(1))), "id", "left")
    grams = _words(own, F.col("t")).select(F.coalesce("in", F.lit(0)).alias("in"), F.explode(_buckets("__words")).alias("b"))
    counts = cut(grams.groupBy("b").agg(F.sum("in").alias("target"), F.count("*").alias("raw")))
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("b")).join(counts, "b", "left").fillna(0, ["target", "raw"])
    sums = counts.agg(F.coalesce(F.sum("target"), F.lit(0)).alias("t"), F.coalesce(F.sum("raw"), F.lit(0)).alias("r"))
    share = lambda n, total: (F.col(n) + SMOOTHING) / (total + SMOOTHING * BUCKETS)
    t, r = sums.select("t").scalar(), sums.select("r").scalar()
    ratio = F.when(t == 0, 0.0).otherwise(F.log(share("target", t) / share("raw", r)))
    rows = every.select(F.struct("b", ratio.alias("w")).alias("x"))
    return cut(rows.agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["w"].cast("float")).alias("weights")))


def judged(docs: DataFrame, weights: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the counts, __llr (null without n-grams), __base_failed and __kept."""
    df = measured(docs, F.col(text_col)).withColumn("__model", weights.scalar())
    size = F.size("__words")
    weight = lambda i, n: F.when(i + n <= size, F.get(F.col("__model"), _bucket("__words", i, n))).otherwise(0.0).cast("double")
    # One pass over the places of the words, with the n-grams of all orders that begin at each, makes no array of buckets.
    total = F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0.0), lambda a, i: a + sum((weight(i, n) for n in ORDERS[1:]), weight(i, ORDERS[0])))
    grams = sum((F.greatest(F.lit(0), size - n + 1) for n in ORDERS[1:]), F.greatest(F.lit(0), size - ORDERS[0] + 1))
    df = df.withColumn("__llr", F.when(size > 0, total / grams)).drop("__model", "__words")
    df = df.withColumn("__base_failed", (F.col("__n_words") < MIN_WORDS) | (100 * F.col("__n_repeat_words") > MAX_REPEATED_PERCENT * F.col("__n_words")))
    return df.withColumn("__kept", ~F.col("__base_failed") & F.coalesce(F.col("__llr") >= THRESHOLD, F.lit(True)))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, llr) of every row.

    Null and empty texts have no words and so fail the base rules. Repeated rows are repeated, null ids stay, an empty
    table gives no rows, extra columns are ignored. Without trusted labels only the base rules decide.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    df = judged(own, fit(docs, trusted_ids(labels), id_col, text_col)).withColumn("__gate", F.rand(0))
    # The gate always holds. A caller's filter on a result refers to it, and as it isn't deterministic, the optimizer leaves
    # the filter above the projections; below them, it would hold each shared expression many times over.
    held = lambda k: F.when(F.col("__gate") >= 0, F.col(f"__{k}")).alias(k)
    return df.select("doc_id", *map(held, (*_COUNTS, "base_failed", "kept", "llr")))


def passing(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that the rules keep, with their own columns.

    Null and empty texts fail the base rules and go. Null ids stay and count as raw text, repeated rows are judged alike, an
    empty table gives no rows. The row is kept as one value beside the text, so no column of it can clash.
    """
    own = docs.select(F.struct(*docs.columns).alias("__row"), F.col(text_col).alias("__text"))
    df = judged(own, fit(docs, trusted_ids(labels), id_col, text_col), "__text").select("__row", "__kept", F.rand(0).alias("__gate"))
    return df.filter(F.col("__kept") & (F.col("__gate") >= 0)).select("__row.*")
