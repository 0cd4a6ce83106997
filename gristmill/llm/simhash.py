"""Near-duplicate groups by SimHash: pigeonhole blocks, a join on blocks, and a Hamming check.

Fingerprints are 64 bits in BLOCKS blocks. Two that differ in at most RADIUS bits agree in at least BLOCKS - RADIUS
blocks, so they share the key of one of the C(5, 3) choices of blocks. Distinct fingerprints (not documents) are joined
on those keys, so copies cost nothing. A key shared by more than PAIR_LIMIT distinct fingerprints isn't joined pairwise:
its members meet at midpoints instead. Two members differ in at most two of the key's free bits exactly if each, with at
most one free bit flipped, gives a common value; at most 1 + free bits members meet at a value, and a star links them.
That way is exact and linear in the size of the group.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from gristmill.llm.common import LOWER, map_rows, texts
from gristmill.operators.components import connected_components
from gristmill.session import cut

WORDS, SEED, RADIUS, BLOCKS, PAIR_LIMIT = 3, 42, 2, 5, 64
_EDGES = [round(i * 64 / BLOCKS) for i in range(BLOCKS + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


#: Of each choice of blocks, its bits as a mask, and each bit outside it.
MASKS = [_signed(sum(((1 << _EDGES[b + 1]) - (1 << _EDGES[b])) for b in choice)) for choice in combinations(range(BLOCKS), BLOCKS - RADIUS)]
FREE = [[_signed(1 << i) for i in range(64) if not (m >> i) & 1] for m in MASKS]


def simhash(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """Unsigned fingerprint of a text; zero without words."""
    w = text.translate(LOWER).split()
    if not w:
        return 0
    runs = zip(*(w[i:] for i in range(words))) if len(w) >= words else [w]
    h = np.array([xxh64_intdigest(b" ".join(r), seed) for r in runs], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp signed long) of every row. Null and empty texts have fingerprint zero."""
    return map_rows(texts(docs, id_col, text_col), lambda: lambda c: (c[0], [_signed(simhash(t)) for t in c[1]]), "doc_id long, fp long")


def links(distinct: DataFrame, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """(src, dst): links between distinct fingerprints (column fp) that connect all within RADIUS bits."""
    keys = F.explode(F.array(*(F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(MASKS))))
    blocks = distinct.select("fp", keys.alias("key")).select("fp", "key.c", "key.v")
    sizes = cut(blocks.groupBy("c", "v").agg(F.count("*").alias("n")).filter("n > 1"))
    shared = cut(blocks.join(sizes, ["c", "v"]))
    few = shared.filter(F.col("n") <= pair_limit)
    pairs = few.select("c", "v", F.col("fp").alias("src")).join(few.select("c", "v", F.col("fp").alias("dst")), ["c", "v"])
    pairs = pairs.filter(F.col("src") < F.col("dst")).filter(F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= RADIUS)
    flips = F.element_at(F.array(*(F.array(*(F.lit(x) for x in [0, *f])) for f in _even(FREE))), F.col("c") + 1)
    met = shared.filter(F.col("n") > pair_limit).select("c", "fp", F.explode(F.array_distinct(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m)))).alias("at"))
    stars = met.groupBy("c", "at").agg(F.array_sort(F.collect_set("fp")).alias("fps")).filter(F.size("fps") > 1)
    stars = stars.select(F.col("fps")[0].alias("src"), F.explode(F.slice("fps", 2, 64)).alias("dst")).filter(F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= RADIUS)
    return pairs.select("src", "dst").unionByName(stars).distinct()


def _even(rows: list[list[int]]) -> list[list[int]]:
    """Rows filled up to one length with zeros (a zero flips nothing)."""
    most = max(map(len, rows))
    return [r + [0] * (most - len(r)) for r in rows]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    component_id is the smallest doc_id reachable over links of at most RADIUS differing bits, its own included. Null or
    empty texts have fingerprint zero and are linked like any other. Null ids keep their row and are never a
    component_id, unless a component has no other (then null). Repeated rows are repeated in the result; an empty table
    gives no rows; extra columns are ignored, whatever their names.
    """
    fps = cut(fingerprints(docs, id_col, text_col))
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("low")))
    comp = connected_components(links(distinct, pair_limit)).withColumnRenamed("node", "fp")
    lows = comp.join(distinct, "fp").groupBy("component").agg(F.min("low").alias("least"))
    near = comp.join(lows, "component").select("fp", "least")
    every = cut(distinct.join(near, "fp", "left").select("fp", F.coalesce("least", "low").alias("component_id")))
    return fps.join(every, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, one of each near-duplicate group: the one with the smallest id.

    Of rows that repeat that id, the one with the smallest text stays, then by the other columns that have an order. Rows with
    a null id can't be told apart by id; they all stay. An empty table gives no rows; columns keep their names and order.
    """
    name = "__kept"
    while name in docs.columns:
        name += "_"
    kept = near_duplicates(docs, id_col, text_col).filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(name)).distinct()
    found = docs.join(kept, docs[id_col].cast("long") == F.col(name), "left_semi")
    ordered = [text_col, *(c for c, kind in docs.dtypes if c != text_col and "map<" not in kind and "variant" not in kind)]
    named = found.groupBy(F.col(id_col).cast("long").alias(name)).agg(F.min_by(F.struct(*docs.columns), F.struct(*ordered)).alias("row")).select("row.*")
    return named.unionByName(docs.filter(F.col(id_col).isNull()))
