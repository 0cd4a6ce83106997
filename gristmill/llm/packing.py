"""Best-fit packing into sequences of several permitted lengths.

Documents go to shards by a hash, of about SHARD tokens each, so a shard is a bounded group and the result doesn't depend
on how the table is dealt. In a shard, pieces come longest first. Each goes where the least room is left over; where none
has room, a bin is opened. A bin costs its tokens, OVERHEAD, and its length squared over SPAN (attention), so short bins lose
by overhead and padding and long ones by attention. Opened is the length that costs least for each token it can be expected
to hold: the piece, and of the pieces still to come those that fit into the room beside it. At the end every bin shrinks to
the shortest permitted length that holds its contents.
Documents longer than the longest length are cut into pieces of that length and a rest.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.session import cut, ready_for_python

LENGTHS, OVERHEAD, SPAN, SHARD = (512, 1024, 2048, 4096, 8192), 16, 1 << 16, 2_000_000


def cost(length: int, overhead: int = OVERHEAD, span: int = SPAN) -> float:
    """What a bin of a length costs, in tokens."""
    return length + overhead + length * length / span


def pack(sizes: list[int], lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD) -> tuple[list[int], list[int], list[int]]:
    """Of each piece (longest first) its bin and its place there; of each bin its length, shrunk to its contents."""
    room: list[tuple[int, int]] = []  # (room left, bin), ascending
    used: list[int] = []
    caps: list[int] = []
    bins, at = [], []
    falling = [-s for s in sizes]
    after = [0, *accumulate(reversed(sizes))][::-1]  # tokens of the pieces from each on
    for i, s in enumerate(sizes):
        k = bisect_left(room, (s, -1))
        if k < len(room):
            free, b = room.pop(k)
        else:
            held = lambda c: s + min(c - s, after[bisect_left(falling, s - c, i + 1)])  # noqa: B023, E731
            b, free = len(caps), min((c for c in lengths if c >= s), key=lambda c: (cost(c, overhead) / held(c), c))
            caps.append(free)
            used.append(0)
        bins.append(b)
        at.append(used[b])
        used[b] += s
        if free > s:
            insort(room, (free - s, b))
    return bins, at, [next(c for c in lengths if c >= u) for u in used]


def packed(counts: DataFrame, lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD, shard: int = SHARD) -> DataFrame:
    """Packs (doc_id, n_tokens, fold) rows: (doc_id, piece, piece_start, n_tokens, shard, bin, bin_length, position).

    One row a piece; pieces of a document cover its tokens in order. Rows of no or null tokens take no place: bin, bin_length
    and position are null. fold tells rows of one id apart. Null ids and repeated rows are packed like any other, an empty
    table gives no rows.
    """
    lengths = tuple(sorted(set(lengths)))
    most = lengths[-1]
    rows = counts.select("doc_id", F.greatest(F.coalesce("n_tokens", F.lit(0)), F.lit(0)).cast("long").alias("n_tokens"), "fold")
    rows = cut(rows.groupBy("doc_id", "n_tokens", "fold").agg(F.count("*").alias("copies")))  # equal rows are numbered, so they spread
    shards = max(1, -(-(rows.agg(F.sum(F.col("n_tokens") * F.col("copies"))).first()[0] or 0) // shard))
    key = F.pmod(F.xxhash64("doc_id", "fold", "piece", "copy"), F.lit(shards))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")
    pieces = rows.select("doc_id", "n_tokens", "fold", "copy", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("n_tokens") / most) - 1).cast("int"))).alias("piece"))
    pieces = pieces.select("doc_id", "piece", "fold", "copy", (F.col("piece").cast("long") * most).alias("piece_start"), F.least(F.lit(most), F.col("n_tokens") - F.col("piece").cast("long") * most).alias("n_tokens"), key.alias("shard"))
    ready_for_python(counts.sparkSession)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "doc_id", "fold", "piece", "copy"], ascending=[False, True, True, True, True]).reset_index(drop=True)
        sizes = [int(n) for n in pdf.n_tokens if n > 0]
        bins, at, caps = pack(sizes, lengths, overhead)
        rest = [None] * (len(pdf) - len(sizes))
        new = {"bin": bins + rest, "bin_length": [caps[b] for b in bins] + rest, "position": at + rest}
        return pdf.drop(columns=["fold", "copy"]).assign(**{k: pd.array(v, "Int64") for k, v in new.items()})

    return pieces.groupBy("shard").applyInPandas(one, "doc_id long, piece int, piece_start long, n_tokens long, shard long, bin long, bin_length long, position long")
