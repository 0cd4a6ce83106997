"""Token ids in a content-addressed store.

Each document's ids (with an end id) are cut into chunks where a rolling hash over the last WINDOW ids says so, so equal
passages give equal chunks wherever they stand. The store is a folder:

- chunks/   key (BLAKE2b of the chunk's bytes), data: the ids as little-endian integers of `width` bytes. Each key once. Beside
            them, in columns of their own, the recipes as they were made.
- recipes/  one file a range of ids, in ascending doc_id: part, doc_id, local_start, n_tokens, recipe (the chunks' keys in a
            row), root (the Merkle root of the keys). local_start counts the ids before the document in its part.
- manifest/ part, n_docs, n_tokens, start (the ids of all parts before), root (the Merkle root of the documents' roots).

Whoever reads checks each chunk against its key, each recipe against its root and each part against the manifest, and
stops at the first that doesn't fit.
"""

from __future__ import annotations

import string
import uuid
import zlib
from bisect import bisect_left
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm.common import map_rows, texts
from gristmill.llm.units import Units
from gristmill.session import cut, ready_for_python, shared_dir

WINDOW, LEAST, MOST, MASK, END, KEY = 4, 128, 8192, (1 << 10) - 1, 0, 16
_MIX = np.uint64(0x9E3779B97F4A7C15)
_POWERS = [np.uint64(pow(0x5851F42D4C957F2D, k, 1 << 64)) for k in range(WINDOW)]


class Encoder:
    """Texts to ids with a tokenizer file of the tokenizers library; short units of a text are encoded once."""

    def __init__(self, path: str, counting: bool = False):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tok, self.words = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.words.pre_tokenizer = WhitespaceSplit()  # for single pieces, spelled in the vocabulary's letters for bytes
        self.gap = self.words.token_to_id(_byte_letters()[10])
        self.texts = Units(self._many, self._pieces, counting)

    def _pieces(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Lines of letters, with a space before and signs after or without, are cut into these and line ends; others aren't."""
        out: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        for k, t in enumerate(texts):
            before = len(out)
            for line in t.split("\n"):
                word = line.rstrip(_STOPS)
                if not (word[1:] if word[:1] == " " else word).isalpha():
                    del out[before:]
                    out.append(t)
                    break
                out.append(word)
                if len(word) < len(line):
                    out.append(line[len(word) :])
                out.append("\n")
            else:
                out.pop()
            counts[k] = len(out) - before
        return out, counts

    def _many(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each piece has."""
        plain = np.array([(p[1:] if p[:1] == " " else p).isalpha() for p in pieces], bool)
        one, one_sizes = self._lettered([p for p, x in zip(pieces, plain.tolist()) if x])
        two = [e.ids for e in self.tok.encode_batch_fast([p for p, x in zip(pieces, plain.tolist()) if not x], add_special_tokens=False)]
        sizes = np.zeros(len(pieces), np.int64)
        sizes[plain], sizes[~plain] = one_sizes, [len(x) for x in two]
        ids, which = np.zeros(int(sizes.sum()), np.uint32), np.repeat(plain, sizes)
        ids[which], ids[~which] = one, [i for x in two for i in x]
        return ids, sizes

    def _lettered(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letters, perhaps with a space before them: pieces of the pattern already."""
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        spelled = "\n\0\n".join(parts).encode().decode("latin-1").translate(_LETTERS)
        ids = np.array(self.words.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(ids == self.gap)
        if len(ends) != len(parts) - 1:
            raise ValueError("the vocabulary has no token of its own for a line end")
        return np.delete(ids, ends), np.diff(np.concatenate([[-1], ends, [len(ids)]])) - 1


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write for bytes: printable ones for themselves, the others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(others)}


_STOPS = string.punctuation  # after letters, any run of these is one piece of the pattern
#: For translate(): pieces stand in lines, and a zero byte stands for the piece that is a line end.
_LETTERS = _byte_letters() | {0: _byte_letters()[10], 10: "\n"}


@lru_cache(maxsize=2)
def encoder(path: str, counting: bool = False) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path, counting)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = 1) -> DataFrame:
    """(doc_id, n_tokens, fold): ids of each row's text and end more; fold is a hash of the text.

    Null texts are empty. Null ids and repeated rows keep their rows, an empty table gives none, other columns are ignored.
    """

    def make():
        enc = encoder(path, True)
        return lambda c: (c[0], [n + end for n in enc.texts(c[1])], [zlib.crc32(t.encode()) for t in c[1]])

    return map_rows(texts(docs, id_col, text_col, binary=False), make, "doc_id long, n_tokens long, fold long")


def boundaries(ids: np.ndarray, sizes: list[int]) -> list[list[int]]:
    """Ends of the chunks of id streams of these sizes, which stand in a row, by the rolling hash of the last WINDOW ids;
    LEAST to MOST ids each but the last. A stream's windows never matter before its place LEAST, so none reach into another."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
    x ^= x >> np.uint64(29)
    h = np.zeros(len(ids), np.uint64)
    for k, p in enumerate(_POWERS):
        h[WINDOW - 1 :] += x[WINDOW - 1 - k : len(ids) - k] * p
    marks = (np.flatnonzero((h >> np.uint64(40)) & np.uint64(MASK) == 0) + 1).tolist()
    out, start, k = [], 0, 0
    for n in sizes:
        ends, at = [], 0
        while n - at > LEAST:
            k = bisect_left(marks, start + at + LEAST, k)
            at = min(marks[k] - start if k < len(marks) else n, at + MOST, n)
            ends.append(at)
        if at < n:
            ends.append(n)
        out.append(ends)
        start += n
    return out


def merkle(keys: list[bytes]) -> bytes:
    """Root of a binary hash tree; an odd last node goes up as it is. No keys: the hash of nothing."""
    level = keys or [blake2b(b"", digest_size=KEY).digest()]
    while len(level) > 1:
        pairs = [blake2b(b"\x01" + a + b, digest_size=KEY).digest() for a, b in zip(level[::2], level[1::2])]
        level = pairs + level[len(pairs) * 2 :]
    return level[0]


def _split(raw: bytes, size: int = KEY) -> list[bytes]:
    return [raw[i : i + size] for i in range(0, len(raw), size)]


def write(docs: DataFrame, path: str, folder: str, width: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode all rows into a store at folder and give its manifest. Ids of more than width bytes end it with an error.

    Null texts are empty (the end id alone). Null ids come first; rows that repeat an id stand in the order of their keys.
    An empty table gives a store without documents. Extra columns are ignored.
    """
    spark = docs.sparkSession
    ready_for_python(spark)

    def cutter():
        enc, kind, seen = encoder(path), f"<u{width}", set()

        end = np.array([END], np.uint32)

        def act(c: list) -> tuple:
            rows = []
            lists = list(enc.texts(c[1]))
            sizes = [len(x) + 1 for x in lists]
            ids, start = np.concatenate([part for x in lists for part in (x, end)]), 0
            if int(ids.max()) >> 8 * width:
                raise ValueError(f"ids need more than {width} bytes")
            raw = ids.astype(kind).tobytes()
            for doc, n, ends in zip(c[0], sizes, boundaries(ids, sizes)):
                at, keys = 0, []
                for e in ends:
                    data = raw[(start + at) * width : (start + e) * width]
                    keys.append(blake2b(data, digest_size=KEY).digest())
                    if keys[-1] not in seen:
                        seen.add(keys[-1])
                        rows.append((keys[-1], None, e - at, data, None))
                    at = e
                rows.append((None, doc, n, None, b"".join(keys)))
                start += n
            return tuple(map(list, zip(*rows)))

        return act

    def unique(batches):
        seen = set()
        for b in batches:
            keys = b.column("key").to_pylist()
            keep = []
            for k in keys:
                keep.append(k is None or k not in seen)
                if k is not None:
                    seen.add(k)
            yield b.filter(pa.array(keep, pa.bool_()))

    rows = map_rows(texts(docs, id_col, text_col, binary=False), cutter, _DATA)
    dealt = rows.repartition(F.xxhash64("key", "recipe", "doc_id"))  # nulls don't count: copies of a chunk meet, recipes spread
    dealt.mapInArrow(unique, _DATA).write.option("compression", "zstd").parquet(f"{folder}/chunks")

    def laid(batches):
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            n = np.array(b.column("n_tokens").to_pylist(), np.int64)
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            roots = [merkle(_split(r)) for r in b.column("recipe").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(n), pa.int32()), b.column("doc_id"), pa.array(starts, pa.int64()), b.column("n_tokens"), b.column("recipe"), pa.array(roots, pa.binary())], ["part", "doc_id", "local_start", "n_tokens", "recipe", "root"])

    recipes = _data(spark, folder).filter("recipe IS NOT NULL").select("doc_id", F.col("n").alias("n_tokens"), "recipe")
    ordered = recipes.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "recipe")
    ordered.mapInArrow(laid, "part int, doc_id long, local_start long, n_tokens long, recipe binary, root binary").write.parquet(f"{folder}/recipes")
    sums = {}
    for r in _recipe_roots(spark, folder).toLocalIterator():  # a row a file
        sums[r["part"]] = (r["part"], r["n_docs"], r["n_tokens"], bytes(r["root"]))
    rows, start = [], 0
    for k in sorted(sums):
        rows.append((*sums[k][:3], start, sums[k][3]))
        start += sums[k][2]
    manifest = "part int, n_docs long, n_tokens long, start long, root binary"
    spark.createDataFrame(rows, manifest).coalesce(1).write.parquet(f"{folder}/manifest")
    return spark.read.schema(manifest).parquet(f"{folder}/manifest")


#: A row of chunks/: a chunk (key, n, data), or a document's recipe before it is put in order (doc_id, n, recipe).
_DATA = "key binary, doc_id long, n long, data binary, recipe binary"


def _data(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_DATA).parquet(f"{folder}/chunks")


def _recipes(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("part int, doc_id long, local_start long, n_tokens long, recipe binary, root binary").parquet(f"{folder}/recipes")


def _recipe_roots(spark: SparkSession, folder: str) -> DataFrame:
    """(part, n_docs, n_tokens, root) of each recipe file as it is read."""
    ready_for_python(spark)

    def total(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("local_start")
        n, roots = rows.column("n_tokens").to_pylist(), rows.column("root").to_pylist()
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([len(n)], pa.int64()), pa.array([sum(n)], pa.int64()), pa.array([merkle(roots)], pa.binary())], ["part", "n_docs", "n_tokens", "root"])

    return _recipes(spark, folder).select("part", "local_start", "n_tokens", "root").groupBy("part").applyInArrow(total, "part int, n_docs long, n_tokens long, root binary")


def digests(spark: SparkSession, folder: str, width: int = 2) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from a store and verified on the way.

    A chunk is read once, checked against its key, and gives the crc32 of its ids as 32-bit integers; a document's crc32 is
    put together from those of its chunks in the recipe's order, so no ids travel.
    """
    ready_for_python(spark)

    def checked(c: list) -> tuple:
        sums = []
        for key, data in zip(*c):
            if blake2b(data, digest_size=KEY).digest() != key:
                raise ValueError(f"chunk {key.hex()} doesn't fit its key")
            sums.append(zlib.crc32(np.frombuffer(data, f"<u{width}").astype("<u4").tobytes()))
        return c[0], [len(d) // width for d in c[1]], sums

    chunks = map_rows(_data(spark, folder).filter("key IS NOT NULL").select("key", "data"), lambda: checked, "key binary, m long, crc long")
    manifest = spark.read.schema("part int, n_docs long, n_tokens long, start long, root binary").parquet(f"{folder}/manifest")
    found = _recipe_roots(spark, folder).select("part", F.col("root").alias("found"))
    parts = manifest.join(found, "part", "left").select("part", F.when(F.col("root") == F.col("found"), F.col("start")).otherwise(F.raise_error(F.lit("a part doesn't fit the manifest")).cast("long")).alias("base"))
    recipes = _recipes(spark, folder)
    piece = recipes.select("part", "local_start", F.posexplode(F.transform(F.sequence(F.lit(0), (F.octet_length("recipe") / KEY).cast("int") - 1), lambda i: F.substring("recipe", i * KEY + 1, F.lit(KEY)))).alias("pos", "key"))
    joined = piece.join(chunks, "key").groupBy("part", "local_start").agg(F.sort_array(F.collect_list(F.struct("pos", "key", "m", "crc"))).alias("chunks"))
    kept = recipes.join(joined, ["part", "local_start"], "left").join(F.broadcast(parts), "part")
    cols = kept.select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "root", F.col("chunks.key").alias("keys"), F.col("chunks.m").alias("m"), F.col("chunks.crc").alias("crc"))

    def together(c: list) -> tuple:
        sums = []
        for doc, n, root, keys, m, crc in zip(c[0], *c[2:]):
            if keys is None or sum(m) != n or merkle(keys) != root:
                raise ValueError(f"document {doc} can't be put together from its recipe")
            total = 0
            for k, x in zip(m, crc):
                total = crc_join(total, x, 4 * k)
            sums.append(total)
        return c[0], c[1], c[2], sums

    return map_rows(cols, lambda: together, "doc_id long, start long, n_tokens long, ids_crc32 long")


def reconstruct(spark: SparkSession, folder: str, width: int = 2) -> DataFrame:
    """(doc_id, ids array<int>) of every document of a store, with the end id. A row for each row that was written, null ids
    and repeated rows too; none from an empty store."""
    recipes = _recipes(spark, folder)
    piece = recipes.select("part", "local_start", "doc_id", F.posexplode(F.transform(F.sequence(F.lit(0), (F.octet_length("recipe") / KEY).cast("int") - 1), lambda i: F.substring("recipe", i * KEY + 1, F.lit(KEY)))).alias("pos", "key"))
    whole = piece.join(_data(spark, folder).filter("key IS NOT NULL").select("key", "data"), "key").groupBy("part", "local_start", "doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", "data"))).alias("x"))
    return map_rows(whole.select("doc_id", F.col("x.data").alias("data")), lambda: lambda c: (c[0], [np.frombuffer(b"".join(d), f"<u{width}").astype("int32") for d in c[1]]), "doc_id long, ids array<int>")


def _times(a: int, b: int) -> int:
    """Product of two bit polynomials modulo that of crc32, bits reversed."""
    m, p = 1 << 31, 0
    while a:
        if a & m:
            p ^= b
            a ^= m
        m >>= 1
        b = (b >> 1) ^ 0xEDB88320 if b & 1 else b >> 1
    return p


@lru_cache(maxsize=1 << 14)
def _shift(n: int) -> int:
    """x to the power 8 n, modulo the polynomial."""
    p, square, n = 1 << 31, 1 << 23, n
    while n:
        if n & 1:
            p = _times(square, p)
        square, n = _times(square, square), n >> 1
    return p


def crc_join(a: int, b: int, length: int) -> int:
    """crc32 of two byte strings in a row from theirs; length is the second's."""
    return _times(_shift(length), a) ^ b


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared store."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stored(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """digests() of a store of docs that is written to the shared folder, read back and removed."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/gristmill-store-{uuid.uuid4().hex}"
    try:
        write(docs, path, folder, id_col=id_col, text_col=text_col)
        return cut(digests(spark, folder))
    finally:
        remove(spark, folder)
