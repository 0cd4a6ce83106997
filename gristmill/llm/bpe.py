"""Byte-level BPE by dynamic programming over byte prefixes.

Every prefix of a piece has exactly one valid encoding, and so exactly one last token; a table of those is all there is to
store. The last token of a prefix is the one that may stand after the last token of the prefix before it. Two tokens may
stand side by side if taking back their merges, the later one first, never meets a merge across the border that would
have come earlier. Appending bytes adds entries; an edit keeps the entries before it, and those after it from where the
table falls into step again.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import regex
import tiktoken
from pyspark.sql import DataFrame

from gristmill.llm.common import map_rows, texts
from gristmill.llm.units import Units

#: What a worker keeps: checked pairs of tokens.
PAIRS = 500_000


class Bpe:
    """Ranks of a vocabulary and what follows from them; ranks order merges and are the ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.longest = max(map(len, ranks))
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.made: dict[bytes, int] = {}  # the tokens that merges can make
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            self._learn(token, rank)
        self.sizes = {r: len(t) for t, r in self.made.items()}
        self.follows: dict[int, bool] = {}
        self.matcher = ahocorasick.Automaton()
        for token, rank in self.made.items():
            self.matcher.add_word(token.decode("latin-1"), rank)
        self.matcher.make_automaton()

    def check(self, a: int, b: int) -> bool:
        """may_follow, remembered."""
        if len(self.follows) > PAIRS:
            self.follows.clear()
        fits = self.follows[a << 32 | b] = self.may_follow(a, b)
        return fits

    def _learn(self, token: bytes, rank: int) -> None:
        if len(token) == 1:
            self.halves[rank] = (rank, rank)
            self.made[token] = rank
            return
        for k in range(len(token) - 1, 0, -1):
            a, b = self.made.get(token[:k]), self.made.get(token[k:])
            if a is not None and b is not None and a < rank and b < rank and self.may_follow(a, b):
                self.merged[a, b] = rank
                self.halves[rank] = (a, b)
                self.made[token] = rank
                return

    def may_follow(self, a: int, b: int) -> bool:
        """Whether tokens a and b stay apart when their joined bytes are encoded."""
        halves, merged = self.halves, self.merged
        bound = 1 << 62  # a merge across the border below this rank would have come first
        while True:
            across = merged.get((a, b))
            if across is not None and across < bound:
                return False
            # Take back the later of the two merges; on the right, ties go to the left one.
            whole_a, whole_b = halves[a][0] == a, halves[b][0] == b
            if a > b:
                if not whole_a:
                    bound, a = a, halves[a][1]
                elif not whole_b:
                    bound, b = b + 1, halves[b][0]
                else:
                    return True
            elif not whole_b:
                bound, b = b + 1, halves[b][0]
            elif not whole_a:
                bound, a = a, halves[a][1]
            else:
                return True

    def piece(self, data: bytes) -> list[int]:
        """Ids of one piece; a piece that is a token is that token, mergeable or not."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else Prefixes(self, data).ids()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Prefixes:
    """The table of one run of bytes: last[i] is the last token of its first i + 1 bytes."""

    def __init__(self, bpe: Bpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", []
        self.append(data)

    def append(self, data: bytes) -> None:
        """Go on with further bytes; what is there stays."""
        done = len(self.last)
        self.data += data
        self.last += [-1] * len(data)
        self._fill(done, len(self.data))

    def _fill(self, start: int, end: int) -> None:
        """Find the entries from start to end, of tokens that end there."""
        last, follows, sizes, ok = self.last, self.bpe.follows, self.bpe.sizes, self.bpe.check
        before = max(0, start + 1 - self.bpe.longest)
        for at, token in self.bpe.matcher.iter(self.data[before:end].decode("latin-1")):
            at += before
            if last[at] < 0:
                left = at - sizes[token]
                if left < 0:
                    last[at] = token
                else:
                    pair = last[left] << 32 | token
                    fits = follows.get(pair)
                    if ok(last[left], token) if fits is None else fits:
                        last[at] = token
        if -1 in last[start:end]:
            raise ValueError("the vocabulary lacks a single byte")

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put new in place of data[start:end]; gives how many entries were computed anew.

        Entries depend on the longest token's length of bytes and entries before them, so once that many in a row, all
        past the edit, are as they were, so are all others.
        """
        old, shift, edge = self.last, len(new) - (end - start), start + len(new)
        self.data, self.last = self.data[:start] + new + self.data[end:], old[:start]
        done = same = 0
        while len(self.last) < len(self.data):
            at = len(self.last)
            self.last.append(-1)
            self._fill(at, at + 1)
            done += 1
            same = same + 1 if at >= edge and self.last[at] == old[at - shift] else 0
            if same >= self.bpe.longest:
                self.last += old[len(self.last) - shift :]
        return done

    def ids(self) -> list[int]:
        out, end = [], len(self.last)
        while end:
            out.append(self.last[end - 1])
            end -= len(self.bpe.tokens[out[-1]])
        return out[::-1]


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """The vocabulary of a rank file: a base64 token and its rank a line."""
    with open(path, "rb") as f:
        return Bpe({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


#: A code point that no version of Unicode has given a meaning: neither letter nor number nor white space.
_NOTHING = "\uffff"


@lru_cache(maxsize=1)
def strangers() -> frozenset[str]:
    """Code points that are letters or numbers to regex, but not yet to the engine that tiktoken splits with.

    The two know different versions of Unicode. Candidates are those that Python's own tables, older than both, have not
    assigned; each is put to tiktoken with a vocabulary that shows the pieces: an a and the first byte of a letter merge, and
    so does an apostrophe with an s unless it ends a piece of signs.
    """
    blank = "".join(c for c in map(chr, (*range(0xD800), *range(0xE000, 0x110000))) if unicodedata.category(c) == "Cn")
    vocabulary = {bytes([b]): b for b in range(256)} | {b"'s": 256} | {b"a" + bytes([b]): b + 257 for b in range(0xC2, 0xF5)}
    ask = tiktoken.Encoding("probe", pat_str=r"'s| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+", mergeable_ranks=vocabulary, special_tokens={}).encode_ordinary
    return frozenset(c for c in regex.findall(r"[\p{L}\p{N}]", blank) if ask("a" + c)[0] < 256 and ask(c + "'s")[-1] != 256)


class Encoder:
    """Texts to ids: pieces by a pattern, each encoded for itself."""

    def __init__(self, path: str, pattern: str):
        self.bpe, self.pattern = load(path), regex.compile(pattern)
        self.texts = Units(self._many, self._pieces)

    def split(self, text: str) -> list[str]:
        """The matches of the pattern, with the letters and numbers that tiktoken knows."""
        if text.isascii() or (new := strangers()).isdisjoint(text):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer("".join(_NOTHING if c in new else c for c in text))]

    def _pieces(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        cut = [self.split(t) for t in texts]
        return [p for c in cut for p in c], np.array([len(c) for c in cut], np.int64)

    def _many(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each piece has."""
        ids = [self.bpe.piece(p.encode()) for p in pieces]
        return np.array([i for x in ids for i in x], np.uint32), np.array([len(x) for x in ids], np.int64)


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row. Null and empty texts have no ids; null ids and repeated rows keep their rows; an
    empty table gives no rows; extra columns are ignored."""

    def make():
        enc = _encoder(path, pattern)
        return lambda c: (c[0], [x.astype("int32") for x in enc.texts(c[1])])

    return map_rows(texts(docs, id_col, text_col, binary=False), make, "doc_id long, ids array<int>")


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: of the ids, and of the bytes they decode to.

    Null and empty texts have no ids. Null ids and repeated rows keep their rows; an empty table gives no rows; extra
    columns are ignored. The vocabulary file is read where the tasks run.
    """

    def make():
        enc = _encoder(path, pattern)

        def act(c: list) -> tuple:
            n, ids_hash, text_hash = [], [], []
            for ids in enc.texts(c[1]):
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                text_hash.append(hashlib.sha256(enc.bpe.decode(ids.tolist())).hexdigest())
            return c[0], n, ids_hash, text_hash

        return act

    return map_rows(texts(docs, id_col, text_col, binary=False), make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
