"""Language-model scores by online logistic mixing of hashed-context bit predictors, over passages that the corpus repeats.

A text is its lower-cased words and an end. Of the counted words, the HEAD most frequent (all with at least some count, which
is above one, so that training has words without a code too) have a code: words in byte order, split by their mass into 256
classes, so a class is eight binary decisions of about a bit each, and the word in its class has its share of the class. Any
other word is an escape and its bytes, eight decisions each.

Each decision is predicted from several contexts: the classes of one, two and three words before (the last hashed), or the
one, two and three bytes before (the last two hashed). The counts of all training documents are summed, task by task, to
one table for each context. A mixer adds the predictions' log odds with weights; which set of weights is used (the gate)
depends on the level of the decision and on how often its context was seen. All documents start with the same weights. While a document is read, the errors of each block of decisions move the weights and a bias for the next.

The mixed probability is refined passage by passage. Hashes of two words in a row say where a passage ends (LENGTH words on
average), so equal texts have equal passages wherever they stand. All passages of the training documents are counted by the
hash of their words. A passage's probability is a mixture of that of its words and of its share of all passages; what the
share weighs is learned while the document is read, from how many of its passages so far occur elsewhere. A training
document's own passages don't count for it.

Counts of all words and passages stay a distributed table, which grows with the corpus. Head words are looked up where a text
is read; other words, rare by construction, and passages are joined.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import LOWER, fold, give_back, texts
from gristmill.session import cut, ready_for_python

HELD_PARTS, HELD = 5, 1
#: Most head words; bytes of text looked at together; slots summed in one row; tokens of a passage on average (a power of two).
HEAD, AT_ONCE, SLOTS, LENGTH = 1 << 19, 1 << 20, 1 << 16, 32
LEAST, BIAS, WAITING = 2, 0.25, 4_000_000
#: Gates: how often the context of two symbols was seen, fewer times than each of these or more.
SEEN = (2, 16, 256)
#: Hits and passages that a document starts with: what the shares of passages weigh is the share of hits.
HITS, PASSAGES = 0.2, 2.0
END = b"\n"  # no word has a line end; a passage's key is one, and eight bytes


class Stream:
    """One kind of symbols: its decisions and contexts. A context table has 2**bits slots: rooms of 256 symbols, or of their decisions."""

    levels = 8

    def __init__(self, tables: tuple[int, ...], block: int, rate: float, start: tuple[tuple[float, ...], ...]):
        self.tables, self.block, self.rate, self.start = tables, block, rate, np.array(start, np.float32)
        self.size = sum(1 << t for t in tables)

    def rooms(self, history: list[np.ndarray]) -> list[np.ndarray]:
        """First slot in each table of the contexts of one, two ... symbols before (history[0] is the last symbol)."""
        out, h = [], np.zeros(len(history[0]), np.int64)
        for past, bits in zip(history, self.tables):
            h = (h << self.levels) | past
            rooms = 1 << (bits - self.levels)
            key = h if h.size and rooms > 1 << (self.levels * (len(out) + 1) - 1) else (h * 0x9E3779B1 & 0x7FFFFFFF) >> 7
            out.append((key & (rooms - 1)) << self.levels)
        return out

    def blocks(self, place: np.ndarray) -> np.ndarray:
        """Each place's block. The first block is dealt out in parts that double, so that short texts move the weights too."""
        return np.where(place < self.block, np.digitize(place, (self.block // 8, self.block // 4, self.block // 2)), 3 + place // self.block)


#: The weights that documents start with, of the three predictors and the bias, by gate: long contexts weigh little while
#: they are rare. They are parameters like the rates, rounded from what suits sf0.1, and move while a document is read.
WORDS = Stream((16, 20, 20), 128, 0.01, ((0.75, 0.2, 0.1, 0.0), (0.75, 0.25, 0.1, 0.0), (0.7, 0.4, 0.2, 0.0), (0.6, 0.5, 0.7, 0.0)))
BYTES = Stream((16, 20, 20), 256, 0.002, ((0.8, 0.2, 0.1, 0.0), (0.5, 0.5, 0.1, 0.0), (0.1, 0.8, 0.3, 0.0), (0.0, 0.5, 0.5, 0.0)))
_LEVELS = np.arange(Stream.levels)[:, None]
#: [level, symbol]: the node of the code tree where the level's decision is taken; 1 if a one bit follows there, else -1.
NODE = ((1 << _LEVELS) | (np.arange(256) >> (Stream.levels - _LEVELS))).astype(np.int32)
SIGN = ((np.arange(256) >> (Stream.levels - 1 - _LEVELS) & 1) * 2 - 1).astype(np.float32)


class Sums:
    """Counts of a stream's symbols by context; slots wait until there are many, as each count goes over whole tables."""

    def __init__(self, stream: Stream, into: np.ndarray):
        self.stream, self.into, self.held, self.waiting = stream, into, [], 0

    def add(self, symbols: np.ndarray, history: list[np.ndarray]) -> None:
        self.held.append([(first + symbols).astype(np.uint32) for first in self.stream.rooms(history)])
        self.waiting += len(symbols)
        if self.waiting > WAITING:
            self.flush()

    def flush(self) -> None:
        at = 0
        for k, bits in enumerate(self.stream.tables if self.held else ()):
            slots = np.concatenate([h[k] for h in self.held])
            self.into[at : at + (1 << bits)] += np.bincount(slots, minlength=1 << bits).astype(self.into.dtype)
            at += 1 << bits
        self.held, self.waiting = [], 0


def decided(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of zero and of one bits at every node of every room's code tree, from the room's counts of symbols."""
    rooms = symbols.reshape(-1, 256).astype(np.float32)
    zero, one = np.zeros_like(rooms), np.zeros_like(rooms)
    for level in range(Stream.levels - 1, -1, -1):
        zero[:, 1 << level : 2 << level], one[:, 1 << level : 2 << level] = rooms[:, ::2], rooms[:, 1::2]
        rooms = rooms[:, ::2] + rooms[:, 1::2]
    return zero.ravel(), one.ravel()


class Mixer:
    """Predictors of a stream from summed counts, and the weights that documents start with."""

    def __init__(self, stream: Stream, counts: np.ndarray):
        self.stream, self.odds = stream, []
        at = 0
        for bits in stream.tables:
            zero, one = decided(counts[at : at + (1 << bits)])
            self.odds.append(np.log((one + np.float32(0.4)) / (zero + np.float32(0.4))))
            if len(self.odds) == 2:
                self.gates = np.digitize(zero + one, SEEN).astype(np.uint8)
            at += 1 << bits

    def log_prob(self, symbols: np.ndarray, history: list[np.ndarray], doc: np.ndarray, place: np.ndarray, docs: int) -> np.ndarray:
        """Natural log of each symbol's probability. doc: each symbol's document, ascending; place: its place there.

        Blocks of the same number are read together for all documents; each document has its own weights.
        """
        st, out, sets = self.stream, np.zeros(len(symbols), np.float32), Stream.levels * len(self.stream.start)
        w = [np.tile(k, docs * Stream.levels) for k in st.start.T]
        rooms, bias, rate = [r.astype(np.int32) for r in st.rooms(history)], np.float32(BIAS), np.float32(st.rate)
        block = st.blocks(place)
        last = np.zeros(docs, np.int64)
        last[doc] = block  # of each document, as places ascend in it
        order = np.argsort(block, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(block[order])) + 1) if len(order) else ():
            mine, whose = symbols[rows], doc[rows]
            node, sign = NODE[:, mine], SIGN[:, mine]
            slots = [r[rows] + node for r in rooms]
            x = [t.take(s) for t, s in zip(self.odds, slots)]
            gate = self.gates.take(slots[1]) + (whose * sets + _LEVELS * len(st.start))
            z = w[-1].take(gate) * bias
            for wk, xk in zip(w, x):
                z += wk.take(gate) * xk
            e = np.exp(np.clip(z, -12, 12) * -sign)  # the odds of the bit that doesn't follow
            more = 1 + e
            half = st.levels // 2  # products of so many stay within single precision
            out[rows] = -np.log(np.multiply.reduce(more[:half])) - np.log(np.multiply.reduce(more[half:]))
            goes_on = last[whose] > block[rows[0]]
            if goes_on.any():
                error = e * sign * rate / more
                if not goes_on.all():
                    error, gate, x = error[:, goes_on], gate[:, goes_on], [xk[:, goes_on] for xk in x]
                gate = gate.ravel()
                for wk, xk in zip(w, x):
                    wk += np.bincount(gate, (error * xk).ravel(), len(wk)).astype(np.float32)
                w[-1] += np.bincount(gate, (error * bias).ravel(), len(w[-1])).astype(np.float32)
        return out


def _history(symbols: np.ndarray, place: np.ndarray, depth: int = 3) -> list[np.ndarray]:
    """The symbols one, two ... places before; zero before a document's start."""
    s = symbols.astype(np.int64)
    return [np.where(place >= d, np.concatenate([np.zeros(min(d, len(s)), np.int64), s[: max(0, len(s) - d)]]), 0) for d in range(1, depth + 1)]


_EIGHT = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xBF58476D1CE4E5B9)
_GAP = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
#: Bytes of a word that its two numbers have room for.
SHORT = 15


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _C
    return h ^ (h >> np.uint64(29))


def _numbers(raw: bytes, starts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers of each word: all bytes and the length of a short word, the first and last eight bytes of a longer one."""
    eight = np.ndarray(len(raw) + 1, "<u8", raw + bytes(8), strides=(1,))  # the eight bytes from each place on
    low = eight[starts] & _EIGHT[np.minimum(n, 8)]
    high = eight[np.minimum(starts + 8, len(raw))] & _EIGHT[np.clip(n - 8, 0, 7)]
    long = np.flatnonzero(n > SHORT)
    high[long] = _mixed(eight[starts[long] + n[long] - 8]) >> np.uint64(8)
    return low, high | np.minimum(n, 255).astype(np.uint64) << np.uint64(56)


class Words:
    """The lower-cased words of some texts, found in all of them at once, and their tokens: words, and an end of each text."""

    def __init__(self, some: list[bytes]):
        self.raw = b"\n".join(some).translate(LOWER)
        gap = _GAP[np.frombuffer(self.raw + b"\n", np.uint8)]
        edges = np.flatnonzero(np.diff(gap, prepend=True))
        self.starts, self.ends = edges[::2], edges[1::2]
        sizes = np.array([len(t) + 1 for t in some], np.int64)
        self.tokens = np.diff(np.searchsorted(self.starts, np.concatenate([[0], np.cumsum(sizes)]))) + 1  # of each text
        self.last = np.cumsum(self.tokens) - 1
        self.inner = np.ones(int(self.tokens.sum()), bool)  # the tokens that are words
        self.inner[self.last] = False
        self.low, self.high = _numbers(self.raw, self.starts, self.ends - self.starts)

    def bytes(self, which: np.ndarray) -> list[bytes]:
        return [self.raw[a:e] for a, e in zip(self.starts[which].tolist(), self.ends[which].tolist())]

    def passages(self) -> tuple[np.ndarray, np.ndarray]:
        """The tokens at which passages begin, and the passages' hashes."""
        h = np.full(len(self.inner), _A)
        h[self.inner] = _mixed(self.low * _A ^ self.high * _B)
        before = np.concatenate([h[:1], h[:-1]])
        before[self.last + 1 - self.tokens] = _A  # a text's first word comes after an end
        ends = _mixed(h * _B + before) & np.uint64(LENGTH - 1) == 0
        ends[self.last] = True
        start = np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1])
        place = np.arange(len(h)) - np.repeat(start, np.diff(np.append(start, len(h))))
        return start, _mixed(np.add.reduceat(_mixed(h + place.astype(np.uint64) * _A), start))


def _keys(hashed: np.ndarray) -> list[bytes]:
    """Passages' hashes as they stand among the counted words."""
    raw = hashed.astype("<u8").tobytes()
    return [END + raw[i : i + 8] for i in range(0, len(raw), 8)]


class Vocabulary:
    """Head words with counts, the end, and an escape for all others; codes follow from the counts.

    Ids are the places of head words in byte order, then the end, then the escape. Short words are found by their numbers,
    in a table with room for four times as many; longer ones by their bytes.
    """

    def __init__(self, words: list[bytes], counts: np.ndarray, total: int, distinct: int, ends: int):
        order = sorted(range(len(words)), key=words.__getitem__)
        self.words, self.counts = b"\n".join(words[j] for j in order), counts[order]
        self.total, self.distinct, self.ends, self.slots = total, distinct, ends, None

    def ready(self) -> Vocabulary:
        """Codes and the table, which aren't sent but made where they are needed."""
        if self.slots is None:
            n = self.counts.astype(float)
            mass = np.concatenate([n, [self.ends + 1, max(0, self.total - self.ends - n.sum()) + 1]])
            middle = (np.cumsum(mass) - mass / 2) / mass.sum()
            self.classes = np.minimum(255, (middle * 256).astype(np.int64))
            self.share = np.log(mass / np.bincount(self.classes, mass, 256)[self.classes])
            self.base = self.log_base(np.concatenate([n, [self.ends]]))
            head = Words([self.words])
            self.low, self.high = head.low, head.high
            long = np.flatnonzero(head.ends - head.starts > SHORT)
            self.long = dict(zip(head.bytes(long), long.tolist()))
            self.bits = max(4, 2 + len(n).bit_length())
            self.slots, rest = np.full(1 << self.bits, -1, np.int32), np.flatnonzero(head.ends - head.starts <= SHORT)
            place = self._place(self.low[rest], self.high[rest])
            while len(rest):
                free = self.slots[place] < 0
                self.slots[place[free]] = rest[free]
                lost = self.slots[place] != rest
                rest, place = rest[lost], (place[lost] + 1) & (len(self.slots) - 1)
        return self

    def _place(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (_mixed(low * _A ^ high * _B) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, words: Words) -> np.ndarray:
        """The ids of words; the escape for those that aren't in the head."""
        low, high = words.low, words.high
        out = np.full(len(low), len(self.counts) + 1, np.int64)
        rest, place = np.arange(len(low)), self._place(low, high)
        while len(rest):
            at = self.slots[place]
            same = (at >= 0) & (self.low[at] == low[rest]) & (self.high[at] == high[rest]) if len(self.low) else at >= 0
            out[rest[same]] = at[same]
            on = (at >= 0) & ~same
            rest, place = rest[on], (place[on] + 1) & (len(self.slots) - 1)
        long = np.flatnonzero(words.ends - words.starts > SHORT)
        out[long] = np.fromiter(map(self.long.get, words.bytes(long), repeat(len(self.counts) + 1)), np.int64, len(long))
        return out

    def log_base(self, count):
        """log10 of the base probability of tokens with these counts."""
        return np.log10((count + 0.5) / (self.total + 0.5 * (self.distinct + 1)))

    def read(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes], np.ndarray]:
        """Ids of all tokens, their document and place; the words escaped, and which tokens they are."""
        doc = np.repeat(np.arange(len(words.tokens)), words.tokens)
        place = np.arange(len(doc)) - (words.last + 1 - words.tokens)[doc]
        ids = np.full(len(doc), len(self.counts), np.int64)
        ids[words.inner] = found = self.find(words)
        out = np.flatnonzero(found == len(self.counts) + 1)
        return ids, doc, place, words.bytes(out), np.flatnonzero(words.inner)[out]


def _spelled(words: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Bytes of escaped words, a space after each: symbols, their history in the word, and which word's they are."""
    raw = np.frombuffer(b" ".join(words) + b" " if words else b"", np.uint8).astype(np.int64)
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    inside = np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return raw, _history(raw, inside, len(BYTES.tables)), np.repeat(np.arange(len(words)), sizes)


def _groups(rows: list[bytes]) -> Iterator[list[bytes]]:
    """Runs of texts of about AT_ONCE bytes."""
    held, size = [], 0
    for t in rows:
        held.append(t)
        size += len(t)
        if size > AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


class Model:
    """What texts are read with: the head words, and the predictors of both streams."""

    def __init__(self, vocabulary: Vocabulary, counts: np.ndarray):
        self.vocabulary = vocabulary
        self.words, self.bytes = Mixer(WORDS, counts[: WORDS.size]), Mixer(BYTES, counts[WORDS.size :])

    def token_logs(self, read: tuple, n: int) -> np.ndarray:
        """Natural log of each token's mixed probability, from what the vocabulary read of n documents."""
        v, (ids, doc, place, rare, at) = self.vocabulary, read
        symbols = v.classes[ids]
        out = self.words.log_prob(symbols, _history(symbols, place), doc, place, n) + v.share[ids]
        raw, history, of = _spelled(rare)
        whose = doc[at][of]
        where = np.arange(len(raw)) - np.searchsorted(whose, np.arange(n))[whose]
        out[at] += np.bincount(of, self.bytes.log_prob(raw, history, whose, where, n), len(rare))
        return out

    def score(self, some: list[bytes], learned: np.ndarray) -> dict[str, np.ndarray]:
        """A document's columns, and found: what is looked up, its rare words and its passages (p: natural log of the mixed
        probability, own: how often the counts have it from the document itself, which they do if it was learned from)."""
        v, n, words = self.vocabulary.ready(), len(some), Words(some)
        ids, doc, place, rare, at = read = v.read(words)
        start, hashed = words.passages()
        p = np.add.reduceat(self.token_logs(read, n), start)
        whose = doc[start]
        _, which, times = np.unique(np.stack([whose.astype(np.uint64), hashed]), axis=1, return_inverse=True, return_counts=True)
        own = np.where(learned[whose], times[which.ravel()], 0)
        known = ids < len(v.base)
        order = np.argsort(np.concatenate([doc[at], whose]), kind="stable")
        keys, empty = rare + _keys(hashed), np.full(len(rare), -1)
        columns = (pa.array([keys[i] for i in order.tolist()], pa.binary()), *(pa.array(np.concatenate([a, b])[order]) for a, b in ((empty, place[start]), (empty * 0.0, p), (empty, own))))
        sizes = np.bincount(doc[at], minlength=n) + np.bincount(whose, minlength=n)
        return {
            "n_tokens": np.bincount(doc, minlength=n),
            "sure": np.bincount(doc[known & ((ids < len(v.counts)) | (v.ends > 0))], minlength=n),
            "base": np.bincount(doc[known], v.base[ids[known]], n),
            "found": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.StructArray.from_arrays(columns, ["word", "place", "p", "own"])),
        }


def _counted(docs: DataFrame) -> DataFrame:
    """(word binary, n): words and passages of training documents, and END once a document; summed in tasks first."""

    def count(batches):
        from collections import Counter

        sums: Counter = Counter()
        for b in batches:
            for some in _groups(b.column("text").to_pylist()):
                words = Words(some)
                sums.update(words.raw.split())
                sums[END] += len(some)
                sums.update(_keys(words.passages()[1]))
            if len(sums) > 1_000_000:
                yield _pairs(sums)
                sums = Counter()
        yield _pairs(sums)
        give_back()

    return docs.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).filter("n > 0")


def _pairs(sums) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.binary()), pa.array(list(sums.values()), pa.int64())], ["word", "n"])


def _vocabulary(counts: DataFrame, head: int) -> tuple[Vocabulary, int]:
    """Totals and head words, and the number of passages. The head is all words from the smallest count on that at most head
    words reach; counts from 1024 on are told apart by their first eleven binary digits, so the driver sees a bounded table."""
    passage = F.substring("word", 1, 1) == F.lit(END)
    digits = F.greatest(F.lit(0), F.length(F.bin("n")) - 11)
    rough = F.col("n") - F.col("n") % F.call_function("shiftleft", F.lit(1).cast("long"), digits.cast("int"))
    sizes = counts.groupBy((passage & (F.col("word") != F.lit(END))).alias("passage"), rough.alias("least")).agg(F.count("*").alias("k"), F.sum("n").alias("n")).collect()
    words, least, room = sorted((r for r in sizes if not r["passage"]), key=lambda r: -r["least"]), 1 << 62, head
    for r in words:
        room -= r["k"]
        if room < 0 or r["least"] < LEAST:
            break
        least = r["least"]
    rows = counts.filter(~passage & (F.col("n") >= least)).toPandas().sort_values("word")  # at most head rows
    ends = counts.filter(F.col("word") == F.lit(END)).first()
    total, distinct = sum(r["n"] for r in words), sum(r["k"] for r in words)
    return Vocabulary([bytes(w) for w in rows.word], rows.n.to_numpy(np.int64), total, distinct, ends["n"] if ends else 0), sum(r["n"] for r in sizes if r["passage"])


def _tables(docs: DataFrame, vocabulary) -> np.ndarray:
    """Summed counts of both streams' symbols by slot; parts of them are added up in two rounds, by parts of the tasks first."""
    size = WORDS.size + BYTES.size

    def count(batches):
        from pyspark import TaskContext

        v, sums = vocabulary.value.ready(), np.zeros(size, np.uint32)
        words_seen, bytes_seen = Sums(WORDS, sums[: WORDS.size]), Sums(BYTES, sums[WORDS.size :])
        for b in batches:
            for some in _groups(b.column("text").to_pylist()):
                ids, _, place, rare, _ = v.read(Words(some))
                symbols = v.classes[ids]
                words_seen.add(symbols, _history(symbols, place))
                bytes_seen.add(*_spelled(rare)[:2])
        words_seen.flush()
        bytes_seen.flush()
        task = TaskContext.get().partitionId()
        for at in range(0, size, SLOTS):
            part = sums[at : at + SLOTS]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([at // SLOTS]), pa.array([task % 32]), pa.array([zlib.compress(part.astype("<u8").tobytes(), 1)], pa.binary())], ["part", "some", "sums"])
        give_back()

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(x), "<u8") for x in rows.column("sums").to_pylist())
        return pa.table([rows.column("part")[:1], rows.column("some")[:1], pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], ["part", "some", "sums"])

    shape = "part long, some long, sums binary"
    some = docs.mapInArrow(count, shape).groupBy("part", "some").applyInArrow(add, shape)
    out = np.zeros(size, np.uint64)
    for r in some.groupBy("part").applyInArrow(add, shape).toLocalIterator():
        part = np.frombuffer(zlib.decompress(bytes(r["sums"])), "<u8")
        out[r["part"] * SLOTS :][: len(part)] = part
    return out


def refined(found: Column, total: int) -> Column:
    """Natural log of a text's probability from its passages in order: (place, p, n), n the times that others have it.

    A passage's probability mixes that of its words with its share of all passages; the mixture's weight is the share of
    passages so far that others have.
    """
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(HITS).alias("hits"), F.lit(PASSAGES).alias("all"))

    def step(a: Column, x: Column) -> Column:
        weight = a["hits"] / a["all"]
        words, whole = F.log1p(-weight) + x["p"], F.log(weight) + F.log(x["n"] / F.lit(float(max(1, total))))
        both = F.greatest(words, whole) + F.log1p(F.exp(-F.abs(words - whole)))
        hit = x["n"] > 0
        return F.struct((a["sum"] + F.when(hit, both).otherwise(words)).alias("sum"), (a["hits"] + hit.cast("double")).alias("hits"), (a["all"] + 1).alias("all"))

    return F.aggregate(found, start, step, lambda a: a["sum"])


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row.

    score is the model's log10 probability of the text's tokens, base_score that of the smoothed word counts. Null and empty
    texts have the end as their only token. Null ids aren't held out. Repeated rows are repeated (and counted); an empty
    table gives no rows, and without training documents every count is zero; extra columns are ignored.
    """
    spark = docs.sparkSession
    ready_for_python(spark)
    own = texts(docs, id_col, text_col).withColumn("learned", ~fold(F.col("doc_id"), HELD_PARTS, HELD))
    training = own.filter("learned").select("text")
    counts = cut(_counted(training))
    vocabulary, total = _vocabulary(counts, head)
    shared = spark.sparkContext.broadcast(Model(vocabulary, _tables(training, spark.sparkContext.broadcast(vocabulary))))

    def score(batches):
        from pyspark import TaskContext

        row, m = TaskContext.get().partitionId() << 40, shared.value
        for b in batches:
            text, at = b.column("text").to_pylist(), 0
            for group in _groups(text):
                n = len(group)
                some = b.slice(at, n)
                got = m.score(group, np.array(some.column("learned")))
                size = pa.array([max(1, len(t)) for t in group], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(range(row, row + n), pa.int64()), some.column("doc_id"), size, *(x if isinstance(x, pa.Array) else pa.array(x) for x in got.values())], ["row", "doc_id", "size", *got])
                at, row = at + n, row + n
        give_back()

    shape = "row long, doc_id long, size long, n_tokens long, sure long, base double, found array<struct<word: binary, place: long, p: double, own: long>>"
    read = cut(own.mapInArrow(score, shape))
    found = read.select("row", F.explode("found").alias("x")).select("row", "x.*").join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rare, passage = F.col("place") < 0, F.struct("place", "p", (F.col("n") - F.col("own")).alias("n"))
    term = F.log10((F.col("n") + 0.5) / F.lit(vocabulary.total + 0.5 * (vocabulary.distinct + 1.0)))
    sums = found.groupBy("row").agg(
        F.sum(F.when(rare, term).otherwise(0.0)).alias("rare_base"),
        F.sum((rare & (F.col("n") > 0)).cast("long")).alias("rare_known"),
        F.sort_array(F.collect_list(F.when(~rare, passage))).alias("passages"),
    )
    out = read.drop("found").join(sums, "row").withColumn("log", refined(F.col("passages"), total))
    return out.select(
        "doc_id", fold(F.col("doc_id"), HELD_PARTS, HELD).alias("held_out"), "n_tokens", (F.col("sure") + F.col("rare_known")).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"), (F.col("base") + F.col("rare_base")).alias("base_score"),
        (F.col("log") / float(np.log(10))).alias("score"), (-F.col("log") / float(np.log(2)) / F.col("size")).alias("bits_per_byte"),
    )
