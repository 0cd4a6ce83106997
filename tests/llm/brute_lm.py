"""The language model of gristmill.llm.lm, one decision after another."""

import math
import zlib
from collections import Counter

import brute

from gristmill.llm import lm

M = (1 << 64) - 1
A, B, C = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9


def mixed(h):
    h = ((h ^ h >> 32) * C) & M
    return h ^ h >> 29


def hashed(word):
    low = int.from_bytes(word[:8], "little")
    high = int.from_bytes(word[8:15], "little") if len(word) <= lm.SHORT else mixed(int.from_bytes(word[-8:], "little")) >> 8
    return mixed((low * A & M) ^ ((high | min(len(word), 255) << 56) * B & M))


def passages(words):
    """Lengths and keys of the passages of a text's words and its end."""
    h = [*map(hashed, words), A]
    out, held = [], []
    for k, x in enumerate(h):
        held.append(mixed((x + len(held) * A) & M))
        if k == len(h) - 1 or mixed((x * B + (h[k - 1] if k else A)) & M) % lm.LENGTH == 0:
            out.append((len(held), mixed(sum(held) & M)))
            held = []
    return out


def rooms(stream, past):
    """The room of each table after the symbols past, the last one first."""
    out, h = [], 0
    for k, bits in enumerate(stream.tables):
        h = h << 8 | past[k]
        n = 1 << (bits - 8)
        out.append((h if n > 1 << (8 * (k + 1) - 1) else (h * 0x9E3779B1 & 0x7FFFFFFF) >> 7) % n)
    return out


def block(stream, place):
    if place >= stream.block:
        return 3 + place // stream.block
    return sum(place >= stream.block // d for d in (8, 4, 2))


def pasts(symbols):
    return [[symbols[k - d] if k >= d else 0 for d in (1, 2, 3)] for k in range(len(symbols))]


class Plain:
    """Counts of a stream, and the probabilities of a document's symbols."""

    def __init__(self, stream):
        self.stream, self.counts = stream, Counter()

    def learn(self, symbols, past):
        for s, p in zip(symbols, past):
            for k, room in enumerate(rooms(self.stream, p)):
                for level in range(8):
                    self.counts[k, room, 1 << level | s >> (8 - level), s >> (7 - level) & 1] += 1

    def read(self, symbols, past):
        w, moves, at, out = {}, Counter(), 0, []
        for place, (s, p) in enumerate(zip(symbols, past)):
            if block(self.stream, place) != at:
                for (level, gate, k), m in moves.items():
                    w[level, gate][k] += m
                moves, at = Counter(), block(self.stream, place)
            total = 0.0
            for level in range(8):
                node, bit = 1 << level | s >> (8 - level), s >> (7 - level) & 1
                seen = [[self.counts[k, room, node, b] for b in (0, 1)] for k, room in enumerate(rooms(self.stream, p))]
                gate = sum(sum(seen[1]) >= n for n in lm.SEEN)
                x = [*(math.log((one + 0.4) / (zero + 0.4)) for zero, one in seen), lm.BIAS]
                weights = w.setdefault((level, gate), [float(v) for v in self.stream.start[gate]])
                one = 1 / (1 + math.exp(-max(-12, min(12, sum(a * b for a, b in zip(weights, x))))))
                total += math.log(one if bit else 1 - one)
                for k, v in enumerate(x):
                    moves[level, gate, k] += (bit - one) * self.stream.rate * v
            out.append(total)
        return out


def scores(data, head):
    """(doc_id as text, n_tokens, log10 probability), sorted. data: (doc_id, text)."""
    texts = [(i, [w.encode() for w in brute.words(brute.ascii_lower(t.decode()))]) for i, t in data]
    learns = [i is None or zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in texts]
    training = [w for (_, w), x in zip(texts, learns) if x]
    counts = Counter(x for w in training for x in w)
    rough = lambda n: n - n % (1 << max(0, n.bit_length() - 11))
    sizes, least, room = Counter(rough(n) for n in (*counts.values(), *([len(training)] if training else []))), 1 << 62, head
    for n in sorted(sizes, reverse=True):
        room -= sizes[n]
        if room < 0 or n < lm.LEAST:
            break
        least = n
    words = sorted(x for x, n in counts.items() if n >= least)
    total = sum(counts.values()) + len(training)
    mass = [counts[x] for x in words] + [len(training) + 1]
    mass.append(max(0, total - len(training) - sum(mass[:-1])) + 1)
    up, classes = 0.0, []
    for m in mass:
        up += m
        classes.append(min(255, int((up - m / 2) / sum(mass) * 256)))
    each = Counter()
    for c, m in zip(classes, mass):
        each[c] += m
    ids = {x: k for k, x in enumerate(words)}
    end, escape = len(words), len(words) + 1
    coded = [[ids.get(x, escape) for x in w] + [end] for _, w in texts]
    classed = [[classes[i] for i in c] for c in coded]
    spelled = [[(k, x + b" ") for k, (x, i) in enumerate(zip(w, c)) if i == escape] for (_, w), c in zip(texts, coded)]
    one, two = Plain(lm.WORDS), Plain(lm.BYTES)
    for s, r, x in zip(classed, spelled, learns):
        if x:
            one.learn(s, pasts(s))
            for _, word in r:
                two.learn(word, pasts(word))
    cut = [passages(w) for _, w in texts]
    known = Counter(key for c, x in zip(cut, learns) if x for _, key in c)
    everything = max(1, sum(known.values()))
    out = []
    for (i, _), c, s, r, p, x in zip(texts, coded, classed, spelled, cut, learns):
        logs = [a + math.log(mass[k] / each[classes[k]]) for a, k in zip(one.read(s, pasts(s)), c)]
        raw = two.read(b"".join(word for _, word in r), [q for _, word in r for q in pasts(word)])
        for k, word in r:
            logs[k] += sum(raw[: len(word)])
            raw = raw[len(word) :]
        own, hits, seen, at, sum_ = Counter(key for _, key in p), lm.HITS, lm.PASSAGES, 0, 0.0
        for n, key in p:
            plain = math.log1p(-hits / seen) + sum(logs[at : at + n])
            others = known[key] - (own[key] if x else 0)
            if others > 0:
                whole = math.log(hits / seen) + math.log(others / everything)
                plain = max(plain, whole) + math.log1p(math.exp(-abs(plain - whole)))
                hits += 1
            sum_, seen, at = sum_ + plain, seen + 1, at + n
        out.append((str(i), len(c), sum_ / math.log(10)))
    return sorted(out)
