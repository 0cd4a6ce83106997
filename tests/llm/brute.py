"""Plain Python versions of what the operators compute."""

import re
from collections import Counter

import xxhash

SPACE = re.compile(r"[ \t-\r]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")


def simhash(text):
    w = words(ascii_lower(text))
    if not w:
        return 0
    runs = [w[i : i + 3] for i in range(len(w) - 2)] or [w]
    h = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def components(nodes, edges):
    """Smallest node reachable from each node."""
    low = {n: n for n in nodes}

    def root(x):
        while low[x] != x:
            low[x] = low[low[x]]
            x = low[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        low[b] = a
    return {n: root(n) for n in nodes}


def near_duplicates(docs, radius=2):
    """{doc_id: (fingerprint, component)}."""
    fp = {i: simhash(t) for i, t in docs}
    ids = sorted(fp)
    edges = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (fp[a] ^ fp[b]).bit_count() <= radius]
    comp = components(ids, edges)
    return {i: (f"{fp[i]:016x}", comp[i]) for i in ids}


def rule_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text, w = text or "", words(text)
    lines = [x for x in text.split("\n") if words(x)]
    runs = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {k for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
