"""Tokenizing long texts through a table of short units.

The byte-level pretokenizing pattern never joins characters across a single space between two non-space characters: the
space begins the next match. So such a text's ids are those of its space-separated units, each (but the first) with its
space in front, and a unit has to be encoded once only. A text with a space beside other white space, or in front or at
the end, is encoded whole.

An unknown unit is put together from its pieces (a word, the signs after it), which are looked up in the same way, so that
only new pieces have to be encoded.

Units are found and looked up for many texts at once. A unit of up to SHORT bytes is its own key: its bytes, its length and
whether it begins a text fill two 64-bit numbers, so equal keys are equal units, and a table with two places for each key
has their ids. Where both places are taken, the later unit has the second, so the table's size bounds memory and not what
can be encoded. Longer units are kept under their bytes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np

#: Places of a worker's table, ids it holds before it is emptied, and bytes of text looked at together.
PLACES, POOL, AT_ONCE = 1 << 21, 1 << 23, 1 << 18
#: Units that are encoded in one call, as the libraries make objects of every id.
RUN = 1 << 13
#: Bytes of a unit that its key has room for, and bytes of longer units that are kept, in all and each.
SHORT, LONG, EACH = 15, 1 << 23, 256
#: White space other than space, tab, line feed and carriage return.
_RARE = "\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_BESIDE = re.compile(r"\s | \s")
#: Of bytes: white space, first and last bytes of white space beyond ASCII.
_WHITE, _LEADS, _TAILS = (np.isin(np.arange(256), list(x)) for x in (b" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f", {c.encode()[0] for c in _RARE[6:]}, {c.encode()[-1] for c in _RARE[6:]}))
#: Of so many bytes (0 to 8) all bits.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_ENTRY = np.dtype([("low", "<u8"), ("high", "<u8"), ("at", "<u4"), ("size", "<u4")])


def splits(text: str) -> bool:
    """Whether the ids of a text are those of its units."""
    if text[:1] == " " or text[-1:] == " " or "  " in text or " \n" in text or "\n " in text:
        return False
    return not (("\t" in text or "\r" in text or any(c in text for c in _RARE)) and _BESIDE.search(text))


def suspects(parts: list[bytes]) -> list[int]:
    """The parts that may not split: those with a space beside another, or beside bytes that may be white space."""
    buf = np.frombuffer(b"\0\0 " + b" ".join(parts) + b" \0\0", np.uint8)
    gaps = np.flatnonzero(buf == 32)
    after, before = buf[gaps + 1], buf[gaps - 1]
    odd = _WHITE[after] | _WHITE[before]
    more = np.flatnonzero(_LEADS[after])
    odd[more] |= (after[more] != 0xC2) | _TAILS[buf[gaps[more] + 2]]
    more = np.flatnonzero(_TAILS[before])
    odd[more] |= (buf[gaps[more] - 2] == 0xC2) | (_LEADS[buf[gaps[more] - 3]] & (buf[gaps[more] - 3] != 0xC2))
    if not odd.any():
        return []
    starts = np.cumsum([3] + [len(p) + 1 for p in parts])  # of the parts, and one past the last
    at = gaps[odd]
    out = np.concatenate([np.searchsorted(starts, at, "right") - 1, np.searchsorted(starts, at + 1, "right") - 1])
    return np.unique(out[(out >= 0) & (out < len(parts))]).tolist()


class Units:
    """Ids of texts from those of their pieces: pieces cuts strings into all their pieces in a row, and how many each has;
    encode gives for pieces all their ids in a row, and how many each has.

    With counting, only the numbers of ids are kept and given, in a table of half the places.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], pieces: Callable[[list[str]], tuple[list[str], np.ndarray]], counting: bool = False):
        self.encode, self.pieces, self.counting, self.places = encode, pieces, counting, PLACES // 2 if counting else PLACES
        self._empty()

    def _empty(self) -> None:
        self.table, self.long, self.kept = np.zeros(self.places, _ENTRY), {}, 0
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray | int]:
        """The ids of each text, or how many there are."""
        held: list[str] = []
        raws: list[bytes] = []
        size = 0
        for t in texts:
            raw = t.encode()
            if size + len(raw) >= AT_ONCE and held:
                yield from self._some(held, raws)
                held, raws, size = [], [], 0
            held.append(t)
            raws.append(raw)
            size += len(raw) + 1
        if held:
            yield from self._some(held, raws)

    def _some(self, held: list[str], raws: list[bytes]) -> Iterator[np.ndarray | int]:
        whole = {k for k in suspects(raws) if not splits(held[k])}
        others = iter(self._each([held[k] for k in sorted(whole)]))
        plain = [r for k, r in enumerate(raws) if k not in whole]
        if len(plain) == 1 and len(plain[0]) >= AT_ONCE:
            runs = [self._ids([p], [k == 0])[0] for k, p in enumerate(_windows(plain[0]))]
            found = iter([sum(runs) if self.counting else np.concatenate(runs)])
        else:
            found = iter(self._ids(plain, [True] * len(plain)) if plain else [])
        for k in range(len(held)):
            yield next(others) if k in whole else next(found)

    def _each(self, texts: list[str]) -> list:
        if not texts:
            return []
        at, size, heads = self._pieces_of(texts)
        if self.counting:
            return np.add.reduceat(size, heads).tolist()
        return np.split(self._gathered(at, size), (np.cumsum(size)[heads] - size[heads])[1:])

    def _ids(self, parts: list[bytes], fresh: list[bool]) -> list:
        """Ids of parts, each less than AT_ONCE bytes together; a part that isn't fresh goes on after a space."""
        if max(map(len, parts)) > AT_ONCE:  # a unit longer than that
            return self._each([("" if f else " ") + p.decode() for p, f in zip(parts, fresh)])
        raw = b" " + b" ".join(parts)  # the space before a unit that isn't first is part of it
        gaps = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)
        starts, ends = gaps + 1, np.append(gaps[1:], len(raw))
        lengths = np.array([len(p) for p in parts])
        heads = np.searchsorted(starts, np.cumsum(lengths + 1) - lengths)
        first = np.zeros(len(starts), bool)
        first[heads[np.array(fresh)]] = True
        if self.used > POOL or self.kept > LONG:
            self._empty()
        at, size = self._found(raw, starts, ends - starts, first, self._joined)
        if self.counting:
            return np.add.reduceat(size, heads).tolist()
        return np.split(self._gathered(at, size), (np.cumsum(size)[heads] - size[heads])[1:])

    def _gathered(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        ends = np.cumsum(size)
        return self.pool[np.repeat(at - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]

    def _found(self, raw: bytes, starts: np.ndarray, n: np.ndarray, first: np.ndarray, make: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of units are in the pool, and how many. A unit is n bytes of raw, and a space before them unless it
        is first. Those that aren't known are made: make gives where and how many of strings, and which of them to remember."""
        at, size = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        units = lambda some: [raw[a:e] for a, e in zip((starts - 1 + first)[some].tolist(), (starts + n)[some].tolist())]
        long = np.flatnonzero(n > SHORT)
        rows = np.flatnonzero(n <= SHORT) if len(long) else np.arange(len(n))
        self._short(raw, starts[rows], n[rows], first[rows], rows, units, make, at, size)
        if len(long):
            found = units(long)
            words = [w for w in dict.fromkeys(found) if w not in self.long]
            fresh = dict(zip(words, zip(*(x.tolist() for x in make([w.decode() for w in words]))))) if words else {}
            at[long], size[long] = np.array([(fresh.get(w) or self.long[w])[:2] for w in found]).T
            for w, p in fresh.items():
                if p[2] and len(w) <= EACH:
                    self.long[w] = p
                    self.kept += len(w)
        return at, size

    def _short(self, raw: bytes, starts: np.ndarray, n: np.ndarray, first: np.ndarray, rows: np.ndarray, units: Callable, make: Callable, at: np.ndarray, size: np.ndarray) -> None:
        """Fill in the short units, which are at these rows."""
        eight = np.ndarray(len(raw) + 9, "<u8", raw + bytes(16), strides=(1,))  # the eight bytes from each place on
        low = eight[starts] & _FIRST_BYTES[np.minimum(n, 8)]
        high = eight[np.minimum(starts + 8, len(raw))] & _FIRST_BYTES[np.maximum(n - 8, 0)]
        high |= (n + 32 + 16 * first).astype(np.uint64) << np.uint64(56)
        h = (low ^ (high << np.uint64(29)) ^ (high >> np.uint64(35))) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        place, other = ((h >> np.uint64(k)).astype(np.int64) & (self.places - 1) for k in (40, 16))
        got = self.table[place]
        new = np.flatnonzero((got["low"] != low) | (got["high"] != high))
        got[new] = self.table[other[new]]
        new = new[(got["low"][new] != low[new]) | (got["high"][new] != high[new])]
        at[rows], size[rows] = got["at"], got["size"]
        if not len(new):
            return
        words: dict[bytes, int] = {}
        which = np.array([words.setdefault(w, len(words)) for w in units(rows[new])])
        ats, sizes, keep = make([w.decode() for w in words])
        at[rows[new]], size[rows[new]] = ats[which], sizes[which]
        new, which = new[keep[which]], which[keep[which]]
        entry = np.zeros(len(new), _ENTRY)
        entry["low"], entry["high"], entry["at"], entry["size"] = low[new], high[new], ats[which], sizes[which]
        self.table[np.where(self.table["high"][place[new]] == 0, place[new], other[new])] = entry

    def _put(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Put ids into the pool: where those of each unit are."""
        if self.counting:
            return sizes
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(ids), len(self.pool)), np.uint32)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return self.used - len(ids) + np.cumsum(sizes) - sizes

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Encode pieces, so many at a time, and remember them."""
        ids, sizes = (np.concatenate(x) for x in zip(*(self.encode(pieces[k : k + RUN]) for k in range(0, len(pieces), RUN))))
        return self._put(ids, sizes), sizes, np.ones(len(pieces), bool)

    def _joined(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Put units together from their pieces, and remember those that aren't a piece."""
        at, size, heads = self._pieces_of(units)
        several = np.diff(np.append(heads, len(size))) > 1
        ats, sizes = at[heads], np.add.reduceat(size, heads)
        rows = np.flatnonzero(np.repeat(several, np.diff(np.append(heads, len(size)))))
        ats[several] = self._put(size[:0] if self.counting else self._gathered(at[rows], size[rows]), sizes[several])
        return ats, sizes, several

    def _pieces_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of all pieces of strings are, how many, and which piece is each string's first. An empty string has
        an empty piece."""
        pieces, counts = self.pieces(texts)
        if not counts.all():
            rest = iter(pieces)
            pieces = [p for n in counts.tolist() for p in ([next(rest) for _ in range(n)] or [""])]
            counts = np.maximum(counts, 1)
        distinct: dict[str, int] = {}
        which = np.array([distinct.setdefault(p, len(distinct)) for p in pieces], np.int64)
        some = [p.encode() for p in distinct]
        first = np.array([p[:1] != b" " for p in some], bool)
        n = np.array([len(p) for p in some], np.int64)
        at, size = self._found(b"".join(some), np.cumsum(n) - n + ~first, n - ~first, first, self._encoded)
        return at[which], size[which], np.cumsum(counts) - counts


def _windows(raw: bytes) -> list[bytes]:
    """A long text in runs of whole units, of less than AT_ONCE bytes where units allow; the spaces between runs are left out."""
    out, at = [], 0
    while len(raw) - at >= AT_ONCE:
        cut = raw.rfind(b" ", at, at + AT_ONCE - 1)
        cut = cut if cut > at else raw.find(b" ", at)
        if cut <= at:
            break
        out.append(raw[at:cut])
        at = cut + 1
    return [*out, raw[at:]]
