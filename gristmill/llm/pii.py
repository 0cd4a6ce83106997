"""Personal data: base patterns, and further spans proposed by wide generators and chosen by boosted trees.

The base spans are those of fixed patterns and always stay. Generators propose spans in other spellings (spelled-out
addresses, phone numbers without a plus, split card numbers, masked IP addresses), overlaps and all; boosted trees score
each by its format and the words around it, and a threshold calibrated for precision selects those that are added. The
trees are fitted on the driver on examples that examples() writes from rules, at most EXAMPLES of them and always the
same, so no document is needed and no run differs from another.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, bisect_right
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.boosting import Trees, threshold
from gristmill.llm.common import map_rows, slices, texts
from gristmill.session import ready_for_python

KINDS = ("email", "ip", "card", "phone")
EXAMPLES, PRECISION, NEAR = 6000, 0.998, 40
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"([0-9]++)((?:\.[0-9]++){3})?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WIDE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64}\s?(?:@|[\[({]\s?at\s?[\])}]|\sat\s)\s?[A-Za-z0-9-]{1,63}(?:\s?(?:\.|[\[({]\s?(?:dot|\.)\s?[\])}]|\sdot\s)\s?[A-Za-z0-9-]{2,24}){1,4}", re.I),
    "ip": re.compile(r"(?<![\w.])[0-9]{1,3}(?:(?:\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?|\sdot\s|\.)[0-9]{1,3}){3}(?![\w.]?[0-9])", re.I),
    "card": re.compile(r"(?<![\w.,+-])[0-9]{4}(?:[ ._/-]{1,2}[0-9]{2,6}){2,5}(?!\w)"),
    "phone": re.compile(r"(?<![\w.,+-])(?:00[ .-]?[1-9][0-9]{0,2}[ .-]?)?\(?[0-9]{2,4}\)?(?:[ ./-]{1,2}[0-9]{2,4}){2,4}(?!\w)|(?<!\w)\+[0-9](?:[ ./()-]{0,2}[0-9]){9,14}(?!\w)"),
}
_SPELLED = re.compile(r"[\[({]\s?(?:at|dot|\.)\s?[\])}]|\sdot\s", re.I)
# Words near personal data, and near numbers that aren't.
_CUES = {
    "email": ("mail", "contact", "write", "reach", "address"),
    "ip": ("ip", "host", "server", "address", "login", "client"),
    "card": ("card", "visa", "mastercard", "amex", "payment", "credit", "debit"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "cell", "whatsapp", "ring", "number"),
}
_OTHER = ("version", "ver", "release", "isbn", "issn", "order", "invoice", "serial", "part", "page", "section", "chapter", "date", "born", "since", "ratio", "score", "total", "build", "ticket", "id", "case", "lot")


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _emails(text: str):
    """Leftmost matches of the base pattern, in time linear in the text however long a run before an @ is."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base patterns, by start, then kind in the order of KINDS."""
    out = [(a, "email", b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if m[2] and all(map(_byte, m[0].split("."))):
                    out.append((m.start(), "ip", m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                d = _digits(m[0])
                if 14 <= len(d) <= 19 and luhn(d):
                    out.append((m.start(), "card", m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m[0])) <= 15:
                    out.append((m.start(), "phone", m.end()))
    return sorted(out, key=_order)


def _order(span: tuple[int, str, int]) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[1]), span[2]


def candidates(text: str) -> list[tuple[int, str, int]]:
    """Spans of all generators, overlapping ones too."""
    spelled, digit = _SPELLED.search(text) is not None, _DIGIT.search(text) is not None
    out = [(m.start(), "email", m.end()) for m in _WIDE["email"].finditer(text)] if spelled else []
    if digit:
        for kind in KINDS[1:]:
            if kind != "ip" or spelled:
                out += [(m.start(), kind, m.end()) for m in _WIDE[kind].finditer(text)]
    return out


def describe(text: str, span: tuple[int, str, int]) -> list[float]:
    """Format and context of a span as numbers."""
    a, kind, b = span
    s, before, after = text[a:b], text[max(0, a - NEAR) : a].lower(), text[b : b + NEAR].lower()
    d, near = _digits(s), set(re.findall(r"[a-z]+", before)) | set(re.findall(r"[a-z]+", after)[:3])
    last = re.findall(r"[a-z#$€]+|$", before)
    parts = re.findall(r"[0-9]+", s)
    seps = re.findall(r"[^0-9A-Za-z]+", s)
    words = re.findall(r"[A-Za-z]+", s)
    return [
        *(float(kind == k) for k in KINDS), float(len(s)), float(len(d)), float(len(parts)), float(len(seps)), float(len(set(seps))),
        float(luhn(d)) if d else -1.0, float(all(map(_byte, parts))) if parts else -1.0, float(max(map(len, parts), default=0)), float(min(map(len, parts), default=0)),
        float(s[:1] == "+"), float(s[:1] == "0"), float("(" in s), float("." in s), float("/" in s), float("@" in s), float(bool(re.search(r"[\[({]\s?at|\sat\s", s, re.I))), float(bool(re.search(r"[\[({]\s?(?:dot|\.)|\sdot\s", s, re.I))),
        float(len(words[-1]) if words else 0), float(len(words)), float(any(any(w.startswith(c) for w in near) for c in _CUES[kind])), float(any(w in near for w in _OTHER)),
        float(bool(last) and last[-2:][0] in _OTHER) if len(last) > 1 else 0.0, float(before[-1:] in tuple("#$€£v/=")), float(after[:1] in tuple("%/=€$")),
        float(bool(re.fullmatch(r"(?:[0-9]{1,2}[./ -][0-9]{1,2}[./ -](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}[./ -][0-9]{1,2}[./ -][0-9]{1,2})(?:[ ./-].*)?", s))),
        float(sum(len(p) == 4 and p[:2] in ("19", "20") for p in parts)),
    ]


def examples(count: int = EXAMPLES, seed: int = 11) -> list[tuple[str, tuple[int, str, int], int]]:
    """(text, span, label): written examples of what generators propose, personal data (1) and look-alikes (0)."""
    rng, out = random.Random(seed), []
    word = lambda: "".join(rng.choice(("an", "er", "th", "in", "lo", "mi", "sa", "re", "ou", "ti")) for _ in range(rng.randint(1, 4)))
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card(good: bool) -> str:
        d = rng.choice("3456") + num(rng.choice((13, 14, 14, 15)) - 1)
        check = next(c for c in "0123456789" if luhn(d + c))
        return d + (check if good else str((int(check) + rng.randint(1, 9)) % 10))

    def split(d: str, sep: str) -> str:
        return sep.join([d[:4], d[4:8], d[8:12], d[12:]]) if len(d) > 12 else d

    while len(out) < count:
        kind, good = rng.choice(KINDS), rng.random() < 0.5
        if kind == "email":
            at, dot = rng.choice((" at ", " (at) ", "(at)", " [at] ", "[at]", "{at}", "@")), rng.choice((" dot ", "(dot)", " (dot) ", "[dot]", "[.]"))
            tld = rng.choice(("com", "org", "net", "example", "de", "io", "edu", "co"))
            s = f"{word()}{rng.choice(('', '.' + word(), num(2)))}{at}{word()}{dot}{tld}" if good else f"{word()} at {word()}{rng.choice(('. ', ' dot ', '.'))}{word()}{word()}"
        elif kind == "ip":
            dot = rng.choice(("[.]", "(dot)", " dot ", "[dot]"))
            s = dot.join(str(rng.randint(1, 255)) for _ in range(4)) if good else dot.join(str(rng.randint(256, 999) if i == 2 else rng.randint(0, 300)) for i in range(4))
        elif kind == "card":
            s = split(card(good), rng.choice((".", "/", "  ", "_", " - ", "-", " "))) if rng.random() < 0.7 or good else rng.choice(("-", ".", " ", "/")).join(num(rng.choice((4, 4, 3, 2))) for _ in range(rng.randint(3, 5)))
        elif good:
            sep = rng.choice((" ", "-", ".", "/"))
            s = rng.choice((f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}{sep}{num(3)}{sep}{num(4)}", f"0{num(3)}{sep}{num(3)}{sep}{num(4)}", f"00{rng.randint(1, 99)} {num(3)} {num(3)} {num(4)}"))
        else:
            s = rng.choice((f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 31)}", f"{rng.randint(10, 31)}.{rng.randint(10, 12)}.{rng.randint(1900, 2030)}", f"{num(2)}.{num(2)}.{num(2)}", f"{num(3)} {num(3)} {num(3)}", f"{num(4)}-{num(2)}-{num(3)}", f"978-{num(1)}{num(2)}-{num(4)}-{num(3)}", f"{num(2)}/{num(2)}/{num(2)}"))
        cue = rng.choice(_CUES[kind]) if rng.random() < (0.75 if good else 0.1) else rng.choice(_OTHER) if not good and rng.random() < 0.6 else word()
        if good and kind == "phone" and cue not in _CUES[kind]:
            continue
        text = f"{word()} {word()} {cue}{rng.choice((' ', ': ', ' is '))}{s}{rng.choice((' ', '. ', ', '))}{word()} {word()}"
        out += [(text, c, int(good and c[1] == kind and text[c[0] : c[2]].strip() == s.strip())) for c in candidates(text)]
    return out[:count]


@cache
def selector() -> tuple[Trees, float]:
    """Trees fitted on three quarters of the examples, and the threshold calibrated on the others."""
    rows = examples()
    x, y = np.array([describe(t, c) for t, c, _ in rows]), np.array([g for _, _, g in rows], float)
    held = np.arange(len(y)) % 4 == 3
    trees = Trees(rounds=150).fit(x[~held], y[~held])
    return trees, max(0.9, threshold(trees.score(x[held]), y[held], PRECISION))


def all_spans(text: str, chosen: tuple[Trees, float], base: list[tuple[int, str, int]] | None = None) -> list[tuple[int, str, int]]:
    """The base spans and the selected further ones, which overlap neither those nor each other; in order."""
    base = base_spans(text) if base is None else base
    taken = Covered()
    for a, _, b in base:
        taken.add(a, b)
    free = [c for c in candidates(text) if not taken.meets(c[0], c[2])]
    if not free:
        return base
    trees, least = chosen
    scores = trees.score(np.array([describe(text, c) for c in free]))
    more: list[tuple[int, str, int]] = []
    for s, c in sorted(zip(scores, free), key=lambda p: (-p[0], _order(p[1]))):
        if s >= least and not taken.meets(c[0], c[2]):
            taken.add(c[0], c[2])
            more.append(c)
    return sorted([*base, *more], key=_order)


class Covered:
    """Places that spans cover, as runs apart from each other; looking up a span takes the logarithm of their number."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def meets(self, a: int, b: int) -> bool:
        k = bisect_left(self.starts, b) - 1
        return k >= 0 and self.ends[k] > a

    def add(self, a: int, b: int) -> None:
        i, j = bisect_right(self.ends, a), bisect_left(self.starts, b)
        if i < j:
            a, b = min(a, self.starts[i]), max(b, self.ends[j - 1])
        self.starts[i:j], self.ends[i:j] = [a], [b]


def listed(spans: list[tuple[int, str, int]]) -> str:
    """kind:start:end, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for a, k, b in spans)


def redacted(text: str, spans: list[tuple[int, str, int]]) -> str:
    """text with every span replaced by its kind in brackets; overlapping spans by that of the first."""
    out, done = [], 0
    for a, kind, b in spans:
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row; counts and digest of the base spans.

    Null and empty texts have no spans. Null ids and repeated rows keep their rows; an empty table gives no rows; extra
    columns are ignored. Offsets count code points; time is linear in the text, but for sorting its spans.
    """
    chosen = selector()

    def act(c: list) -> tuple:
        rows = []
        for t in c[1]:
            base = base_spans(t)
            counts = [sum(k == kind for _, k, _ in base) for kind in KINDS]
            rows.append((*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(all_spans(t, chosen, base))))
        return c[0], *map(list, zip(*rows))

    return map_rows(texts(docs, id_col, text_col, binary=False), lambda: act, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def without_personal_data(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """docs with all spans redacted in the text and, if there is such a column, its length set anew.

    Null texts stay null with their length, empty ones empty; ids don't matter; repeated rows are repeated; an empty table
    gives no rows; other columns, whatever their names, stay as they are.
    """
    chosen = selector()
    ready_for_python(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in slices(batches):
            new = [t if t is None else redacted(t, all_spans(t, chosen)) for t in b.column(at).to_pylist()]
            yield b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.when(F.col(text_col).isNull(), F.col(length_col)).otherwise(F.length(text_col)).cast(docs.schema[length_col].dataType))
    return out.select(*docs.columns)
