"""Personal data with offset-preserving deobfuscation.

Plain identifiers are found by fixed patterns in the text as it stands. Then a
transducer rewrites the text: homoglyphs and full-width signs become ASCII,
spelled digits become digits, disguised at and dot signs become ``@`` and
``.``. Every character that it writes carries the source span it stands for.
The same patterns run over what it wrote, and what they find is mapped back to
spans of the source; a find counts if the transducer changed something in it
and no plain identifier of its kind overlaps it.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.shared import with_uid

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A digit run is taken whole or not at all, so no match starts inside one and the scan stays linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their at signs: the local part is the run before it, back to the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def find_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the identifiers that stand in ``text`` as such; matches that fail their check are dropped."""
    found = []
    if "@" in text:
        found += [(a, "email", b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
            found.append((m.start(), "ip", m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append((m.start(), "card", m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                found.append((m.start(), "phone", m.end()))
    found.sort(key=lambda x: (x[0], KINDS.index(x[1])))
    return found


# ---------------------------------------------------------------- the transducer

# Letters of other scripts that look like ASCII ones.
_ALIKE = dict(zip("АВСЕНІЈКМОРЅТХУаеосрхуіјѕԁһԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧαονρτυικ",
                  "ABCEHIJKMOPSTXYaeocpxyijsdhqwABEZHIKMNOPTYXaovptuik", strict=True))
_SIGNS = {"﹫": "@", "。": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "\xa0": " ", " ": " ", " ": " "}
_DROPPED = frozenset("\xad​‌‍⁠﻿")
# The digits' names.
_SPELLED = {w: str(d) for names in (
    "zero one two three four five six seven eight nine", "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf", "cero uno dos tres cuatro cinco seis siete ocho nueve",
) for d, w in enumerate(names.split())} | {"oh": "0"}
_NAMES = "|".join(sorted(_SPELLED, key=len, reverse=True))
_AT, _DOT, _PLUS = "at|arroba|arobase|ät", "dot|point|punto|punkt", "plus|más"
_GAP = r"[\s,;-]{1,3}"
_BRACKETED = re.compile(rf"\s?[\[({{<]\s?(?:(?P<at>{_AT}|@)|(?P<dot>{_DOT}|\.))\s?[\])}}>]\s?", re.I)
_BARE = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+(?:\s(?:{_DOT})\s[A-Za-z0-9_%+-]+)?(?:\s(?:{_AT})\s|@)[A-Za-z0-9-]+(?:(?:\s(?:{_DOT})\s|\.)[A-Za-z0-9-]+)*\s(?:{_DOT})\s[A-Za-z]{{2,}}(?![A-Za-z0-9])", re.I)
_BARE_SIGN = re.compile(rf"\s(?:(?P<at>{_AT})|(?P<dot>{_DOT}))\s", re.I)
_TOKEN = rf"(?:{_NAMES}|[0-9]+|{_DOT}|{_PLUS}|\+)"
_NEXT = rf"(?:{_GAP}|(?<=\+)|(?=\.[0-9])\.)"
# Pluses that no digit follows are taken as one match (which changes nothing), so that the scan stays linear.
_RUN = re.compile(rf"(?<!\w)(?:(?:{_TOKEN}{_NEXT})*(?:{_NAMES}|[0-9]+|{_DOT})(?!\w)|(?:(?:{_PLUS}|\+){_NEXT})++)", re.I)
_IN_RUN = re.compile(rf"(?P<name>{_NAMES})|(?P<digits>[0-9]+)|(?P<dot>{_DOT})|(?P<plus>{_PLUS}|\+)", re.I)
# What every match of _BARE holds, and what every run of _RUN holds that is rewritten: a word beside another token.
_SAYS_DOT = re.compile(rf"\s(?:{_DOT})\s", re.I)
_SAYS_RUN = re.compile(rf"(?<!\w)(?:{_NAMES}|{_DOT}|{_PLUS}){_NEXT}{_TOKEN}|(?:[0-9]{_NEXT}|\+{_GAP}?)(?:{_NAMES}|{_DOT}|{_PLUS})(?!\w)", re.I)


def _plain(c: str) -> str:
    """What one character is written as."""
    if c in _DROPPED:
        return ""
    if c in _ALIKE:
        return _ALIKE[c]
    if c in _SIGNS:
        return _SIGNS[c]
    o = ord(c)
    if 0xFF01 <= o <= 0xFF5E:
        return chr(o - 0xFEE0)
    if o > 0x7F and unicodedata.category(c) == "Nd":
        return str(unicodedata.decimal(c))
    if 0x1D400 <= o <= 0x1D7FF and len(n := unicodedata.normalize("NFKC", c)) == 1 and n.isascii():
        return n
    return c


# Every character that is written as another, by the rules above; all of them lie below U+20000.
_WRITTEN = {c: n for c in map(chr, range(0x80, 0x20000)) if (n := _plain(c)) != c}


class Tape:
    """Text under rewriting: each character with the source span it stands for."""

    def __init__(self, text: str):
        self.text, self.first, self.last = text, range(len(text)), range(1, len(text) + 1)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace spans (in order, apart from each other); new characters stand for the whole span replaced."""
        if not edits:
            return
        text, first, last, at = [], [], [], 0
        for a, b, new in edits:
            text.append(self.text[at:a])
            first += self.first[at:a]
            last += self.last[at:a]
            text.append(new)
            first += [self.first[a]] * len(new)
            last += [self.last[b - 1]] * len(new)
            at = b
        text.append(self.text[at:])
        self.first = [*first, *self.first[at:]]
        self.last = [*last, *self.last[at:]]
        self.text = "".join(text)


def deobfuscate(text: str) -> Tape:
    """Three passes: characters, at and dot signs, spelled digits."""
    tape = Tape(text)
    if not (text.isascii() or _WRITTEN.keys().isdisjoint(text)):
        tape.rewrite([(i, i + 1, _WRITTEN[c]) for i, c in enumerate(text) if c in _WRITTEN])
    tape.rewrite([(m.start(), m.end(), "@" if m["at"] else ".") for m in _BRACKETED.finditer(tape.text)])
    if _SAYS_DOT.search(tape.text):
        tape.rewrite([(m.start() + s.start(), m.start() + s.end(), "@" if s["at"] else ".")
                      for m in _BARE.finditer(tape.text) for s in _BARE_SIGN.finditer(m[0])])
    if not _SAYS_RUN.search(tape.text):
        return tape
    edits = []
    for m in _RUN.finditer(tape.text):
        tokens = list(_IN_RUN.finditer(tape.text, m.start(), m.end()))
        if not any(t["name"] or t["dot"] or (t["plus"] and t["plus"] != "+") for t in tokens):
            continue
        if sum(len(t["digits"] or "") + bool(t["name"]) for t in tokens) < 4:
            continue
        for i, t in enumerate(tokens):
            new = _SPELLED[t["name"].lower()] if t["name"] else "." if t["dot"] else "+" if t["plus"] else t["digits"]
            edits.append((t.start(), t.end(), new))
            if i + 1 < len(tokens):
                after = tokens[i + 1]
                if t.end() < after.start():   # no gap beside signs or between two spelled digits; else one space
                    joined = t["dot"] or t["plus"] or after["dot"] or (t["name"] and after["name"])
                    kept = "." if tape.text[t.end():after.start()] == "." else " "
                    edits.append((t.end(), after.start(), "" if joined else kept))
    tape.rewrite(edits)
    return tape


def detect(text: str) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
    """Plain spans of ``text``, and the further spans that deobfuscation shows."""
    base = find_spans(text)
    tape = deobfuscate(text)
    if tape.text == text:
        return base, []
    more = []
    for a, kind, b in find_spans(tape.text):
        lo, hi = tape.first[a], tape.last[b - 1]
        if text[lo:hi] != tape.text[a:b] and not any(k == kind and x < hi and lo < y for x, k, y in base):
            more.append((lo, kind, hi))
    return base, more


def _said(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(spans, key=lambda x: (x[0], KINDS.index(x[1]))))


_OUT = "uid long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_disguised long, base_spans string, spans string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for text in b.column("text"):
            base, more = detect(text.as_py() or "")
            every = base + more
            rows.append((*(sum(k == kind for _, k, _ in every) for kind in KINDS), len(more), _said(base), _said(every)))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
        yield pa.RecordBatch.from_arrays([b.column("uid"), b.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:5]], *[pa.array(c, pa.string()) for c in cols[5:]]],
                                         ["uid", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "n_disguised", "base_spans", "spans"])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Spans of personal data in documents (doc_id, text), one row for each input row.

    ``spans`` lists kind:start:end (code points, end exclusive) of all finds by
    start, then kind; ``base_spans`` those that stand in the text undisguised;
    the counts are over all. Rows never leave their partition.

    Edge cases: a null text counts as empty and has no spans; texts are scanned
    whole and in time linear in their length; repeated rows are reported each;
    an empty table gives an empty result.
    """
    return with_uid(docs, "uid").select("uid", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_scan, _OUT)


def mask(text: str, spans: list[tuple[int, str, int]]) -> str:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans the first counts."""
    out, at = [], 0
    for a, kind, b in sorted(spans):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
            at = b
    return "".join([*out, text[at:]])


def sha256_hex(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()
