"""Benchmark decontamination by pigeonhole edit matching.

A test item of ``L`` normalised characters may differ from a passage by
``e = L // CHARS_PER_EDIT`` edits. Cut into ``e + 1`` pieces, at least one piece
of it stands in such a passage unchanged. An Aho-Corasick automaton finds all
pieces in a document, each hit names a window where the whole item may lie, and
Myers' bit-parallel algorithm gives the least edit distance in that window.
Items of a few words have no edits to spend: their one piece is the item itself.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.shared import stage, with_uid

#: One edit is allowed for so many characters of an item.
CHARS_PER_EDIT = 13
#: Items with fewer words say too little to be recognised with edits; they match unchanged and as whole words only.
MIN_WORDS = 5
#: Items with fewer normalised characters match nothing: they are single words or numbers that any text may hold.
MIN_CHARS = 12
#: Characters of items that one pass over the documents searches for (one item at least).
BLOCK_CHARS = 1_000_000

_BREAK = re.compile(r"[\W_]+")


def normalise(text: str | None) -> str:
    """Lower-cased words (runs of letters and digits) joined by single spaces."""
    return _BREAK.sub(" ", (text or "").lower()).strip()


def budget(length: int, chars_per_edit: int = CHARS_PER_EDIT) -> int:
    return length // chars_per_edit


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` consecutive pieces of nearly equal length with their places."""
    n, k = len(item), errors + 1
    cut = [i * n // k for i in range(k + 1)]
    return [(a, item[a:b]) for a, b in zip(cut, cut[1:], strict=False) if b > a]


def myers(pattern_bits: dict[str, int], m: int, text: str, most: int) -> tuple[int, int] | None:
    """Least distance of the whole pattern to any part of ``text`` and where that part ends, if at most ``most``."""
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = mask, 0, m
    best = None
    get = pattern_bits.get
    for i, c in enumerate(text):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = (mv | ~(xh | pv)) & mask
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & mask
        mh = (mh << 1) & mask
        pv = (mh | ~(xv | ph)) & mask
        mv = ph & xv
        if score <= most and (best is None or score < best[0]):
            best = (score, i + 1)
            if score == 0:
                break
    return best


class Matcher:
    """Finds near copies of a block of normalised items in normalised texts."""

    def __init__(self, items: list[tuple[int, str]], chars_per_edit: int = CHARS_PER_EDIT, min_words: int = MIN_WORDS):
        import ahocorasick

        self.items = []
        where: dict[str, list[tuple[int, int]]] = {}
        for key, item in items:
            short = item.count(" ") + 1 < min_words
            errors = 0 if short else budget(len(item), chars_per_edit)
            bits: dict[str, int] = {}
            for i, c in enumerate(item):
                bits[c] = bits.get(c, 0) | 1 << i
            for at, piece in pieces(item, errors):
                where.setdefault(piece, []).append((len(self.items), at))
            self.items.append((key, len(item), errors, None if short else bits))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in where.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    def find(self, text: str) -> dict[int, tuple[int, int]]:
        """By item key: the least distance, and the place in ``text`` where that passage ends."""
        if self.empty or not text:
            return {}
        windows: dict[int, list[list[int]]] = {}
        found: dict[int, tuple[int, int]] = {}
        for end, (size, uses) in self.automaton.iter(text):
            first = end + 1 - size
            for k, at in uses:
                key, length, errors, bits = self.items[k]
                if bits is None:
                    if key not in found and _whole(text, first, end + 1):
                        found[key] = (0, end + 1)
                    continue
                lo, hi = max(0, first - at - errors), min(len(text), first - at + length + errors)
                own = windows.setdefault(k, [])
                # Hits come in order of their ends, so windows of one item start nearly in order: join the overlapping ones.
                if own and lo <= own[-1][1] and hi >= own[-1][0]:
                    own[-1][0] = min(own[-1][0], lo)
                    own[-1][1] = max(own[-1][1], hi)
                else:
                    own.append([lo, hi])
        for k, own in windows.items():
            key, length, errors, bits = self.items[k]
            for lo, hi in own:
                got = myers(bits, length, text[lo:hi], errors)
                if got and (key not in found or got[0] < found[key][0]):
                    found[key] = (got[0], lo + got[1])
                    if got[0] == 0:
                        break
        return found

    def touches(self, text: str) -> bool:
        return bool(self.find(text))


def _whole(text: str, lo: int, hi: int) -> bool:
    """Whether text[lo:hi] ends where words end. Letters without case are of scripts that need no space between words."""
    def open_edge(inside: str, at: int) -> bool:
        return not 0 <= at < len(text) or text[at] == " " or unicodedata.category(inside) == "Lo"

    return open_edge(text[lo], lo - 1) and open_edge(text[hi - 1], hi)


def _normal_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.array([normalise(x) for x in b.column("text").to_pylist()], pa.string())], ["item_id", "item"])


def _search(batches: Iterator[pa.RecordBatch], items: list[tuple[int, str]], chars_per_edit: int, min_words: int) -> Iterator[pa.RecordBatch]:
    matcher = Matcher(items, chars_per_edit, min_words)
    for b in batches:
        rows = []
        for uid, doc_id, text in zip(b.column("uid").to_pylist(), b.column("doc_id").to_pylist(), b.column("text"), strict=True):
            rows += [(uid, doc_id, key, d, end) for key, (d, end) in matcher.find(normalise(text.as_py())).items()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
            zip(*rows, strict=True) if rows else [[]] * 5, [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()], strict=True)],
            ["uid", "doc_id", "key", "edits", "ends_at"])


def _clean(batches: Iterator[pa.RecordBatch], items: list[tuple[int, str]], chars_per_edit: int, min_words: int) -> Iterator[pa.RecordBatch]:
    matcher = Matcher(items, chars_per_edit, min_words)
    for b in batches:
        keep = [not matcher.touches(normalise(t.as_py())) for t in b.column("text")]
        yield b.filter(pa.array(keep, pa.bool_()))


def _items(benchmark: DataFrame) -> DataFrame:
    """item_id, item (normalised), key (one for each different item); staged."""
    plain = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return stage(plain.mapInArrow(_normal_items, "item_id long, item string")
                 .where(F.length("item") >= MIN_CHARS).withColumn("key", F.xxhash64("item")))


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The different items in blocks; the driver holds one block at a time."""
    different = items.select("key", "item").distinct()
    chars = different.agg(F.sum(F.length("item"))).first()[0] or 0
    n = max(1, -(-chars // block_chars))
    for i in range(n):
        got = different.where(F.pmod(F.xxhash64(F.lit(5), "key"), F.lit(n)) == i).collect()
        if got:
            yield sorted((r["key"], r["item"]) for r in got)


def contaminated(docs: DataFrame, benchmark: DataFrame, chars_per_edit: int = CHARS_PER_EDIT, min_words: int = MIN_WORDS,
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Documents (doc_id, text) that hold a near copy of a benchmark item (item_id, text).

    One row for each document row and item: uid (place in the scan), doc_id,
    item_id, edits (the least distance) and ends_at (where that passage ends, in
    normalised characters). Both sides are lower-cased and reduced to words. The
    benchmark is searched in blocks of bounded size, each in one pass over all
    documents.

    Edge cases: null, empty or wordless texts hold nothing; an item of fewer
    than ``min_words`` words (an unspaced script counts as one) matches where it
    stands unchanged as whole words, one of fewer than 12 characters nowhere; equal items are searched once and
    all reported; repeated documents are reported each; empty tables on either
    side give an empty result.
    """
    spark = docs.sparkSession
    items = _items(benchmark)
    texts = with_uid(docs, "uid").select("uid", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = "uid long, doc_id long, key long, edits int, ends_at long"
    found = spark.createDataFrame([], kind)
    for block in _blocks(items, block_chars):
        shared = spark.sparkContext.broadcast(block)
        found = found.unionByName(texts.mapInArrow(lambda b, s=shared: _search(b, s.value, chars_per_edit, min_words), kind))
    return found.join(items.select("key", "item_id"), "key").select("uid", "doc_id", "item_id", "edits", "ends_at")


def decontaminate(docs: DataFrame, benchmark: DataFrame, chars_per_edit: int = CHARS_PER_EDIT, min_words: int = MIN_WORDS,
                  block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the documents that hold a near copy of a benchmark item; no row is shuffled.

    Edge cases as in ``contaminated``: what holds nothing stays, copies go or
    stay alike, an empty table on either side changes nothing; all columns are kept.
    """
    spark = docs.sparkSession
    schema = docs.schema
    for block in _blocks(_items(benchmark), block_chars):
        shared = spark.sparkContext.broadcast(block)
        docs = docs.mapInArrow(lambda b, s=shared: _clean(b, s.value, chars_per_edit, min_words), schema)
    return docs
