"""Exact removal of repeated byte strings by distributed prefix doubling.

The suffix of each position is ranked by a prefix that grows from round to
round (``ROUNDS``). In a round of length ``L`` the rank of a position is the
pair of the ranks, of half that length or more, at the position and at an
offset behind it: (0, 16) makes 32 bytes, (0, 32) makes 64, and offsets that
overlap make the last lengths. Spark deals the rank pairs out and each task
sorts its own; positions whose rank is unique drop out, and after the last
round, at the threshold, equal ranks are equal strings.

Not every position is sent. Of the positions in a window of threshold length,
the one whose rank of length ``L`` is least stands for the window (any two equal
windows choose the same), and consecutive windows with one choice form a run,
which is a row: at first about one for 35 bytes. Runs that agree in all their
bytes are settled at once, the later ones being repeats throughout. Only runs
whose rank is shared but whose bytes differ go to the next round.

Ranks are 64-bit digests of the strings. Rows count as equal if two such digests
agree, the rank and one of all bytes of the run, so chance equality needs 2**64
rows or so.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.shared import text_arrays, with_uid, write_stage

THRESHOLD = 100
ROUNDS = (32, 64, 84)
_CHUNK = 1 << 19      # bytes hashed at a time
_PIECE = 1 << 21      # windows of one text in a piece
_LAST = np.iinfo(np.int64).max

U = np.uint64
_C1, _C2, _C3 = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)
_FIELDS = [("rank", pa.int64()), ("whole", pa.int64()), ("doc", pa.int64()), ("uid", pa.int64()), ("lo", pa.int64()),
           ("hi", pa.int64()), ("kind", pa.int32()), ("bytes", pa.binary())]
_SCHEMA = "rank long, whole long, doc long, uid long, lo long, hi long, kind int, bytes binary"
#: Kinds of rows: a run to rank, a run that repeats an earlier one, a run for the next round.
RUN, REPEAT, NEXT = 0, 1, 2


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(32))
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(29)
    return x


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rank of a pair of ranks."""
    return _mix(a * _C1 + b * _C2)


def _ranks(b: np.ndarray, most: int) -> dict[int, np.ndarray]:
    """Ranks of all positions by their prefixes of 1, 2, 4, ... bytes up to ``most``; only the last two lengths are kept."""
    rank, size, out = _mix(b.astype(np.uint64) * _C1 + U(77)), 1, {}
    out[1] = rank
    while size * 2 <= most and len(rank) > size:
        rank = _pair(rank[:-size], rank[size:])
        out.pop(size // 4, None)
        size *= 2
        out[size] = rank
    return out


def _rank_at(ranks: dict[int, np.ndarray], length: int, n: int) -> np.ndarray:
    """Ranks of the first ``n - length + 1`` positions by prefixes of ``length`` bytes, from two overlapping shorter ones."""
    if length in ranks:
        return ranks[length][:n - length + 1]
    half = max(s for s in ranks if s < length)
    r = ranks[half]
    return _pair(r[:n - length + 1], r[length - half:length - half + n - length + 1])


def find_runs(data: np.ndarray, at: np.ndarray, length: int, threshold: int = THRESHOLD) -> tuple[np.ndarray, ...]:
    """Runs of windows of ``threshold`` bytes in segments of ``data`` (offsets ``at``, each at least that long).

    Returns, for each run: segment, first and last window in it, rank of the
    chosen position by ``length`` bytes, and a digest of all bytes of the run.
    """
    out = []
    sizes = np.diff(at)
    i, n_seg = 0, len(sizes)
    while i < n_seg:
        j = max(i + 1, int(np.searchsorted(at, at[i] + _CHUNK, "right")) - 1)
        if j == i + 1 and sizes[i] > _PIECE + threshold:
            for a in range(0, int(sizes[i]) - threshold + 1, _PIECE):
                b = min(a + _PIECE + threshold - 1, int(sizes[i]))
                seg, lo, hi, rank, whole = _chunk(data[at[i] + a:at[i] + b], np.array([0, b - a]), length, threshold)
                out.append((seg + i, lo + a, hi + a, rank, whole))
        else:
            seg, lo, hi, rank, whole = _chunk(data[at[i]:at[j]], at[i:j + 1] - at[i], length, threshold)
            out.append((seg + i, lo, hi, rank, whole))
        i = j
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _chunk(b: np.ndarray, at: np.ndarray, length: int, threshold: int) -> tuple[np.ndarray, ...]:
    n = len(b)
    top = 1 << (threshold.bit_length() - 1)                 # the longest power of two in the threshold
    own = _rank_at(_ranks(b, 1 << (length.bit_length() - 1)), length, n)
    far = _rank_at(_ranks(b, top), threshold, n)            # of whole windows
    width = threshold - length + 1
    low = U((1 << 24) - 1)
    least = (own & ~low) | np.arange(len(own), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
    chosen = (least & low).astype(np.int64)
    p = np.arange(n - threshold + 1)
    seg = np.repeat(np.arange(len(at) - 1), np.diff(at))[:len(p)]
    inside = p + threshold <= at[seg + 1]
    p, seg, chosen = p[inside], seg[inside], chosen[inside]
    if not len(p):
        return seg, p, p, p.view(np.uint64), p.view(np.uint64)
    first = np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (seg[1:] != seg[:-1])])
    s = np.flatnonzero(first)
    lo, hi, c = p[s], p[np.concatenate([s[1:] - 1, [len(p) - 1]])], chosen[s]
    # A run is covered by its first and its last window, as it is shorter than two of them.
    whole = _mix(_mix(far[lo] * _C2 + far[hi] * _C3) + _C1 * ((hi - lo) * 256 + (c - lo)).astype(np.uint64))
    base = at[seg[s]]
    return seg[s], lo - base, hi - base, own[c], whole


def _batch(rank, whole, doc, uid, lo, hi, kind, raw=None) -> pa.RecordBatch:
    n = len(rank)
    cols = [np.asarray(x).view(np.int64) if np.asarray(x).dtype == np.uint64 else x for x in (rank, whole, doc, uid, lo, hi)]
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols], pa.array(kind, pa.int32()),
                                       pa.nulls(n, pa.binary()) if raw is None else raw], [f for f, _ in _FIELDS])


def _slices(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Array:
    """Binary array of data[a:b] for each row."""
    sizes = b - a
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(a - ends[:-1], sizes) + np.arange(ends[-1])
    return pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data[at].tobytes())])


def _order(doc, uid, lo, *more) -> np.ndarray:
    return np.lexsort((lo, uid, doc, *more))


def _join_runs(uid: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Join runs of a row that follow each other."""
    if not len(uid):
        return uid, lo, hi
    o = np.lexsort((lo, uid))
    uid, lo, hi = uid[o], lo[o], hi[o]
    first = np.concatenate([[True], (uid[1:] != uid[:-1]) | (lo[1:] > hi[:-1] + 1)])
    s = np.flatnonzero(first)
    return uid[s], lo[s], np.maximum.reduceat(hi, s)


def _rank_runs(data: np.ndarray, at: np.ndarray, base: np.ndarray, doc: np.ndarray, uid: np.ndarray, length: int,
               threshold: int, carry: bool) -> Iterator[pa.RecordBatch]:
    """Rows of one batch of segments; runs repeated in the batch itself are settled here."""
    seg, lo, hi, rank, whole = find_runs(data, at, length, threshold)
    d, u, l0, h0 = doc[seg], uid[seg], lo + base[seg], hi + base[seg]
    o = _order(d, u, l0, whole, rank)
    new = np.ones(len(o), bool)
    new[1:] = (rank[o][1:] != rank[o][:-1]) | (whole[o][1:] != whole[o][:-1])
    keep, drop = o[new], o[~new]
    keep.sort()   # in the order of the texts, which compresses best
    start = at[seg[keep]]
    raw = _slices(data, start + lo[keep], start + hi[keep] + threshold) if carry else None
    yield _batch(rank[keep], whole[keep], d[keep], u[keep], l0[keep], h0[keep], np.full(len(keep), RUN), raw)
    if len(drop):
        x, y, z = _join_runs(u[drop], l0[drop], h0[drop])
        yield _batch(x * 0x9E3779B1 + y, x * 0, x * 0, x, y, z, np.full(len(x), REPEAT))


def _first_round(batches: Iterator[pa.RecordBatch], length: int, threshold: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, at = text_arrays(b.column("text"))
        long = np.flatnonzero(np.diff(at) >= threshold)
        if not len(long):
            continue
        doc = b.column("doc").to_numpy()[long]
        uid = b.column("uid").to_numpy()[long]
        if len(long) < b.num_rows:   # close the gaps that short texts leave
            sizes = np.diff(at)[long]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            data = data[np.repeat(at[:-1][long] - ends[:-1], sizes) + np.arange(ends[-1])]
            at = ends
        yield from _rank_runs(data, at, np.zeros(len(long), np.int64), doc, uid, length, threshold, False)


def _from_texts(batches: Iterator[pa.RecordBatch], length: int, threshold: int) -> Iterator[pa.RecordBatch]:
    """The next round from whole texts and the runs that are left in them."""
    for b in batches:
        data, at = text_arrays(b.column("text"))
        runs = b.column("runs")
        n = np.diff(np.asarray(runs.offsets))
        lo = np.asarray(runs.flatten().field("lo"))
        hi = np.asarray(runs.flatten().field("hi"))
        row, lo, hi = _join_runs(np.repeat(np.arange(b.num_rows), n), lo, hi)
        if not len(row):
            continue
        yield from _segments(data, at[row] + lo, at[row] + hi + threshold, lo, b.column("doc").to_numpy()[row], b.column("uid").to_numpy()[row], length, threshold)


def _segments(data, a, b, base, doc, uid, length, threshold) -> Iterator[pa.RecordBatch]:
    sizes = b - a
    ends = np.concatenate([[0], np.cumsum(sizes)])
    part = data[np.repeat(a - ends[:-1], sizes) + np.arange(ends[-1])]
    yield from _rank_runs(part, ends, base, doc, uid, length, threshold, length < threshold)


def _from_runs(batches: Iterator[pa.RecordBatch], length: int, threshold: int) -> Iterator[pa.RecordBatch]:
    """The next round from runs that carry their bytes."""
    for b in batches:
        if not b.num_rows:
            continue
        data, at = text_arrays(b.column("bytes"))
        yield from _segments(data, at[:-1], at[1:], b.column("lo").to_numpy(), b.column("doc").to_numpy(), b.column("uid").to_numpy(), length, threshold)


def _settle(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
    """Sort one partition's rows by rank: repeats, and firsts whose rank is shared by other bytes; unique ranks drop out."""
    held = list(batches)
    if not held:
        return
    t = pa.Table.from_batches(held).combine_chunks()
    kind = t.column("kind").to_numpy()
    done = np.flatnonzero(kind == REPEAT)
    uid, lo, hi, doc = (t.column(c).to_numpy() for c in ("uid", "lo", "hi", "doc"))
    run = np.flatnonzero(kind == RUN)
    rank, whole = t.column("rank").to_numpy()[run], t.column("whole").to_numpy()[run]
    o = _order(doc[run], uid[run], lo[run], whole, rank)
    rank, whole, run = rank[o], whole[o], run[o]
    new_rank = np.ones(len(run), bool)
    new_rank[1:] = rank[1:] != rank[:-1]
    new = new_rank.copy()
    new[1:] |= whole[1:] != whole[:-1]
    again = np.concatenate([done, run[~new]])
    if len(again):
        x, y, z = _join_runs(uid[again], lo[again], hi[again])
        yield _batch(x * 0, x * 0, x * 0, x, y, z, np.full(len(x), REPEAT))
    if not last and len(run):
        of = np.cumsum(new_rank) - 1
        shared = np.bincount(of, weights=new)[of] > 1
        go = run[new & shared]
        if len(go):
            yield _batch(go * 0, go * 0, doc[go], uid[go], lo[go], hi[go], np.full(len(go), NEXT),
                         t.column("bytes").combine_chunks().take(pa.array(go)))


def repeated_runs(docs: DataFrame, threshold: int = THRESHOLD, rounds: tuple[int, ...] = ROUNDS) -> DataFrame:
    """``uid, lo, hi``: windows of ``threshold`` bytes at lo to hi of a text that also start earlier.

    ``docs`` has uid, doc and text. Earlier means a smaller (doc, uid), or the
    same row and a smaller position.
    """
    lengths = [x for x in rounds if x < threshold]

    def deal(rows: DataFrame, last: bool, name: str) -> DataFrame:
        return write_stage(rows.repartition("rank").mapInArrow(lambda b: _settle(b, last), _SCHEMA), name)

    found = []
    state = None
    for k, length in enumerate([*lengths, threshold]):
        if state is None:
            rows = docs.mapInArrow(lambda b, n=length: _first_round(b, n, threshold), _SCHEMA)
        elif k == 1:
            runs = state.where(F.col("kind") == NEXT).groupBy("uid").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
            rows = docs.join(runs, "uid").select("uid", "doc", "text", "runs").mapInArrow(lambda b, n=length: _from_texts(b, n, threshold), _SCHEMA)
        else:
            rows = state.where(F.col("kind") == NEXT).mapInArrow(lambda b, n=length: _from_runs(b, n, threshold), _SCHEMA)
        state = deal(rows, length == threshold, f"ranks{length}")
        found.append(state.where(F.col("kind") == REPEAT).select("uid", "lo", "hi"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def cut(text: bytes, lo: np.ndarray, hi: np.ndarray, threshold: int = THRESHOLD) -> tuple[bytes, int, int]:
    """Remaining bytes, removed bytes and removed runs when the windows at lo to hi (inclusive) go."""
    if not len(lo):
        return text, 0, 0
    o = np.argsort(lo, kind="stable")
    a, b = lo[o], np.maximum.accumulate(hi[o] + threshold)
    first = np.concatenate([[True], a[1:] > b[:-1]])
    s = np.flatnonzero(first)
    a, b = a[s], b[np.concatenate([s[1:] - 1, [len(b) - 1]])]
    kept, at = [], 0
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        kept.append(text[at:x])
        at = y
    kept.append(text[at:])
    return b"".join(kept), int((b - a).sum()), len(a)


def _cut_all(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    none = np.zeros(0, np.int64)
    for b in batches:
        data, at = text_arrays(b.column("text"))
        raw = data.tobytes()
        runs = b.column("runs")
        offsets = np.asarray(runs.offsets)
        lo, hi = np.asarray(runs.values.field("lo")), np.asarray(runs.values.field("hi"))
        rows = []
        for k in range(b.num_rows):
            x, y = int(offsets[k]), int(offsets[k + 1])
            whole = raw[at[k]:at[k + 1]]
            kept, removed, n = cut(whole, lo[x:y] if y > x else none, hi[x:y] if y > x else none, threshold)
            rows.append((len(whole), removed, n, kept))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([b.column("uid"), b.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.binary())],
                                         ["uid", "doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD, rounds: tuple[int, ...] = ROUNDS) -> DataFrame:
    """Documents (doc_id, text) without bytes covered by a ``threshold``-byte string that also starts earlier.

    Texts are taken as UTF-8 bytes; strings never cross texts and are judged on
    the input. One row for each input row: uid (place in the scan), doc_id,
    n_bytes, n_removed, n_spans (maximal removed runs) and kept (the rest,
    binary, as a cut may fall inside a character).

    Edge cases: a null text counts as empty; texts shorter than ``threshold``
    lose nothing; rows with a null doc_id come after all others, and rows with
    equal ids follow the order of the scan; an empty table gives an empty
    result.
    """
    base = with_uid(docs, "uid").select("uid", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranked = base.select("uid", F.coalesce("doc_id", F.lit(int(_LAST))).alias("doc"), "text")
    runs = repeated_runs(ranked, threshold, rounds).groupBy("uid").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    whole = base.join(runs, "uid", "left").withColumn("runs", F.coalesce("runs", F.expr("cast(array() as array<struct<lo:bigint,hi:bigint>>)")))
    return whole.select("uid", "doc_id", "text", "runs").mapInArrow(
        lambda b: _cut_all(b, threshold), "uid long, doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
