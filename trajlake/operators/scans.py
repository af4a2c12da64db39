"""Ordered scans over one key's log, split into chunks so that no single task
holds a whole key.

A robot, job or collection may own a large share of all rows. A window
``partitionBy(robot).orderBy(ts)`` would put that whole log into one task.
Every ordered computation the operators need -- running sum, running max,
lag, last-non-null, and the max-plus queue recurrence with resets -- is an
associative prefix scan, so it is computed in levels:

1. a window per ``(key, chunk)``, where ``chunk`` is a time bucket of the row
   (bounded by how many rows one key can produce per bucket), and
2. a scan of the chunk summaries (one row per chunk), whose result is joined
   back on ``(key, chunk)``. The summaries are scanned in the same way: in
   windows of ``FANOUT`` chunks, then over one row for each such window, and so
   on until a key has no more than ``FANOUT`` rows. How many levels that takes
   follows from the chunk width, so no job runs while a plan is built.

The join's large side is already hash-partitioned on ``(key, chunk)`` by the
first window's exchange, so only the small summary side moves; AQE may turn
that side into a broadcast when its measured size is under the threshold.

Keys may be null: windows and joins use one struct of the key columns, which is
never null itself and equals another struct whose fields are null alike.
Chunk and struct columns start with ``__chunk_``; ``drop_chunks`` removes them.

Callers guarantee that ``chunk`` is non-decreasing in the order columns.
``chunk=None`` skips all levels but the first: plain per-key windows, for data
where no key is large.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a key that one window reads above the first level, as a power of two.
FANOUT_BITS = 20
#: The longest log: with the width of a chunk it bounds the chunks of a key, and so the levels. A longer one is scanned
#: right as well, in a larger top window.
HORIZON_US = 100 * 366 * 86_400_000_000


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def _order(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def _keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, str, bool]:
    """``df`` with one null-safe key column, its name, and whether it was added here."""
    name = "__chunk_key_" + "_".join(keys)
    return (df, name, False) if name in df.columns else (df.withColumn(name, F.struct(*_cols(keys))), name, True)


def with_chunk(df: DataFrame, ts: str, chunk_us: int | None, reuse: bool = False,
               keys: Sequence[str] | None = None) -> tuple[DataFrame, str | None]:
    """Add the chunk column for a width (named after the width), or nothing when not chunking.

    With ``reuse`` an existing column of the same width (left by an earlier
    operator over the same rows and time column) is kept, so the data keeps
    the hash partitioning that operator gave it and no second shuffle is needed.
    ``keys``: also add their struct, so that several scans over them share it.
    """
    if chunk_us is None:
        return df, None
    from trajlake.functions.timecols import time_chunk
    name = f"__chunk_{int(chunk_us)}"
    if not (reuse and name in df.columns):
        df = df.withColumn(name, time_chunk(ts, chunk_us))
    return (_keyed(df, keys)[0] if keys else df), name


def drop_chunks(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__chunk_")])


def attach_by_chunk(df: DataFrame, per_key: DataFrame, key: str | Sequence[str], chunk: str | None,
                    log: DataFrame | None = None, hint: str | None = None) -> DataFrame:
    """Inner-join one row per key to a log in which one key may hold most rows.

    The log's distinct ``(key, chunk)`` pairs (combined map-side) get the key's
    row first; the log then joins on ``(key, chunk)``, so a hot key's rows are
    spread over its chunks. The pairs are one small row per key and chunk.
    ``log``: a cheaper frame that holds the pairs of ``df`` (its source).
    ``hint``: the strategy of the joins that add the key's row and the pairs.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if chunk is None:
        return df.join(per_key.hint(hint) if hint else per_key, keys)
    pairs = (df if log is None else log).select(*keys, chunk).distinct().join(per_key.hint(hint) if hint else per_key, keys)
    return df.join(pairs.hint(hint) if hint else pairs, [*keys, chunk])


# ---------------------------------------------------------------------------
# Scans of chunk summaries
# ---------------------------------------------------------------------------
_FNS = {"sum": F.sum, "max": F.max, "min": F.min, "last": lambda c: F.last(c, ignorenulls=True)}


def _joined_value(fn: str, here: Column, before: Column) -> Column:
    if fn == "sum":
        return F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0))
    return {"max": F.greatest, "min": F.least, "last": F.coalesce}[fn](here, before)


def _levels(chunk: str, fanout_bits: int) -> int:
    width = re.fullmatch(r"__chunk_(\d+)", chunk)
    rows, n = HORIZON_US // int(width[1]) if width else 0, 0
    while rows >> fanout_bits:
        rows, n = rows >> fanout_bits, n + 1
    return n


def before_chunk(rows: DataFrame, key: str, chunk: str, aggs: dict[str, tuple[str, str]], levels: int,
                 fanout_bits: int | None = None, reverse: bool = False) -> DataFrame:
    """``rows`` (one per key and chunk) with aggregates over all earlier chunks of the key (later ones with ``reverse``).

    ``aggs``: output -> (sum, max, min or last, value). A sum over no chunk is 0, any other aggregate null.
    """
    bits = FANOUT_BITS if fanout_bits is None else fanout_bits
    ahead = F.col(chunk).desc() if reverse else F.col(chunk).asc()
    if not levels:
        w = Window.partitionBy(key).orderBy(ahead).rowsBetween(Window.unboundedPreceding, -1)
        return rows.select("*", *[F.coalesce(_FNS[fn](v).over(w), F.lit(0)).alias(o) if fn == "sum" else _FNS[fn](v).over(w).alias(o)
                                  for o, (fn, v) in aggs.items()])
    up = f"{chunk}_up"
    rows = rows.withColumn(up, F.shiftright(F.col(chunk), bits))
    w = Window.partitionBy(key, up).orderBy(ahead).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.select("*", *[_FNS[fn](v).over(w).alias(f"{o}__here") for o, (fn, v) in aggs.items()])
    newest = F.min_by if reverse else F.max_by
    totals = rows.groupBy(key, up).agg(*[
        (newest(F.col(v), F.when(F.col(v).isNotNull(), F.col(chunk))) if fn == "last" else _FNS[fn](v)).alias(f"{o}__all")
        for o, (fn, v) in aggs.items()])
    above = before_chunk(totals, key, up, {f"{o}__ahead": (fn, f"{o}__all") for o, (fn, _) in aggs.items()}, levels - 1, bits, reverse)
    joined = local.join(above.select(key, up, *[f"{o}__ahead" for o in aggs]), [key, up], "left")
    return joined.select(*[c for c in rows.columns if c != up], *[
        _joined_value(fn, F.col(f"{o}__here"), F.col(f"{o}__ahead")).alias(o) for o, (fn, _) in aggs.items()])


def _carry(df: DataFrame, key: str, chunk: str, totals: dict[str, Column], aggs: dict[str, tuple[str, str]], fanout_bits: int | None) -> DataFrame:
    """Chunk summaries of ``df`` scanned: key, chunk and the outputs of ``aggs`` over ``totals``."""
    summary = df.groupBy(key, chunk).agg(*[c.alias(o) for o, c in totals.items()])
    bits = FANOUT_BITS if fanout_bits is None else fanout_bits
    return before_chunk(summary, key, chunk, aggs, _levels(chunk, bits), bits).select(key, chunk, *aggs)


# ---------------------------------------------------------------------------
# Scans of rows
# ---------------------------------------------------------------------------
def chunked_prefix(df: DataFrame, keys: Sequence[str], chunk: str | None, order: Sequence[str | Column],
                   aggs: dict[str, tuple[str, str]], range_frame: bool = False, fanout_bits: int | None = None) -> DataFrame:
    """Several running aggregates in one pass over the rows.

    ``aggs`` maps an output column to ``(fn, value)`` with ``fn`` in sum, max,
    min (associative and commutative, so chunk totals combine with the same
    function). With ``range_frame`` (a single order column) rows with equal
    order value are aggregated together, so ties apply at once.
    """
    def running(parts: Sequence[str]) -> list[Column]:
        w = Window.partitionBy(*parts).orderBy(*_order(order))
        w = (w.rangeBetween if range_frame else w.rowsBetween)(Window.unboundedPreceding, Window.currentRow)
        return [_FNS[fn](v).over(w) for fn, v in aggs.values()]

    if chunk is None:
        return df.select("*", *[c.alias(o) for o, c in zip(aggs, running(keys), strict=True)])
    df, key, added = _keyed(df, keys)
    local = df.select("*", *[c.alias(f"__l_{o}") for o, c in zip(aggs, running([key, chunk]), strict=True)])
    carry = _carry(df, key, chunk, {f"__t_{o}": _FNS[fn](v) for o, (fn, v) in aggs.items()},
                   {f"__c_{o}": (fn, f"__t_{o}") for o, (fn, _) in aggs.items()}, fanout_bits)
    joined = local.join(carry, [key, chunk], "left")
    out = joined.select(*[c for c in df.columns if not (added and c == key)], *[
        (F.col(f"__l_{o}") + F.coalesce(F.col(f"__c_{o}"), F.lit(0)) if fn == "sum" else _joined_value(fn, F.col(f"__l_{o}"), F.col(f"__c_{o}"))).alias(o)
        for o, (fn, _) in aggs.items()])
    return out


def chunked_running_sum(df: DataFrame, keys: Sequence[str], chunk: str | None, order: Sequence[str | Column],
                        value: str, out: str, range_frame: bool = False) -> DataFrame:
    """``out = sum(value)`` over all rows of the key up to and including this one."""
    return chunked_prefix(df, keys, chunk, order, {out: ("sum", value)}, range_frame)


def chunked_carry_last(df: DataFrame, keys: Sequence[str], chunk: str | None, order: Sequence[str | Column],
                       value: str, out: str, fanout_bits: int | None = None, before: bool = False) -> DataFrame:
    """``out`` = last non-null ``value`` at or before this row (per key); with ``before`` of earlier rows only."""
    def last(parts: Sequence[str]) -> Column:
        w = Window.partitionBy(*parts).orderBy(*_order(order)).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
        return F.last(value, ignorenulls=True).over(w)

    if chunk is None:
        return df.withColumn(out, last(keys))
    df, key, added = _keyed(df, keys)
    local = df.withColumn("__sc_local", last([key, chunk]))
    newest = F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*_order(order))))
    carry = _carry(df, key, chunk, {"__sc_last": newest}, {"__sc_carry": ("last", "__sc_last")}, fanout_bits)
    joined = local.join(carry, [key, chunk], "left").withColumn(out, F.coalesce("__sc_local", "__sc_carry"))
    return joined.select(*[c for c in df.columns if c != out and not (added and c == key)], out)


def chunked_lag(df: DataFrame, keys: Sequence[str], chunk: str | None, order: Sequence[str | Column],
                value: str, out: str, fanout_bits: int | None = None) -> DataFrame:
    """``out`` = ``value`` of the previous row of the same key (null for the first)."""
    if chunk is None:
        return df.withColumn(out, F.lag(value).over(Window.partitionBy(*_cols(keys)).orderBy(*_order(order))))
    df, key, added = _keyed(df, keys)
    w = Window.partitionBy(key, chunk).orderBy(*_order(order))
    local = df.withColumn("__sc_local", F.lag(value).over(w)).withColumn("__sc_rn", F.row_number().over(w))
    # a struct, so that a null value is carried like any other
    newest = F.max_by(F.struct(F.col(value).alias("v")), F.struct(*_order(order)))
    carry = _carry(df, key, chunk, {"__sc_last": newest}, {"__sc_carry": ("last", "__sc_last")}, fanout_bits)
    joined = local.join(carry, [key, chunk], "left").withColumn(
        out, F.when(F.col("__sc_rn") == 1, F.col("__sc_carry.v")).otherwise(F.col("__sc_local")))
    return joined.select(*[c for c in df.columns if c != out and not (added and c == key)], out)


def chunked_lag_by_key(df: DataFrame, keys: Sequence[str], sub_keys: Sequence[str], chunk: str | None,
                       order: Sequence[str | Column], value: str, out: str, fanout_bits: int | None = None) -> DataFrame:
    """``chunked_lag`` per ``(keys, sub_keys)`` while the data stays hash-partitioned
    on ``(keys, chunk)`` only.

    ``sub_keys`` take few values per key (the arms of one robot), so the carry
    between chunks travels as a small map per ``(keys, chunk)``. The join back
    and any later scan on ``(keys, chunk)`` reuse the one shuffle made here;
    the key and chunk columns stay for it.
    """
    if chunk is None:
        return chunked_lag(df, [*keys, *sub_keys], None, order, value, out)
    df, key, _ = _keyed(df, keys)
    src, sub = df, F.struct(*_cols(sub_keys))
    df = df.repartition(F.col(key), F.col(chunk))
    w = Window.partitionBy(F.col(key), *_cols(sub_keys), F.col(chunk)).orderBy(*_order(order))
    local = (df.withColumn("__sc_local", F.lag(value).over(w))
             .withColumn("__sc_rn", F.row_number().over(w)))
    # from the input before the repartition: partial aggregation map-side, so
    # only one small row per (key, chunk) and task is shuffled for the summary
    whole = src.withColumn("__sc_key", F.struct(key, *_cols(sub_keys)))
    newest = F.max_by(F.struct(F.col(value).alias("v")), F.struct(*_order(order)))
    carry = _carry(whole, "__sc_key", chunk, {"__sc_last": newest}, {"__sc_carry": ("last", "__sc_last")}, fanout_bits)
    packed = (carry.select(F.col(f"__sc_key.{key}").alias(key), chunk, F.struct(*[F.col(f"__sc_key.{s}").alias(s) for s in sub_keys]).alias("k"), "__sc_carry")
              .groupBy(key, chunk).agg(F.map_from_entries(F.collect_list(F.struct("k", F.col("__sc_carry").alias("v")))).alias("__sc_map")))
    joined = local.join(packed, [key, chunk], "left")
    return (joined.withColumn(out, F.when(F.col("__sc_rn") == 1, F.element_at("__sc_map", sub)["v"])
                              .otherwise(F.col("__sc_local")))
            .drop("__sc_local", "__sc_rn", "__sc_map"))


def chunked_queue(df: DataFrame, keys: Sequence[str], chunk: str | None, order: Sequence[str | Column], arrival: str,
                  period: str, start: str | None = None, segment: str | None = None, clear: str | None = None,
                  fanout_bits: int | None = None) -> DataFrame:
    """Single-server queue where the wait counts toward the period, with resets.

    For actions in queue order with arrival ``a_i`` and period ``p_i``::

        g_i = max(a_i, e_{i-1})          # dequeue time
        e_i = max(a_i, e_{i-1} + p_i)    # end of the worker iteration

    No recursion: with ``S_i = sum_{k<=i} p_k``, ``e_i - S_i`` is the running
    maximum of ``a_j - S_j``. A reset forgets what came before: the maximum runs
    over structs ``(segment, a_j - S_j)``, whose order puts the current segment
    above all earlier ones, so it stays associative. A chunk passes on its total
    period and its last segment's maximum.

    Segments: none (one queue per key); ``segment``, a column that does not
    fall in queue order, with ``start``, when its queue became idle (null: since
    forever); or ``clear``, a boolean column of rows that are resets and not
    actions (``arrival`` their time, ``period`` 0), which come before actions at
    their instant. With ``clear`` the columns ``segment_id`` (resets so far),
    ``segment_start_us`` and ``next_clear_us`` are added in the same pass.

    Adds ``e_us``, ``g_us`` and ``prev_end_us`` (``e_{i-1}``; when the queue
    became idle for the first row of a segment).
    """
    asked = df.columns
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    idle = F.col(start) if start else none

    def local(frame: DataFrame, parts: Sequence[str]) -> DataFrame:
        by = Window.partitionBy(*parts)
        w = by.orderBy(*_order(order))
        run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        frame = frame.withColumn("__q_s", F.sum(period).over(run))
        if clear:
            at = F.when(F.col(clear), F.col(arrival))
            back = by.orderBy(*[(F.col(o) if isinstance(o, str) else o).desc() for o in order]).rowsBetween(Window.unboundedPreceding, -1)
            frame = (frame.withColumn("__q_seg", F.sum(F.col(clear).cast("bigint")).over(run))
                     .withColumn("__q_from", F.max(at).over(run)).withColumn("__q_next", F.min(at).over(back)))
        else:
            frame = frame.withColumn("__q_seg", F.col(segment).cast("bigint") if segment else zero)
        left = F.greatest(F.col(arrival) - F.col("__q_s"), idle - F.col("__q_s") + F.col(period))
        frame = frame.withColumn("__q_c", F.struct(F.col("__q_seg").alias("seg"), left.alias("v")))
        return frame.withColumn("__q_m", F.max("__q_c").over(run)["v"]).withColumn("__q_rn", F.row_number().over(w))

    def finish(frame: DataFrame, parts: Sequence[str], seg: Column, end: Column, first: Column) -> DataFrame:
        w = Window.partitionBy(*parts).orderBy(*_order(order))
        frame = frame.withColumn("__q_seg", seg).withColumn("e_us", end)
        before = F.lag(F.struct("__q_seg", "e_us")).over(w)
        same = F.when(before["__q_seg"] == F.col("__q_seg"), before["e_us"])
        # a reset row ends at its own time, which is when the queue it starts became idle
        return (frame.withColumn("prev_end_us", F.when(F.col("__q_rn") == 1, first).otherwise(F.coalesce(same, idle)))
                .withColumn("g_us", F.greatest(F.col(arrival), F.col("prev_end_us"))))

    added = ["segment_id", "segment_start_us", "next_clear_us"] if clear else []
    outs = [*added, "e_us", "g_us", "prev_end_us"]

    def named(frame: DataFrame, seg_from: Column, seg_next: Column) -> DataFrame:
        if clear:
            frame = frame.withColumns({"segment_id": F.col("__q_seg"), "segment_start_us": seg_from, "next_clear_us": seg_next})
        return frame.select(*[c for c in asked if c not in outs], *outs)

    if chunk is None:
        out = finish(local(df, keys), keys, F.col("__q_seg"), F.col("__q_s") + F.col("__q_m"), idle)
        return named(out, F.col("__q_from") if clear else none, F.col("__q_next") if clear else none)
    df, key, _ = _keyed(df, keys)
    parts = [key, chunk]
    loc = local(df, parts)
    totals = [F.sum(period).alias("__q_t"), F.max("__q_c").alias("__q_top")]
    if clear:
        at = F.when(F.col(clear), F.col(arrival))
        totals += [F.sum(F.col(clear).cast("bigint")).alias("__q_k"), F.max(at).alias("__q_newest"), F.min(at).alias("__q_oldest")]
    rows = loc.groupBy(*parts).agg(*totals)
    bits = FANOUT_BITS if fanout_bits is None else fanout_bits
    levels = _levels(chunk, bits)
    rows = before_chunk(rows, key, chunk, {"__q_r": ("sum", "__q_t"), **({"__q_kb": ("sum", "__q_k"), "__q_fb": ("max", "__q_newest")} if clear else {})}, levels, bits)
    if clear:
        rows = before_chunk(rows, key, chunk, {"__q_nb": ("min", "__q_oldest")}, levels, bits, reverse=True)
    base = F.col("__q_kb") if clear else zero
    rows = rows.withColumn("__q_in", F.struct((base + F.col("__q_top.seg")).alias("seg"), (F.col("__q_top.v") - F.col("__q_r")).alias("v")))
    rows = before_chunk(rows, key, chunk, {"__q_b": ("max", "__q_in")}, levels, bits)
    joined = loc.join(rows.select(*parts, "__q_r", "__q_b", *(["__q_kb", "__q_fb", "__q_nb"] if clear else [])), parts, "left")
    seg = base + F.col("__q_seg")
    carried = F.when(F.col("__q_b.seg") == seg, F.col("__q_b.v"))
    end = F.col("__q_s") + F.greatest(F.col("__q_m"), F.col("__q_r") + carried)
    # ``seg`` is worked out from the local number, so the carried end is too, before the number is replaced
    joined = joined.withColumn("__q_first", F.coalesce(F.col("__q_r") + carried, idle)).withColumn("__q_end", end)
    out = finish(joined, parts, seg, F.col("__q_end"), F.col("__q_first"))
    return named(out, F.greatest("__q_from", "__q_fb") if clear else none, F.coalesce("__q_next", "__q_nb") if clear else none)
