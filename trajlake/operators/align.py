"""Stream alignment and episode timing: positional zip (J1), cyclic
alignment (J2), frame timestamps (W7), episode statistics (A6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.functions.timecols import seconds_to_micros
from trajlake.schemas import NOMINAL_FPS

#: Ticks that one row makes.
TICK_BLOCK = 65_536


def positional_zip(left: DataFrame, right: DataFrame, on: Sequence[str] = ("episode", "frame_idx"),
                   prefixes: tuple[str, str] = ("left_", "right_")) -> DataFrame:
    """Row n of one stream pairs with row n of the other (equi-join on the
    ordinal). Non-key columns get the prefixes. Streams stop at the shorter one."""
    def pref(df: DataFrame, p: str) -> DataFrame:
        return df.select(*on, *[F.col(c).alias(p + c) for c in df.columns if c not in on])
    return pref(left, prefixes[0]).join(pref(right, prefixes[1]), list(on), "inner")


def cyclic_align(streams: DataFrame, ticks: DataFrame, episode: str = "episode", stream: str = "arm",
                 ordinal: str = "frame_idx", keep: Sequence[str] = (), together: bool = False) -> DataFrame:
    """Streams of different lengths that each restart from their start:
    tick n of an episode reads row ``n % len`` of every stream.

    ``ticks(episode, n_ticks)`` gives how many ticks to emit per episode
    (``n_ticks >= 1``). Ticks are made in blocks of ``TICK_BLOCK``: an episode
    yields one small row for each block, the blocks are dealt to tasks, and each
    makes its own ticks, so a long episode is neither one array nor one task.
    Empty streams have no rows, so they never divide by zero.
    With ``together`` the rows of an episode stay in the partition where they
    are: each gives its own ticks, which only suits streams that are dealt by
    ``episode`` already and are not replayed many times over. ``ticks`` without
    ``n_ticks`` then stands for as many as the longest stream has rows.
    Returns ``(episode, tick, stream, <stream columns>)`` and the columns ``keep`` of ``ticks``.
    """
    lens = streams.groupBy(episode, stream).agg(F.count(F.lit(1)).alias("__n"))
    if together:
        return _own_ticks(streams, lens, ticks, episode, stream, ordinal, keep)
    # merged: neither lengths nor ticks are sent whole through the driver, however well they compress
    blocks = (lens.join(tick_blocks(ticks, episode, "__block", keep).hint("merge"), episode)
              .repartition(F.col(episode), F.col(stream), F.col("__block")))
    begin = F.col("__block") * TICK_BLOCK
    grid = (blocks.select(episode, stream, "__n", *keep, F.explode(F.sequence(begin, F.least(begin + (TICK_BLOCK - 1), F.col("n_ticks") - 1))).alias("tick"))
            .withColumn(ordinal, F.col("tick") % F.col("__n")).drop("__n"))
    return grid.hint("merge").join(streams, [episode, stream, ordinal], "inner")


def _own_ticks(streams: DataFrame, lens: DataFrame, ticks: DataFrame, episode: str, stream: str, ordinal: str, keep: Sequence[str]) -> DataFrame:
    """``cyclic_align`` without moving ``streams``: row i of n gives the ticks i, i + n, i + 2n, ... before the last."""
    # the streams' lengths are one small row an episode, so that the join is by nothing but the episode
    named = lens.groupBy(episode).agg(F.max("__n").alias("__most"), F.map_from_entries(F.collect_list(
        F.when(F.col(stream).isNotNull(), F.struct(stream, "__n")))).alias("__n"))
    asked = F.col("n_ticks").cast("bigint") if "n_ticks" in ticks.columns else F.col("__most")
    till = ticks.join(named.hint("merge"), episode).select(episode, "__n", (asked - 1).alias("__last"), *keep).filter("__last >= 0")
    rows = streams.join(till.hint("shuffle_hash"), episode).withColumn("__n", F.element_at("__n", F.col(stream)))
    i = F.col(ordinal).cast("bigint")
    rows = rows.filter((i >= 0) & (i < F.col("__n")) & (i <= F.col("__last")))
    # in blocks: a row of a short stream is never one long array
    wide = F.col("__n") * TICK_BLOCK
    rest = [c for c in streams.columns if c not in (episode, stream)]
    blocks = rows.select("*", F.explode(F.sequence(i, F.col("__last"), wide)).alias("__from"))
    return blocks.select(episode, stream, *keep, *rest, F.explode(F.sequence(
        F.col("__from"), F.least(F.col("__last"), F.col("__from") + wide - 1), F.col("__n"))).alias("tick"))


def tick_blocks(ticks: DataFrame, episode: str, block: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(episode, n_ticks, *keep, block)``: a row for each block of ``TICK_BLOCK`` ticks, or part of one, of each episode."""
    n = F.col("n_ticks").cast("bigint")
    return ticks.filter(n >= 1).select(episode, n.alias("n_ticks"), *keep, F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.expr(f"(cast(n_ticks as bigint) - 1) div {TICK_BLOCK}"))).alias(block))


def frame_timestamps(frames: DataFrame, meta: DataFrame, episode: str = "episode", frame_idx: str = "frame_idx",
                     fps: float = NOMINAL_FPS) -> DataFrame:
    """Time of frame i, nominal ``start + i/fps`` and measured
    ``start + i*(end-start)/frames`` (both in µs)."""
    m = meta.select(episode, seconds_to_micros("start_time").alias("__s"), seconds_to_micros("end_time").alias("__e"),
                    F.col("frames").alias("__f"))
    i = F.col(frame_idx).cast("double")
    return (frames.join(m, episode)
            .withColumn("nominal_us", F.col("__s") + F.round(i * F.lit(1e6) / F.lit(float(fps))).cast("bigint"))
            .withColumn("measured_us", F.col("__s") + F.round(
                i * (F.col("__e") - F.col("__s")).cast("double") / F.col("__f").cast("double")).cast("bigint"))
            .drop("__s", "__e", "__f"))


def episode_stats(meta: DataFrame, fps: float = NOMINAL_FPS) -> DataFrame:
    """``duration``, ``fps``, drift from the nominal rate and the frames a
    replay emits (the first frame is loaded up front, then ``frames - 1`` more)."""
    dur = F.col("end_time") - F.col("start_time")
    return (meta.withColumn("duration_s", dur)
            .withColumn("fps", F.try_divide(F.col("frames").cast("double"), F.col("duration_s")))
            .withColumn("fps_drift", F.col("fps") - F.lit(float(fps)))
            .withColumn("replay_frames", F.greatest(F.col("frames") - 1, F.lit(0))))


def episode_task_rollup(stats: DataFrame, task: str = "task") -> DataFrame:
    """A6 rollup per task (partial aggregation map-side)."""
    return stats.groupBy(task).agg(F.count(F.lit(1)).alias("n_episodes"), F.sum("frames").alias("frames"),
                                   F.sum("duration_s").alias("duration_s"), F.avg("fps").alias("avg_fps"),
                                   F.min("fps").alias("min_fps"), F.max("fps").alias("max_fps"))
