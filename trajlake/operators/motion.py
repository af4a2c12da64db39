"""Action execution: step velocity (W1), retiming (W2), queue timeline (W3),
pending backlog (W4), motion segments (W5) and as-of position (J3).

All ordered work goes through ``operators.scans`` so that one robot's log is
split into time chunks (``chunk_us``) instead of landing in one task.
Positions are tracked per ``(robot, arm)`` where ``arm`` is left, right or
both; the queue (and so the timeline) is one per robot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.functions.vectors import array_abs_max, scale_dims
from trajlake.operators.lineage import cut_lineage, write_table
from trajlake.operators.scans import (attach_by_chunk, chunked_carry_last, chunked_lag_by_key, chunked_queue,
                                      chunked_running_sum, drop_chunks, with_chunk)
from trajlake.schemas import DEFAULT_VELOCITY_LIMIT

HOUR_US = 3_600_000_000
QUEUE_ORDER = ("ts_us", "request_id", "seq")


def step_velocity(actions: DataFrame, order: Sequence[str] = QUEUE_ORDER,
                  chunk_us: int | None = HOUR_US) -> DataFrame:
    """Per ``(robot, arm)`` in queue order, ``(cur - last) / duration`` per dimension.

    The first action of a ``(robot, arm)`` compares with zeros of its own
    length (home). A later length change gives a null velocity and
    ``shape_mismatch`` (the reference raises and keeps the nominal period).
    Adds ``velocity``, ``max_abs`` (all dims) and ``max_abs_no_gripper``.
    """
    df, ch = with_chunk(actions, order[0], chunk_us)
    # shuffled once on (robot, chunk); the chunk column is kept so that the
    # queue timeline over the same rows reuses this partitioning
    df = chunked_lag_by_key(df, ["robot"], ["arm"], ch, list(order), "position", "last_position")
    return _with_velocity(df)


def _with_velocity(df: DataFrame) -> DataFrame:
    last = F.coalesce(F.col("last_position"), F.array_repeat(F.lit(0.0), F.size("position")))
    dur_s = F.col("duration_us").cast("double") / F.lit(1e6)
    mismatch = F.size(last) != F.size("position")
    vel = F.when(~mismatch, F.zip_with("position", last, lambda c, l: F.try_divide(c - l, dur_s)))
    return (df
            .withColumn("shape_mismatch", mismatch)
            .withColumn("velocity", vel)
            .withColumn("max_abs", array_abs_max("velocity"))
            .withColumn("max_abs_no_gripper", array_abs_max(scale_dims("velocity", "arm"))))


def retime_actions(velocities: DataFrame, velocity_limit: float = DEFAULT_VELOCITY_LIMIT) -> DataFrame:
    """``period = duration``, scaled by ``max_abs_no_gripper / limit`` when ``max_abs > limit``.

    The trigger includes the gripper but the scale does not, so a gripper-only
    jump shortens the period (kept as the reference does it). NaN never
    triggers. Adds ``retimed`` and ``period_us`` (bigint µs).
    """
    lim = F.lit(float(velocity_limit))
    trig = (F.col("max_abs").isNotNull() & ~F.isnan("max_abs") & (F.col("max_abs") > lim))
    scaled = F.round(F.col("duration_us").cast("double") * F.col("max_abs_no_gripper") / lim)
    period = F.when(trig & F.col("max_abs_no_gripper").isNotNull() & ~F.isnan("max_abs_no_gripper"), scaled)
    return (velocities.withColumn("retimed", trig)
            .withColumn("period_us", F.coalesce(period, F.col("duration_us").cast("double")).cast("bigint")))


def execution_timeline(actions: DataFrame, keys: Sequence[str] = ("robot",), order: Sequence[str] = QUEUE_ORDER,
                       arrival: str = "ts_us", period: str = "period_us", start: str | None = None,
                       chunk_us: int | None = HOUR_US) -> DataFrame:
    """Dequeue time ``g_us``, end ``e_us`` and the overrun flag per action.

    The worker's clock starts before its blocking get, so waiting counts
    toward the period: ``g = max(a, e_prev)``, ``e = max(a, e_prev + p)``.
    ``overrun`` marks iterations that did not sleep (``g - e_prev >= p``), which
    includes every action that found the worker idle. Also ``wait_us`` (queue
    wait), ``busy_us`` (``e - g``) and ``gap_us`` (``g - e_prev``).
    """
    df, ch = with_chunk(actions, arrival, chunk_us, reuse=(list(keys) == ["robot"] and arrival == order[0]))
    return _timeline_columns(drop_chunks(chunked_queue(df, list(keys), ch, list(order), arrival, period, start)), arrival, period)


def _timeline_columns(df: DataFrame, arrival: str = "ts_us", period: str = "period_us") -> DataFrame:
    prev = F.col("prev_end_us")
    return (df.withColumn("overrun", prev.isNull() | ((F.col("g_us") - prev) >= F.col(period)))
            .withColumn("wait_us", F.col("g_us") - F.col(arrival))
            .withColumn("busy_us", F.col("e_us") - F.col("g_us"))
            .withColumn("gap_us", F.greatest(F.col("g_us") - prev, F.lit(0)).cast("bigint")))


def pending_backlog(timeline: DataFrame, observations: DataFrame, key: str = "robot", arrival: str = "ts_us",
                    obs_time: str = "t_us", chunk_us: int | None = HOUR_US) -> DataFrame:
    """Queue length seen by each observation = #{actions: a <= t < leave}.

    ``leave`` is the dequeue time ``g``; for a ``motion_segments`` timeline an
    action cleared from the queue leaves at the clear instead (the earlier of
    ``g`` and ``next_clear_us``). Event sweep: arrivals +1, leaves -1,
    observations 0, summed over a range frame on time so that events at the
    same instant apply together. Returns the observation rows with ``pending``.
    """
    leave = (F.least(F.col("g_us"), F.col("next_clear_us")) if "next_clear_us" in timeline.columns
             else F.col("g_us"))
    # both events of an action come from one row, so the timeline is worked out once
    moves = timeline.select(F.col(key), F.explode(F.array(
        F.struct(F.col(arrival).alias("t"), F.lit(1).alias("d")), F.struct(leave.alias("t"), F.lit(-1).alias("d")))).alias("__m"))
    moves = moves.select(key, F.col("__m.t").alias("__t"), F.col("__m.d").alias("__d"))
    obs = observations.withColumn("__t", F.col(obs_time)).withColumn("__d", F.lit(0)).withColumn("__obs", F.lit(True))
    ev = moves.unionByName(obs, allowMissingColumns=True)
    ev, ch = with_chunk(ev, "__t", chunk_us)
    ev = chunked_running_sum(ev, [key], ch, ["__t"], "__d", "pending", range_frame=True)
    return (drop_chunks(ev.filter(F.col("__obs"))).drop("__t", "__d", "__obs")
            .withColumn("pending", F.col("pending").cast("bigint")))


def motion_segments(actions: DataFrame, clears: DataFrame, order: Sequence[str] = QUEUE_ORDER,
                    chunk_us: int | None = HOUR_US) -> DataFrame:
    """Queue clears cut the action log into segments; actions not dequeued
    before the next clear are ``dropped``.

    ``clears``: ``(robot, ts_us, kind)`` with kind in start_motion, end_motion,
    stop_motion, format_error. A clear at the same instant as an arrival comes
    first. Each segment starts idle at its clear time (segment 0 idle since
    forever). Returns the action rows with ``segment_id``, ``segment_start_us``,
    ``next_clear_us``, the timeline columns and ``dropped``.
    """
    a = actions.withColumn("__clear", F.lit(False)).withColumn("__tag", F.lit(1))
    c = clears.select("robot", F.col("ts_us").alias(order[0]), F.lit(0).cast("bigint").alias("period_us"), F.lit(True).alias("__clear"), F.lit(0).alias("__tag"))
    ev, ch = with_chunk(drop_chunks(a).unionByName(c, allowMissingColumns=True), order[0], chunk_us)
    ev = chunked_queue(ev, ["robot"], ch, [order[0], "__tag", *order[1:]], order[0], "period_us", clear="__clear")
    return _with_dropped(_timeline_columns(drop_chunks(ev.filter(~F.col("__clear"))).drop("__clear", "__tag"), order[0]))


def _with_dropped(df: DataFrame) -> DataFrame:
    return df.withColumn("dropped", F.coalesce(F.col("g_us") >= F.col("next_clear_us"), F.lit(False)))


def execute_with_clears(actions: DataFrame, clears: DataFrame, velocity_limit: float = DEFAULT_VELOCITY_LIMIT,
                        order: Sequence[str] = QUEUE_ORDER, chunk_us: int | None = HOUR_US,
                        passes: list[int] | None = None) -> DataFrame:
    """W1 + W2 + W3 under queue clears: a command that a clear removed never becomes the last position.

    ``actions`` as for ``step_velocity``, ``clears`` as for ``motion_segments``.
    The queue is first in, first out, so the commands that run before a clear
    are a prefix of their segment. A command therefore compares with its
    predecessor on its arm if that is in the same segment, else with the last
    command of earlier segments that ran.

    The first pass takes all commands as run. Then only segments are worked out
    again whose first command on some arm compared with another command than
    the last that ran (the frontier): their rows are read, the others stay as
    they are. What is compared between passes is one small row for each arm
    and segment. Every pass settles at least the first segment of each robot
    that is not settled yet, so the passes end, without a limit on them, when
    no segment is left. Each pass is written to the shared folder
    (``spark.checkpoint.dir``), so this operator runs jobs when it is called;
    ``passes`` receives the number of rows that each pass read.

    Returns the action rows with the columns of W1, W2, W3 and W5. For
    ``dropped`` rows these say what would have happened without the clear.
    """
    rank = F.struct(*order)
    me = F.struct(*[F.col(o).alias(f"k{i}") for i, o in enumerate(order)], F.col("position").alias("position"))
    actions, clears = drop_chunks(actions), cut_lineage(clears)
    names = [c for c in actions.columns if c not in _EXECUTED]
    log, ch = with_chunk(actions.withColumn("__me", me), order[0], chunk_us)
    log = drop_chunks(chunked_lag_by_key(log, ["robot"], ["arm"], ch, list(order), "__me", "__look"))
    timed = retime_actions(_with_velocity(log.withColumn("last_position", F.col("__look.position"))), velocity_limit)
    done = motion_segments(cut_lineage(timed), clears, order, chunk_us)
    # the first command of an arm in its segment looks back over the clear
    over = F.col("__look").isNull() | F.coalesce(F.col("__look.k0") < F.col("segment_start_us"), F.lit(False))
    done = write_table(done.withColumn("__first", over).withColumn("__seg", F.struct("robot", "segment_id")).withColumn("__pass", F.lit(0)), "pass")
    frames, ends = [done], None
    while True:
        if passes is not None:
            passes.append(frames[-1].count())
        latest = frames[-1].groupBy("robot", "arm", "segment_id", "__seg").agg(
            F.max_by("__me", F.when(~F.col("dropped"), rank)).alias("__ran"),
            F.max(F.when(F.col("__first"), F.struct(F.col("__look").alias("look")))).alias("__used"), F.max("__pass").alias("__pass"))
        # one row for each arm and segment, those of this pass instead of earlier ones
        ends = cut_lineage(latest if ends is None else ends.join(latest.select("__seg").distinct(), "__seg", "left_anti").unionByName(latest))
        placed = ends.withColumn("__chunk_segments", F.shiftright("segment_id", 16))
        looks = drop_chunks(chunked_carry_last(placed, ["robot", "arm"], "__chunk_segments", ["segment_id"], "__ran", "__upto", before=True))
        wrong = looks.filter(F.col("__used").isNotNull() & ~F.col("__upto").eqNullSafe(F.col("__used.look")))
        frontier = cut_lineage(wrong.select("__seg").distinct())
        if frontier.isEmpty():
            break
        rows, ch = with_chunk(done, order[0], chunk_us)
        rows = drop_chunks(attach_by_chunk(rows, frontier, "__seg", ch)).withColumn("__arm", F.struct("arm", "__seg"))
        look = looks.select(F.struct("arm", "__seg").alias("__arm"), F.col("__upto").alias("__new"))
        first = rows.filter("__first").join(look, "__arm").withColumn("__look", F.col("__new")).drop("__new")
        rows = first.unionByName(rows.filter("not __first")).withColumn("last_position", F.col("__look.position"))
        rows = rows.select(*names, "__me", "__look", "__first", "__seg", "last_position", "segment_id", "segment_start_us", "next_clear_us")
        rows, ch = with_chunk(cut_lineage(retime_actions(_with_velocity(rows), velocity_limit)), order[0], chunk_us)
        again = chunked_queue(rows, ["robot"], ch, list(order), order[0], "period_us", start="segment_start_us", segment="segment_id")
        again = _with_dropped(_timeline_columns(drop_chunks(again), order[0])).withColumn("__pass", F.lit(len(frames)))
        frames.append(write_table(again.select(*done.columns), "pass"))
    if len(frames) > 1:
        every = frames[0]
        for f in frames[1:]:
            every = every.unionByName(f)
        settled = ends.groupBy("__seg").agg(F.max("__pass").alias("__settled"))
        every, ch = with_chunk(every, order[0], chunk_us)
        done = write_table(drop_chunks(attach_by_chunk(every, settled, "__seg", ch).filter(F.col("__pass") == F.col("__settled"))).drop("__settled"), "executed")
    return done.drop("__me", "__look", "__first", "__seg", "__pass")


#: Columns that execution adds to actions.
_EXECUTED = {"last_position", "shape_mismatch", "velocity", "max_abs", "max_abs_no_gripper", "retimed", "period_us", "segment_id", "segment_start_us",
             "next_clear_us", "e_us", "g_us", "prev_end_us", "overrun", "wait_us", "busy_us", "gap_us", "dropped"}


def _queued(commands: DataFrame) -> Column:
    return F.col("ts_us") if "ts_us" in commands.columns else F.lit(None).cast("bigint")


def asof_position(commands: DataFrame, observations: DataFrame, time_col: str = "g_us", obs_time: str = "t_us",
                  chunk_us: int | None = HOUR_US) -> DataFrame:
    """Latest commanded position at or before each observation, per ``(robot, arm)``.

    ``commands`` carry ``robot, arm, <time_col>, request_id, seq, position``
    (the position becomes current when the worker dequeues it);
    ``observations`` carry ``robot, arm, <obs_time>`` plus their own columns.
    Commands dequeued at one instant follow the order in which they were
    queued (``ts_us`` if there is one, then request and sequence number).
    Adds ``cmd_request_id``, ``cmd_seq`` and ``cmd_position`` (null before any command).
    """
    cmd = commands.select("robot", "arm", F.col(time_col).alias("__t"), F.lit(0).alias("__tag"),
                          _queued(commands).alias("__ts"), F.struct(F.col("request_id").alias("cmd_request_id"), F.col("seq").alias("cmd_seq"),
                                   F.col("position").alias("cmd_position")).alias("__cmd"))
    obs = (observations.withColumn("__t", F.col(obs_time)).withColumn("__tag", F.lit(1)).withColumn("__ts", F.lit(None).cast("bigint"))
           .withColumn("__cmd", F.lit(None).cast(cmd.schema["__cmd"].dataType)))
    ev = cmd.unionByName(obs, allowMissingColumns=True)
    ev, ch = with_chunk(ev, "__t", chunk_us)
    ev = chunked_carry_last(ev, ["robot", "arm"], ch, ["__t", "__tag", "__ts", F.col("__cmd.cmd_request_id"),
                                                              F.col("__cmd.cmd_seq")], "__cmd", "__last")
    out = ev.filter(F.col("__tag") == 1)
    return drop_chunks(out.select("*", "__last.*")).drop("__t", "__tag", "__ts", "__cmd", "__last")
