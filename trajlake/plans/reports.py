"""Batch job: action-execution reports written as tables.

The timeline (validate -> explode -> velocity -> retime -> queue) feeds
several reports. It is computed once, then its lineage is cut with a reliable
checkpoint in the shared folder named by ``spark.checkpoint.dir``, so a lost
executor does not replay the whole chain for every report. All steps are
deterministic (unique orderings everywhere), so recomputed tasks give the same
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.operators import actions as act
from trajlake.operators import motion as mo
from trajlake.operators.lineage import cut_lineage
from trajlake.schemas import DEFAULT_VELOCITY_LIMIT


def action_timeline(requests: DataFrame, spec: DataFrame, velocity_limit: float = DEFAULT_VELOCITY_LIMIT,
                    chunk_us: int = mo.HOUR_US) -> DataFrame:
    """Executable actions with velocity, period and queue times (C1 -> C2 -> W1 -> W2 -> W3)."""
    ex = act.explode_action_chunk(act.validate_action_arity(requests, spec))
    rt = mo.retime_actions(mo.step_velocity(ex, chunk_us=chunk_us), velocity_limit)
    return mo.execution_timeline(rt, chunk_us=chunk_us)


def write_action_reports(spark: SparkSession, requests: DataFrame, spec: DataFrame, out_dir: str,
                         observations: DataFrame | None = None, motion_clears: DataFrame | None = None,
                         velocity_limit: float = DEFAULT_VELOCITY_LIMIT, chunk_us: int = mo.HOUR_US) -> dict[str, str]:
    """Write ``outcomes``, ``timeline``, ``robot_summary``, ``segments`` and (with
    ``observations(obs_id, robot, arm, t_us)``) ``backlog`` and ``positions`` as
    parquet tables under ``out_dir``. ``motion_clears(robot, ts_us, kind)`` are
    start/end/stop-motion events added to the arity-error clears.
    ``timeline`` is the plan as queued; the summary, segments, backlog and
    positions follow queue clears. Returns table name -> path."""
    paths: dict[str, str] = {}

    def write(name: str, df: DataFrame) -> None:
        path = f"{out_dir.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        paths[name] = path

    write("outcomes", act.batch_outcome(requests, spec))
    timeline = cut_lineage(action_timeline(requests, spec, velocity_limit, chunk_us))
    write("timeline", timeline.drop("velocity"))
    clears = act.clear_events(requests, spec)
    if motion_clears is not None:
        clears = clears.unionByName(motion_clears.select("robot", "ts_us", "kind"))
    executable = timeline.drop("e_us", "g_us", "prev_end_us", "overrun", "wait_us", "busy_us", "gap_us", "velocity",
                               "last_position", "shape_mismatch", "max_abs", "max_abs_no_gripper", "retimed", "period_us")
    # checkpointed by its last pass, so the tables below read it as it is
    segments = mo.execute_with_clears(executable, clears, velocity_limit, chunk_us=chunk_us)
    # a command cleared before it was dequeued did not run and never became the current position
    executed = segments.filter(~F.col("dropped"))
    write("robot_summary", executed.groupBy("robot").agg(
        F.count(F.lit(1)).alias("n_actions"), F.max("max_abs").alias("max_velocity"),
        F.count_if("retimed").alias("n_retimed"), (F.sum("busy_us") / 1e6).alias("busy_s"),
        (F.sum("gap_us") / 1e6).alias("idle_s")))
    write("segments", segments.select("robot", "request_id", "seq", "segment_id", "segment_start_us",
                                      "next_clear_us", "g_us", "e_us", "dropped"))
    if observations is not None:
        # queue length with clears: a cleared action leaves the queue at the clear
        write("backlog", mo.pending_backlog(segments, observations, chunk_us=chunk_us))
        write("positions", mo.asof_position(executed, observations, chunk_us=chunk_us))
    return paths
