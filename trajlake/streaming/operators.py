"""Structured Streaming forms of the job and action operators.

* T3 reuses the batch expressions: validation is window-free (computed
  inside each request's array).
* T1 and T4 keep typed state per job with ``transformWithState``: a few
  scalars, dropped by event-time timers (Spark's own TTL counts processing time).
* T2 carries the state of a robot with ``applyInPandasWithState``.

Streams carry instants as bigint µs plus a ``timestamp`` column for the
watermark (session zone UTC).
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegralType

from trajlake.operators.actions import validate_action_arity
from trajlake.operators.jobs import poll_order
from trajlake.schemas import DEFAULT_JOB_LIMIT_S, DEFAULT_VELOCITY_LIMIT, RC_EXCEPTION, RC_FAILURE, RC_SUCCESS, RC_TIMEOUT

# The state functions below run in Python workers; ship them by value so
# workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_store(spark: SparkSession) -> None:
    """Let streams that start from now on keep their state in RocksDB, which typed state (T1, T4) needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


# ---------------------------------------------------------------------------
# T4: running latest status per job
# ---------------------------------------------------------------------------
#: Event time for which a decided job, or the status of a job, is remembered.
RETENTION_S = 30 * 86_400
STATUS_OUT = "job_id string, status string, robot_id string, last_poll_us long"


def _micros(seconds: float) -> int:
    return int(round(seconds * 1_000_000))


def _poll_id(sdf: DataFrame) -> tuple[Column, str]:
    """``poll_id`` as a value that is never null, with its type (zero where there is none)."""
    if "poll_id" not in sdf.columns:
        return F.lit(0).cast("long"), "long"
    if isinstance(sdf.schema["poll_id"].dataType, IntegralType):
        return F.coalesce(F.col("poll_id").cast("long"), F.lit(-(1 << 63))), "long"
    return F.coalesce(F.col("poll_id").cast("string"), F.lit("")), "string"


def stream_job_status(sdf: DataFrame, ts: str = "poll_ts_us") -> DataFrame:
    """T4: latest polled status per job as a streaming aggregate (update/complete mode).

    Polls at one instant are ordered by ``poll_id`` where there is one, as in A3.
    An aggregate keeps every job; ``stream_latest_status`` bounds its state.
    """
    p = sdf.filter(F.col("status").isNotNull())
    last = F.max_by(F.struct(F.col("status"), F.col("device.robot_id").alias("robot_id"), F.col(ts).alias("ts")),
                    poll_order(sdf, ts))
    return (p.groupBy("job_id").agg(last.alias("__l"))
            .select("job_id", F.col("__l.status").alias("status"), F.col("__l.robot_id").alias("robot_id"),
                    F.col("__l.ts").alias("last_poll_us")))


def _latest_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The last poll of each job in each Arrow batch."""
    for pdf in batches:
        yield pdf.sort_values(["ts_us", "poll_id"], kind="stable").drop_duplicates("job_id", keep="last")


class _LatestStatus(StatefulProcessor):
    """State of a job: its last poll. An event-time timer drops it."""

    def __init__(self, keep_us: int, id_type: str):
        self._keep_us, self._id_type = keep_us, id_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", f"ts_us long, poll_id {self._id_type}, status string, robot_id string")

    def _timer(self, ts_us: int) -> int:
        return (ts_us + self._keep_us) // 1000 + 1

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self._last.get() if self._last.exists() else None
        best = held
        for pdf in _latest_rows(rows):
            r = pdf.iloc[0]
            new = (int(r["ts_us"]), r["poll_id"] if self._id_type == "string" else int(r["poll_id"]),
                   r["status"], None if pd.isna(r["robot_id"]) else r["robot_id"])
            if best is None or new[:2] > tuple(best[:2]):
                best = new
        if best is held:
            return
        if held is not None:
            self._handle.deleteTimer(self._timer(held[0]))
        self._handle.registerTimer(self._timer(best[0]))
        self._last.update(best)
        yield pd.DataFrame({"job_id": [key[0]], "status": [best[2]], "robot_id": [best[3]], "last_poll_us": [best[0]]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._last.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_latest_status(sdf: DataFrame, retention_s: float = RETENTION_S, watermark: str = "1 hour",
                         ts_us: str = "poll_ts_us") -> DataFrame:
    """T4 with bounded state (update mode): one row whenever a job's latest status changes.

    Each task first reduces a batch to one poll a job, so a job with most polls
    is combined before the shuffle. A job's state is one poll; an event-time
    timer drops it once the watermark passes its time by ``retention_s``. Polls
    that the watermark still admits are later than a dropped one, so the last
    row of a job equals A3 whatever the retention. Needs the RocksDB state store
    (``state_store`` sets it).

    Edge cases: polls without a status, a job or a time are passed over and do
    not move the watermark (a null job is no key of a state); polls at one instant are ordered by
    ``poll_id``, a null one first; a repeated poll changes nothing and gives no
    row; a missing device gives a null ``robot_id``.
    """
    if retention_s < 0:
        raise ValueError("retention_s is the event time for which a job's status is kept")
    poll_id, id_type = _poll_id(sdf)
    rows = (sdf.where(F.col("status").isNotNull() & F.col("job_id").isNotNull() & F.col(ts_us).isNotNull())
            .select(F.col("job_id").cast("string").alias("job_id"), F.col(ts_us).cast("long").alias("ts_us"), poll_id.alias("poll_id"),
                    "status", F.col("device.robot_id").cast("string").alias("robot_id"), F.timestamp_micros(F.col(ts_us).cast("long")).alias("event_time")))
    last = rows.mapInPandas(_latest_rows, rows.schema)
    return (last.withWatermark("event_time", watermark).groupBy("job_id")
            .transformWithStateInPandas(_LatestStatus(_micros(retention_s), id_type), STATUS_OUT, "Update", "EventTime"))


# ---------------------------------------------------------------------------
# Stateless validation
# ---------------------------------------------------------------------------
def stream_validate_actions(sdf: DataFrame, spec: DataFrame) -> DataFrame:
    """C1 on a stream (stream-static join with the broadcast spec; no windows)."""
    return validate_action_arity(sdf, spec)


# ---------------------------------------------------------------------------
# Bounded wait for ``running`` with event-time timers
# ---------------------------------------------------------------------------
AWAIT_OUT = "job_id string, start_us long, code int, decided_us long"


class _AwaitRunning(StatefulProcessor):
    """State of a job: the start of its wait and whether it is decided. Timers end the wait and drop the state."""

    def __init__(self, limit_us: int, keep_us: int):
        self._limit_us, self._keep_us = limit_us, keep_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._wait = handle.getValueState("wait", "start_us long, done boolean")

    def _needed(self, pdf: pd.DataFrame, start_us: int | None) -> tuple[pd.DataFrame, int | None]:
        """Rows in order up to the one that decides, with the start they give."""
        if start_us is not None:
            pdf = pdf[(pdf["ts_us"] > start_us) & pdf["code"].notna()]
            return pdf.sort_values(["ts_us", "poll_id"], kind="stable").iloc[:1], start_us
        pdf = pdf.sort_values(["ts_us", "poll_id"], kind="stable")
        starts = np.flatnonzero(pdf["is_start"].to_numpy(bool))
        if not starts.size:
            return pdf, None
        first = int(pdf["ts_us"].iloc[starts[0]])
        after = np.flatnonzero((pdf["ts_us"] > first).to_numpy(bool) & pdf["code"].notna().to_numpy(bool))
        return pdf.iloc[:after[0] + 1] if after.size else pdf, first

    def _finish(self, job: str, start_us: int, code: int, decided_us: int) -> pd.DataFrame:
        self._wait.update((start_us, True))
        self._handle.registerTimer((decided_us + self._keep_us) // 1000 + 1)
        return pd.DataFrame({"job_id": [job], "start_us": [start_us], "code": [code], "decided_us": [decided_us]})

    def _deadline(self, start_us: int) -> int:
        return (start_us + self._limit_us) // 1000 + 1

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known, done = self._wait.get() if self._wait.exists() else (None, False)
        if done:
            return
        held, start_us = None, known
        for pdf in rows:
            held, start_us = self._needed(pdf if held is None else pd.concat([held, pdf], ignore_index=True), known)
        if start_us is None:
            return
        end_us = start_us + self._limit_us
        later = held[(held["ts_us"] > start_us) & held["code"].notna()]
        if len(later):
            t, code = int(later["ts_us"].iloc[0]), int(later["code"].iloc[0])
            decided = (code, t) if t <= end_us else (RC_TIMEOUT, end_us)
        elif end_us <= timerValues.getCurrentWatermarkInMs() * 1000:
            decided = (RC_TIMEOUT, end_us)
        else:
            if known is None:
                self._wait.update((start_us, False))
                self._handle.registerTimer(self._deadline(start_us))
            return
        if known is not None:
            self._handle.deleteTimer(self._deadline(start_us))
        yield self._finish(key[0], start_us, *decided)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self._wait.exists():
            return
        start_us, done = self._wait.get()
        if done:
            self._wait.clear()
        else:
            yield self._finish(key[0], start_us, RC_TIMEOUT, start_us + self._limit_us)

    def close(self) -> None:
        pass


def stream_await_running(sdf: DataFrame, timeout_s: float = DEFAULT_JOB_LIMIT_S, watermark: str = "1 hour",
                         start_status: str = "ready", ts_us: str = "poll_ts_us", event_time: str = "poll_ts",
                         done_retention_s: float = RETENTION_S) -> DataFrame:
    """Streaming W8. The wait starts at the job's first ``start_status``
    row; the first decisive later row within the limit emits 0/1 (3 for a
    failed poll); an event-time timer emits 2 once the watermark passes
    ``start + timeout``. A marker stays in state so a later row of the same job
    does not start a second wait; a second timer drops it once the watermark
    passes ``decided + done_retention_s``, which bounds the state. A job that
    becomes ready again after that starts a new wait. Polls at one instant are
    ordered by ``poll_id`` where there is one. Needs the RocksDB state store
    (``state_store`` sets it).

    Only rows that start or decide a wait are shuffled, and a task holds a job's
    rows of a micro-batch up to the one that decides.

    Edge cases: polls without a job or a time are passed over; a poll without a
    status counts only if it failed; repeated polls change nothing."""
    if done_retention_s is None or done_retention_s < 0:
        raise ValueError("done_retention_s is the event time for which a decided job is remembered")
    poll_id, _ = _poll_id(sdf)
    status = F.col("status")
    code = (F.when(F.coalesce(F.col("poll_error"), F.lit(False)), RC_EXCEPTION)
            .when(status == "running", RC_SUCCESS).when(status != "prepare", RC_FAILURE))
    # A condition on the event time stays above the watermark, so that polls which decide nothing still move it.
    matters = F.col("is_start") | F.col("code").isNotNull() | F.col(event_time).isNull()
    rows = (sdf.withWatermark(event_time, watermark)
            .select(F.col("job_id").cast("string").alias("job_id"), F.col(ts_us).cast("long").alias("ts_us"), poll_id.alias("poll_id"),
                    F.coalesce(status == start_status, F.lit(False)).alias("is_start"), code.cast("int").alias("code"), event_time)
            .where(F.col("job_id").isNotNull() & F.col("ts_us").isNotNull() & matters))
    return rows.groupBy("job_id").transformWithStateInPandas(
        _AwaitRunning(_micros(timeout_s), _micros(done_retention_s)), AWAIT_OUT, "Append", "EventTime")


# ---------------------------------------------------------------------------
# Velocity retiming + queue timeline with state per robot
# ---------------------------------------------------------------------------
RETIME_OUT = ("robot string, request_id string, seq int, ts_us long, period_us long, retimed boolean, "
              "g_us long, e_us long, late boolean")
RETIME_STATE = "positions string, last_end long, last_ts long, last_req string, last_seq int"


def _abs_max(v: np.ndarray) -> float | None:
    if v.size == 0:
        return None
    a = np.abs(v)
    return float("nan") if np.isnan(a).any() else float(a.max())


def _round_half_up(x: float) -> int:
    return int(math.floor(x + 0.5))


def stream_retime_actions(sdf: DataFrame, velocity_limit: float = DEFAULT_VELOCITY_LIMIT) -> DataFrame:
    """Streaming W1 + W2 + W3 per robot.

    Input rows: ``robot, arm, request_id, seq, ts_us, duration_us, position``
    (executable actions, as from ``explode_action_chunk``). State per robot:
    last position per arm, end of the last worker iteration and the last
    processed ``(ts, request, seq)``. Rows are sorted inside the batch; a row
    not after the stored key is emitted with ``late = true`` and does not
    change the state. Equals the batch operators over an in-order log.
    """
    limit = float(velocity_limit)

    def step(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        robot = key[0]
        pdf = pd.concat(list(batches), ignore_index=True)
        if state.exists:
            pos_json, last_end, last_ts, last_req, last_seq = state.get
            positions = json.loads(pos_json)
            last_key = (last_ts, last_req, last_seq)
        else:
            positions, last_end, last_key = {}, None, None
        pdf = pdf.sort_values(["ts_us", "request_id", "seq"], kind="stable")
        out = []
        for r in pdf.itertuples(index=False):
            k = (int(r.ts_us), str(r.request_id), int(r.seq))
            if last_key is not None and k <= tuple(last_key):
                out.append((robot, k[1], k[2], k[0], None, None, None, None, True))
                continue
            cur = np.asarray(r.position, dtype=np.float32).astype(np.float64)
            prev = positions.get(r.arm)
            prev = np.zeros_like(cur) if prev is None else np.asarray(prev, dtype=np.float64)
            dur = int(r.duration_us)
            period = float(dur)
            retimed = False
            if prev.shape == cur.shape and dur:     # no velocity over a zero duration, as in the batch form
                vel = (cur - prev) / (dur / 1e6)
                mx = _abs_max(vel)
                if r.arm == "both" and vel.size:
                    h = vel.size // 2
                    scale = np.concatenate([vel[:h - 1], vel[h:vel.size - 1]])
                else:
                    scale = vel[:-1] if vel.size else vel
                ng = _abs_max(scale)
                if mx is not None and not math.isnan(mx) and mx > limit:
                    retimed = True
                    if ng is not None and not math.isnan(ng):
                        period = float(_round_half_up(dur * ng / limit))
            positions[r.arm] = cur.tolist()
            p = int(period)
            a = k[0]
            g = a if last_end is None else max(a, last_end)
            e = a if last_end is None else max(a, last_end + p)
            last_end = e
            last_key = k
            out.append((robot, k[1], k[2], a, p, retimed, g, e, False))
        if last_key is not None:
            state.update((json.dumps(positions), last_end, last_key[0], last_key[1], last_key[2]))
        if out:
            yield pd.DataFrame(out, columns=["robot", "request_id", "seq", "ts_us", "period_us", "retimed",
                                             "g_us", "e_us", "late"])

    return sdf.groupBy("robot").applyInPandasWithState(step, RETIME_OUT, RETIME_STATE, "append",
                                                       GroupStateTimeout.NoTimeout)


# ---------------------------------------------------------------------------
# Posted requests -> executed timeline, on a stream (T3 -> C2 -> T2)
# ---------------------------------------------------------------------------
def stream_execute_requests(sdf: DataFrame, spec: DataFrame,
                            velocity_limit: float = DEFAULT_VELOCITY_LIMIT) -> DataFrame:
    """A stream of posted requests -> validated, exploded, retimed and queued actions.

    Validation and explosion are narrow (no state); the per-robot state lives
    in ``stream_retime_actions``. Bad requests never reach the queue.
    """
    from trajlake.operators.actions import explode_action_chunk
    ex = explode_action_chunk(stream_validate_actions(sdf, spec))
    return stream_retime_actions(ex.select("robot", "arm", "request_id", "seq", "ts_us", "duration_us", "position"),
                                 velocity_limit)
