"""Streams over files equal the batch operators (availableNow)."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
import time

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from trajlake.operators import actions as act
from trajlake.operators import jobs as jb
from trajlake.operators import motion as mo
from trajlake.plans import derived as dv
from trajlake.schemas import spec_for_join
from trajlake.streaming import operators as so


def _write_parts(df, sort_col, n_parts):
    """Write a batch DataFrame as ``n_parts`` parquet files in ``sort_col`` order."""
    d = tempfile.mkdtemp(prefix="trajlake-stream-in-")
    pdf = df.toPandas().sort_values(sort_col, kind="stable").reset_index(drop=True)
    schema = df.schema
    step = (len(pdf) + n_parts - 1) // n_parts
    for i in range(n_parts):
        part = pdf.iloc[i * step:(i + 1) * step]
        tbl = pa.Table.from_pandas(part, preserve_index=False)
        pq.write_table(tbl, os.path.join(d, f"part-{i:03d}.parquet"))
        time.sleep(0.05)
    return d, schema


def _run(spark, sdf, name, mode="append", ckpt=None):
    ckpt = ckpt or tempfile.mkdtemp(prefix="trajlake-stream-ckpt-")
    q = (sdf.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination(300)
    return spark.table(name), ckpt


def _run_to_files(spark, sdf, out_dir, ckpt):
    """Append-mode file sink: restartable from its checkpoint (exactly-once)."""
    q = (sdf.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(300)
    return spark.read.parquet(out_dir)


def test_stream_job_status_equals_batch(spark):
    polls = dv.job_polls(spark, SF001)
    d, schema = _write_parts(polls, "poll_id", 3)
    sdf = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)
    out, _ = _run(spark, so.stream_job_status(sdf), "t4_status", mode="complete")
    got = {tuple(r) for r in out.collect()}
    want = {tuple(r) for r in jb.latest_job_status(polls).select("job_id", "status", "robot_id", "last_poll_us").collect()}
    assert got == want and len(got) > 10


def test_stream_validate_equals_batch(spark):
    req = dv.action_requests(spark, SF001)
    d, schema = _write_parts(req, "ts_us", 3)
    sdf = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)
    cols = ["request_id", "seq", "is_bad", "first_bad_pos", "quarantine_reason", "effective"]
    out, _ = _run(spark, so.stream_validate_actions(sdf, spec_for_join(spark)).select(*cols), "t3_validate")
    want = {tuple(r) for r in act.validate_action_arity(req, spec_for_join(spark)).select(*cols).collect()}
    assert {tuple(r) for r in out.collect()} == want


def test_stream_await_running_matches_batch(spark):
    polls = dv.job_polls(spark, SF01).select("job_id", "poll_ts_us", "status", "poll_error")
    d, schema = _write_parts(polls, "poll_ts_us", 4)
    sdf = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)
           .withColumn("poll_ts", F.timestamp_micros("poll_ts_us")))
    timeout_s = 12 * 3600
    out, _ = _run(spark, so.stream_await_running(sdf, timeout_s=timeout_s, watermark="1 hour"), "t1_await")
    got = {tuple(r) for r in out.select("job_id", "start_us", "code", "decided_us").collect()}
    batch = jb.await_running_outcome(dv.job_polls(spark, SF01), dv.job_starts(dv.job_polls(spark, SF01)),
                                     timeout_s=timeout_s)
    want = {tuple(r) for r in batch.select("job_id", "start_us", "code", "decided_us").collect()}
    assert got <= want
    decided = {w for w in want if w[2] != 2}
    assert decided <= got
    assert {c for (_, _, c, _) in got} >= {0, 1, 2}


def _executable(spark, sf):
    ex = act.explode_action_chunk(act.validate_action_arity(dv.action_requests(spark, sf), spec_for_join(spark)))
    return ex.select("robot", "arm", "request_id", "seq", "ts_us", "duration_us", "position")


def _batch_retimed(spark, ex):
    tl = mo.execution_timeline(mo.retime_actions(mo.step_velocity(ex, chunk_us=1_000_000), 10.0),
                               chunk_us=1_000_000)
    return {tuple(r) for r in tl.select("robot", "request_id", "seq", "ts_us", "period_us", "retimed",
                                        "g_us", "e_us").collect()}


def test_stream_retime_equals_batch_with_restart(spark):
    ex = _executable(spark, SF01)
    d, schema = _write_parts(ex, "ts_us", 4)
    # first run sees only the first two files, then restarts from its checkpoint
    staged = tempfile.mkdtemp(prefix="trajlake-stream-stage-")
    files = sorted(os.listdir(d))
    for f in files[:2]:
        os.link(os.path.join(d, f), os.path.join(staged, f))
    out_dir = tempfile.mkdtemp(prefix="trajlake-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="trajlake-stream-ckpt-")
    sdf = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(staged)
    n_first = _run_to_files(spark, so.stream_retime_actions(sdf, 10.0), out_dir, ckpt).count()
    for f in files[2:]:
        os.link(os.path.join(d, f), os.path.join(staged, f))
        time.sleep(0.05)
    sdf2 = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(staged)
    both = _run_to_files(spark, so.stream_retime_actions(sdf2, 10.0), out_dir, ckpt)
    rows = [tuple(r) for r in both.select("robot", "request_id", "seq", "ts_us", "period_us", "retimed",
                                          "g_us", "e_us", "late").collect()]
    assert n_first > 0 and len(rows) == ex.count()
    assert not any(r[-1] for r in rows)  # nothing late
    got = {r[:8] for r in rows}
    assert got == _batch_retimed(spark, ex)


def test_stream_retime_marks_late_rows(spark):
    ex = _executable(spark, SF001)
    d, schema = _write_parts(ex, "ts_us", 2)
    # replay the first file again as a third file: all of its rows are late
    files = sorted(os.listdir(d))
    time.sleep(0.05)
    tbl = pq.read_table(os.path.join(d, files[0]))
    pq.write_table(tbl, os.path.join(d, "part-999.parquet"))
    sdf = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)
    out, _ = _run(spark, so.stream_retime_actions(sdf, 10.0), "t2_late")
    rows = out.collect()
    assert sum(1 for r in rows if r.late) == tbl.num_rows
    assert {tuple(r)[:8] for r in rows if not r.late} == _batch_retimed(spark, ex)


def test_stream_job_status_update_mode(spark):
    polls = dv.job_polls(spark, SF001)
    d, schema = _write_parts(polls, "poll_id", 3)
    sdf = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)
    out_rows = []

    def collect_batch(df, epoch):
        out_rows.extend((epoch, *r) for r in df.collect())

    q = (so.stream_job_status(sdf).writeStream.outputMode("update").foreachBatch(collect_batch)
         .option("checkpointLocation", tempfile.mkdtemp(prefix="trajlake-stream-ckpt-"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    # the last update per job equals the batch result; each batch only re-emits changed jobs
    last = {}
    for epoch, job, status, robot, ts in sorted(out_rows, key=lambda r: r[0]):
        last[job] = (job, status, robot, ts)
    want = {tuple(r) for r in jb.latest_job_status(polls).select("job_id", "status", "robot_id", "last_poll_us").collect()}
    assert set(last.values()) == want
    assert len(out_rows) <= 3 * len(want)   # at most one update per job per batch


def test_stream_execute_requests_equals_batch(spark):
    req = dv.action_requests(spark, SF01)
    d, schema = _write_parts(req, "ts_us", 3)
    sdf = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)
    out_dir = tempfile.mkdtemp(prefix="trajlake-stream-out-")
    got = _run_to_files(spark, so.stream_execute_requests(sdf, spec_for_join(spark), 10.0), out_dir,
                        tempfile.mkdtemp(prefix="trajlake-stream-ckpt-"))
    rows = {tuple(r) for r in got.select("robot", "request_id", "seq", "ts_us", "period_us", "retimed",
                                         "g_us", "e_us").collect()}
    assert rows == _batch_retimed(spark, _executable(spark, SF01))


def test_stream_job_status_orders_ties_like_the_batch(spark, tmp_path):
    """Two polls of a job at one instant, in different files: the later poll_id counts, whichever file comes first."""
    rows = [[(2, "j", 5, "running"), (1, "k", 5, "ready")], [(1, "j", 5, "ready"), (2, "k", 5, "finished"), (3, "j", 4, "failed")]]
    for n, part in enumerate(rows):
        cols = list(zip(*part))
        pq.write_table(pa.table({"poll_id": cols[0], "job_id": cols[1], "poll_ts_us": cols[2], "status": cols[3],
                                 "device": [{"robot_id": "r"}] * len(part)}), str(tmp_path / f"part-{n}.parquet"))
        time.sleep(0.05)
    polls = spark.read.parquet(str(tmp_path))
    sdf = spark.readStream.schema(polls.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path))
    q = so.stream_job_status(sdf).writeStream.outputMode("complete").format("memory").queryName("t4_ties").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r.job_id, r.status) for r in spark.table("t4_ties").collect()}
    assert got == {(r.job_id, r.status) for r in jb.latest_job_status(polls).collect()} == {("j", "running"), ("k", "finished")}


def test_stream_validation_equals_batch_on_all_requests(spark):
    """T3 over every request of the larger table, in several files."""
    req, spec = dv.action_requests(spark, SF01), spec_for_join(spark)
    d, schema = _write_parts(req, "ts_us", 4)
    cols = ["request_id", "seq", "arm", "mode", "expected_len", "actual_len", "is_bad", "first_bad_pos", "quarantine_reason", "effective"]
    out, _ = _run(spark, so.stream_validate_actions(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d), spec).select(*cols), "t3_all")
    got, want = ({tuple(r) for r in f.select(*cols).collect()} for f in (out, act.validate_action_arity(req, spec)))
    assert got == want and out.count() == len(want) and any(r[6] for r in want)


def _stream(spark, df, n_parts):
    """``df`` as a stream of files in time order, with the event time of its polls."""
    d, schema = _write_parts(df, "poll_ts_us", n_parts)
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)
            .withColumn("poll_ts", F.timestamp_micros("poll_ts_us")))


def _updates(sdf, ckpt=None):
    """Rows of each micro-batch, and the rows of state after it."""
    found = []
    q = (sdf.writeStream.outputMode("update").foreachBatch(lambda df, epoch: found.extend((epoch, *r) for r in df.collect()))
         .option("checkpointLocation", ckpt or tempfile.mkdtemp(prefix="trajlake-stream-ckpt-")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    return found, [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]


def test_latest_status_equals_batch_with_bounded_state(spark):
    """All polls of the larger table in time order: the last update of every job is A3's row, and old jobs leave the state."""
    polls = dv.job_polls(spark, SF01)
    sdf = _stream(spark, polls, 6)
    found, kept = _updates(so.stream_latest_status(sdf, retention_s=0, watermark="1 second"))
    last = {job: (job, *row) for _, job, *row in sorted(found, key=lambda r: r[0])}
    want = {tuple(r) for r in jb.latest_job_status(polls).select("job_id", "status", "robot_id", "last_poll_us").collect()}
    assert set(last.values()) == want
    assert kept[-1] < len(want) / 10             # the watermark has passed nearly all last polls
    whole, all_kept = _updates(so.stream_latest_status(sdf, watermark="1 second"))
    assert {job: row for _, job, *row in sorted(whole, key=lambda r: r[0])} == {job: list(r[1:]) for job, r in last.items()}
    assert max(all_kept) > kept[-1]


def test_latest_status_odd_rows_and_restart(spark, tmp_path):
    """Ties, repeated and older polls, nulls in every column; the second half after a restart."""
    t0 = 1_700_000_000_000_000

    def part(n, rows):
        schema = pa.schema([("poll_id", pa.int64()), ("job_id", pa.string()), ("poll_ts_us", pa.int64()), ("status", pa.string()),
                            ("device", pa.struct([("robot_id", pa.string())]))])
        rows = [(i, j, None if t is None else t0 + t, *more) for i, j, t, *more in rows]
        pq.write_table(pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema), str(tmp_path / f"part-{n}.parquet"))

    ckpt = tempfile.mkdtemp(prefix="trajlake-stream-ckpt-")
    part(0, [(2, "j", 5, "running", {"robot_id": "r"}), (2, "j", 5, "running", {"robot_id": "r"}), (1, "k", 5, "ready", None),
             (None, "k", 5, "prepare", None), (3, None, 5, "ready", None), (4, "n", None, "ready", None), (5, "m", 6, None, None)])
    read = lambda: so.stream_latest_status(spark.readStream.schema(spark.read.parquet(str(tmp_path)).schema).parquet(str(tmp_path)))
    first, _ = _updates(read(), ckpt)
    assert {r[1:] for r in first} == {("j", "running", "r", t0 + 5), ("k", "ready", None, t0 + 5)} and len(first) == 2
    part(1, [(1, "j", 5, "ready", None), (2, "k", 5, "finished", {"robot_id": None}), (9, "j", 4, "failed", None)])
    second, _ = _updates(read(), ckpt)
    assert [r[1:] for r in second] == [("k", "finished", None, t0 + 5)]


def test_await_running_state_is_dropped(spark):
    """All polls of the larger table: with a short memory the state of decided jobs goes, and timers end every wait."""
    polls = dv.job_polls(spark, SF01).select("poll_id", "job_id", "poll_ts_us", "status", "poll_error")
    sdf = _stream(spark, polls, 6)
    wait = lambda keep: so.stream_await_running(sdf, timeout_s=3600, watermark="1 second", done_retention_s=keep)
    found, kept = _updates(wait(10 * 365 * 86_400))
    want = {tuple(r) for r in jb.await_running_outcome(polls, dv.job_starts(dv.job_polls(spark, SF01)), timeout_s=3600)
            .select("job_id", "start_us", "code", "decided_us").collect()}
    got = {r[1:] for r in found}
    assert got <= want and len(got) == len(found) and {w for w in want if w[2] != 2} <= got
    assert sum(w[2] == 2 for w in got) > 0.9 * sum(w[2] == 2 for w in want)
    _, short = _updates(wait(0))
    assert short[-1] < kept[-1] / 10


def test_await_running_needs_a_retention(spark):
    sdf = spark.readStream.format("rate").load()
    with pytest.raises(ValueError):
        so.stream_await_running(sdf, done_retention_s=None)


@pytest.mark.parametrize("seed", range(4))
def test_needed_rows_decide_alike(seed):
    """Rows of a job in batches of any order and size, against a walk through all of them in order."""
    rng = np.random.default_rng(seed)
    wait = so._AwaitRunning(50, 0)
    for _ in range(200):
        n = int(rng.integers(1, 12))
        rows = pd.DataFrame({"ts_us": rng.integers(0, 8, n), "poll_id": rng.permutation(n), "is_start": rng.random(n) < 0.3,
                             "code": pd.array(rng.integers(0, 4, n), "Int32")})
        rows.loc[rng.random(n) < 0.3, "code"] = pd.NA
        known = int(rng.integers(0, 8)) if rng.random() < 0.4 else None
        start, decided = known, None
        for r in rows.sort_values(["ts_us", "poll_id"]).itertuples():
            if start is None:
                start = r.ts_us if r.is_start else None
            elif r.ts_us > start and not pd.isna(r.code):
                decided = (r.ts_us, r.code)
                break
        held, found = None, known
        for part in np.array_split(rng.permutation(n), int(rng.integers(1, 4))):
            pdf = rows.iloc[part]
            held, found = wait._needed(pdf if held is None else pd.concat([held, pdf], ignore_index=True), known)
        assert found == start
        if start is not None:
            later = held[(held["ts_us"] > start) & held["code"].notna()]
            assert (tuple(later[["ts_us", "code"]].iloc[0]) if len(later) else None) == decided
