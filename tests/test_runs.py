"""Job runs from logs against a line-by-line automaton."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from trajlake.operators import runs as rn
from trajlake.sources.runlog import read_run_log

KINDS = rn.CLOSING_KINDS + ["started", "state_latency", "inference_result", "other"]
SCHEMA = "worker string, line_no long, ts_us long, kind string, job_id string, status string, latency_s double"


def _walk(lines):
    """Runs of one log, one line after the other."""
    out, run = [], None

    def close(line):
        if run and run["start_us"] is not None:
            named = line is not None and line["job_id"] == run["job_id"] and line["job_id"] is not None
            run["end_us"] = line["ts_us"] if line else None
            run["end_reason"] = (None if line is None else {"max_wait": "max_wait", "error": "exception"}.get(line["kind"], "not_running")
                                 if named else "not_running")
            out.append(run)

    for x in sorted(lines, key=lambda x: x["line_no"]):
        if x["kind"] in rn.CLOSING_KINDS:
            close(x)
            called = x["kind"] == "processing_job" and x["status"] == "ready"
            run = dict(worker=x["worker"], first_line=x["line_no"], job_id=x["job_id"], called_us=x["ts_us"], start_us=None, n_states=0,
                       n_inferences=0, lat=[]) if called else None
        elif run and x["kind"] == "started" and run["start_us"] is None:
            run["start_us"] = x["ts_us"]
        elif run and run["start_us"] is not None and x["kind"] == "state_latency":
            run["n_states"] += 1
            run["lat"].append(x["latency_s"])
        elif run and run["start_us"] is not None and x["kind"] == "inference_result":
            run["n_inferences"] += 1
    close(None)
    return {(r["worker"], r["first_line"], r["job_id"], r["called_us"], r["start_us"], r["end_us"], r["n_states"], r["n_inferences"],
             round(sum(r["lat"]), 6) if r["lat"] else None, max(r["lat"]) if r["lat"] else None, r["end_reason"]) for r in out}


def _rows(df):
    return [(*r[:8], None if r.latency_s is None else round(r.latency_s, 6), r.max_latency_s, r.end_reason) for r in df.collect()]


@pytest.mark.parametrize("chunk_lines", [None, 1, 7, 65_536])
def test_runs_equal_the_line_by_line_automaton(spark, chunk_lines):
    rng = random.Random(5)
    rows = []
    for worker in ("a", "b", None):
        for n in range(600):
            # mostly lines of a run, so that many runs start
            kind = rng.choices(KINDS, [8, 3, 3, 1, 1, 1, 9, 9, 9, 2])[0]
            named = kind in ("processing_job", "max_wait", "error", "job_status")
            rows.append(dict(worker=worker, line_no=n, ts_us=n * 10 - rng.randrange(30), kind=kind, job_id=f"j{rng.randrange(2)}" if named else None,
                             status=rng.choice(["ready", "ready", "running", None]) if kind == "processing_job" else None,
                             latency_s=rng.randrange(500) / 100 if kind == "state_latency" else None))
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = _rows(rn.job_runs(df, chunk_lines=chunk_lines))
    want = set().union(*[_walk([x for x in rows if x["worker"] == w]) for w in ("a", "b", None)])
    assert len(got) == len(set(got)) and set(got) == want
    assert {r[-1] for r in want} >= {"max_wait", "exception", "not_running"}


def test_run_broken_off_and_empty_log(spark):
    call = ("w", 0, 5, "processing_job", "j", "ready", None)
    lines = [call, ("w", 1, 6, "started", None, None, None), ("w", 2, 7, "inference_result", None, None, None),
             ("w", None, 8, "exit", None, None, None), ("w", 3, 8, None, None, None, None)]
    (r,) = rn.job_runs(spark.createDataFrame(lines, SCHEMA)).collect()
    assert (r.start_us, r.end_us, r.n_inferences, r.n_states, r.end_reason) == (6, None, 1, 0, None)
    assert rn.job_runs(spark.createDataFrame([call], SCHEMA)).count() == 0          # called, never started
    assert rn.job_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_runs_of_log_files_read_in_splits(spark, tmp_path):
    want = 0
    for w in range(2):
        with open(tmp_path / f"worker-{w}.log", "w") as f:
            for j in range(60):
                stamp = f"2025-09-01 10:{j:02d}:00,250"
                f.write(f"{stamp} INFO:Job id: j{j}, status: ready, remaining jobs: 9\n{stamp} INFO:Processing job_id: j{j}, status: ready\n"
                        f"[{stamp}] INFO: Started robot: b'ok'\n")
                for _ in range(j):
                    f.write(f"{stamp} INFO:get_robot_state time: 0.25\n{stamp} INFO:Inference result: [[1.0],\n [2.0]]\n")
                f.write(f"{stamp} WARNING:Job j{j} exceeded max wait time.\n" if j % 3 == 0 else "")
                want += 1
    prev = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        log = read_run_log(spark, str(tmp_path / "*.log"))
        assert log.select(F.spark_partition_id().alias("p")).distinct().count() > 4
        rows = rn.job_runs(log, chunk_lines=64).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", prev)
    assert len(rows) == want
    for r in rows:
        j = int(r.job_id[1:])
        assert r.n_states == r.n_inferences == j and (r.latency_s or 0) == 0.25 * j
        assert r.end_reason == ("max_wait" if j % 3 == 0 else None if j == 59 else "not_running")


def test_a_long_log_is_spread(spark):
    """One log with all lines: no task of the first level reads most of it."""
    n = 40_000
    log = spark.range(n).select(F.lit("w").alias("worker"), F.col("id").alias("line_no"), F.col("id").alias("ts_us"),
                                F.when(F.col("id") == 0, "processing_job").when(F.col("id") == 1, "started").otherwise("inference_result").alias("kind"),
                                F.lit("j").alias("job_id"), F.lit("ready").alias("status"), F.lit(None).cast("double").alias("latency_s"))
    (r,) = rn.job_runs(log, chunk_lines=1_000).collect()
    assert (r.n_inferences, r.end_reason) == (n - 2, None)
    plan = rn.job_runs(log, chunk_lines=1_000)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and any("__chunk_1000" in line.split("windowspec")[-1] or "__chunk_1000" in line for line in windows)
