"""W1-W6, J3 and the chunked scans against plain sequential loops.

DuckDB shares the closed forms with the Spark side, so these loops are the
independent check of the algebra (including the chunk carry).
"""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from trajlake.operators import motion as mo
from trajlake.operators import jobs as jb
from trajlake.operators.scans import chunked_carry_last, chunked_lag, chunked_running_sum

SCHEMA = "robot string, request_id string, seq int, ts_us long, period_us long"


def _random_log(seed: int, robots=("r0", "r1", "r2"), n=60):
    rnd = random.Random(seed)
    rows = []
    for r in robots:
        t = rnd.randint(0, 1000)
        for i in range(n):
            gap = rnd.choice([0, 0, 5, 50, 400, 3000])          # ties, short and long idle gaps
            t += gap
            p = rnd.choice([0, 10, 100, 250, 1000])              # zero periods included
            rows.append((r, f"q{i:04d}", 0, t, p))
            if rnd.random() < 0.2:                               # several actions of one request
                rows.append((r, f"q{i:04d}", 1, t, rnd.choice([0, 100])))
    return rows


def _sequential(rows, e0=None):
    """The worker loop: clock starts before the blocking get."""
    out = {}
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for robot, rs in by.items():
        e_prev = e0
        for (_, req, seq, a, p) in sorted(rs, key=lambda x: (x[3], x[1], x[2])):
            g = a if e_prev is None else max(a, e_prev)
            e = a if e_prev is None else max(a, e_prev + p)
            over = e_prev is None or g - e_prev >= p
            out[(robot, req, seq)] = (g, e, over)
            e_prev = e
    return out


@pytest.mark.parametrize("seed,chunk", [(1, 10_000), (2, 997), (3, 10**12), (4, None)])
def test_timeline_matches_sequential_loop(spark, seed, chunk):
    rows = _random_log(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.robot, r.request_id, r.seq): (r.g_us, r.e_us, r.overrun)
           for r in mo.execution_timeline(df, chunk_us=chunk).collect()}
    assert got == _sequential(rows)


def test_naive_recurrence_would_differ():
    rows = _random_log(4)
    seq = _sequential(rows)
    # naive e = max(a, e_prev) + p: the wait is not counted toward the period
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    naive = {}
    for robot, rs in by.items():
        e_prev = None
        for (_, req, s, a, p) in sorted(rs, key=lambda x: (x[3], x[1], x[2])):
            e = (a if e_prev is None else max(a, e_prev)) + p
            naive[(robot, req, s)] = e
            e_prev = e
    assert any(naive[k] != seq[k][1] for k in seq)


def test_pending_backlog_brute_force(spark):
    rows = _random_log(5)
    df = spark.createDataFrame(rows, SCHEMA)
    tl = mo.execution_timeline(df, chunk_us=5_000)
    rnd = random.Random(7)
    seq = _sequential(rows)
    # observe exactly at arrivals, at dequeues and in between
    instants = sorted({r[3] for r in rows} | {v[0] for v in seq.values()} | {rnd.randint(0, 200_000) for _ in range(50)})
    obs = [(f"o{i}", robot, t) for i, t in enumerate(instants) for robot in ("r0", "r1", "r2")]
    odf = spark.createDataFrame(obs, "obs_id string, robot string, t_us long")
    got = {(r.obs_id, r.robot): r.pending for r in mo.pending_backlog(tl, odf, chunk_us=5_000).collect()}
    for (oid, robot, t) in obs:
        want = sum(1 for r in rows if r[0] == robot and r[3] <= t < seq[(r[0], r[1], r[2])][0])
        assert got[(oid, robot)] == want


def test_motion_segments_sequential(spark):
    rows = _random_log(6, robots=("r0", "r1"), n=80)
    rnd = random.Random(9)
    clears = []
    for robot in ("r0", "r1"):
        ts = sorted(rnd.sample([r[3] for r in rows if r[0] == robot], 5))
        clears += [(robot, t + rnd.choice([0, 1]), "end_motion") for t in ts]
    df = spark.createDataFrame(rows, SCHEMA)
    cdf = spark.createDataFrame(clears, "robot string, ts_us long, kind string")
    got = {(r.robot, r.request_id, r.seq): (r.segment_id, r.g_us, r.e_us, r.dropped)
           for r in mo.motion_segments(df, cdf, chunk_us=3_000).collect()}
    for robot in ("r0", "r1"):
        cts = sorted(t for (rb, t, _) in clears if rb == robot)
        acts = sorted((r for r in rows if r[0] == robot), key=lambda x: (x[3], x[1], x[2]))
        for k in range(len(cts) + 1):
            lo = cts[k - 1] if k > 0 else None
            hi = cts[k] if k < len(cts) else None
            seg = [a for a in acts if (lo is None or a[3] >= lo) and (hi is None or a[3] < hi)]
            e_prev = lo
            for (_, req, s, a, p) in seg:
                g = a if e_prev is None else max(a, e_prev)
                e = a if e_prev is None else max(a, e_prev + p)
                dropped = hi is not None and g >= hi
                assert got[(robot, req, s)] == (k, g, e, dropped)
                e_prev = e


def _worker_with_clears(acts, clears, limit):
    """One robot, one arm: only dequeued commands become the last position."""
    out, last, bounds = {}, 0.0, [None, *sorted(clears), None]
    for k in range(len(bounds) - 1):
        lo, hi = bounds[k], bounds[k + 1]
        e_prev, prev = lo, last
        for (req, ts, dur, pos) in [a for a in acts if (lo is None or a[1] >= lo) and (hi is None or a[1] < hi)]:
            v = abs(pos - prev) / (dur / 1e6)
            period = math.floor(dur * v / limit + 0.5) if v > limit else dur
            g = ts if e_prev is None else max(ts, e_prev)
            e_prev = ts if e_prev is None else max(ts, e_prev + period)
            dropped = hi is not None and g >= hi
            out[req] = (k, True, None) if dropped else (k, False, (period, g, e_prev))
            prev = pos
            last = last if dropped else pos
    return out


@pytest.mark.parametrize("seed,chunk", [(21, 400_000), (22, 1_000), (23, None)])
def test_execute_with_clears_matches_worker_loop(spark, seed, chunk):
    rnd = random.Random(seed)
    rows, clears = [], []
    for robot in ("r0", "r1"):
        t = 0
        for i in range(50):
            t += rnd.choice([0, 20_000, 60_000])
            rows.append((robot, "left", f"q{i:03d}", 0, t, 100_000, [float(rnd.choice([0, 9, 11, 50, 73])), 0.0]))
        clears += [(robot, c, "end_motion") for c in sorted(rnd.sample(range(1, t), 8))]
    df = spark.createDataFrame(rows, "robot string, arm string, request_id string, seq int, ts_us long, duration_us long, position array<double>")
    cdf = spark.createDataFrame(clears, "robot string, ts_us long, kind string")
    got = {(r.robot, r.request_id): (r.segment_id, r.dropped, None if r.dropped else (r.period_us, r.g_us, r.e_us))
           for r in mo.execute_with_clears(df, cdf, velocity_limit=100.0, chunk_us=chunk).collect()}
    want = {}
    for robot in ("r0", "r1"):
        acts = [(r[2], r[4], r[5], r[6][0]) for r in rows if r[0] == robot]
        want.update({(robot, q): x for q, x in _worker_with_clears(acts, [c[1] for c in clears if c[0] == robot], 100.0).items()})
    assert got == want
    assert any(x[1] for x in want.values()) and any(not x[1] and x[0] > 0 for x in want.values())


def test_removed_command_is_not_the_last_position(spark):
    rows = [("r", "left", "b", 0, 0, 100_000, [9.0, 0.0]), ("r", "left", "x", 0, 10_000, 100_000, [50.0, 0.0]),
            ("r", "left", "x2", 0, 20_000, 100_000, [50.0, 0.0]), ("r", "left", "y", 0, 60_000, 100_000, [9.0, 0.0])]
    df = spark.createDataFrame(rows, "robot string, arm string, request_id string, seq int, ts_us long, duration_us long, position array<double>")
    cdf = spark.createDataFrame([("r", 50_000, "end_motion")], "robot string, ts_us long, kind string")
    got = {r.request_id: r for r in mo.execute_with_clears(df, cdf, velocity_limit=1000.0).collect()}
    assert [got[q].dropped for q in ("b", "x", "x2", "y")] == [False, False, True, False]
    assert got["y"].last_position == [50.0, 0.0]     # x ran
    early = spark.createDataFrame([("r", 5_000, "end_motion"), ("r", 50_000, "end_motion")], "robot string, ts_us long, kind string")
    slow = df.withColumn("ts_us", F.when(F.col("request_id") == "x", 10_000).otherwise(F.col("ts_us")).cast("bigint"))
    again = {r.request_id: r for r in mo.execute_with_clears(slow, early, velocity_limit=1000.0).collect()}
    assert again["x"].dropped is False and again["y"].segment_id == 2


def test_asof_position_brute_force(spark):
    rnd = random.Random(11)
    cmds = [("r0", rnd.choice(["left", "right"]), rnd.randint(0, 10_000), f"q{i}", 0, [float(i)]) for i in range(200)]
    cmds = list({(c[0], c[1], c[2]): c for c in cmds}.values())
    obs = [(f"o{i}", "r0", rnd.choice(["left", "right"]), rnd.randint(0, 10_000)) for i in range(100)]
    cdf = spark.createDataFrame(cmds, "robot string, arm string, g_us long, request_id string, seq int, position array<double>")
    odf = spark.createDataFrame(obs, "obs_id string, robot string, arm string, t_us long")
    got = {r.obs_id: r.cmd_request_id for r in mo.asof_position(cdf, odf, chunk_us=700).collect()}
    for (oid, robot, arm, t) in obs:
        cands = [c for c in cmds if c[1] == arm and c[2] <= t]
        want = max(cands, key=lambda c: (c[2], c[3]))[3] if cands else None
        assert got[oid] == want


@pytest.mark.parametrize("chunk", ["c", None])
def test_chunked_scans_vs_pandas(spark, chunk):
    rnd = random.Random(13)
    rows = [(rnd.choice(["a", "b"]), i, rnd.choice([None, 1, 2, 3])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t long, v int").withColumn("c", F.floor(F.col("t") / 37))
    s = chunked_running_sum(df.withColumn("v0", F.coalesce("v", F.lit(0))), ["k"], chunk, ["t"], "v0", "rs")
    s = chunked_carry_last(s, ["k"], chunk, ["t"], "v", "cl")
    s = chunked_lag(s, ["k"], chunk, ["t"], "v", "lg")
    got = {(r.k, r.t): (r.rs, r.cl, r.lg) for r in s.collect()}
    for key in ("a", "b"):
        run, last, prev = 0, None, "START"
        for (k, t, v) in [r for r in rows if r[0] == key]:
            run += v or 0
            if v is not None:
                last = v
            assert got[(k, t)] == (run, last, None if prev == "START" else prev)
            prev = v


def test_idle_exit_loop(spark):
    rnd = random.Random(17)
    rows = [(c, i, i * 1000, rnd.random() < 0.7) for c in range(3) for i in range(200)]
    df = spark.createDataFrame(rows, "collection_id int, poll_id int, poll_ts_us long, is_idle boolean")
    got = {r.collection_id: r.exit_poll_id for r in jb.idle_exit(df, n=4, chunk_us=7_000).collect()}
    for c in range(3):
        run, want = 0, None
        for (_, p, _, idle) in [r for r in rows if r[0] == c]:
            run = run + 1 if idle else 0
            if run >= 4:
                want = p
                break
        assert got[c] == want


def test_segments_and_backlog_unchunked(spark):
    rows = _random_log(8, robots=("r0",), n=50)
    df = spark.createDataFrame(rows, SCHEMA)
    cdf = spark.createDataFrame([("r0", rows[20][3], "end_motion")], "robot string, ts_us long, kind string")
    a = {(r.request_id, r.seq): (r.segment_id, r.g_us, r.dropped) for r in mo.motion_segments(df, cdf, chunk_us=None).collect()}
    b = {(r.request_id, r.seq): (r.segment_id, r.g_us, r.dropped) for r in mo.motion_segments(df, cdf, chunk_us=500).collect()}
    assert a == b
    tl = mo.execution_timeline(df, chunk_us=None)
    obs = spark.createDataFrame([("o", "r0", t) for t in range(0, 60_000, 997)], "obs_id string, robot string, t_us long")
    p1 = {r.t_us: r.pending for r in mo.pending_backlog(tl, obs, chunk_us=None).collect()}
    p2 = {r.t_us: r.pending for r in mo.pending_backlog(tl, obs, chunk_us=800).collect()}
    assert p1 == p2


def test_backlog_after_clears_counts_until_the_clear(spark):
    rows = _random_log(12, robots=("r0",), n=80)
    df = spark.createDataFrame(rows, SCHEMA)
    clear_ts = sorted(r[3] for r in rows)[40] + 1
    cdf = spark.createDataFrame([("r0", clear_ts, "end_motion")], "robot string, ts_us long, kind string")
    seg = mo.motion_segments(df, cdf, chunk_us=2_000)
    segs = {(r.request_id, r.seq): (r.g_us, r.next_clear_us) for r in seg.collect()}
    instants = sorted({r[3] for r in rows} | {clear_ts, clear_ts - 1} | {g for g, _ in segs.values()})
    obs = spark.createDataFrame([(f"o{i}", "r0", t) for i, t in enumerate(instants)],
                                "obs_id string, robot string, t_us long")
    got = {r.t_us: r.pending for r in mo.pending_backlog(seg, obs, chunk_us=2_000).collect()}
    for t in instants:
        want = 0
        for r in rows:
            g, nxt = segs[(r[1], r[2])]
            leave = g if nxt is None else min(g, nxt)
            want += r[3] <= t < leave
        assert got[t] == want, t


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(gaps=st.lists(st.integers(min_value=0, max_value=5_000), min_size=1, max_size=40),
       periods=st.lists(st.sampled_from([0, 1, 50, 999, 4_000]), min_size=40, max_size=40),
       chunk=st.sampled_from([None, 1, 700, 10_000, 10**12]),
       start=st.one_of(st.none(), st.integers(min_value=-1_000, max_value=3_000)))
def test_timeline_hypothesis(spark, gaps, periods, chunk, start):
    t, rows = 0, []
    for i, gap in enumerate(gaps):
        t += gap
        rows.append(("r", f"q{i:03d}", 0, t, periods[i], start))
    df = spark.createDataFrame(rows, SCHEMA + ", e0 long")
    got = {(r.request_id, r.seq): (r.g_us, r.e_us) for r in
           mo.execution_timeline(df, chunk_us=chunk, start="e0").collect()}
    want = {k[1:]: v[:2] for k, v in _sequential([r[:5] for r in rows], e0=start).items()}
    assert got == want


@pytest.mark.parametrize("bits", [2, 20])
def test_null_keys_and_many_levels_equal_plain_windows(spark, monkeypatch, bits):
    """Rows without a robot or arm are a key of their own, whatever the chunks and levels."""
    from trajlake.operators import scans
    monkeypatch.setattr(scans, "FANOUT_BITS", bits)
    monkeypatch.setattr(scans, "HORIZON_US", 4_000)
    rng = random.Random(bits)
    rows = [(rng.choice(["r1", "r2", None]), rng.choice(["left", "right", None]), f"q{i:04d}", 0, i * 9, rng.randint(5, 40), rng.randint(3, 30),
             [rng.uniform(-1, 1) for _ in range(3)]) for i in range(300)]
    df = spark.createDataFrame(rows, "robot string, arm string, request_id string, seq int, ts_us long, duration_us long, period_us long, position array<double>")
    clears = spark.createDataFrame([(rng.choice(["r1", "r2", None]), rng.randint(0, 2700), "end_motion") for _ in range(25)], "robot string, ts_us long, kind string")
    obs = spark.createDataFrame([(i, rng.choice(["r1", "r2", None]), rng.choice(["left", "right", None]), rng.randint(0, 3000)) for i in range(60)],
                                "obs_id int, robot string, arm string, t_us long")

    def results(width):
        tl = mo.execution_timeline(df, chunk_us=width)
        seg = mo.motion_segments(df, clears, chunk_us=width)
        vel = mo.step_velocity(df, chunk_us=width).select("request_id", "last_position")
        yield tl.select("request_id", "g_us", "e_us", "prev_end_us")
        yield seg.select("request_id", "segment_id", "segment_start_us", "next_clear_us", "g_us", "e_us", "dropped")
        yield vel
        yield mo.pending_backlog(tl, obs, chunk_us=width).select("obs_id", "pending")
        yield mo.asof_position(tl, obs, chunk_us=width).select("obs_id", "cmd_request_id")

    for plain, chunked in zip(results(None), results(60), strict=True):
        assert sorted(map(str, chunked.collect())) == sorted(map(str, plain.collect()))


def test_clears_touch_only_the_segments_that_change(spark):
    """500 segments: passes after the first read only the rows of segments whose look back changed."""
    rng = random.Random(11)
    acts, clears = [], []
    for s in range(500):
        t = s * 1_000
        clears.append(("r", t, "end_motion"))
        for i in range(4):
            acts.append(("r", "left", f"q{s:03d}-{i}", 0, t + 10 + i * 20, 40 if s % 50 else 700, [rng.uniform(-1, 1) for _ in range(3)]))
    df = spark.createDataFrame(acts, "robot string, arm string, request_id string, seq int, ts_us long, duration_us long, position array<double>")
    cdf = spark.createDataFrame(clears, "robot string, ts_us long, kind string")
    passes = []
    got = mo.execute_with_clears(df, cdf, velocity_limit=1e9, chunk_us=100_000, passes=passes)
    assert got.count() == 2_000 and got.filter("dropped").count() > 0
    assert passes[0] == 2_000 and len(passes) >= 2 and all(n <= 200 for n in passes[1:]) and passes[1:] == sorted(passes[1:], reverse=True), passes
    prev = {}
    for r in got.orderBy("ts_us").collect():   # the worker's loop: the last command that ran, or the predecessor in the segment
        same = prev.get("segment") == r.segment_id
        assert r.last_position == (prev.get("any") if same else prev.get("ran"))
        prev.update(segment=r.segment_id, any=r.position)
        if not r.dropped:
            prev["ran"] = r.position


def test_segments_need_no_exchange_by_segment(spark):
    df = spark.createDataFrame([("r", "left", "q", 0, 5, 5)], "robot string, arm string, request_id string, seq int, ts_us long, period_us long")
    clears = spark.createDataFrame([("r", 7, "x")], "robot string, ts_us long, kind string")
    plan = mo.motion_segments(df, clears)._jdf.queryExecution().executedPlan().toString()
    assert not [ln for ln in plan.split("\n") if "Exchange" in ln and "segment_id" in ln]
    assert sum("Scan ExistingRDD" in ln for ln in plan.split("\n")) <= 4   # actions and clears, for the rows and for their summaries
