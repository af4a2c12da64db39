"""One test per decided reference defect and per action-path edge case."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajlake.operators import actions as act
from trajlake.operators import jobs as jb
from trajlake.operators import motion as mo
from trajlake.operators import observations as ob
from trajlake.schemas import BAD_ARITY_MESSAGE, MISSING_TYPE_MESSAGE, spec_for_join
from trajlake.functions.vectors import parse_action_type

REQ = "request_id string, robot string, ts_us long, action_type string, actions array<array<double>>, duration_us long"


def _req(spark, rows):
    return spark.createDataFrame(rows, REQ)


def test_action_type_precedence(spark):
    df = spark.createDataFrame([(t,) for t in ["joint", "pos", "leftjoint", "leftpos", "rightjoint", "rightpos",
                                               "leftright", "foo", None]], "t string")
    out = [r.p for r in df.select(parse_action_type("t").alias("p")).collect()]
    got = [(p.arm, p.mode, p.is_documented) if p else None for p in out]
    assert got == [("both", "joint", True), ("both", "pos", True), ("left", "joint", True), ("left", "pos", True),
                   ("right", "joint", True), ("right", "pos", True), ("left", "joint", False),
                   ("both", "joint", False), None]


def test_arity_every_robot_and_type(spark):
    expect = {("aloha", "joint"): 14, ("aloha", "pos"): 34, ("aloha", "leftjoint"): 7, ("aloha", "leftpos"): 17,
              ("arx5", "leftjoint"): 7, ("arx5", "leftpos"): 7, ("ur5", "leftpos"): 7, ("franka", "leftjoint"): 8,
              ("franka", "leftpos"): 8, ("franka", "rightpos"): 8}
    rows = [(f"{r}-{t}", r, 0, t, [[0.0] * n], 50000) for (r, t), n in expect.items()]
    out = act.validate_action_arity(_req(spark, rows), spec_for_join(spark)).collect()
    assert all(not o.is_bad and o.expected_len == expect[(o.robot, o.action_type)] for o in out)


def test_short_action_first_middle_last_and_outcomes(spark):
    ok, short = [0.0] * 7, [0.0] * 6
    rows = [("first", "arx5", 0, "leftjoint", [short, ok, ok], 50000),
            ("middle", "arx5", 1, "leftjoint", [ok, short, ok], 50000),
            ("last", "arx5", 2, "leftjoint", [ok, ok, short], 50000),
            ("empty", "arx5", 3, "leftjoint", [], 50000),
            ("notype", "arx5", 4, None, [ok], 50000),
            ("notype_empty", "arx5", 5, None, [], 50000),
            ("zero_dur", "arx5", 6, "leftjoint", [ok], 0),
            ("null_dur", "arx5", 7, "leftjoint", [ok], None),
            ("robot?", "spot", 8, "leftjoint", [ok], 50000)]
    spec = spec_for_join(spark)
    out = {r.request_id: r for r in act.batch_outcome(_req(spark, rows), spec).collect()}
    assert [out[k].first_bad_pos for k in ("first", "middle", "last")] == [0, 1, 2]
    assert all(out[k].message == BAD_ARITY_MESSAGE and out[k].clears_queue for k in ("first", "middle", "last"))
    assert out["empty"].result == "success" and out["notype_empty"].result == "success"
    assert (out["notype"].result, out["notype"].http_status, out["notype"].message) == ("error", 400, MISSING_TYPE_MESSAGE)
    assert out["robot?"].result == "error"
    val = act.validate_action_arity(_req(spark, rows), spec)
    eff = {(r.request_id, r.seq): (r.effective, r.quarantine_reason) for r in val.collect()}
    # a bad request clears the whole queue: none of its actions run (prefix included)
    assert eff[("middle", 0)] == (False, "bad_arity")
    # Null or zero duration is quarantined
    assert eff[("zero_dur", 0)] == (False, "bad_duration") and eff[("null_dur", 0)] == (False, "bad_duration")
    clears = act.clear_events(_req(spark, rows), spec).collect()
    assert sorted(c.ts_us for c in clears) == [0, 1, 2]


def _run_motion(spark, rows, limit):
    ex = act.explode_action_chunk(act.validate_action_arity(_req(spark, rows), spec_for_join(spark)))
    return {(r.request_id, r.seq): r for r in mo.retime_actions(mo.step_velocity(ex), limit).collect()}


def test_d2_d3_two_arm_split_and_scale(spark):
    # 34-long two-arm pose splits 17/17 (D2); both grippers are left out of the scale (D3)
    a = [0.0] * 34
    b = [0.0] * 34
    b[16] = 100.0   # left gripper jump
    b[33] = 100.0   # right gripper jump
    b[0] = 1.0
    rows = [("p0", "aloha", 0, "pos", [a, b], 1_000_000)]
    ex = act.explode_action_chunk(act.validate_action_arity(_req(spark, rows), spec_for_join(spark)))
    r = ex.filter(F.col("seq") == 1).collect()[0]
    assert len(r.left) == 17 and len(r.right) == 17 and r.right[16] == 100.0
    m = _run_motion(spark, rows, 10.0)[("p0", 1)]
    assert m.max_abs == 100.0 and m.max_abs_no_gripper == 1.0
    # gripper-only jump: triggered by the gripper, scaled without it -> period shortens
    assert m.retimed and m.period_us == 100_000


def test_d4_home_and_length_change(spark):
    rows = [("q0", "aloha", 0, "leftjoint", [[1.0] * 7], 1_000_000),
            ("q1", "aloha", 1, "leftpos", [[1.0] * 17], 1_000_000)]
    m = _run_motion(spark, rows, 1e6)
    # first action compares with zeros of its own length
    assert m[("q0", 0)].max_abs == 1.0 and not m[("q0", 0)].shape_mismatch
    # a later length change on the same arm: null velocity, nominal period
    assert m[("q1", 0)].shape_mismatch and m[("q1", 0)].max_abs is None and m[("q1", 0)].period_us == 1_000_000


def test_d17_positions_per_arm(spark):
    rows = [("a", "aloha", 0, "leftjoint", [[5.0] * 7], 1_000_000),
            ("b", "aloha", 1, "rightjoint", [[5.0] * 7], 1_000_000),
            ("c", "aloha", 2, "leftjoint", [[5.0] * 7], 1_000_000)]
    m = _run_motion(spark, rows, 1e6)
    # the right arm starts from home; the left arm's second command did not move
    assert m[("b", 0)].max_abs == 5.0 and m[("c", 0)].max_abs == 0.0


def test_nan_never_triggers(spark):
    rows = [("n", "arx5", 0, "leftjoint", [[float("nan")] + [0.0] * 6], 1_000_000)]
    m = _run_motion(spark, rows, 0.5)[("n", 0)]
    assert not m.retimed and m.period_us == 1_000_000


def test_d1_two_arm_pos_returns_poses(spark):
    df = spark.createDataFrame([("pos", [1.0] * 6, [2.0] * 16, 0.5, [3.0] * 6, [4.0] * 16, 0.7, True, True)],
                               "action_type string, left_joint array<double>, left_pose array<double>, left_gripper double,"
                               " right_joint array<double>, right_pose array<double>, right_gripper double,"
                               " left_enabled boolean, right_enabled boolean")
    r = ob.observation_status(ob.select_state_vector(df)).collect()[0]
    assert len(r.vector) == 34 and r.vector[0] == 2.0 and r.vector[16] == 0.5 and r.vector[33] == 0.7
    assert r.state == "normal"


def test_observation_status_abnormal_and_size_none(spark):
    df = spark.createDataFrame([("joint", True, False), ("leftjoint", True, False), ("rightjoint", True, False),
                                (None, True, True)], "action_type string, left_enabled boolean, right_enabled boolean")
    df = df.select("*", F.array(F.lit(1.0)).alias("left_joint"), F.array(F.lit(1.0)).alias("right_joint"),
                   F.array(F.lit(1.0)).alias("left_pose"), F.array(F.lit(1.0)).alias("right_pose"),
                   F.lit(0.0).alias("left_gripper"), F.lit(0.0).alias("right_gripper"))
    st = [(r.state, r.vector is None) for r in ob.observation_status(ob.select_state_vector(df)).collect()]
    assert st == [("abnormal", True), ("normal", False), ("abnormal", True), ("size_none", True)]


def test_letterbox_examples(spark):
    df = spark.createDataFrame([(640, 480, "padding"), (224, 224, "padding"), (100, 1, "padding"),
                                (640, 480, "stretch"), (1, 2000, "padding")],
                               "src_w int, src_h int, resize_name string")
    out = [(r.resized_w, r.resized_h, r.pad_x, r.pad_y, r.identity, r.degenerate)
           for r in ob.letterbox_geometry(df).collect()]
    assert out[0] == (224, 168, 0, 28, False, False)
    assert out[1] == (224, 224, 0, 0, True, False)
    assert out[2] == (224, 2, 0, 111, False, False)
    assert out[3] == (224, 224, 0, 0, False, False)
    assert out[4][0] == 0 and out[4][5]


def test_d11_size_none_ends_run_with_exception_and_d13_device(spark):
    polls = spark.createDataFrame([
        ("j", 0, "ready", False, True, None, None, 0),
        ("j", 10, "running", False, True, "normal", 10, 0),
        ("j", 20, "running", False, True, "size_none", 20, 0),
        ("j", 30, "running", False, True, "normal", 30, 0),
    ], "job_id string, poll_ts_us long, status string, poll_error boolean, start_ok boolean, state string,"
       " state_ts_us long, pending_actions int")
    starts = spark.createDataFrame([("j", 0, True)], "job_id string, start_us long, start_ok boolean")
    r = jb.job_run_summary(polls, starts, max_wait_s=600).collect()[0]
    assert (r.end_reason, r.end_us, r.n_inferences, r.n_iterations) == ("exception", 20, 1, 2)
    dev = spark.createDataFrame([("j", 1, None), ("j", 2, ("r9",))],
                                "job_id string, poll_ts_us long, device struct<robot_id:string>")
    assert jb.first_device_assignment(dev).collect()[0].robot_id == "r9"


def test_max_wait_only_after_post(spark):
    polls = spark.createDataFrame([
        ("j", 1_000_000_000, "running", False, "abnormal", 1, 0),   # late, but no post: not ended
        ("j", 1_000_000_100, "running", False, "normal", 2, 0),     # post, then the check fires
    ], "job_id string, poll_ts_us long, status string, poll_error boolean, state string, state_ts_us long,"
       " pending_actions int")
    starts = spark.createDataFrame([("j", 0, True)], "job_id string, start_us long, start_ok boolean")
    r = jb.job_run_summary(polls, starts, max_wait_s=600).collect()[0]
    assert (r.end_reason, r.end_us, r.n_skip_not_normal, r.n_inferences) == ("max_wait", 1_000_000_100, 1, 1)


def test_rollup_empty_and_unknown(spark):
    job = "struct<job_id:string,status:string,device:struct<robot_id:string>>"
    df = spark.createDataFrame([(1, []), (2, [("a", "paused", ("r",))]), (3, [("a", "failed", ("r",))]),
                                (4, [("a", "failed", ("r",)), ("b", "ready", ("r",))])],
                               f"poll_id int, jobs array<{job}>").withColumn("collection_id", F.lit(0))
    out = {r.poll_id: (r.has_active, r.n_terminal, r.is_idle) for r in jb.collection_rollup(df).collect()}
    assert out == {1: (False, 0, True), 2: (False, 0, False), 3: (False, 1, True), 4: (True, 1, False)}


def test_await_outcome_codes(spark):
    polls = spark.createDataFrame([
        ("ok", 10, "prepare", False), ("ok", 20, None, False), ("ok", 30, "running", False),
        ("bad", 10, "failed", False),
        ("err", 10, "prepare", False), ("err", 11, None, True), ("err", 12, "running", False),
        ("slow", 10, "prepare", False), ("slow", 2_000, "running", False),
    ], "job_id string, poll_ts_us long, status string, poll_error boolean")
    starts = spark.createDataFrame([(j, 0) for j in ("ok", "bad", "err", "slow", "silent")],
                                   "job_id string, start_us long")
    out = {r.job_id: r.code for r in jb.await_running_outcome(polls, starts, timeout_s=0.001).collect()}
    assert out == {"ok": 0, "bad": 1, "err": 3, "slow": 2, "silent": 2}


def test_await_outcome_as_of(spark):
    polls = spark.createDataFrame([("a", 5, "running", False)], "job_id string, poll_ts_us long, status string, poll_error boolean")
    starts = spark.createDataFrame([("a", 0), ("open", 0), ("expired", -2_000_000)], "job_id string, start_us long")
    out = {r.job_id: r.code for r in jb.await_running_outcome(polls, starts, timeout_s=1, as_of_us=500_000).collect()}
    # "open" is still inside its window at as_of and undecided: left out
    assert out == {"a": 0, "expired": 2}


def test_stream_await_late_decisive_row_gives_timeout(spark):
    import os
    import tempfile
    import pyarrow as pa
    import pyarrow.parquet as pq
    from trajlake.streaming.operators import stream_await_running
    d = tempfile.mkdtemp(prefix="trajlake-t1-")
    t0 = 1_700_000_000_000_000   # event times must be after the initial watermark (the epoch)
    rows = {"job_id": ["j", "j"], "poll_ts_us": [t0, t0 + 5_000_000], "status": ["ready", "running"],
            "poll_error": [False, False]}
    pq.write_table(pa.table(rows), os.path.join(d, "part-000.parquet"))
    sdf = (spark.readStream.schema("job_id string, poll_ts_us long, status string, poll_error boolean").parquet(d)
           .withColumn("poll_ts", F.timestamp_micros("poll_ts_us")))
    q = (stream_await_running(sdf, timeout_s=1, watermark="1 hour").writeStream.format("memory")
         .queryName("t1_late").outputMode("append").option("checkpointLocation", tempfile.mkdtemp())
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = [tuple(r) for r in spark.table("t1_late").collect()]
    # the running row came 5 s after a 1 s limit, in the same batch, before any timer: code 2
    assert got == [("j", t0, 2, t0 + 1_000_000)]


def test_d9_offset_applied_only_on_request(spark):
    from trajlake.operators.clock import clock_offset, observation_latency
    samples = spark.createDataFrame([("j", 0, 1_000, 100), ("j", 10, 1_010, 110)], "session string, t1 long, t2 long, t3 long")
    off = clock_offset(samples).collect()[0]
    assert off.offset_us == 950.0 and off.n_samples == 2 and off.min_rtt_us == 100
    obs = spark.createDataFrame([("j", 5_000, 5_300)], "job_id string, state_ts_us long, recv_us long")
    raw = observation_latency(obs).collect()[0]
    shifted = observation_latency(obs, clock_offset(samples)).collect()[0]
    assert raw.avg_latency_us == 300.0 and shifted.avg_latency_us == 1_250.0


def test_d15_stop_and_end_motion_both_clear(spark):
    acts = spark.createDataFrame([("r", "a", 0, 0, 100), ("r", "a2", 0, 1, 100), ("r", "b", 0, 10, 100),
                                  ("r", "c", 0, 20, 100)],
                                 "robot string, request_id string, seq int, ts_us long, period_us long")
    for kind in ("stop_motion", "end_motion", "start_motion", "format_error"):
        clears = spark.createDataFrame([("r", 15, kind)], "robot string, ts_us long, kind string")
        out = {r.request_id: (r.segment_id, r.dropped) for r in mo.motion_segments(acts, clears).collect()}
        # a finds the worker idle and ends at once (t=0); a2 is dequeued at 1 and ends at 0 + 100;
        # b (arrived at 10) would be dequeued at 100, after the clear at 15: dropped
        assert out == {"a": (0, False), "a2": (0, False), "b": (0, True), "c": (1, False)}, kind


def test_d12_index_key_drift(spark, tmp_path):
    import json
    from trajlake.sources.episodes import episode_catalog
    for pid, key, idx in (("000001", "episode_index", 1), ("FFFFFF", "episode_idx", 80)):
        d = tmp_path / "20250919" / "task" / "data" / f"episode_{pid}" / "meta"
        d.mkdir(parents=True)
        (d / "episode_meta.json").write_text(json.dumps({key: idx, "start_time": 1.0, "end_time": 2.0, "frames": 30},
                                                        indent=2))
    got = {r.episode_id: r.episode_index for r in episode_catalog(spark, str(tmp_path)).collect()}
    assert got == {"000001": 1, "FFFFFF": 80}


def test_policy_entry_points_are_equal(spark):
    """Per state, per batch of states and on columns: the same answers, also for null and empty vectors."""
    from conftest import SF001
    from trajlake.operators.policy import NoActionPolicy, ScaledStateArrowPolicy, ScaledStateBatchPolicy, ScaledStatePolicy, score_policy
    from trajlake.plans.derived import policy_observations
    odd = spark.createDataFrame([(-1, None, 0, "normal"), (-2, [], 0, "normal"), (-3, [1.0, 3.0], None, None), (-4, None, 1, "x"), (-5, [2.0], 0, "normal")],
                                "obs_id long, action array<double>, pending_actions int, state string")
    obs = policy_observations(spark, SF001).select("obs_id", "action", "pending_actions", "state").unionByName(odd).coalesce(2)
    a, b, c = ({r.obs_id: r.actions for r in score_policy(obs, p).collect()} for p in (ScaledStatePolicy, ScaledStateBatchPolicy, ScaledStateArrowPolicy))
    assert a == b == c and len(a) > 5
    assert (c[-1], c[-2], c[-3]) == ([], [[], []], [[0.5, 1.5], [0.25, 0.75]])
    assert all(r.actions == [] for r in score_policy(obs, NoActionPolicy).collect())
    assert score_policy(obs.limit(0), ScaledStateArrowPolicy).count() == 0


def test_policy_null_answers_and_own_columns(spark):
    """A null answer stays null, a column of the answer's name is replaced, other columns pass through."""
    from trajlake.operators.policy import score_policy

    class Picky:
        def __init__(self, checkpoint):
            self.limit = float(checkpoint)

        def run_policy(self, state):
            return None if state["v"] is None or state["v"] > self.limit else [[state["v"]]]

    df = spark.createDataFrame([(1.0, "a", "x"), (9.0, "b", "y"), (None, None, "z")], "v double, actions string, keep string")
    rows = score_policy(df, Picky, checkpoint="5", state_cols=("v",)).select("keep", "actions").collect()
    assert {tuple(r) for r in ((x.keep, None if x.actions is None else tuple(map(tuple, x.actions))) for x in rows)} == {("x", ((1.0,),)), ("y", None), ("z", None)}


def test_policy_flow_runs_the_policy_once(spark):
    """What follows the policy reads its stored requests: no Python node is left in the flow's plan."""
    from conftest import SF001
    from trajlake.plans import catalog
    plan = catalog.q_policy_execution_summary(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "MapInPandas" not in plan and "PythonMapInArrow" not in plan


def test_stream_await_done_retention(spark):
    import os
    import tempfile
    import time as _time
    import pyarrow as pa
    import pyarrow.parquet as pq
    from trajlake.streaming.operators import stream_await_running
    t0 = 1_700_000_000_000_000
    hour = 3_600_000_000
    d = tempfile.mkdtemp(prefix="trajlake-t1r-")
    batches = [
        {"job_id": ["j", "j"], "poll_ts_us": [t0, t0 + 1_000_000], "status": ["ready", "running"]},
        {"job_id": ["k"], "poll_ts_us": [t0 + 10 * hour], "status": ["prepare"]},        # pushes the watermark
        {"job_id": ["k"], "poll_ts_us": [t0 + 11 * hour], "status": ["prepare"]},        # timers fire here
        {"job_id": ["j", "j"], "poll_ts_us": [t0 + 12 * hour, t0 + 12 * hour + 1], "status": ["ready", "failed"]},
    ]
    for i, b in enumerate(batches):
        b["poll_error"] = [False] * len(b["job_id"])
        pq.write_table(pa.table(b), os.path.join(d, f"part-{i:03d}.parquet"))
        _time.sleep(0.05)
    sdf = (spark.readStream.schema("job_id string, poll_ts_us long, status string, poll_error boolean")
           .option("maxFilesPerTrigger", 1).parquet(d).withColumn("poll_ts", F.timestamp_micros("poll_ts_us")))
    q = (stream_await_running(sdf, timeout_s=60, watermark="1 second", done_retention_s=3600).writeStream
         .format("memory").queryName("t1_ret").outputMode("append").option("checkpointLocation", tempfile.mkdtemp())
         .trigger(availableNow=True).start())
    q.awaitTermination(180)
    got = sorted(tuple(r) for r in spark.table("t1_ret").filter(F.col("job_id") == "j").collect())
    # first wait decided (running); after the retention the marker is gone and a new wait runs
    assert got == [("j", t0, 0, t0 + 1_000_000), ("j", t0 + 12 * hour, 1, t0 + 12 * hour + 1)]


def test_skip_reason_order(spark):
    df = spark.createDataFrame([(None, None, None), (1, None, 0), (1, "size_none", 0), (1, "abnormal", 0),
                                (1, "normal", 2), (1, "normal", 0)],
                               "state_ts_us long, state string, pending_actions int")
    got = [r.r for r in df.select(jb.skip_reason().alias("r")).collect()]
    assert got == ["no_state", "not_normal", "size_none", "not_normal", "pending", None]


def test_letterbox_zero_size_is_degenerate(spark):
    df = spark.createDataFrame([(0, 0, "padding")], "src_w int, src_h int, resize_name string")
    r = ob.letterbox_geometry(df).collect()[0]
    assert r.degenerate


def test_cameras_long_form_and_ordered_ready_queue(spark):
    rows = spark.createDataFrame([(0, "high"), (0, "left_hand"), (0, "right_hand"), (1, "high")],
                                 "frame_idx int, slot string")
    kept = sorted(tuple(r) for r in ob.select_camera_rows(rows, ["high", "depth"]).collect())
    assert kept == [(0, "high"), (1, "high")]
    flat = spark.createDataFrame([(1, 20, 2, 0, "ready"), (1, 10, 1, 1, "ready"), (1, 10, 1, 0, "ready"),
                                  (0, 30, 3, 0, "failed")],
                                 "collection_id int, poll_ts_us long, poll_id int, pos int, status string")
    order = [(r.poll_id, r.pos) for r in jb.ready_queue(flat, ordered=True).collect()]
    assert order == [(1, 0), (1, 1), (2, 0)]


def test_null_action_in_request(spark):
    ok, short = [0.0] * 7, [0.0] * 6
    rows = [("n1", "arx5", 0, "leftjoint", [ok, None, ok], 50000),      # null first: 400, prefix runs
            ("n2", "arx5", 1, "leftjoint", [short, None], 50000)]       # mismatch first: clear, nothing runs
    spec = spec_for_join(spark)
    out = {r.request_id: r for r in act.batch_outcome(_req(spark, rows), spec).collect()}
    assert (out["n1"].result, out["n1"].http_status, out["n1"].clears_queue) == ("error", 400, False)
    assert (out["n2"].message, out["n2"].clears_queue) == (BAD_ARITY_MESSAGE, True)
    eff = {(r.request_id, r.seq): r.quarantine_reason for r in act.validate_action_arity(_req(spark, rows), spec).collect()}
    assert eff == {("n1", 0): None, ("n1", 1): "null_action", ("n1", 2): "null_action",
                   ("n2", 0): "bad_arity", ("n2", 1): "bad_arity"}
