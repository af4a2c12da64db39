"""Cases that the tables hardly reach: null counts, missing keys, ties, encoded paths."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from trajlake.operators import jobs as jb
from trajlake.operators import motion as mo
from trajlake.plans import derived as dv
from trajlake.schemas import spec_for_join
from trajlake.sources import episodes, runlog

SF001 = "/root/testdata/sf0.001"
LOG = "job_id string, poll_id long, poll_ts_us long, status string, poll_error boolean, has_device boolean, state string, state_ts_us long, pending_actions int"


def test_null_pending_count_is_not_usable(spark):
    df = spark.createDataFrame([("normal", None, 5), ("normal", 0, 5), ("normal", 2, 5)], "state string, pending_actions int, state_ts_us long")
    assert [r[0] for r in df.select(jb.skip_reason()).collect()] == ["pending", None, "pending"]


def test_missing_device_key_ends_the_run(spark):
    rows = [("a", 1, 10, "running", False, True, "normal", 10, 0), ("a", 2, 20, "finished", False, False, "normal", 20, 0),
            ("b", 3, 20, "finished", False, True, "normal", 20, 0)]
    starts = spark.createDataFrame([("a", 0, True), ("b", 0, True)], "job_id string, start_us long, start_ok boolean")
    got = {r["job_id"]: (r["end_reason"], r["n_inferences"]) for r in jb.job_run_summary(spark.createDataFrame(rows, LOG), starts).collect()}
    assert got == {"a": ("exception", 1), "b": ("not_running", 0)}


def test_polls_of_one_instant_follow_their_ids(spark):
    rows = [("a", 2, 10, "running", False, True, "normal", 10, 0), ("a", 1, 10, "failed", False, True, "normal", 10, 0)]
    for part in (1, 2):
        df = spark.createDataFrame(rows if part == 1 else rows[::-1], LOG).coalesce(1)
        starts = spark.createDataFrame([("a", 0, True)], "job_id string, start_us long, start_ok boolean")
        polls = df.withColumn("device", F.struct(F.concat(F.lit("r"), F.col("poll_id").cast("string")).alias("robot_id")))
        assert jb.await_running_outcome(polls, starts).first()["code"] == 1
        assert jb.latest_job_status(polls).first()["status"] == "running"
        assert jb.first_device_assignment(polls).first()["robot_id"] == "r1"
        assert tuple(jb.job_run_summary(df, starts).select("n_iterations", "end_reason").first()) == (1, "not_running")


def test_commands_of_one_instant_follow_the_queue(spark):
    cmd = spark.createDataFrame([("r", "left", 100, "q-9", 0, 10, [1.0]), ("r", "left", 100, "q-10", 0, 20, [2.0])],
                                "robot string, arm string, g_us long, request_id string, seq int, ts_us long, position array<double>")
    obs = spark.createDataFrame([("r", "left", 150)], "robot string, arm string, t_us long")
    for width in (None, 40):
        assert mo.asof_position(cmd, obs, chunk_us=width).first()["cmd_request_id"] == "q-10"


def test_started_line_without_a_tail(spark):
    df = spark.createDataFrame([("[2025-01-01 00:00:00,000] INFO: Started robot",), ("[2025-01-01 00:00:00,000] INFO: Started robot: x",)], "value string")
    assert [r["kind"] for r in runlog.parse_run_log(df).collect()] == ["started", "started"]


def test_task_folder_with_space_and_plus(spark, tmp_path):
    base = tmp_path / "2025" / "task a+b" / "data" / "episode_1"
    for d in ("meta", "states", "videos"):
        (base / d).mkdir(parents=True)
    (base / "meta" / "episode_meta.json").write_text(json.dumps({"episode_index": 1, "frames": 1, "start_time": 0.0, "end_time": 1.0}))
    (base / "states" / "states.jsonl").write_text('{"timestamp": 1}\n\n')
    for name in ("cam_high", "cam_wrist", "cam_left", "cam_right", "cam_left_wrist", "cam_right_wrist"):
        (base / "videos" / f"{name}.mp4").write_bytes(b"x")
    cat = episodes.episode_catalog(spark, str(tmp_path))
    assert cat.first()["task"] == "task a+b"
    from trajlake.schemas import robot_spec

    found = episodes.camera_manifest(spark, str(tmp_path), cat.select("episode_dir", F.lit("aloha").alias("robot")), robot_spec(spark)).collect()
    files = {p.name for p in (base / "videos").iterdir()}
    assert found and all((r["path"] is not None) == (r["file"] in files) for r in found)
    dirs = {r["episode_dir"] for r in episodes.read_states(spark, str(tmp_path)).collect()}
    assert dirs == {cat.first()["episode_dir"]}


def test_requests_use_every_value_of_an_embedding(spark):
    req = dv.action_requests(spark, SF001)
    total = req.select(F.explode("actions").alias("a")).agg(F.sum(F.aggregate("a", F.lit(0.0), lambda x, y: x + y))).first()[0]
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet").select(F.explode("embedding").alias("x")).agg(F.sum(F.col("x").cast("double"))).first()[0]
    assert abs(total - emb) < 1e-6
    assert spec_for_join(spark).count() == 4
