"""S1-S8 on generated episode trees and derived logs."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from fixtures import GOLDEN_META, ROBOT_OF_TASK, make_episode_tree
from trajlake.schemas import robot_spec
from trajlake.sources import episodes as ep


@pytest.fixture(scope="module")
def tree():
    root = tempfile.mkdtemp(prefix="trajlake-tree-")
    make_episode_tree(root)
    return root


def _robots(spark):
    return spark.createDataFrame(list(ROBOT_OF_TASK.items()), "task string, robot string")


def test_episode_catalog_golden(spark, tree):
    rows = {r.task: r for r in ep.episode_catalog(spark, tree).collect()}
    assert len(rows) == 4
    for date, task, pid, _key, idx, st, et, frames in GOLDEN_META:
        r = rows[task]
        assert (r.date, r.episode_id, r.episode_index, r.frames) == (date, pid, idx, frames)
        assert r.start_time == st and r.end_time == et
    # the path id is not the index
    assert rows["press_three_buttons"].episode_id == "FFFFFF" and rows["press_three_buttons"].episode_index == 80


def test_episode_stats_golden_fps(spark, tree):
    from trajlake.operators.align import episode_stats
    s = {r.task: r for r in episode_stats(ep.episode_catalog(spark, tree)).collect()}
    assert round(s["shred_scrap_paper"].fps, 3) == 29.614
    assert round(s["pour_fries_into_plate"].fps, 3) == 30.303
    assert round(s["press_three_buttons"].fps, 3) == 30.006
    assert round(s["arrange_paper_cups"].fps, 3) == 29.786
    assert s["arrange_paper_cups"].replay_frames == 1781


def test_read_states_ordinals_and_cases(spark, tree):
    st = ep.read_states(spark, tree).cache()
    # exact ordinals over >1,000 lines: element 0 of joint_positions is the line number
    big = st.filter(F.col("episode_dir").contains("arrange_paper_cups"))
    assert big.count() == 1100
    assert big.filter(F.col("joint_positions")[0] != F.col("frame_idx").cast("double")).count() == 0
    # unequal left/right lengths, trailing newline is not a frame
    aloha = st.filter(F.col("episode_dir").contains("pour_fries"))
    counts = {r.file: r["count"] for r in aloha.groupBy("file").count().collect()}
    assert counts == {"left_states.jsonl": 40, "right_states.jsonl": 37}
    # corrupt line kept and flagged
    bad = st.filter(F.col("corrupt")).collect()
    assert [(b.frame_idx, "shred_scrap_paper" in b.episode_dir) for b in bad] == [(5, True)]


def test_normalize_and_enrich(spark, tree):
    cat = ep.episode_catalog(spark, tree).join(_robots(spark), "task").select("episode_dir", "robot")
    st = ep.read_states(spark, tree).join(cat, "episode_dir")
    norm = ep.normalize_states(ep.enrich_with_spec(st, robot_spec(spark))).filter(~F.col("corrupt"))
    by = {(r.robot, r.arm): r for r in norm.filter(F.col("frame_idx") == 0).collect()}
    assert set(by) == {("aloha", "left"), ("aloha", "right"), ("arx5", "left"), ("ur5", "left"), ("franka", "left")}
    assert by[("aloha", "left")].gripper == 0.5 and len(by[("aloha", "left")].pose) == 16
    assert by[("arx5", "left")].gripper == 0.04 and len(by[("arx5", "left")].pose) == 6
    assert by[("franka", "left")].gripper == 0.02 and len(by[("franka", "left")].joint) == 7
    wrong = norm.filter(~F.col("pose_len_ok")).select("robot", "frame_idx").collect()
    assert [(w.robot, w.frame_idx) for w in wrong] == [("franka", 3)]


def test_unknown_robot_quarantined(spark):
    df = spark.createDataFrame([("aloha", 1), ("spot", 2)], "robot string, x int")
    enriched = ep.enrich_with_spec(df, robot_spec(spark))
    assert {r.robot: r.unknown_robot for r in enriched.collect()} == {"aloha": False, "spot": True}
    assert [r.robot for r in ep.unknown_robots(df, robot_spec(spark)).collect()] == ["spot"]


def test_camera_manifest_missing_slot(spark, tree):
    cat = ep.episode_catalog(spark, tree).join(_robots(spark), "task").select("episode_dir", "robot", "task")
    man = ep.camera_manifest(spark, tree, cat, robot_spec(spark))
    rows = man.collect()
    # aloha 3 + arx5 3 + ur5 2 (no high slot) + franka 3
    assert len(rows) == 11
    missing = [(r.robot, r.slot) for r in rows if r.path is None]
    assert missing == [("franka", "high")]
    plan = man._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.split("\n") if "FileScan binaryFile" in ln]
    # the video bytes are never read: the scan outputs metadata columns only
    assert scans and all("content" not in ln.split("]")[0] for ln in scans)


def test_flatten_job_collection_json(spark):
    from trajlake.sources.jobs import flatten_job_collection
    df = spark.createDataFrame([
        (1, '{"jobs": [{"job_id": "a", "status": "ready", "device": {"robot_id": "r1"}},'
            ' {"job_id": "b", "status": "failed", "device": {"robot_id": "r2"}}]}'),
        (2, '{"jobs": []}')], "poll_id long, payload string")
    out = sorted((r.poll_id, r.pos, r.job_id, r.status, r.robot_id) for r in flatten_job_collection(df).collect())
    assert out == [(1, 0, "a", "ready", "r1"), (1, 1, "b", "failed", "r2")]


def test_parse_run_log_layouts(spark):
    from trajlake.sources.runlog import parse_run_log
    lines = [
        "2025-09-19 10:00:00,123 INFO:Processing job_id: j1, status: ready",
        "[2025-09-19 10:00:01,000] WARNING: Job j1 exceeded max wait time.",
        "2025-09-19 10:00:02,500 INFO get_robot_state time: 0.12",
        "garbage line",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    out = parse_run_log(df).collect()
    assert [r.kind for r in out] == ["processing_job", "max_wait", "state_latency", "other"]
    assert out[0].job_id == "j1" and out[0].status == "ready" and out[0].level == "INFO"
    assert out[1].level == "WARNING" and out[1].job_id == "j1"
    assert out[2].latency_s == 0.12
    assert out[0].ts_us % 1_000_000 == 123_000


def test_serialize_roundtrip(spark):
    from trajlake.sources.observations import deserialize_observation, serialize_observation
    df = spark.createDataFrame([("normal", 5, 0, [0.1, 0.2])],
                               "state string, timestamp_us long, pending_actions int, action array<double>")
    js = serialize_observation(df)
    r = deserialize_observation(js.select("json")).collect()[0]
    assert (r.state, r.timestamp_us, r.pending_actions, r.action) == ("normal", 5, 0, [0.1, 0.2])


def test_read_states_with_index_field(spark, tmp_path):
    import json
    ep_dir = tmp_path / "20250101" / "task" / "data" / "episode_000001" / "states"
    ep_dir.mkdir(parents=True)
    lines = [json.dumps({"frame": i, "joint_positions": [float(i)] * 6, "gripper": 0.1}) for i in range(50)]
    (ep_dir / "states.jsonl").write_text("\n".join(lines) + "\n{broken\n")
    st = ep.read_states(spark, str(tmp_path), index_field="frame")
    rows = st.collect()
    good = [r for r in rows if not r.corrupt]
    assert len(good) == 50 and all(r.joint_positions[0] == float(r.frame_idx) for r in good)
    assert sum(1 for r in rows if r.corrupt) == 1


@pytest.mark.parametrize("split", [64, 700, 20_000])
def test_line_numbers_of_files_read_in_many_splits(spark, tmp_path, split):
    """Exact numbers whatever the splits: blank lines, long lines, no final newline, carriage returns, an empty file."""
    texts = {"a.txt": "".join(f"line {i} {'x' * (i * 37 % 300)}\n" for i in range(900)), "b.txt": "\n\none\n\n\ntwo\r\nthree",
             "c +%20.txt": "y" * 3000 + "\nz\n", "d.txt": "", "e.txt": "\n"}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    conf = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "16"}
    prev = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        numbered = ep.number_lines(spark, str(tmp_path))
        got = sorted((r.path.rsplit("/", 1)[1], r.frame_idx, r.value) for r in numbered.collect())
        parts = numbered.select(F.spark_partition_id()).distinct().count()
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)
    want = sorted((name, i, line) for name, text in texts.items() for i, line in enumerate(text.removesuffix("\n").split("\n") if text else []))
    assert got == want and parts >= (8 if split < 1000 else 1)


def test_path_parts_are_worked_out_once_a_file(spark):
    from trajlake.plans import derived as dv
    plan = ep.split_state_lines(dv.state_files(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate posexplode", 1)
    assert "regexp_extract" not in above and "regexp_extract" in below


def test_state_lines_are_parsed_once(spark):
    """A filter on the parsed fields repeats no parsing; who only counts lines parses none; no pattern goes over a whole text."""
    from trajlake.plans import catalog, derived as dv

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()
    sf = "/root/testdata/sf0.001"
    lines = ep.split_state_lines(dv.state_files(spark, sf))
    assert plan(catalog.q_normalize_states(spark, sf)).count("from_json(") == plan(catalog.q_read_states(spark, sf)).count("from_json(") == 1
    assert "from_json(" not in plan(lines.groupBy("episode_dir", "file").count()) and "regexp_replace(body" not in plan(lines)


def test_split_state_lines_of_odd_texts(spark):
    ok = '{"gripper": 1.5}'
    texts = {"a": f"{ok}\n\n{ok}\n\n", "b": "", "c": "\n", "d": None, "e": f"é€{ok}\r\n{ok}", "f": f'{ok}\n{{"gripper": [\nnull\n{ok}é\n'}
    df = spark.createDataFrame([(f"/rec/1/t/data/episode_{k}/states/states.jsonl", v) for k, v in texts.items()], "path string, body string")
    got = {}
    for r in ep.split_state_lines(df).collect():
        got.setdefault(r.episode_dir[-1], {})[r.frame_idx] = (r.corrupt, r.gripper)
    good, bad = (False, 1.5), (True, None)
    assert got == {"a": {0: good, 1: bad, 2: good, 3: bad}, "c": {0: bad}, "e": {0: bad, 1: good},
                   "f": {0: good, 1: bad, 2: bad, 3: good}}


def test_reading_states_shuffles_no_lines(spark, tree):
    """The lines are joined with the numbers of their splits where they were read."""
    plan = ep.read_states(spark, tree)._jdf.queryExecution().executedPlan().toString()
    assert not [ln for ln in plan.split("\n") if "Exchange" in ln and "value#" in ln], plan
