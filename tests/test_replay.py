"""Replayed observations against a plain loop over ticks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from fixtures import make_episode_tree
from trajlake.operators import align as al, replay as rp
from trajlake.plans import catalog, derived as dv
from trajlake.schemas import robot_spec
from trajlake.sources import episodes as ep

STATES = "episode string, arm string, frame_idx long, joint array<double>, gripper double, pose array<double>, enabled boolean"
EPISODES = "episode string, robot string, action_type string, image_types array<string>"
CAMERAS = "episode string, slot string, path string, n_frames long"
TYPES = ["joint", "pos", "leftjoint", "leftpos", "rightjoint", "rightpos", None]


def _state(e, arm, i, enabled=True):
    base = float(i + (100 if arm == "right" else 0))
    return (e, arm, i, [base] * 6, base / 4, [base + 0.5] * 16, enabled)


def _expected(states, episodes, cameras, n_ticks=None):
    out = {}
    for e, robot, action_type, asked in episodes:
        arms = {a: [s for s in states if s[0] == e and s[1] == a] for a in ("left", "right")}
        for t in range(n_ticks or max(len(a) for a in arms.values())):
            if not any(arms.values()):
                continue
            row = {a: s[t % len(s)] if s else None for a, s in arms.items()}
            if action_type is None or asked is None:
                out[e, t] = ("size_none", None, None)
                continue
            need = ["left"] if "left" in action_type else ["right"] if "right" in action_type else ["left", "right"]
            k = 5 if "pos" in action_type else 3
            ok = all(row[a] is not None and row[a][6] for a in need)
            vec = sum([[*row[a][k], row[a][4]] for a in need], []) if ok else None
            images = {c[1]: (c[2], t % c[3]) for c in cameras if c[0] == e and c[3] and c[1] in asked}
            out[e, t] = ("normal" if ok else "abnormal", vec, images)
    return out


def _got(df):
    rows = df.collect()
    out = {(r.episode, r.tick): (r.state, r.vector, None if r.images is None else {k: (v.path, v.frame_idx) for k, v in r.images.items()}) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("n_ticks", [None, 23])
def test_replay_equals_loop(spark, n_ticks):
    states, episodes, cameras = [], [], []
    for n, t in enumerate(TYPES):
        for kind, (left, right) in {"uneven": (5, 3), "one": (4, 0), "other": (0, 2)}.items():
            e = f"{kind}-{n}"
            states += [_state(e, "left", i, i != 2) for i in range(left)] + [_state(e, "right", i) for i in range(right)]
            episodes.append((e, "aloha", t, ["high", "left_hand", "depth"] if n % 2 else ["right_hand"]))
            cameras += [(e, "high", f"{e}/h.mp4", 7), (e, "left_hand", None, None), (e, "right_hand", f"{e}/r.mp4", 2), (e, "depth", f"{e}/d.mp4", 9)]
    episodes += [("uneven-asked-none", "aloha", "joint", None), ("no-states", "aloha", "joint", ["high"])]
    states += [_state("uneven-asked-none", "left", 0), _state("no-episode-row", "left", 0)]
    cameras = [c for c in cameras if c[1] != "depth"] + [("one-0", "right_hand", "one-0/z.mp4", 5), ("one-1", "high", "one-1/0.mp4", 0)]
    want = _expected(states, episodes, [c for c in cameras if c[2] not in ("one-0/z.mp4", "one-1/0.mp4")], n_ticks)
    f = spark.createDataFrame
    ticks = f([(e[0], n_ticks) for e in episodes], "episode string, n_ticks long") if n_ticks else None
    got = _got(rp.replay_observations(f(states, STATES), f(episodes, EPISODES), f(cameras, CAMERAS), ticks))
    assert got == want
    assert {len(v[1]) for v in got.values() if v[1]} == {7, 14, 17, 34}


def test_zip_streams_any_number(spark):
    rows = [("e", i, s, i * 10 + n) for n, (s, ln) in enumerate({"a": 4, "b": 2, "c": 3}.items()) for i in range(ln)] + [("e", 0, "unasked", 9)]
    df = spark.createDataFrame(rows, "episode string, frame_idx long, stream string, v long")
    wide = {r.frame_idx: (r.a and r.a.v, r.b and r.b.v, r.c and r.c.v) for r in rp.zip_streams(df, ["a", "b", "c"]).collect()}
    assert wide == {0: (0, 1, 2), 1: (10, 11, 12), 2: (20, None, 22), 3: (30, None, None)}
    shortest = rp.zip_streams(df, ["a", "b", "c"], need=["a", "b", "c"])
    # one exchange, whatever the number of streams (the plan before it runs: afterwards it is shown twice)
    assert shortest._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(r.frame_idx for r in shortest.collect()) == [0, 1]
    assert rp.zip_streams(df.limit(0), ["a", "b"]).count() == 0


def test_replay_empty_tables(spark):
    f = spark.createDataFrame
    one = f([("e", "aloha", "joint", ["high"])], EPISODES)
    assert rp.replay_observations(f([], STATES), one, f([], CAMERAS)).count() == 0
    assert rp.replay_observations(f([_state("e", "left", 0)], STATES), f([], EPISODES), f([], CAMERAS)).count() == 0
    (r,) = rp.replay_observations(f([_state("e", "left", 0)], STATES), one, f([], CAMERAS)).collect()
    assert (r.state, r.images) == ("abnormal", {})


def test_long_episode_is_spread(spark):
    """300,000 ticks of one episode from arms of 3 and 2 rows: the ticks of no task are most of them."""
    states = spark.createDataFrame([_state("e", "left", i) for i in range(3)] + [_state("e", "right", i) for i in range(2)], STATES)
    episodes = spark.createDataFrame([("e", "aloha", "joint", ["high"])], EPISODES)
    cameras = spark.createDataFrame([("e", "high", "h.mp4", 11)], CAMERAS)
    n = 300_000
    obs = rp.replay_observations(states, episodes, cameras, spark.createDataFrame([("e", n)], "episode string, n_ticks long"))
    wrong = obs.filter((F.col("vector")[0] != F.col("tick") % 3) | (F.col("vector")[7] != 100 + F.col("tick") % 2) | (F.col("images")["high"]["frame_idx"] != F.col("tick") % 11))
    assert obs.agg(F.count("*"), F.count_distinct("tick")).first() == (n, n) and wrong.count() == 0


def test_recorded_tree_to_observations(spark, tmp_path):
    """Files to observations: two arms of 40 and 37 lines give 40 ticks."""
    make_episode_tree(str(tmp_path))
    lines = ep.read_states(spark, str(tmp_path)).filter(F.col("episode_dir").contains("pour_fries")).withColumn("robot", F.lit("aloha"))
    states = ep.normalize_states(ep.enrich_with_spec(lines, robot_spec(spark))).withColumn("enabled", ~F.col("corrupt"))
    states = states.withColumnRenamed("episode_dir", "episode")
    episodes = states.select("episode", "robot").distinct().select("*", F.lit("joint").alias("action_type"), F.array(F.lit("high")).alias("image_types"))
    obs = rp.replay_observations(states, episodes, spark.createDataFrame([], CAMERAS)).collect()
    assert sorted(r.tick for r in obs) == list(range(40)) and {r.state for r in obs} == {"normal"}
    by = {(r.arm, r.frame_idx): [*r.joint, r.gripper] for r in states.collect()}
    assert all(r.vector == by["left", r.tick] + by["right", r.tick % 37] for r in obs)


def test_query_covers_every_branch(spark):
    rows = catalog.q_replay_observations(spark, SF001).select("action_type", "arm", "mode", "state", "vec_len").distinct().collect()
    assert {r.action_type for r in rows} == set(dv.OBS_ACTION_TYPES)
    normal = [r for r in rows if r.state == "normal"]
    assert {(r.arm, r.mode) for r in normal} == {(a, m) for a in ("left", "right", "both") for m in ("joint", "pos")}
    assert {7, 14, 17, 34} <= {r.vec_len for r in normal}
    assert {r.state for r in rows} == {"normal", "abnormal", "size_none"}


def test_replay_sends_no_list_through_the_driver(spark):
    """Lines are parsed in one place; only the robots' spec and the cameras' slots are broadcast."""
    plan = catalog.q_replay_observations(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
    joins = [ln for ln in plan.split("\n") if "BroadcastHashJoin" in ln]
    assert joins and all("[robot#" in ln for ln in joins), joins


def test_values_that_no_observation_shows_are_not_moved(spark):
    rows = [(t, arm, on, asked) for t in TYPES for arm in ("left", "right") for on in (True, False, None) for asked in (True, False)]
    df = spark.createDataFrame([(*r, [1.0], 2.0, [3.0]) for r in rows], "action_type string, arm string, enabled boolean, __asked boolean, "
                               "joint array<double>, gripper double, pose array<double>").withColumns({"t": F.col("action_type"), "asked": F.col("__asked")})
    for r in rp._only_shown(df).collect():
        shown = bool(r.asked and r.enabled and r.t and (r.arm in r.t or not ("left" in r.t or "right" in r.t)))
        pos = shown and "pos" in r.t
        assert (r.joint, r.gripper, r.pose) == ([1.0] if shown and not pos else None, 2.0 if shown else None, [3.0] if pos else None)


def test_no_line_is_shuffled(spark):
    """Files are dealt by episode as texts; their lines are parsed, repeated and zipped in that partition."""
    plan = catalog.q_replay_observations(spark, SF001)._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(ln) - len(ln.lstrip(" :+-")) for ln in plan]
    parsed = next(i for i, ln in enumerate(plan) if "from_json(" in ln)
    above = [ln for i, ln in enumerate(plan[:parsed]) if depth[i] < min(depth[i + 1:parsed + 1])]
    assert len(above) > 10 and not [ln for ln in above if "Exchange" in ln], above


def test_episodes_in_their_partitions_give_the_same(spark):
    """With ``together`` as without, also for lengths asked for, repeated rows, and rows without episode, arm or number."""
    states = [_state(f"e{n}", arm, i, i != 2) for n in range(7) for arm, ln in (("left", 5 - n % 3), ("right", n % 4)) for i in range(ln)]
    states += [_state(None, "left", 0), _state("e1", None, 0), _state("e2", "third", 9), (*_state("e3", "left", 0)[:2], None, *_state("e3", "left", 0)[3:])]
    states += [_state("twice", "left", i) for i in (0, 0, 1, 1)] + [_state("gap", "left", i) for i in (0, 3)]
    episodes = [(f"e{n}", "aloha", t, ["high", "left_hand"] if n % 2 else ["right_hand", "depth"]) for n, t in enumerate(TYPES)]
    episodes += [("e4", "aloha", "pos", None), ("twice", "ur5", "leftpos", ["high"]), ("gap", "ur5", "joint", ["high"]), (None, "ur5", "joint", ["high"])]
    cameras = [(e[0], s, f"{s}.mp4", 2 + i) for e in episodes for i, s in enumerate(("high", "left_hand", "right_hand"))] + [("e1", "high", "0.mp4", 0)]
    f = spark.createDataFrame
    for ticks in (None, [(e[0], 9) for e in episodes[:5]] + [("e5", 0), ("e6", None), ("twice", 3), (None, 4)]):
        asked = f(ticks, "episode string, n_ticks long") if ticks else None
        args = f(episodes, EPISODES), f(cameras, CAMERAS), asked
        rows = f(states, STATES)
        apart, together = rp.replay_observations(rows, *args), rp.replay_observations(rows.repartition(5, "episode"), *args, together=True)
        assert together.schema.simpleString() == apart.schema.simpleString()
        got = sorted(map(str, together.collect()))
        assert got == sorted(map(str, apart.collect())) and len(got) > 20


def test_state_lines_that_are_looked_up(spark, tmp_path):
    """Words of any length give the lines of ``state_line``, whether looked up or worked out."""
    lengths = [*range(dv.SPELLED + 20), 200, 1_001]
    text = " ".join("é" * n for n in lengths)
    docs = [(i, text if i else None) for i in range(-1, 11)] + [(None, text), (20, ""), (21, "é")]
    spark.createDataFrame([(d, t) for d, t in docs if d is None or d >= 0], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    n = 0
    for pairs in (False, True):
        for r in dv.state_files(spark, str(tmp_path), pairs=pairs).filter("path is not null and body is not null").collect():
            i = dv.ROBOTS_RECORDED.index(r.robot)
            lines = r.body.split("\n")[:len(lengths)]
            if len(lines) == len(lengths):
                n += 1
                assert lines == [dv.state_line(k, dv.GRIPPER_KEYS[i], dv.POSE_KEYS[i]) for k in lengths]
    assert n == 20


def test_rows_that_are_replayed_many_times(spark):
    """A row of a short stream gives its ticks in blocks: the ends of blocks neither lose nor repeat a tick."""
    rows = spark.createDataFrame([("e", arm, i, 10 * i) for arm, n in (("left", 2), ("right", 3)) for i in range(n)], "episode string, arm string, frame_idx int, v int")
    for n in (2, 3, 2 * al.TICK_BLOCK, 2 * al.TICK_BLOCK + 1, 200_001):
        got = al.cyclic_align(rows, spark.createDataFrame([("e", n)], "episode string, n_ticks int"), together=True)
        per = {r.arm: (r.n, r.d, r.t) for r in got.groupBy("arm").agg(F.count("*").alias("n"), F.count_distinct("tick").alias("d"), F.max("tick").alias("t")).collect()}
        assert per == {"left": (n, n, n - 1), "right": (n, n, n - 1)}
        assert got.filter(F.col("v") != 10 * (F.col("tick") % F.when(F.col("arm") == "left", 2).otherwise(3))).count() == 0
