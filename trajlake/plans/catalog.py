"""Registered queries: each binds derived inputs to one shipped operator.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole tables. Arrays are reported as lengths and rounded sums and instants as
bigint µs, so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.functions.vectors import array_len, array_round_sum
from trajlake.operators import actions as act
from trajlake.operators import align as al
from trajlake.operators import clock as ck
from trajlake.operators import jobs as jb
from trajlake.operators import motion as mo
from trajlake.operators import observations as ob
from trajlake.operators import replay as rp
from trajlake.operators import runs as rn
from trajlake.operators.lineage import write_table
from trajlake.operators.policy import ScaledStateArrowPolicy, score_policy
from trajlake.plans import derived as dv
from trajlake.schemas import robot_spec, spec_for_join
from trajlake.session import checkpoint_folder
from trajlake.sources import episodes as ep
from trajlake.sources.jobs import flatten_job_collection
from trajlake.sources.observations import deserialize_observation, serialize_observation
from trajlake.sources.runlog import parse_run_log

# Parameters of the bindings (fixed; the oracle uses the same numbers).
VELOCITY_LIMIT = 10.0
# Chunk widths of the two-level scans. A chunk should hold many rows of one key:
# the embeddings log has ~17 actions per robot-second; 1 s keeps several chunks on the small tables;
# the events log has ~66 rows per key over 30 days -> 1 day (1 h chunks would
# hold about one row each and make the chunk summaries as large as the data).
ACTION_CHUNK_US = 1_000_000
# Execution under clears reads chunks of an hour (about 60,000 actions of a robot).
EXECUTION_CHUNK_US = 3_600_000_000
EVENT_CHUNK_US = 86_400_000_000
# Lines of a worker's log in a chunk: several chunks on the small tables.
LOG_CHUNK = 1_024

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------------------
# Action path (embeddings)
# ---------------------------------------------------------------------------
def _validated(spark: SparkSession, sf: str) -> DataFrame:
    return act.validate_action_arity(dv.action_requests(spark, sf), spec_for_join(spark))


def _executable(spark: SparkSession, sf: str) -> DataFrame:
    return act.explode_action_chunk(_validated(spark, sf))


def _retimed(spark: SparkSession, sf: str) -> DataFrame:
    vel = mo.step_velocity(_executable(spark, sf), chunk_us=ACTION_CHUNK_US)
    return mo.retime_actions(vel, VELOCITY_LIMIT)


def q_action_validation(spark: SparkSession, sf: str) -> DataFrame:
    """C1 over the action requests derived from embeddings."""
    return _validated(spark, sf).select(
        "request_id", "seq", "robot", "action_type", "arm", "mode", "expected_len", "actual_len",
        "is_bad", "first_bad_pos", "quarantine_reason", "effective")


def q_batch_outcome(spark: SparkSession, sf: str) -> DataFrame:
    """A5: the server reply per request."""
    return act.batch_outcome(dv.action_requests(spark, sf), spec_for_join(spark)).select(
        "request_id", "robot", "n_actions", "first_bad_pos", "result", "message", "http_status", "clears_queue")


def q_action_chunk(spark: SparkSession, sf: str) -> DataFrame:
    """C2 with P4 (arm split) and P9 (nominal action times)."""
    return _executable(spark, sf).select(
        "request_id", "seq", "robot", "arm", "t_nominal_us",
        array_len("left").alias("left_len"), array_len("right").alias("right_len"),
        array_round_sum("left").alias("left_sum"), array_round_sum("right").alias("right_sum"))


def q_step_velocity(spark: SparkSession, sf: str) -> DataFrame:
    """W1 per (robot, arm), 1 s chunks."""
    v = mo.step_velocity(_executable(spark, sf), chunk_us=ACTION_CHUNK_US)
    return v.select("request_id", "seq", "robot", "arm", "shape_mismatch",
                    F.round("max_abs", 6).alias("max_abs"),
                    F.round("max_abs_no_gripper", 6).alias("max_abs_no_gripper"))


def q_retime_actions(spark: SparkSession, sf: str) -> DataFrame:
    """W2 with a velocity limit of 10."""
    return _retimed(spark, sf).select("request_id", "seq", "robot", "retimed", "period_us")


def _executed(spark: SparkSession, sf: str, chunk_us: int = EXECUTION_CHUNK_US) -> DataFrame:
    """Every executable command as the worker treats it: queue clears from wrong requests followed.

    Runs jobs in the shared folder: a command's last position depends on which earlier ones were removed."""
    checkpoint_folder(spark)
    requests, spec = write_table(dv.action_requests(spark, sf), "requests"), spec_for_join(spark)
    commands = act.explode_action_chunk(act.validate_action_arity(requests, spec))
    return mo.execute_with_clears(commands, act.clear_events(requests, spec), VELOCITY_LIMIT, chunk_us=chunk_us)


def _execution_summary(executed: DataFrame) -> DataFrame:
    """Per robot: commands that ran and that clears removed, and what those that ran took."""
    ran = ~F.col("dropped")

    def when_run(c: str) -> F.Column:
        return F.when(ran, F.col(c))

    return executed.groupBy("robot").agg(
        F.count_if(ran).alias("n_actions"), F.count_if("dropped").alias("n_dropped"),
        F.round(F.max(when_run("max_abs")), 6).alias("max_velocity"), F.count_if(ran & F.col("retimed")).alias("n_retimed"),
        F.round(F.sum(when_run("busy_us")) / 1e6, 6).alias("busy_s"), F.round(F.sum(when_run("gap_us")) / 1e6, 6).alias("idle_s"))


def q_execution_timeline(spark: SparkSession, sf: str) -> DataFrame:
    """W3 of the commands that ran."""
    return _executed(spark, sf).filter("not dropped").select("request_id", "seq", "robot", "ts_us", "period_us", "g_us", "e_us", "overrun")


def q_robot_execution_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: validate -> explode -> velocity -> retime -> queue under clears, per robot."""
    per = _execution_summary(_executed(spark, sf))
    bad = (_validated(spark, sf).groupBy("robot")
           .agg(F.count_if(F.col("is_bad")).alias("n_bad")))
    # From the requests: a robot all of whose requests are bad still has a row.
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_actions", "n_dropped")]
    return bad.join(per, "robot", "left").select("robot", *zero, "n_bad", "max_velocity",
                                                 F.coalesce("n_retimed", F.lit(0)).alias("n_retimed"), "busy_s", "idle_s")


def q_motion_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Clears from wrong requests cut the log; dropped commands with the times they would have had."""
    return _executed(spark, sf).select("request_id", "seq", "robot", "segment_id", "segment_start_us", "next_clear_us",
                                       "g_us", "e_us", "dropped")


def q_execution_with_clears(spark: SparkSession, sf: str) -> DataFrame:
    """W1 + W2 + W3 + W5 as the worker runs them: removed commands never become the last position."""
    ran = [F.when(~F.col("dropped"), F.col(c)).alias(c) for c in ("period_us", "g_us", "e_us")]
    return _executed(spark, sf, ACTION_CHUNK_US).select("request_id", "seq", "robot", "segment_id", "dropped", *ran)


def q_asof_position(spark: SparkSession, sf: str) -> DataFrame:
    """The command that ran last before each request's observation instant."""
    obs = dv.request_observations(dv.action_requests(spark, sf))
    out = mo.asof_position(_executed(spark, sf).filter("not dropped"), obs, chunk_us=ACTION_CHUNK_US)
    return out.select("obs_id", "robot", "arm", "t_us", "cmd_request_id", "cmd_seq",
                      array_round_sum("cmd_position").alias("cmd_position_sum"))


# ---------------------------------------------------------------------------
# Scalar action log (events): the timeline at scale
# ---------------------------------------------------------------------------
def _scalar_timeline(spark: SparkSession, sf: str) -> DataFrame:
    return mo.execution_timeline(dv.scalar_action_log(spark, sf), chunk_us=EVENT_CHUNK_US)


def q_execution_timeline_events(spark: SparkSession, sf: str) -> DataFrame:
    """W3 at scale over the scalar events log (one day chunks)."""
    return _scalar_timeline(spark, sf).select("robot", "request_id", "ts_us", "period_us", "g_us", "e_us",
                                              "overrun", "wait_us")


def q_pending_backlog(spark: SparkSession, sf: str) -> DataFrame:
    """Queue length at each observation of the events log."""
    out = mo.pending_backlog(_scalar_timeline(spark, sf), dv.backlog_observations(spark, sf),
                             chunk_us=EVENT_CHUNK_US)
    return out.select("obs_id", "robot", "t_us", "pending")


QUERIES: dict[str, Query] = {
    "robot_execution_summary": q_robot_execution_summary,
    "action_validation": q_action_validation,
    "batch_outcome": q_batch_outcome,
    "action_chunk": q_action_chunk,
    "step_velocity": q_step_velocity,
    "retime_actions": q_retime_actions,
    "execution_timeline": q_execution_timeline,
    "motion_segments": q_motion_segments,
    "execution_with_clears": q_execution_with_clears,
    "asof_position": q_asof_position,
    "execution_timeline_events": q_execution_timeline_events,
    "pending_backlog": q_pending_backlog,
}


# ---------------------------------------------------------------------------
# Job path (events)
# ---------------------------------------------------------------------------

WAIT_TIMEOUT_S = 12 * 3600          # the events span 30 days: 12 h limits
RUN_MAX_WAIT_S = 24 * 3600
IDLE_POLLS = 3


def q_flatten_job_collection(spark: SparkSession, sf: str) -> DataFrame:
    """Collection JSON bodies to one row per job."""
    flat = flatten_job_collection(dv.collection_payloads(spark, sf))
    return flat.select("collection_id", "poll_id", "pos", "job_id", "status", "robot_id")


def q_latest_job_status(spark: SparkSession, sf: str) -> DataFrame:
    """A3 over the job polls."""
    return jb.latest_job_status(dv.job_polls(spark, sf))


def q_collection_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """A4 per collection poll."""
    return jb.collection_rollup(dv.collection_polls(spark, sf)).select(
        "collection_id", "poll_id", "n_jobs", "has_active", "n_terminal", "is_idle")


def q_idle_exit(spark: SparkSession, sf: str) -> DataFrame:
    """W6 with n = 3 consecutive idle polls."""
    return jb.idle_exit(jb.collection_rollup(dv.collection_polls(spark, sf)), n=IDLE_POLLS, chunk_us=EVENT_CHUNK_US)


def q_ready_queue(spark: SparkSession, sf: str) -> DataFrame:
    """L1: ready jobs in collection order."""
    flat = flatten_job_collection(dv.collection_polls(spark, sf), payload=None)
    return jb.ready_queue(flat).select("collection_id", "poll_id", "pos", "job_id", "robot_id")


def q_await_running_outcome(spark: SparkSession, sf: str) -> DataFrame:
    """W8 with a 12 h limit, waits starting at each job's first ready poll."""
    polls = dv.job_polls(spark, sf)
    return jb.await_running_outcome(polls, dv.job_starts(polls), timeout_s=WAIT_TIMEOUT_S, chunk_us=EVENT_CHUNK_US)


def q_job_run_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A7 with a one day max wait."""
    return jb.job_run_summary(dv.job_run_log(spark, sf), dv.job_starts(dv.job_polls(spark, sf)),
                              max_wait_s=RUN_MAX_WAIT_S, chunk_us=EVENT_CHUNK_US)


def q_first_device_assignment(spark: SparkSession, sf: str) -> DataFrame:
    """A8 over the job polls."""
    return jb.first_device_assignment(dv.job_polls(spark, sf))


def q_actionable_observations(spark: SparkSession, sf: str) -> DataFrame:
    """Skip reason per received observation."""
    obs = dv.job_observations(spark, sf).withColumn("skip_reason", jb.skip_reason())
    return obs.select("obs_id", "job_id", "state", "pending_actions", "skip_reason")


QUERIES.update({
    "flatten_job_collection": q_flatten_job_collection,
    "latest_job_status": q_latest_job_status,
    "collection_rollup": q_collection_rollup,
    "idle_exit": q_idle_exit,
    "ready_queue": q_ready_queue,
    "await_running_outcome": q_await_running_outcome,
    "job_run_summary": q_job_run_summary,
    "first_device_assignment": q_first_device_assignment,
    "actionable_observations": q_actionable_observations,
})


# ---------------------------------------------------------------------------
# Observations, alignment, clock, logs, policy
# ---------------------------------------------------------------------------


def q_observation_state(spark: SparkSession, sf: str) -> DataFrame:
    """J1 + P1 + P2 + P3 + P6 over the two-arm frames."""
    fr = ob.observation_status(ob.select_state_vector(dv.frames(spark, sf)))
    return fr.select("episode", "frame_idx", "action_type", "arm", "mode", "state",
                     array_len("vector").alias("vec_len"), array_round_sum("vector").alias("vec_sum"))


def q_positional_zip(spark: SparkSession, sf: str) -> DataFrame:
    """Left and right streams zipped by frame."""
    return dv.frames(spark, sf).select("episode", "frame_idx", "left_turn", "right_turn")


def q_cyclic_align(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks up to the longer stream; the shorter wraps."""
    st = dv.with_ordinals(dv.arm_streams(spark, sf)).select("episode", "arm", "frame_idx", "turn")
    ticks = st.groupBy("episode", "arm").count().groupBy("episode").agg(F.max("count").alias("n_ticks"))
    return al.cyclic_align(st, ticks).select("episode", "tick", "arm", "frame_idx", "turn")


def q_frame_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    """Nominal and measured frame times."""
    st = dv.with_ordinals(dv.arm_streams(spark, sf)).select("episode", "arm", "frame_idx")
    return al.frame_timestamps(st, dv.episode_meta_rows(spark, sf)).select(
        "episode", "arm", "frame_idx", "nominal_us", "measured_us")


def q_episode_stats(spark: SparkSession, sf: str) -> DataFrame:
    """A6 per episode."""
    s = al.episode_stats(dv.episode_meta_rows(spark, sf))
    return s.select("task", "episode", "frames", F.round("duration_s", 6).alias("duration_s"),
                    F.round("fps", 6).alias("fps"), F.round("fps_drift", 6).alias("fps_drift"), "replay_frames")


def q_episode_task_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """A6 rollup per task."""
    r = al.episode_task_rollup(al.episode_stats(dv.episode_meta_rows(spark, sf)))
    return r.select("task", "n_episodes", "frames", *[F.round(c, 6).alias(c) for c in
                                                       ("duration_s", "avg_fps", "min_fps", "max_fps")])


def q_clock_offset(spark: SparkSession, sf: str) -> DataFrame:
    """A1 per session."""
    c = ck.clock_offset(dv.clock_samples(spark, sf))
    return c.select("session", "n_samples", F.round("offset_us", 3).alias("offset_us"), "min_rtt_us")


def _latency(spark: SparkSession, sf: str, with_offset: bool) -> DataFrame:
    offs = ck.clock_offset(dv.clock_samples(spark, sf)) if with_offset else None
    lat = ck.observation_latency(dv.job_observations(spark, sf), offs)
    return lat.select("job_id", "n_obs", F.round("avg_latency_us", 3).alias("avg_latency_us"),
                      F.round("max_latency_us", 3).alias("max_latency_us"))


def q_observation_latency(spark: SparkSession, sf: str) -> DataFrame:
    """A2, raw."""
    return _latency(spark, sf, False)


def q_observation_latency_offset(spark: SparkSession, sf: str) -> DataFrame:
    """A2 with the A1 offset applied."""
    return _latency(spark, sf, True)


def q_select_cameras(spark: SparkSession, sf: str) -> DataFrame:
    """P5: requested camera slots per frame."""
    fr = dv.frames(spark, sf)
    images = F.create_map(F.lit("left_hand"), F.encode("left_text", "UTF-8"),
                          F.lit("right_hand"), F.encode("right_text", "UTF-8"),
                          F.lit("high"), F.encode(F.concat("left_text", "right_text"), "UTF-8"))
    req = F.element_at(F.array(*[F.array(*[F.lit(s) for s in r]) for r in dv.CAMERA_REQUESTS]),
                       (F.col("episode") % 4 + 1).cast("int"))
    sel = ob.select_cameras(fr.withColumn("images", images).withColumn("image_types", req))
    return sel.select("episode", "frame_idx", F.explode("images").alias("slot", "img")).select(
        "episode", "frame_idx", "slot", F.length("img").alias("n_bytes"))


def q_letterbox_geometry(spark: SparkSession, sf: str) -> DataFrame:
    """P8 over image sizes derived from documents."""
    g = ob.letterbox_geometry(dv.image_sizes(spark, sf))
    return g.select("doc_id", "src_w", "src_h", "resize_name", "resized_w", "resized_h", "pad_x", "pad_y",
                    "identity", "degenerate")


def q_parse_run_log(spark: SparkSession, sf: str) -> DataFrame:
    """S7 over run-log lines in three layouts."""
    return parse_run_log(dv.run_log_lines(spark, sf)).select(
        "line_no", "ts_us", "level", "kind", "job_id", "status", "latency_s", "message")


def q_job_runs_from_log(spark: SparkSession, sf: str) -> DataFrame:
    """S7 -> A7: the runs that the workers' logs tell of."""
    r = rn.job_runs(parse_run_log(dv.worker_log_lines(spark, sf)), chunk_lines=LOG_CHUNK)
    return r.select("worker", "first_line", "job_id", "called_us", "start_us", "end_us", "n_states", "n_inferences",
                    F.round("latency_s", 6).alias("latency_s"), "max_latency_s", "end_reason")


def q_serialize_observation(spark: SparkSession, sf: str) -> DataFrame:
    """Observation to JSON and back."""
    js = serialize_observation(dv.policy_observations(spark, sf), cols=("state", "pending_actions", "action"))
    back = deserialize_observation(js.select("obs_id", "json"))
    return back.select("obs_id", "state", "pending_actions", array_len("action").alias("action_len"),
                       array_round_sum("action").alias("action_sum"))


def q_score_policy(spark: SparkSession, sf: str) -> DataFrame:
    """U1 with a deterministic example policy on columns."""
    sc = score_policy(dv.policy_observations(spark, sf), ScaledStateArrowPolicy, checkpoint=None)
    return sc.select("obs_id", "robot", array_len("actions").alias("n_actions"),
                     array_round_sum(F.element_at("actions", 1)).alias("a0_sum"),
                     array_round_sum(F.element_at("actions", 2)).alias("a1_sum"))


def q_policy_execution_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Evaluation-run flow: usable observations -> policy -> validate -> explode ->
    velocity -> retime -> queue, cleared at every turn, summarised per robot."""
    checkpoint_folder(spark)
    # the policy runs once: what follows reads its requests from the shared folder
    req = write_table(dv.policy_requests(score_policy(jb.actionable_observations(dv.policy_observations(spark, sf)), ScaledStateArrowPolicy, checkpoint=None)), "policy-requests")
    turns = req.select("robot", "ts_us", F.lit("start_motion").alias("kind")).distinct()   # the client clears the queue at every turn
    commands = act.explode_action_chunk(act.validate_action_arity(req, spec_for_join(spark)))
    return _execution_summary(mo.execute_with_clears(commands, turns, VELOCITY_LIMIT, chunk_us=EXECUTION_CHUNK_US))


QUERIES.update({
    "policy_execution_summary": q_policy_execution_summary,
    "observation_state": q_observation_state,
    "positional_zip": q_positional_zip,
    "cyclic_align": q_cyclic_align,
    "frame_timestamps": q_frame_timestamps,
    "episode_stats": q_episode_stats,
    "episode_task_rollup": q_episode_task_rollup,
    "clock_offset": q_clock_offset,
    "observation_latency": q_observation_latency,
    "observation_latency_offset": q_observation_latency_offset,
    "select_cameras": q_select_cameras,
    "letterbox_geometry": q_letterbox_geometry,
    "parse_run_log": q_parse_run_log,
    "job_runs_from_log": q_job_runs_from_log,
    "serialize_observation": q_serialize_observation,
    "score_policy": q_score_policy,
})


# ---------------------------------------------------------------------------
# Recorded episodes (documents)
# ---------------------------------------------------------------------------


def q_episode_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """S1 over metadata files, a few of them cut off."""
    return ep.parse_episode_meta(dv.episode_meta_files(spark, sf))


def _state_lines(spark: SparkSession, sf: str) -> DataFrame:
    return ep.split_state_lines(dv.state_files(spark, sf))


def q_read_states(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of every state file; the fields of corrupt lines are left out."""
    ok = [F.when(~F.col("corrupt"), c).alias(n) for n, c in (
        ("joint_len", array_len("joint_positions")), ("joint_sum", array_round_sum("joint_positions")),
        ("gripper", F.col("gripper")), ("gripper_width", F.col("gripper_width")),
        ("rpy_len", array_len("ee_pose_rpy")), ("effector_len", array_len("end_effector_pose")), ("positions_len", array_len("ee_positions")))]
    return _state_lines(spark, sf).select("episode_dir", "file", "frame_idx", "corrupt", *ok)


def q_normalize_states(spark: SparkSession, sf: str) -> DataFrame:
    """S3 over the lines that parse, with the spec attached."""
    lines = ep.enrich_with_spec(_state_lines(spark, sf).filter("not corrupt"), robot_spec(spark))
    return ep.normalize_states(lines).select("episode_dir", "frame_idx", "robot", "arm", array_len("joint").alias("joint_len"), "gripper",
                                             array_len("pose").alias("pose_len"), "joint_len_ok", "pose_len_ok")


def q_replay_observations(spark: SparkSession, sf: str) -> DataFrame:
    """Episode files -> observations: S2, S3, S4, S5, J2, J1, P1-P6. An arm whose line did not parse is not enabled."""
    spec = robot_spec(spark)
    # the spec is attached to files, so no line of an unknown robot is parsed; files are dealt by episode, and lines stay there
    files = ep.enrich_with_spec(dv.state_files(spark, sf, pairs=True), spec).filter("not unknown_robot")
    states = ep.normalize_states(ep.split_state_lines(files))
    # a video of n bytes has 1 + n % 97 frames
    videos = ep.join_camera_files(dv.video_files(spark, sf), dv.recorded_episodes(spark, sf), spec)
    cameras = videos.select(F.col("episode_dir").alias("episode"), "slot", "path", (1 + F.col("length") % 97).alias("n_frames"))
    obs = rp.replay_observations(states.withColumn("enabled", ~F.col("corrupt")).withColumnRenamed("episode_dir", "episode"),
                                 dv.replayed_episodes(spark, sf), cameras, together=True)
    frames = F.map_values("images")
    return obs.select("episode", "tick", "robot", "action_type", "arm", "mode", "state", array_len("vector").alias("vec_len"),
                      array_round_sum("vector").alias("vec_sum"), F.when(F.col("images").isNotNull(), F.size("images")).alias("n_images"),
                      F.aggregate(frames, F.lit(0).cast("bigint"), lambda acc, f: acc + f["frame_idx"]).alias("frames_sum"))


def q_camera_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Camera slots of every episode and the listed videos that fill them."""
    return ep.join_camera_files(dv.video_files(spark, sf), dv.recorded_episodes(spark, sf), robot_spec(spark))


def q_enrich_with_spec(spark: SparkSession, sf: str) -> DataFrame:
    """The spec of every episode's robot, unknown robots marked."""
    return ep.enrich_with_spec(dv.recorded_episodes(spark, sf), robot_spec(spark))


def q_unknown_robots(spark: SparkSession, sf: str) -> DataFrame:
    """Episodes of robots without a spec."""
    return ep.unknown_robots(dv.recorded_episodes(spark, sf), robot_spec(spark))


QUERIES.update({
    "episode_catalog": q_episode_catalog,
    "read_states": q_read_states,
    "normalize_states": q_normalize_states,
    "replay_observations": q_replay_observations,
    "camera_manifest": q_camera_manifest,
    "enrich_with_spec": q_enrich_with_spec,
    "unknown_robots": q_unknown_robots,
})
