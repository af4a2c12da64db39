"""Inputs for the registered queries, derived from the driver's tables.

The test tables are generic (TPC-H-like plus ``events``, ``embeddings``,
``conversations``, ``documents``); each function below maps one of them onto
a robot-log shape by a fixed rule. ``plans.oracle`` writes the same rules in
DuckDB SQL. Only the columns a rule needs are read (column pruning reaches
the parquet scan).
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.functions.timecols import micros
from trajlake.sources.episodes import episode_of

# Fixed rule values shared with plans/oracle.py.
ROBOTS_BY_LABEL = ["aloha", "arx5", "ur5", "franka"]          # label % 4
TYPE_BY_LABEL = ["joint", "leftjoint", "leftpos", "leftjoint"]
LEN_BY_LABEL = [14, 7, 7, 8]
STATUS_BY_EVENT = {"signup": "assigned", "view": "prepare", "click": "ready",
                   "purchase": "running", "error": "failed"}
STATUS_CYCLE = ["assigned", "prepare", "ready", "running", "finished", "cancelled", "failed"]
EVENT_TYPE_INDEX = {"signup": 0, "view": 1, "click": 2, "purchase": 3, "error": 4}
CAMERA_REQUESTS = [["left_hand", "right_hand", "high"], ["high"], ["left_hand", "right_hand"], ["high", "depth"]]
OBS_ACTION_TYPES = ["joint", "pos", "leftjoint", "leftpos", "rightjoint", "rightpos", None]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (callers select only the columns they use)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _k(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k").cast("int")


def _status_of(event_type: Column) -> Column:
    expr = None
    for et, st in STATUS_BY_EVENT.items():
        expr = (F.when(event_type == et, F.lit(st)) if expr is None else expr.when(event_type == et, F.lit(st)))
    return expr


def _fold(n: Column) -> Column:
    """A vector of ``n`` values from all values of an embedding: value i is the sum of embedding values i, i + n, ..."""
    e = F.col("embedding").cast("array<double>")
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.aggregate(
        F.sequence(i, F.size("embedding"), n), F.lit(0.0), lambda acc, j: acc + F.element_at(e, j)))


# ---------------------------------------------------------------------------
# Action requests (from embeddings)
# ---------------------------------------------------------------------------
def action_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per posted request: 3 consecutive vectors of one robot form a request.

    The embedding is folded to the robot's vector length, so every value counts.
    robot = label % 4; request number = vec_id div 3; a vector is one element
    short when vec_id % 17 = 0; action type missing when req_no % 37 = 5;
    duration 0 when req_no % 53 = 11; arrival = req_no * 45 ms.
    """
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    li = F.col("label") % 4
    req_no = F.expr("vec_id div 3")
    n = _pick(LEN_BY_LABEL, li) - F.when(F.col("vec_id") % 17 == 0, 1).otherwise(0)
    rows = emb.select(
        _pick(ROBOTS_BY_LABEL, li).alias("robot"),
        req_no.alias("req_no"),
        F.when(req_no % 37 == 5, F.lit(None).cast("string")).otherwise(_pick(TYPE_BY_LABEL, li)).alias("action_type"),
        F.col("vec_id"),
        _fold(n.cast("int")).alias("vec"))
    # A request holds at most 3 vectors (fixed by the rule): bounded collect.
    req = rows.groupBy("robot", "req_no", "action_type").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "vec"))), lambda x: x["vec"]).alias("actions"))
    return req.select(
        F.concat_ws("-", "robot", F.col("req_no").cast("string")).alias("request_id"),
        "robot",
        (F.col("req_no") * 45000).cast("bigint").alias("ts_us"),
        "action_type", "actions",
        F.when(F.col("req_no") % 53 == 11, F.lit(0)).otherwise(20000 + 10000 * (F.col("req_no") % 4))
         .cast("bigint").alias("duration_us"))


def request_observations(requests: DataFrame) -> DataFrame:
    """Observation instants for J3: each request's arrival + 10 ms, on the request's arm."""
    from trajlake.functions.vectors import parse_action_type
    return (requests.filter(F.col("action_type").isNotNull())
            .select(F.col("request_id").alias("obs_id"), "robot",
                    parse_action_type("action_type")["arm"].alias("arm"),
                    (F.col("ts_us") + 10000).alias("t_us")))


# ---------------------------------------------------------------------------
# Scalar action log and observations (from events)
# ---------------------------------------------------------------------------
def scalar_action_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """robot = user_id; arrival = ts; period = round(value*100) * 4 s (= 400 x value seconds)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    return ev.select(
        F.col("user_id").cast("string").alias("robot"),
        F.col("event_id").cast("string").alias("request_id"),
        F.lit(0).alias("seq"),
        micros("ts").alias("ts_us"),
        (F.round(F.col("value") * 100).cast("bigint") * 4000000).alias("period_us"))


def backlog_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One state read per event, 0.5 s after it, by the same robot."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return ev.select(F.col("event_id").alias("obs_id"), F.col("user_id").cast("string").alias("robot"),
                     (micros("ts") + 500000).alias("t_us"))


def clock_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """session = user_id; t1 = ts; t3 = t1 + k ms; t2 = t1 + k*0.5 ms + round(value*100) µs."""
    ev = table(spark, sf_dir, "events").select("ts", "user_id", "value", "props")
    t1 = micros("ts")
    return ev.select(F.col("user_id").cast("string").alias("session"), t1.alias("t1"),
                     (t1 + _k() * 500 + F.round(F.col("value") * 100).cast("bigint")).alias("t2"),
                     (t1 + _k() * 1000).alias("t3"))


def job_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations a job worker received: job = user_id, state by k % 10.

    k%10 = 0: no observation; 1: size_none; 2: abnormal; 3: pending 1 + k % 4;
    k%20 = 14: normal without a count of pending actions;
    else normal. Received k ms + 2 ms after the state timestamp.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "props")
    return ev.select(F.col("event_id").alias("obs_id"), F.col("user_id").cast("string").alias("job_id"), *_observation_columns())


def _observation_columns() -> list[Column]:
    k, ts = _k(), micros("ts")
    state = (F.when(k % 10 == 0, F.lit(None).cast("string")).when(k % 10 == 1, F.lit("size_none"))
             .when(k % 10 == 2, F.lit("abnormal")).otherwise(F.lit("normal")))
    return [F.when(k % 10 != 0, ts).alias("state_ts_us"), (ts + k * 1000 + 2000).alias("recv_us"), state.alias("state"),
            F.when((k % 10 == 0) | (k % 20 == 14), F.lit(None)).when(k % 10 == 3, 1 + k % 4).otherwise(F.lit(0))
             .cast("int").alias("pending_actions")]


def job_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job status polls: job = user_id, status by event type, device from the 2nd state on.

    Records without a status when k % 50 = 7; a failed poll when k >= 97.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    return ev.select(*_poll_columns())


def _poll_columns() -> list[Column]:
    k = _k()
    status = F.when(k % 50 == 7, F.lit(None).cast("string")).otherwise(_status_of(F.col("event_type")))
    device = F.struct(F.concat(F.lit("robot-"), (F.col("user_id") % 8).cast("string")).alias("robot_id"))
    return [F.col("event_id").alias("poll_id"), F.col("user_id").cast("string").alias("job_id"), micros("ts").alias("poll_ts_us"),
            status.alias("status"), F.when(F.col("event_type") != "signup", device).alias("device"),
            (k >= 97).alias("poll_error"), (k % 13 != 0).alias("start_ok")]


def job_starts(polls: DataFrame) -> DataFrame:
    """Start of each job's wait: its first ``ready`` poll."""
    return (polls.filter(F.col("status") == "ready").groupBy("job_id")
            .agg(F.min("poll_ts_us").alias("start_us"),
                 F.min_by("start_ok", F.struct("poll_ts_us", "poll_id")).alias("start_ok")))


def collection_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls of job collections: collection = user_id % 10, one poll per event.

    The poll lists 1 + k % 3 jobs (none when k < 5); job i has id user_id + 10 i,
    status cycling with the event type and k, and the first is an unknown
    status ``paused`` when k >= 95.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    tidx = None
    for et, i in EVENT_TYPE_INDEX.items():
        tidx = F.when(F.col("event_type") == et, F.lit(i)) if tidx is None else tidx.when(F.col("event_type") == et, F.lit(i))
    # Scalars first, so the job slots below read plain columns (the JSON is parsed once per row).
    base = ev.select("event_id", "ts", "user_id", _k().alias("k"), tidx.alias("tidx"))
    k = F.col("k")
    n = F.when(k < 5, 0).otherwise(1 + k % 3)
    cyc = F.array(*[F.lit(s) for s in STATUS_CYCLE])

    def job(i: Column) -> Column:
        st = F.when((i == 0) & (k >= 95), F.lit("paused")).otherwise(
            F.element_at(cyc, ((F.col("tidx") + i * k) % 7 + 1).cast("int")))
        return F.struct((F.col("user_id") + 10 * i).cast("string").alias("job_id"), st.alias("status"),
                        F.struct(F.concat(F.lit("robot-"), ((F.col("user_id") + i) % 8).cast("string")).alias("robot_id"))
                         .alias("device"))

    # At most 3 jobs per poll: build the fixed slots and cut to n (no lambda, stays in codegen).
    jobs = F.slice(F.array(*[job(F.lit(i)) for i in range(3)]), F.lit(1), n)
    return base.select((F.col("user_id") % 10).alias("collection_id"), F.col("event_id").alias("poll_id"),
                       micros("ts").alias("poll_ts_us"), jobs.alias("jobs"))


def collection_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same polls as raw JSON bodies (``{"jobs": [...]}``), as the client receives them."""
    cp = collection_polls(spark, sf_dir)
    return cp.select("collection_id", "poll_id", "poll_ts_us", F.to_json(F.struct("jobs")).alias("payload"))


def job_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Worker loop iterations per job: every poll of the job with its observation (``job_polls`` and ``job_observations``
    of one event, read in one scan); the device key lacks when poll_id % 23 = 7."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    return ev.select(*_poll_columns(), *_observation_columns()).withColumn("has_device", F.pmod("poll_id", F.lit(23)) != 7)


# ---------------------------------------------------------------------------
# Arm streams and frames (from conversations)
# ---------------------------------------------------------------------------
def arm_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """episode = conv_id; assistant turns are the right-arm stream, all others (user, system) the left.

    Joint vector (6) and pose (16) are functions of the text length; gripper = turn / 10.
    """
    cv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ln = F.length("text")
    joint = F.array(*[((ln * i) % 1000) / 100.0 for i in range(1, 7)])
    pose = F.array(*[((ln + i * 7) % 100) / 10.0 for i in range(1, 17)])
    return cv.select(
        F.col("conv_id").alias("episode"),
        F.when(F.col("role") == "assistant", F.lit("right")).otherwise(F.lit("left")).alias("arm"),
        "turn", "text",
        joint.alias("joint"), (F.col("turn") / 10.0).alias("gripper"), pose.alias("pose"))


# ---------------------------------------------------------------------------
# Recorded episodes (from documents)
# ---------------------------------------------------------------------------
# doc_id % 5; the last has no spec row.
ROBOTS_RECORDED = ["aloha", "arx5", "ur5", "franka", "gen9"]
GRIPPER_KEYS = ["gripper", "gripper_width", "gripper", "gripper_width", "gripper"]
POSE_KEYS = ["ee_pose_rpy", "end_effector_pose", "ee_positions", "ee_positions", "ee_positions"]
# State lines of words up to this length are looked up.
SPELLED = 63
VIDEO_FILES = [["cam_wrist_left_rgb.mp4", "cam_wrist_right_rgb.mp4", "cam_high_rgb.mp4"],
               ["arm_realsense_rgb.mp4", "global_realsense_rgb.mp4", "right_realsense_rgb.mp4"],
               ["handeye_realsense_rgb.mp4", "global_realsense_rgb.mp4", "depth.mp4"],
               ["handeye_realsense_rgb.mp4", "main_realsense_rgb.mp4", "side_realsense_rgb.mp4"],
               ["cam_high_rgb.mp4", "depth.mp4", "side_realsense_rgb.mp4"]]


def _episode_dir(number: Column | None = None) -> Column:
    """/rec/2025-0<1 + number % 9>/task <number % 7>+a%20/data/episode_E<number>; the number is doc_id if none is given."""
    d = F.col("doc_id") if number is None else number
    return F.concat(F.lit("/rec/2025-0"), (1 + d % 9).cast("string"), F.lit("/task "),
                    (d % 7).cast("string"), F.lit("+a%20/data/episode_E"), d.cast("string"))


def recorded_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(episode_dir, robot) of one episode per document."""
    return table(spark, sf_dir, "documents").select(_episode_dir().alias("episode_dir"),
                                                    _pick(ROBOTS_RECORDED, F.col("doc_id") % 5).alias("robot"))


def episode_meta_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata files (path, body): frames = n_chars; both spellings of the index key; doc_id % 11 = 4 is cut off."""
    n, d = F.col("n_chars"), F.col("doc_id")
    key = F.when(d % 2 == 0, F.lit("episode_index")).otherwise(F.lit("episode_idx"))
    whole = F.concat(F.lit('{"'), key, F.lit('": '), (d * 3).cast("string"), F.lit(', "start_time": '), d.cast("string"),
                     F.lit('.25,\n "end_time": '), (d + n).cast("string"), F.lit('.5, "frames": '), n.cast("string"), F.lit("}"))
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("file:"), _episode_dir(), F.lit("/meta/episode_meta.json")).alias("path"),
        F.when(d % 11 == 4, F.lit('{"frames": ')).otherwise(whole).alias("body"))


def state_line(n: int, grip: str, pose: str) -> str:
    """A line of ``state_files`` for a word of ``n`` characters."""
    if n == 0 or n % 13 == 12:
        return f'{{"joint_positions": [{n}' if n else ""

    def values(count: int) -> str:
        return f"[{','.join([str(n)] * count)}]"

    return (f'{{"joint_positions": {values(6 + n % 2)}, "{"grip" if n % 7 == 3 else grip}": {n}, '
            f'"{pose}": {values(16 if n % 3 == 0 else 6 + n % 2)}}}')


def state_files(spark: SparkSession, sf_dir: str, pairs: bool = False) -> DataFrame:
    """State logs (path, body, robot): the words of a text, split at blanks, are the lines.

    A word of n characters gives a line with 6 + n % 2 joints of value n, the
    gripper n (under the wrong key when n % 7 = 3) and a pose of 6 + n % 2
    values (16 when n % 3 = 0); n = 0 a blank line; n % 13 = 12 a cut-off one.
    A two-arm robot's file is the left arm's for even doc_id, else the right's.
    Texts of even doc_id end in a newline. With ``pairs`` both files of a two-arm
    robot are of one episode: the left arm's doc_id is a multiple of 10, the right
    arm's is five more. All files of an episode are then in one partition.
    """
    r, d = F.col("doc_id") % 5, F.col("doc_id")
    grip, pose = _pick(GRIPPER_KEYS, r), _pick(POSE_KEYS, r)

    def line(n: Column) -> Column:
        text = n.cast("string")

        def values(count: Column) -> Column:
            return F.concat(F.lit("["), F.repeat(F.concat(text, F.lit(",")), count - 1), text, F.lit("]"))

        whole = F.concat(F.lit('{"joint_positions": '), values(6 + n % 2), F.lit(', "'),
                         F.when(n % 7 == 3, F.lit("grip")).otherwise(grip), F.lit('": '), text, F.lit(', "'), pose, F.lit('": '),
                         values(F.when(n % 3 == 0, 16).otherwise(6 + n % 2)), F.lit("}"))
        return F.when(n == 0, F.lit("")).when(n % 13 == 12, F.concat(F.lit('{"joint_positions": ['), text)).otherwise(whole)

    def lines(robot: int | None = None) -> Column:
        words = F.split("text", " ")
        if robot is None:
            return F.transform(words, lambda w: line(F.length(w)))
        # the lines of words of up to SPELLED characters are written out; a longer word's is worked out
        spelled = F.split(F.lit("\n".join(state_line(n, GRIPPER_KEYS[robot], POSE_KEYS[robot]) for n in range(SPELLED + 1))), "\n")
        return F.transform(words, lambda w: F.coalesce(F.get(spelled, F.length(w)), line(F.length(w))))

    name = F.when(r != 0, F.lit("states.jsonl")).when(d % 2 == 0, F.lit("left_states.jsonl")).otherwise(F.lit("right_states.jsonl"))
    written = functools.reduce(lambda expr, i: expr.when(r == i, lines(i)), range(1, len(ROBOTS_RECORDED)), F.when(r == 0, lines(0))).otherwise(lines())
    body = F.concat(F.array_join(written, "\n"), F.when(d % 2 == 0, F.lit("\n")).otherwise(F.lit("")))
    # a file of the table may be one row group, which is one task: the texts are dealt before the lines are made, into a set
    # number of parts, since the lines are many times the texts by whose size parts would be put together
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = F.when(r == 0, d - d % 10).otherwise(d) if pairs else d
    texts = table(spark, sf_dir, "documents").select("doc_id", "text", F.concat(_episode_dir(number), F.lit("/states/"), name).alias("path"))
    return texts.repartition(parts, episode_of("path") if pairs else "doc_id").select(
        "path", body.alias("body"), _pick(ROBOTS_RECORDED, r).alias("robot"))


def video_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed videos (path, length, modified): three names of the robot; name i is missing when (doc_id + i) % 4 = 3."""
    names = F.element_at(F.array(*[F.array(*[F.lit(x) for x in v]) for v in VIDEO_FILES]), (F.col("doc_id") % 5 + 1).cast("int"))
    d = F.col("doc_id")
    files = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(names).alias("i", "name")).filter((d + F.col("i")) % 4 != 3)
    return files.select(F.concat(F.lit("file:"), _episode_dir(), F.lit("/videos/"), "name").alias("path"),
                        (d * 10 + F.col("i")).alias("length"), d.alias("modified"))


def replayed_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(episode, robot, action_type, image_types): the types follow doc_id; none are asked for when doc_id % 31 = 3."""
    d = F.col("doc_id")
    asked = F.element_at(F.array(*[F.array(*[F.lit(s) for s in r]) for r in CAMERA_REQUESTS]), (d % 4 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select(
        _episode_dir().alias("episode"), _pick(ROBOTS_RECORDED, d % 5).alias("robot"),
        _pick(OBS_ACTION_TYPES, F.expr("doc_id div 5") % 7).alias("action_type"), F.when(d % 31 != 3, asked).alias("image_types"))


def with_ordinals(streams: DataFrame, turn_chunk: int = 4096) -> DataFrame:
    """0-based frame index per (episode, arm) in turn order: a running count,
    computed chunked (``turn div turn_chunk``) so a long stream is not one task."""
    from trajlake.operators.scans import chunked_running_sum
    df = streams.withColumn("__one", F.lit(1)).withColumn("__chunk", F.floor(F.col("turn") / turn_chunk))
    df = chunked_running_sum(df, ["episode", "arm"], "__chunk", ["turn"], "__one", "__n")
    return df.withColumn("frame_idx", (F.col("__n") - 1).cast("bigint")).drop("__one", "__chunk", "__n")


def episode_meta_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episode metadata per conversation: frames = 30 per turn; start = 1.75e9 + 100 s * conv_id;
    end = start + frames / (29.5 + 0.25 * (conv_id % 5))."""
    cv = table(spark, sf_dir, "conversations").select("conv_id")
    g = cv.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    start = F.lit(1.75e9) + F.col("conv_id").cast("double") * 100.0
    frames = F.col("n") * 30
    fps = F.lit(29.5) + (F.col("conv_id") % 5).cast("double") * 0.25
    return g.select(F.concat(F.lit("task_"), (F.col("conv_id") % 4).cast("string")).alias("task"),
                    F.col("conv_id").alias("episode"), start.alias("start_time"),
                    (start + frames.cast("double") / fps).alias("end_time"), frames.cast("bigint").alias("frames"))


def image_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source image sizes from documents: width = 1 + n_chars % 1920, height = 1 + (doc_id*37) % 1080."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return d.select("doc_id", (1 + F.col("n_chars") % 1920).cast("int").alias("src_w"),
                    (1 + (F.col("doc_id") * 37) % 1080).cast("int").alias("src_h"),
                    F.when(F.col("doc_id") % 2 == 0, F.lit("padding")).otherwise(F.lit("stretch")).alias("resize_name"))


# ---------------------------------------------------------------------------
# Run log lines (from events)
# ---------------------------------------------------------------------------
def run_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log text in the three layouts (event_id % 3) with one of nine message kinds (k % 9)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    k = _k()
    job = F.concat(F.lit("job-"), F.col("user_id").cast("string"))
    status = _status_of(F.col("event_type"))
    kind = k % 9
    msg = (F.when(kind == 0, F.format_string("Processing job_id: %s, status: %s", job, status))
           .when(kind == 1, F.format_string("Started robot: b'{\"job_id\": \"%s\"}'", job))
           .when(kind == 2, F.format_string("get_robot_state time: %.2f", F.col("value")))
           .when(kind == 3, F.format_string("Inference result: [[%.2f]]", F.col("value")))
           .when(kind == 4, F.format_string("Job %s exceeded max wait time.", job))
           .when(kind == 5, F.format_string("Error processing job %s: %s", job, F.col("event_type")))
           .when(kind == 6, F.format_string("No active jobs, poll count: %d", k % 10 + 1))
           .when(kind == 7, F.lit("No new jobs after multiple checks, exiting."))
           .otherwise(F.format_string("Job id: %s, status: %s, remaining jobs: %d", job, status, k % 5 + 1)))
    level = (F.when(kind == 4, F.lit("WARNING")).when(kind == 5, F.lit("ERROR")).otherwise(F.lit("INFO")))
    stamp = F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss,SSS")
    layout = F.col("event_id") % 3
    line = (F.when(layout == 0, F.concat(stamp, F.lit(" "), level, F.lit(":"), msg))
            .when(layout == 1, F.concat(F.lit("["), stamp, F.lit("] "), level, F.lit(": "), msg))
            .otherwise(F.concat(stamp, F.lit(" "), level, F.lit(" "), msg)))
    return ev.select(F.col("event_id").alias("line_no"), line.alias("value"))


def worker_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of ten workers (user_id % 10), one line an event, in the order of event_id; the kind follows k.

    A worker's job changes every 500 events. k < 10 calls a ready job, 10-11 one
    in ``prepare``; 12-29 a start; 30-59 a state read; 60-87 an inference; 88-89
    the max wait; 90-91 an error; 92-93 an idle poll; 94 the exit; 95-97 a
    status; the rest a line in no layout.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "props")
    worker = F.pmod(F.col("user_id"), F.lit(10))
    job = F.concat(F.lit("job-"), worker.cast("string"), F.lit("-"), F.expr("event_id div 500").cast("string"))
    k = F.col("k")
    msg = (F.when(k < 12, F.concat(F.lit("Processing job_id: "), job, F.lit(", status: "), F.when(k < 10, F.lit("ready")).otherwise(F.lit("prepare"))))
           .when(k < 30, F.lit("Started robot: b'ok'"))
           .when(k < 60, F.format_string("get_robot_state time: %.2f", F.col("value")))
           .when(k < 88, F.format_string("Inference result: [[%.2f]]", F.col("value")))
           .when(k < 90, F.concat(F.lit("Job "), job, F.lit(" exceeded max wait time.")))
           .when(k < 92, F.concat(F.lit("Error processing job "), job, F.lit(": lost")))
           .when(k < 94, F.lit("No active jobs, poll count: 1"))
           .when(k < 95, F.lit("No new jobs after multiple checks, exiting."))
           .when(k < 98, F.concat(F.lit("Job id: "), job, F.lit(", status: running, remaining jobs: 2"))))
    stamp = F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss,SSS")
    line = F.coalesce(F.concat(stamp, F.lit(" INFO:"), msg), F.lit("    ... 4 more rows]"))
    return ev.withColumn("k", _k()).select(worker.alias("worker"), F.col("event_id").alias("line_no"), line.alias("value"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zipped two-arm frames with an action type per episode and arm-enable flags."""
    from trajlake.operators.align import positional_zip
    st = with_ordinals(arm_streams(spark, sf_dir))
    cols = ["episode", "frame_idx", "turn", "text", "joint", "gripper", "pose"]
    left = st.filter(F.col("arm") == "left").select(*cols)
    right = st.filter(F.col("arm") == "right").select(*cols)
    z = positional_zip(left, right)
    return (z.withColumn("action_type", _pick(OBS_ACTION_TYPES, F.col("episode") % 7))
            .withColumn("left_enabled", F.length("left_text") % 11 != 0)
            .withColumn("right_enabled", F.length("right_text") % 13 != 0))


# ---------------------------------------------------------------------------
# Policy observations (from embeddings)
# ---------------------------------------------------------------------------
def policy_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per embedding: the robot's state vector is the whole embedding folded to its length."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    li = F.col("label") % 4
    return emb.select(F.col("vec_id").alias("obs_id"), _pick(ROBOTS_BY_LABEL, li).alias("robot"),
                      _pick(TYPE_BY_LABEL, li).alias("action_type"),
                      (F.col("vec_id") * 45000).cast("bigint").alias("state_ts_us"),
                      F.lit("normal").alias("state"), F.lit(0).alias("pending_actions"),
                      _fold(_pick(LEN_BY_LABEL, li).cast("int")).alias("action"))


def policy_requests(scored: DataFrame, duration_us: int = 50000) -> DataFrame:
    """Action requests posted from policy output: one request per scored
    observation, at the observation's time, with the robot's action type and
    the default 0.05 s per action."""
    return scored.select(F.concat(F.lit("p-"), F.col("obs_id").cast("string")).alias("request_id"), "robot",
                         F.col("state_ts_us").alias("ts_us"), "action_type", "actions",
                         F.lit(int(duration_us)).cast("bigint").alias("duration_us"))
