"""Episode trees on shared storage.

Layout: ``<root>/<date>/<task>/data/episode_<id>/{meta/episode_meta.json,
states/*.jsonl, videos/*.mp4}``. Every reader passes a declared schema and
takes its location columns from the file's path. The readers only list and
read files; what they do with paths and texts are the DataFrame forms
``parse_episode_meta``, ``split_state_lines`` and ``join_camera_files``, which
also work on paths and texts that are stored in a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajlake.schemas import CAMERA_SLOTS, EPISODE_META_SCHEMA, STATE_LINE_SCHEMA

# Path shape of an episode file: .../<date>/<task>/data/episode_<id>/<kind>/<file>
PATH_PATTERN = r"^(.*)/([^/]+)/([^/]+)/data/episode_([^/]+)/(meta|states|videos)/([^/]+)$"


def _decoded_path() -> F.Column:
    # _metadata.file_path is percent-encoded, binaryFile.path is not; a plus sign stands for itself.
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _path_parts(path: F.Column) -> dict[str, F.Column]:
    # Readers spell local URIs differently (file:/x vs file:///x); keep one form.
    path = F.regexp_replace(path, r"^file:/+", "/")
    return {
        "date": F.regexp_extract(path, PATH_PATTERN, 2),
        "task": F.regexp_extract(path, PATH_PATTERN, 3),
        "episode_id": F.regexp_extract(path, PATH_PATTERN, 4),
        "episode_dir": F.concat_ws("/", F.regexp_extract(path, PATH_PATTERN, 1), F.regexp_extract(path, PATH_PATTERN, 2),
                                   F.regexp_extract(path, PATH_PATTERN, 3), F.lit("data"),
                                   F.concat(F.lit("episode_"), F.regexp_extract(path, PATH_PATTERN, 4))),
        "file": F.regexp_extract(path, PATH_PATTERN, 6),
    }


def episode_of(path: F.Column | str) -> F.Column:
    """The ``episode_dir`` of an episode file's path (not percent-encoded), as all readers here give it."""
    return _path_parts(F.col(path) if isinstance(path, str) else path)["episode_dir"]


def episode_catalog(spark: SparkSession, root: str) -> DataFrame:
    """One row per episode.

    ``date``, ``task`` and ``episode_id`` come from the path; the id in the
    path is not the index (``episode_FFFFFF`` may hold index 80). The index
    key drifted between recordings (``episode_index`` / ``episode_idx``).
    """
    return parse_episode_meta(spark.read.text(f"{root.rstrip('/')}/*/*/data/*/meta/episode_meta.json", wholetext=True)
                              .select(_decoded_path().alias("path"), F.col("value").alias("body")))


def parse_episode_meta(metas: DataFrame, path: str = "path", body: str = "body") -> DataFrame:
    """S1 on rows: the catalog of episodes from each metadata file's ``path`` (not percent-encoded) and JSON text.

    A text that is null or does not parse leaves the episode in the catalog
    with null metadata.
    """
    df = metas.select(F.col(path).alias("__path"), F.from_json(F.col(body), EPISODE_META_SCHEMA).alias("__m")).select("__path", "__m.*")
    p = _path_parts(F.col("__path"))
    return df.select(p["episode_dir"].alias("episode_dir"), p["date"].alias("date"), p["task"].alias("task"),
                     p["episode_id"].alias("episode_id"),
                     F.coalesce("episode_index", "episode_idx").alias("episode_index"),
                     "start_time", "end_time", "frames")


def read_states(spark: SparkSession, root: str, pattern: str = "*/*/data/*/states/*.jsonl",
                index_field: str | None = None) -> DataFrame:
    """JSONL state logs -> one row per line with ``frame_idx`` = 0-based line number.

    Files are read line by line and split over tasks whatever their size; the
    numbers come from ``number_lines``. The end of a file after a final newline
    is not a frame; any other line that does not parse is kept with ``corrupt = true``.

    If lines carry their own frame number, ``index_field`` names it: then
    ``frame_idx`` is that field, and nothing is counted.
    """
    base = f"{root.rstrip('/')}/{pattern}"
    if not index_field:
        return _parsed_lines(_with_path_parts(number_lines(spark, base), "path").withColumnRenamed("value", "line"), [])
    lines = spark.read.option("lineSep", "\n").text(base).select(F.col("value").alias("line"), _decoded_path().alias("path"))
    schema = T.StructType([*STATE_LINE_SCHEMA.fields, T.StructField(index_field, T.LongType(), True), T.StructField("_corrupt_record", T.StringType(), True)])
    parsed = _with_path_parts(lines, "path").withColumn("__s", F.from_json(F.col("line"), schema, _PERMISSIVE))
    return (parsed.withColumn("frame_idx", F.col(f"__s.{index_field}"))
            .withColumn("corrupt", F.col("__s._corrupt_record").isNotNull() | F.col("frame_idx").isNull())
            .select("episode_dir", "file", "frame_idx", "corrupt", "__s.*")
            .drop("_corrupt_record", index_field))


def number_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their exact 0-based number in the file: path (decoded), frame_idx, value.

    A file is read in splits by several tasks. The lines of one split are
    consecutive rows of one task, so their places in the scan are consecutive
    numbers. One row for each split says where its lines start and how many
    there are; a running sum over a file's splits gives the lines before it.
    Only these rows are shuffled, the lines stay where they were read.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__split"),
        F.monotonically_increasing_id().alias("__place"), _decoded_path().alias("path"), "value")
    splits = lines.groupBy("__file", "__split").agg(F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__n"))
    ahead = Window.partitionBy("__file").orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)
    start = splits.select("__file", "__split", (F.coalesce(F.sum("__n").over(ahead), F.lit(0)) - F.col("__first")).alias("__shift"))
    return lines.join(start, ["__file", "__split"]).select("path", (F.col("__place") + F.col("__shift")).alias("frame_idx"), "value")


def split_state_lines(texts: DataFrame, path: str = "path", body: str = "body") -> DataFrame:
    """S2 on rows: each state file's ``path`` (not percent-encoded) and whole text -> one row per line.

    Other columns of ``texts`` stay on every line. A null text has no lines.
    """
    rest = [c for c in texts.columns if c not in (path, body)]
    # worked out once a file, below the generator: an expression beside it would be worked out once a line
    files = _with_path_parts(texts, path).select(*rest, "episode_dir", "file", _without_final_newline(F.col(body)).alias("__body"))
    lines = files.select(*rest, "episode_dir", "file", F.posexplode(F.split("__body", "\n")).alias("frame_idx", "line"))
    return _parsed_lines(lines, rest)


def _without_final_newline(body: F.Column) -> F.Column:
    """Null for an empty text, which has no lines. Cut by bytes: neither a pattern nor a count of characters goes over the text."""
    return F.when(body.endswith("\n"), F.left(body.cast("binary"), F.octet_length(body) - 1).cast("string")).when(body != "", body)


def _with_path_parts(df: DataFrame, path: str) -> DataFrame:
    p = _path_parts(F.col(path))
    return df.withColumns({"episode_dir": p["episode_dir"], "file": p["file"]})


_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def _parsed_lines(lines: DataFrame, rest: list[str]) -> DataFrame:
    schema = T.StructType([*STATE_LINE_SCHEMA.fields, T.StructField("_corrupt_record", T.StringType(), True)])
    # the condition always holds; as a number of the scan it keeps filters on the fields above the parsing, which they would else repeat
    once = F.monotonically_increasing_id() >= 0
    return (lines.withColumn("__s", F.when(once, F.from_json(F.col("line"), schema, _PERMISSIVE)))
            .withColumn("corrupt", F.col("__s").isNull() | F.col("__s._corrupt_record").isNotNull()
                        | (F.trim(F.col("line")) == ""))
            .select(*rest, "episode_dir", "file", F.col("frame_idx").cast("bigint").alias("frame_idx"), "corrupt", "__s.*")
            .drop("_corrupt_record"))


def enrich_with_spec(df: DataFrame, spec: DataFrame, robot: str = "robot") -> DataFrame:
    """Attach ``arms, dof_num, pos_num, gripper_key, pose_key`` by robot tag.

    The spec has one row per embodiment, so it is broadcast. Rows with an
    unknown tag keep null spec columns and ``unknown_robot = true``; use
    ``unknown_robots`` to quarantine them.
    """
    s = spec.select(F.col("robot").alias(robot), "arms", "dof_num", "pos_num", "gripper_key", "pose_key")
    return df.join(F.broadcast(s), robot, "left").withColumn("unknown_robot", F.col("dof_num").isNull())


def unknown_robots(df: DataFrame, spec: DataFrame, robot: str = "robot") -> DataFrame:
    """S5 quarantine: rows whose robot tag has no spec row (``left_anti``)."""
    return df.join(F.broadcast(spec.select(F.col("robot").alias(robot))), robot, "left_anti")


def normalize_states(states: DataFrame) -> DataFrame:
    """S3: per-robot keys -> canonical ``(arm, joint, gripper, pose)``.

    ``states`` must carry ``robot`` and the spec columns (``enrich_with_spec``).
    Two-arm robots log one file per arm (``left_states.jsonl`` /
    ``right_states.jsonl``); one-arm robots log ``states.jsonl`` (arm left).
    ``joint_len_ok`` / ``pose_len_ok`` compare with ``dof_num`` / ``pos_num``.
    """
    arm = (F.when(F.col("file").startswith("left_"), F.lit("left"))
           .when(F.col("file").startswith("right_"), F.lit("right")).otherwise(F.lit("left")))
    gripper = (F.when(F.col("gripper_key") == "gripper", F.col("gripper"))
               .when(F.col("gripper_key") == "gripper_width", F.col("gripper_width")))
    pose = (F.when(F.col("pose_key") == "ee_pose_rpy", F.col("ee_pose_rpy"))
            .when(F.col("pose_key") == "end_effector_pose", F.col("end_effector_pose"))
            .when(F.col("pose_key") == "ee_positions", F.col("ee_positions")))
    return (states.withColumn("arm", arm)
            .withColumn("joint", F.col("joint_positions"))
            .withColumn("gripper", gripper)
            .withColumn("pose", pose)
            .withColumn("joint_len_ok", F.size("joint") == F.col("dof_num"))
            .withColumn("pose_len_ok", F.size("pose") == F.col("pos_num"))
            .drop("joint_positions", "gripper_width", "ee_pose_rpy", "end_effector_pose", "ee_positions"))


def camera_slots(spec: DataFrame) -> DataFrame:
    """Expected ``(robot, slot, file)`` per embodiment (slots without a camera omitted)."""
    stacked = spec.select("robot", F.explode(F.array(*[
        F.struct(F.lit(s).alias("slot"), F.col(f"cam_{s}").alias("file")) for s in CAMERA_SLOTS])).alias("c"))
    return stacked.select("robot", "c.slot", "c.file").filter(F.col("file").isNotNull())


def camera_manifest(spark: SparkSession, root: str, episodes: DataFrame, spec: DataFrame) -> DataFrame:
    """Which video fills which camera slot per episode.

    ``episodes(episode_dir, robot)``. Lists ``videos/*.mp4`` with the binary
    file source but only selects ``path, length, modificationTime`` -- the
    ``content`` column is pruned from the scan, so no video bytes are read.
    A missing file gives a null ``path``.
    """
    files = (spark.read.format("binaryFile").load(f"{root.rstrip('/')}/*/*/data/*/videos/*.mp4")
             .select("path", "length", F.col("modificationTime").alias("modified")))
    return join_camera_files(files, episodes, spec)


def join_camera_files(files: DataFrame, episodes: DataFrame, spec: DataFrame) -> DataFrame:
    """S4 on rows: ``files(path, length, modified)`` put into the camera slots of ``episodes(episode_dir, robot)``."""
    p = _path_parts(F.col("path"))
    files = files.select(p["episode_dir"].alias("episode_dir"), p["file"].alias("file"), "path", "length", "modified")
    expected = episodes.select("episode_dir", "robot").join(F.broadcast(camera_slots(spec)), "robot")
    return expected.join(files.hint("merge"), ["episode_dir", "file"], "left")   # the list is not sent whole through the driver
