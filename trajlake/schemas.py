"""Declared schemas and the embodiment dimension table.

Nothing in the library infers a schema; every reader passes one of these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the recorded data's conventions).
# Robot tags, joint/pose counts, state files, state keys and camera files per
# embodiment; camera slot names; action types; job statuses.
# ---------------------------------------------------------------------------
ROBOT_SPEC_ROWS = [
    # robot, arms, dof_num, pos_num, state_files, gripper_key, pose_key,
    # camera files for slots (left_hand, right_hand, high)
    ("aloha", 2, 6, 16, ["left_states.jsonl", "right_states.jsonl"], "gripper", "ee_pose_rpy",
     "cam_wrist_left_rgb.mp4", "cam_wrist_right_rgb.mp4", "cam_high_rgb.mp4"),
    ("arx5", 1, 6, 6, ["states.jsonl"], "gripper_width", "end_effector_pose",
     "arm_realsense_rgb.mp4", "global_realsense_rgb.mp4", "right_realsense_rgb.mp4"),
    ("ur5", 1, 6, 6, ["states.jsonl"], "gripper", "ee_positions",
     "handeye_realsense_rgb.mp4", "global_realsense_rgb.mp4", None),
    ("franka", 1, 7, 7, ["states.jsonl"], "gripper_width", "ee_positions",
     "handeye_realsense_rgb.mp4", "main_realsense_rgb.mp4", "side_realsense_rgb.mp4"),
]
CAMERA_SLOTS = ["left_hand", "right_hand", "high"]
ACTION_TYPES = ["joint", "pos", "leftjoint", "leftpos", "rightjoint", "rightpos"]
ACTIVE_STATUSES = ["assigned", "prepare", "ready", "running"]
TERMINAL_STATUSES = ["finished", "cancelled", "failed"]
NOMINAL_FPS = 30.0
DEFAULT_VELOCITY_LIMIT = 1_000_000.0
DEFAULT_JOB_LIMIT_S = 600
DEFAULT_IDLE_POLLS = 10
BAD_ARITY_MESSAGE = "The number and type of actions do not match!"
MISSING_TYPE_MESSAGE = "argument of type 'NoneType' is not iterable"
NULL_ACTION_MESSAGE = "object of type 'NoneType' has no len()"
# Return codes of a bounded wait.
RC_SUCCESS, RC_FAILURE, RC_TIMEOUT, RC_EXCEPTION = 0, 1, 2, 3

ROBOT_SPEC_SCHEMA = T.StructType([
    T.StructField("robot", T.StringType(), False),
    T.StructField("arms", T.IntegerType(), False),
    T.StructField("dof_num", T.IntegerType(), False),
    T.StructField("pos_num", T.IntegerType(), False),
    T.StructField("state_files", T.ArrayType(T.StringType()), False),
    T.StructField("gripper_key", T.StringType(), False),
    T.StructField("pose_key", T.StringType(), False),
    T.StructField("cam_left_hand", T.StringType(), True),
    T.StructField("cam_right_hand", T.StringType(), True),
    T.StructField("cam_high", T.StringType(), True),
])

EPISODE_META_SCHEMA = T.StructType([
    T.StructField("episode_index", T.LongType(), True),
    T.StructField("episode_idx", T.LongType(), True),
    T.StructField("start_time", T.DoubleType(), True),
    T.StructField("end_time", T.DoubleType(), True),
    T.StructField("frames", T.LongType(), True),
])

# Superset of the per-robot state-line keys; one reader serves all robots.
STATE_LINE_SCHEMA = T.StructType([
    T.StructField("joint_positions", T.ArrayType(T.DoubleType()), True),
    T.StructField("gripper", T.DoubleType(), True),
    T.StructField("gripper_width", T.DoubleType(), True),
    T.StructField("ee_pose_rpy", T.ArrayType(T.DoubleType()), True),
    T.StructField("end_effector_pose", T.ArrayType(T.DoubleType()), True),
    T.StructField("ee_positions", T.ArrayType(T.DoubleType()), True),
])

JOB_SCHEMA = T.StructType([
    T.StructField("job_id", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("device", T.StructType([T.StructField("robot_id", T.StringType(), True)]), True),
])
JOB_COLLECTION_SCHEMA = T.StructType([T.StructField("jobs", T.ArrayType(JOB_SCHEMA), True)])


def robot_spec(spark: SparkSession) -> DataFrame:
    """The embodiment dimension table (4 rows, fixed size: safe to broadcast)."""
    return spark.createDataFrame(ROBOT_SPEC_ROWS, ROBOT_SPEC_SCHEMA)


def spec_for_join(spark: SparkSession) -> DataFrame:
    """Spec projected to the join columns and hinted for broadcast.

    The table has one row per embodiment (4), a size bound that does not grow
    with the data, so broadcasting it is always safe.
    """
    return F.broadcast(robot_spec(spark).select("robot", "arms", "dof_num", "pos_num"))
