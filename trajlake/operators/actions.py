"""Action requests: arity validation (C1), request outcome (A5), chunk
explosion with arm split and nominal times (C2, P4, P9), clear events.

Input: one row per posted request
``(request_id, robot, ts_us, action_type, actions array<array<double>>, duration_us)``.
Everything request-level is computed on the nested row itself (array
lambdas), so validation is a narrow, shuffle-free projection; the only join
is with the 4-row embodiment table, which is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.functions.vectors import array_len, expected_action_len, parse_action_type, split_arm_vector
from trajlake.schemas import BAD_ARITY_MESSAGE, MISSING_TYPE_MESSAGE, NULL_ACTION_MESSAGE


def _with_request_checks(requests: DataFrame, spec: DataFrame) -> DataFrame:
    """Attach spec, parsed action type, expected length and the first bad position."""
    spec_cols = spec.select("robot", "dof_num", "pos_num")
    df = requests.join(F.broadcast(spec_cols), "robot", "left")
    pt = parse_action_type("action_type")
    df = (df.withColumn("__pt", pt)
          .withColumn("arm", F.col("__pt.arm"))
          .withColumn("mode", F.col("__pt.mode"))
          .withColumn("is_documented", F.col("__pt.is_documented"))
          .drop("__pt")
          .withColumn("actions", F.coalesce(F.col("actions"), F.array().cast("array<array<double>>")))
          .withColumn("expected_len", F.when(F.col("action_type").isNotNull(), expected_action_len(
              "arm", "mode", "dof_num", "pos_num")).cast("int")))
    # First action (0-based) whose length differs, computed inside the array:
    # no window, no shuffle, and valid on streams as well.
    bad_positions = F.filter(
        F.transform("actions", lambda a, i: F.when(array_len(a) != F.col("expected_len"), i)),
        lambda x: x.isNotNull())
    null_positions = F.filter(F.transform("actions", lambda a, i: F.when(a.isNull(), i)), lambda x: x.isNotNull())
    n = F.size("actions")
    known = F.col("dof_num").isNotNull()
    df = (df.withColumn("first_bad_pos", F.when(F.col("action_type").isNotNull() & known,
                                                F.array_min(bad_positions)).cast("int"))
          .withColumn("null_pos", F.array_min(null_positions).cast("int")))
    # Checked action by action in order: a length mismatch clears the queue and
    # replies with an error; a null action fails the length check itself (HTTP
    # 400) after the actions before it were queued, and clears nothing.
    null_first = F.col("null_pos").isNotNull() & (F.col("first_bad_pos").isNull()
                                                  | (F.col("null_pos") < F.col("first_bad_pos")))
    status = (F.when(~known, F.lit("unknown_robot"))
              .when(F.col("action_type").isNull() & (n > 0), F.lit("missing_action_type"))
              .when(null_first, F.lit("null_action"))
              .when(F.col("first_bad_pos").isNotNull(), F.lit("bad_arity")))
    return df.withColumn("request_error", status).withColumn("n_actions", n.cast("int"))


def batch_outcome(requests: DataFrame, spec: DataFrame) -> DataFrame:
    """A5: one row per request with the server's reply.

    ``success``; or ``error`` + the arity message (reply 200) when an action
    has the wrong length; a missing action type with at least one action is a
    400 error. An empty action list succeeds. Unknown robots are reported as
    ``unknown_robot`` (the reference cannot start with one).
    """
    df = _with_request_checks(requests, spec)
    err = F.col("request_error")
    return df.select(
        "request_id", "robot", "ts_us", "action_type", "n_actions", "first_bad_pos",
        F.when(err.isNull(), F.lit("success")).otherwise(F.lit("error")).alias("result"),
        F.when(err == "bad_arity", F.lit(BAD_ARITY_MESSAGE))
         .when(err == "missing_action_type", F.lit(MISSING_TYPE_MESSAGE))
         .when(err == "null_action", F.lit(NULL_ACTION_MESSAGE))
         .when(err == "unknown_robot", F.lit("unknown robot tag")).alias("message"),
        F.when(err.isin("missing_action_type", "null_action"), F.lit(400)).otherwise(F.lit(200)).alias("http_status"),
        (err == "bad_arity").alias("clears_queue"),
    )


def validate_action_arity(requests: DataFrame, spec: DataFrame) -> DataFrame:
    """Explode each request into its actions and flag arity.

    ``is_bad``: this action's length differs from the expected one.
    A bad request queues its prefix and then clears the whole queue, so no
    action of it runs: ``effective`` is false for all of them. Requests with a
    null/non-positive duration are quarantined (``bad_duration``): the worker
    cannot time them.
    """
    df = _with_request_checks(requests, spec)
    ex = df.select("*", F.posexplode("actions").alias("seq", "action")).drop("actions")
    err = F.col("request_error")
    # after a null action nothing more was queued; the actions before it run
    req_reason = F.when(err == "null_action", F.when(F.col("seq") >= F.col("null_pos"), err)).otherwise(err)
    reason = F.coalesce(
        req_reason,
        F.when(F.col("duration_us").isNull() | (F.col("duration_us") <= 0), F.lit("bad_duration")))
    return (ex.withColumn("actual_len", array_len("action").cast("int"))
            .withColumn("is_bad", F.coalesce(F.col("actual_len") != F.col("expected_len"), F.lit(False)))
            .withColumn("quarantine_reason", reason)
            .withColumn("effective", reason.isNull()))


def clear_events(requests: DataFrame, spec: DataFrame) -> DataFrame:
    """Queue-clear events caused by bad-arity requests: ``(robot, ts_us, kind)``."""
    out = batch_outcome(requests, spec).filter(F.col("clears_queue"))
    return out.select("robot", "ts_us", F.lit("format_error").alias("kind"))


def explode_action_chunk(validated: DataFrame) -> DataFrame:
    """C2 (+P4, P9): the executable action rows of validated requests.

    Adds ``left``/``right`` (``array<float>``, other arm null for one-arm
    commands), ``position`` (the commanded vector as stored, float32 values in
    double), and ``t_nominal_us = ts_us + seq * duration_us``.
    """
    df = validated.filter(F.col("effective"))
    left, right = split_arm_vector("action", "arm")
    return (df.withColumn("left", left).withColumn("right", right)
            .withColumn("position", F.col("action").cast("array<float>").cast("array<double>"))
            .withColumn("t_nominal_us", nominal_action_time("ts_us", "seq", "duration_us")))


def nominal_action_time(ts_us: str, seq: str, duration_us: str) -> F.Column:
    """Time of the k-th action of a chunk = ``ts + k * duration``."""
    return F.col(ts_us) + F.col(seq).cast("bigint") * F.col(duration_us)
