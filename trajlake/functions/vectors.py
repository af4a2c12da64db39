"""Column-level helpers for action types and arm vectors.

All of these are plain Spark expressions, so they stay inside whole-stage
codegen (except the array lambdas, which Spark evaluates per row in the JVM).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trajlake.schemas import ACTION_TYPES


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_action_type(col: Column | str) -> Column:
    """Action type string -> ``struct<arm, mode, is_documented>``.

    Dispatch is by substring with the precedence left > right > both and
    pos > joint; an unknown non-null string therefore means both arms, joint.
    A null type gives a null struct.
    """
    c = _c(col)
    arm = (F.when(c.contains("left"), F.lit("left"))
           .when(c.contains("right"), F.lit("right"))
           .otherwise(F.lit("both")))
    mode = F.when(c.contains("pos"), F.lit("pos")).otherwise(F.lit("joint"))
    return F.when(c.isNull(), F.lit(None)).otherwise(
        F.struct(arm.alias("arm"), mode.alias("mode"), c.isin(*ACTION_TYPES).alias("is_documented")))


def expected_action_len(arm: Column | str, mode: Column | str, dof_num: Column | str, pos_num: Column | str) -> Column:
    """Length an action must have: ``dof_num+1`` (joint) or ``pos_num+1`` (pose), doubled for both arms."""
    per_arm = F.when(_c(mode) == "pos", _c(pos_num) + 1).otherwise(_c(dof_num) + 1)
    return per_arm * F.when(_c(arm) == "both", F.lit(2)).otherwise(F.lit(1))


def compose_arm_vector(vec: Column | str, gripper: Column | str) -> Column:
    """``[joints or pose..., gripper]``."""
    return F.concat(_c(vec), F.array(_c(gripper).cast("double")))


def concat_arms(left: Column | str, right: Column | str) -> Column:
    """Two-arm vector = left block then right block."""
    return F.concat(_c(left), _c(right))


def split_arm_vector(action: Column | str, arm: Column | str) -> tuple[Column, Column]:
    """Action -> (left, right) as ``array<float>``; a one-arm command leaves the other null.

    A two-arm action is split at half its length (so 34-long poses split 17/17).
    """
    a, r = _c(action), _c(arm)
    half = (F.size(a) / 2).cast("int")
    left = (F.when(r == "left", a)
            .when(r == "both", F.slice(a, F.lit(1), half)))
    right = (F.when(r == "right", a)
             .when(r == "both", F.slice(a, half + 1, half)))
    return left.cast("array<float>"), right.cast("array<float>")


def scale_dims(vel: Column | str, arm: Column | str) -> Column:
    """Velocity entries used to scale the period: all but the gripper(s).

    One arm: drop the last entry. Both arms: drop each block's last entry.
    """
    v, r = _c(vel), _c(arm)
    n = F.size(v)
    half = (n / 2).cast("int")
    both = F.concat(F.slice(v, F.lit(1), half - 1), F.slice(v, half + 1, half - 1))
    one = F.slice(v, F.lit(1), n - 1)
    return F.when(n == 0, v).when(r == "both", both).otherwise(one)


def array_abs_max(arr: Column | str) -> Column:
    """``max(|x|)`` over an array; empty -> null. A NaN entry makes the result NaN
    (Spark orders NaN above numbers), so comparisons must guard with ``isnan``."""
    return F.array_max(F.transform(_c(arr), lambda x: F.abs(x)))


def array_round_sum(arr: Column | str, digits: int = 6) -> Column:
    """Rounded sum of an array's values (for order-independent comparison of vectors)."""
    return F.round(F.aggregate(_c(arr).cast("array<double>"), F.lit(0.0), lambda acc, x: acc + x), digits)


def array_len(arr: Column | str) -> Column:
    """Array length, null for a null array (``size`` gives -1 there when ANSI mode is off)."""
    a = _c(arr)
    return F.when(a.isNotNull(), F.size(a))
