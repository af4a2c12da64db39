"""Observation shaping: state vector by action type (P2), camera selection
(P5), observation status (P6) and letterbox geometry (P8). Pure column
expressions: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.functions.vectors import compose_arm_vector, concat_arms, parse_action_type


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def select_state_vector(df: DataFrame, action_type: Column | str = "action_type") -> DataFrame:
    """The vector an observation carries for its action type.

    Needs ``left_joint, left_pose, left_gripper`` (and the ``right_*`` twins for
    two-arm robots). left/right -> that arm's ``[joints|pose, gripper]``; both
    -> left block then right block, of poses for ``pos`` (the documented
    behaviour; the reference returned joints there). Adds ``arm``, ``mode``, ``vector``.
    """
    pt = parse_action_type(action_type)
    df = df.withColumns({"arm": pt["arm"], "mode": pt["mode"]})   # columns first: the vector asks for them several times
    arm, mode = F.col("arm"), F.col("mode")

    def arm_vec(side: str) -> Column:
        return F.when(mode == "pos", compose_arm_vector(f"{side}_pose", f"{side}_gripper")) \
            .otherwise(compose_arm_vector(f"{side}_joint", f"{side}_gripper"))

    vec = (F.when(arm == "left", arm_vec("left")).when(arm == "right", arm_vec("right"))
           .when(arm == "both", concat_arms(arm_vec("left"), arm_vec("right"))))
    return df.withColumn("vector", vec)


def observation_status(df: DataFrame, action_type: Column | str = "action_type",
                       left_enabled: Column | str = "left_enabled", right_enabled: Column | str = "right_enabled",
                       image_types: Column | str | None = None) -> DataFrame:
    """``size_none`` if the action type (or the image list, when given) is
    missing; ``normal`` if the selected arm(s) are enabled (both needed for
    both); else ``abnormal`` and the vector is withheld. Expects ``arm`` and
    ``vector`` from ``select_state_vector``."""
    at = _c(action_type)
    missing = at.isNull() if image_types is None else (at.isNull() | _c(image_types).isNull())
    le, re = _c(left_enabled), _c(right_enabled)
    ok = (F.when(F.col("arm") == "left", le).when(F.col("arm") == "right", re).otherwise(le & re))
    state = F.when(missing, F.lit("size_none")).when(ok, F.lit("normal")).otherwise(F.lit("abnormal"))
    return (df.withColumn("state", state)
            .withColumn("vector", F.when(F.col("state") == "normal", F.col("vector"))))


def select_cameras(df: DataFrame, images: str = "images", image_types: Column | str = "image_types") -> DataFrame:
    """P5: keep requested camera slots of the ``images`` map; unknown names are ignored."""
    types = _c(image_types)
    return df.withColumn(images, F.map_filter(F.col(images), lambda k, v: F.array_contains(types, k)))


def letterbox_geometry(df: DataFrame, src_w: str = "src_w", src_h: str = "src_h", target_w: int = 224,
                       target_h: int = 224, mode: Column | str = "resize_name") -> DataFrame:
    """Output geometry of fitting an image into ``target_w x target_h``.

    ``padding``: aspect-preserving fit, ``ratio = max(w/W, h/H)``,
    ``resized = int(w/ratio), int(h/ratio)`` (truncation), centered with
    ``pad = max(0, int((W - resized)/2))``; identity when the size already
    matches. Any other mode stretches to ``(W, H)``. ``degenerate`` flags a zero
    resized side (the reference fails there). Pixels are not touched.
    """
    w, h = F.col(src_w).cast("double"), F.col(src_h).cast("double")
    W, H = float(target_w), float(target_h)
    pad_mode = _c(mode) == "padding"
    same = (F.col(src_w) == target_w) & (F.col(src_h) == target_h)
    ratio = F.greatest(w / F.lit(W), h / F.lit(H))
    rw = F.try_divide(w, ratio).cast("int")      # a 0x0 source has ratio 0: null, flagged degenerate
    rh = F.try_divide(h, ratio).cast("int")
    fit = pad_mode & ~same
    return (df.withColumn("resized_w", F.when(fit, rw).when(pad_mode, F.col(src_w)).otherwise(F.lit(target_w)))
            .withColumn("resized_h", F.when(fit, rh).when(pad_mode, F.col(src_h)).otherwise(F.lit(target_h)))
            .withColumn("pad_x", F.when(fit, F.greatest(F.lit(0), ((F.lit(W) - rw) / 2).cast("int"))).otherwise(F.lit(0)))
            .withColumn("pad_y", F.when(fit, F.greatest(F.lit(0), ((F.lit(H) - rh) / 2).cast("int"))).otherwise(F.lit(0)))
            .withColumn("identity", pad_mode & same)
            .withColumn("degenerate", F.coalesce((F.col("resized_w") == 0) | (F.col("resized_h") == 0), F.lit(True))))


def select_camera_rows(df: DataFrame, image_types: list[str], slot: str = "slot") -> DataFrame:
    """P5, long form: one row per (frame, camera slot); keep the requested slots.
    Unknown names in ``image_types`` simply match nothing."""
    return df.filter(F.col(slot).isin(*image_types))
