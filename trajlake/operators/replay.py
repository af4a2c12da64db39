"""Observations replayed from recorded episodes: arm and camera streams of
unequal length brought to one row a tick (J1, J2), then state vector, status
and cameras as a client would receive them (P1-P6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.functions.vectors import parse_action_type
from trajlake.operators.align import TICK_BLOCK, cyclic_align, tick_blocks
from trajlake.operators.observations import observation_status, select_cameras, select_state_vector
from trajlake.operators.scans import attach_by_chunk, drop_chunks, with_chunk
from trajlake.schemas import CAMERA_SLOTS

ARM_FIELDS = ["joint", "gripper", "pose", "enabled"]


def zip_streams(rows: DataFrame, names: Sequence[str], on: Sequence[str] = ("episode", "frame_idx"), stream: str = "stream",
                need: Sequence[str] = ()) -> DataFrame:
    """J1 for any number of streams, in one pass: a struct column for each of ``names``.

    ``rows`` holds all streams, told apart by ``stream``; ``(on, stream)`` is
    unique. All rows of an ordinal meet in one exchange on ``on``, whatever the
    number of streams. A stream without the ordinal gives a null struct; an
    ordinal that a stream of ``need`` lacks is left out, so ``need=names`` stops
    at the shortest stream. Rows of other streams are ignored.
    """
    values = [c for c in rows.columns if c not in (*on, stream)]
    # the struct is made before the rows are sorted: the aggregate then copies it as one piece
    packed = rows.filter(F.col(stream).isin(list(names))).select(*on, stream, F.struct(*values).alias("__row"))
    wide = packed.groupBy(*on).agg(*[F.first(F.when(F.col(stream) == n, F.col("__row")), ignorenulls=True).alias(n) for n in names])
    for n in need:
        wide = wide.filter(F.col(n).isNotNull())
    return wide


def _only_shown(arms: DataFrame) -> DataFrame:
    """Arm rows without the values that no observation shows: of an arm that the action type does not ask for or that is
    not enabled, and of the vector (joint or pose) of the other mode."""
    kind = parse_action_type("action_type")
    used = F.col("__asked") & F.col("enabled") & ((kind["arm"] == "both") | (kind["arm"] == F.col("arm")))
    pos = kind["mode"] == "pos"
    return arms.select(*[c for c in arms.columns if c not in ("action_type", "__asked", "joint", "gripper", "pose")],
                       F.when(used & ~pos, F.col("joint")).alias("joint"), F.when(used, F.col("gripper")).alias("gripper"),
                       F.when(used & pos, F.col("pose")).alias("pose"))


def replay_observations(states: DataFrame, episodes: DataFrame, cameras: DataFrame, ticks: DataFrame | None = None,
                        episode: str = "episode", together: bool = False) -> DataFrame:
    """Observation of every tick of each episode.

    ``states(episode, arm, frame_idx, joint, gripper, pose, enabled)``: the arms'
    streams, numbered from 0 without gaps. ``episodes(episode, robot,
    action_type, image_types)``: one row an episode. ``cameras(episode, slot,
    path, n_frames)``: the videos; of several in a slot the first path counts.
    ``ticks(episode, n_ticks)``: how long to replay, by default as long as the
    longer arm. Every stream starts over at its own end: tick n shows row
    ``n % length`` of each arm and frame ``n % n_frames`` of each camera.

    Adds nothing for an episode without states, without ticks or without a row
    in ``episodes``. A video without frames, or a null count, fills no slot. An
    arm without states is not enabled, so what needs it is ``abnormal``.
    Returns ``episode, tick, robot, action_type, arm, mode, state, vector,
    images`` (slot -> path and frame_idx; null when the state is ``size_none``).

    Frames are numbers: cameras are not rows to be joined but one small row of
    counts an episode, which reaches the ticks by ``(episode, block of ticks)``,
    so a long episode stays spread. With ``together`` (``states`` dealt by
    ``episode``, say as whole files) no state is moved at all: an episode is
    then one task, so this does not suit ``ticks`` far beyond the streams' ends.
    Where they are not dealt so, Spark deals them.
    """
    if ticks is None and not together:
        ticks = states.groupBy(episode, "arm").agg(F.count(F.lit(1)).alias("n")).groupBy(episode).agg(F.max("n").alias("n_ticks"))
    types = episodes.select(episode, "action_type", F.col("image_types").isNotNull().alias("__asked"))
    # hints on joins of tables that grow with the episodes: none is sent whole through the driver, however well it compresses
    ticks = types if ticks is None else ticks.select(episode, "n_ticks").join(types.hint("merge"), episode)
    arms = cyclic_align(states.select(episode, "arm", "frame_idx", *ARM_FIELDS), ticks, episode, "arm", keep=["action_type", "__asked"], together=together)
    arms, block = with_chunk(_only_shown(arms.drop("frame_idx")), "tick", None if together else TICK_BLOCK)
    if block:   # one exchange by block of ticks serves the streams' meeting and the episode's row
        arms = arms.repartition(episode, block)
    wide = zip_streams(arms, ["left", "right"], (episode, block, "tick") if block else (episode, "tick"), "arm")

    video = F.struct(F.col("path").alias("path"), F.col("n_frames").cast("bigint").alias("n_frames"))
    slots = cameras.filter(F.col("n_frames") > 0).groupBy(episode).agg(*[
        F.min(F.when(F.col("slot") == s, video)).alias(f"__{s}") for s in CAMERA_SLOTS])
    per_episode = episodes.select(episode, "robot", "action_type", "image_types").join(slots.hint("merge"), episode, "left")
    # which videos are shown is settled once an episode; a tick only turns their counts into frames
    filled = F.map_from_entries(F.filter(F.array(*[
        F.when(F.col(f"__{s}").isNotNull(), F.struct(F.lit(s).alias("slot"), F.col(f"__{s}").alias("video"))) for s in CAMERA_SLOTS]),
        lambda e: e.isNotNull()))
    per_episode = select_cameras(per_episode.withColumn("__videos", filled), "__videos").drop(*[f"__{s}" for s in CAMERA_SLOTS])
    # in their partitions the ticks are in the order of their episodes by now
    wide = drop_chunks(attach_by_chunk(wide, per_episode, episode, block, tick_blocks(ticks, episode, block) if block else None,
                                       hint="shuffle_hash" if block else "merge"))

    flat = wide.select(episode, "tick", "robot", "action_type", "image_types", "__videos", *[
        F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("left", "right") for c in ARM_FIELDS])
    seen = observation_status(select_state_vector(flat), image_types="image_types")
    frames = F.transform_values("__videos", lambda _, v: F.struct(v["path"].alias("path"), (F.col("tick") % v["n_frames"]).alias("frame_idx")))
    return seen.select(episode, "tick", "robot", "action_type", "arm", "mode", "state", "vector",
                       F.when(F.col("state") != "size_none", frames).alias("images"))
