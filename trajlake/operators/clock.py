"""Clock offset (A1) and observation latency (A2). Aggregates with map-side
partial aggregation; a hot session or job does not pin one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clock_offset(samples: DataFrame, session: str = "session") -> DataFrame:
    """A1: per session the mean of ``((t2 - t1) + (t2 - t3)) / 2`` (µs), the
    sample count (failed rounds keep their samples) and the best round trip."""
    off = ((F.col("t2") - F.col("t1")) + (F.col("t2") - F.col("t3"))) / 2
    return samples.groupBy(session).agg(F.count(F.lit(1)).alias("n_samples"), F.avg(off).alias("offset_us"),
                                        F.min(F.col("t3") - F.col("t1")).alias("min_rtt_us"))


def observation_latency(obs: DataFrame, offsets: DataFrame | None = None, job: str = "job_id",
                        state_ts: str = "state_ts_us", recv: str = "recv_us") -> DataFrame:
    """A2: ``receive - state timestamp`` per observation, then per job count /
    mean / max. With ``offsets(session, offset_us)`` (from A1, session = job)
    the robot clock is first moved onto the client clock (``+ offset``)."""
    o = obs.filter(F.col(state_ts).isNotNull())
    lat = F.col(recv) - F.col(state_ts)
    per = o.groupBy(job).agg(F.count(F.lit(1)).alias("n_obs"), F.avg(lat).alias("avg_latency_us"),
                             F.max(lat).cast("double").alias("max_latency_us"))
    if offsets is None:
        return per
    # one offset per job: it moves mean and maximum alike, so it joins the aggregate, not the observations
    off = offsets.select(F.col("session").alias(job), F.col("offset_us").alias("__off"))
    moved = [(F.col(c) + F.coalesce(F.col("__off"), F.lit(0.0))).alias(c) for c in ("avg_latency_us", "max_latency_us")]
    return per.join(off, job, "left").select(job, "n_obs", *moved)
