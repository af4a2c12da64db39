"""Job-collection bodies (``{"jobs": [...]}``) -> one row per job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.schemas import JOB_COLLECTION_SCHEMA


def parse_job_collection(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Parse the JSON body with the declared schema (no inference) into ``jobs``."""
    return df.withColumn("jobs", F.from_json(F.col(payload), JOB_COLLECTION_SCHEMA)["jobs"]).drop(payload)


def flatten_job_collection(df: DataFrame, payload: str | None = "payload") -> DataFrame:
    """One row per listed job: ``pos`` (order in the collection), ``job_id``,
    ``status``, ``robot_id`` (from ``device.robot_id``). Other columns are kept.
    An empty collection yields no rows. Accepts raw JSON (``payload``) or an
    already parsed ``jobs`` array (``payload=None``)."""
    parsed = parse_job_collection(df, payload) if payload else df
    # posexplode_outer + filter on the generated ordinal: the inner generator would make
    # Catalyst infer ``size(jobs) > 0`` and push it below the projection that builds
    # ``jobs``, evaluating that expression twice per row.
    ex = (parsed.select("*", F.posexplode_outer("jobs").alias("pos", "__job")).drop("jobs")
          .filter(F.col("pos").isNotNull()))
    return (ex.withColumn("job_id", F.col("__job.job_id"))
            .withColumn("status", F.col("__job.status"))
            .withColumn("robot_id", F.col("__job.device.robot_id"))
            .drop("__job"))
