"""Cutting lineage for work that reads one result several times."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the session's ``spark.checkpoint.dir``.

    The folder must be shared storage named by the cluster; it is never made
    up here.
    """
    df.sparkSession.sparkContext.setCheckpointDir(_shared_folder(df))
    return df.checkpoint(eager=True)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage like ``cut_lineage``, by a Parquet table in that folder: later reads take only the columns they use."""
    path = f"{_shared_folder(df).rstrip('/')}/trajlake-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _shared_folder(df: DataFrame) -> str:
    folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    return folder
