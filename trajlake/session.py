"""Session construction for tests, the bench and local runs.

On a cluster the session comes from the platform; only the options that the
operators rely on (UTC session zone, AQE) are asserted there. The checkpoint
folder is the one that the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def get_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "trajlake",
                checkpoint: str | None = None) -> SparkSession:
    """Local session: UTC zone, AQE with skew-join and coalescing, UI off; ``checkpoint`` names the shared folder."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", os.environ.get("TRAJLAKE_MIN_PARTITION", "1MB"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TRAJLAKE_DRIVER_MEMORY", "8g"))
    )
    if checkpoint:
        builder = builder.config("spark.checkpoint.dir", checkpoint)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a scratch folder where none is named on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")
        folder = tempfile.mkdtemp(prefix="trajlake-checkpoints-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder
