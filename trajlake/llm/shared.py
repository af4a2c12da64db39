"""Helpers used by several operators: row ids, shared storage, Arrow batches."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as every contract on words defines it.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_uid(df: DataFrame, name: str = "uid") -> DataFrame:
    """Add a unique id per row, so that rows with equal or null keys stay apart.

    The id is the row's place in the scan. A table scan (or a checkpoint) yields
    the same ids whenever it is read again in the session, also by a retried
    task; a frame that a shuffle produced has to be staged first.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores in front as keep it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a scratch one only where none is set."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root or tempfile.mkdtemp(prefix="trajlake-shared-"))
    return root or sc.getCheckpointDir()


def stage(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_stage(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/trajlake-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A key with more than this share of all rows, and more than this many, is a large one: there are at most 10,000 of them.
LARGE_SHARE, LARGE_ROWS = 1e-4, 1000


def join_to_groups(rows: DataFrame, groups: DataFrame, key: list[str], size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``groups`` (one row for each ``key``, with the number of its rows in ``size``), whatever a key's share.

    ``total`` is the sum of ``size`` (a bound will do). Large groups, at most
    10,000 as their sizes add up to ``total``, are broadcast, so their rows stay
    where they are; the others meet by shuffle, so a task gets no more than a
    10,000th of all rows (or 1,000) by one key. Rows with a null key drop out.
    """
    bound = max(LARGE_ROWS, int(total * LARGE_SHARE))
    large = groups.where(F.col(size) > bound).drop(size)
    small = groups.where(F.col(size) <= bound).drop(size)
    return (rows.join(F.broadcast(large), key)
            .unionByName(rows.join(F.broadcast(large.select(*key)), key, "left_anti").join(small, key)))


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (int64, one more than rows) of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def spans(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each (one row at least)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def one_thread() -> None:
    """Task code runs beside other tasks: no thread pools inside a worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    pa.set_cpu_count(1)
