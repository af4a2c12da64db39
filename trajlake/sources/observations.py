"""Observations as plain JSON (nested lists/maps serialised by Spark)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OBSERVATION_JSON_SCHEMA = T.StructType([
    T.StructField("state", T.StringType(), True),
    T.StructField("timestamp_us", T.LongType(), True),
    T.StructField("pending_actions", T.IntegerType(), True),
    T.StructField("action", T.ArrayType(T.DoubleType()), True),
])


def serialize_observation(df: DataFrame, cols: tuple[str, ...] = ("state", "timestamp_us", "pending_actions", "action"),
                          out: str = "json") -> DataFrame:
    """Nested observation fields -> one JSON text column (arrays and maps included)."""
    return df.withColumn(out, F.to_json(F.struct(*[F.col(c) for c in cols])))


def deserialize_observation(df: DataFrame, col: str = "json", schema: T.StructType = OBSERVATION_JSON_SCHEMA) -> DataFrame:
    """Inverse of ``serialize_observation`` with a declared schema."""
    return df.withColumn("__o", F.from_json(F.col(col), schema)).select("*", "__o.*").drop("__o")
