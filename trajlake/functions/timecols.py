"""Time conversions. Inside the library every instant is ``bigint`` microseconds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

US_PER_S = 1_000_000


def micros(col: Column | str) -> Column:
    """Timestamp (LTZ or NTZ) -> bigint microseconds since the epoch, zone-free.

    ``unix_micros`` refuses ``timestamp_ntz``; the difference to the NTZ epoch
    works for both and equals the wall-clock reading in UTC.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            c.cast("timestamp_ntz"))


def seconds_to_micros(col: Column | str) -> Column:
    """Float unix seconds -> bigint microseconds (rounded to the nearest µs)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c * F.lit(US_PER_S)).cast("bigint")


def time_chunk(us: Column | str, chunk_us: int) -> Column:
    """Bucket index of an instant. Used to split one key's ordered log into
    bounded pieces for the chunked scans in ``operators.scans``."""
    c = F.col(us) if isinstance(us, str) else us
    return F.floor(c / F.lit(int(chunk_us))).cast("bigint")
