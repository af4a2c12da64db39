"""Worker run-log text -> typed events.

Three layouts are accepted (the three logger formats in use):
``ts LEVEL:message``, ``[ts] LEVEL: message`` and ``ts LEVEL message`` with
``ts`` as ``yyyy-MM-dd HH:mm:ss,SSS``. Parsing is regex work inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.functions.timecols import micros
from trajlake.sources.episodes import number_lines

# The worker's message shapes, one pattern per kind (first match wins).
LINE_PATTERN = r"^\[?(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3})\]? ([A-Z]+):? ?(.*)$"
KIND_PATTERNS = [
    ("processing_job", r"^Processing job_id: ([^,]+), status: (\S+)$"),
    ("started", r"^Started robot(?:: |$)"),
    ("state_latency", r"^get_robot_state time: (-?[0-9.]+)$"),
    ("inference_result", r"^Inference result: "),
    ("max_wait", r"^Job (\S+) exceeded max wait time\.$"),
    ("error", r"^Error processing job ([^:\s]+): "),
    ("no_active_poll", r"^No active jobs, poll count: (\d+)$"),
    ("exit", r"^No new jobs after multiple checks, exiting\.$"),
    ("job_status", r"^Job id: ([^,]+), status: ([^,]+), remaining jobs: (\d+)$"),
]
JOB_ID_KINDS = {"processing_job": 1, "max_wait": 1, "error": 1, "job_status": 1}
STATUS_KINDS = {"processing_job": 2, "job_status": 2}


def _literal_prefix(pattern: str) -> str:
    """Literal text a ``^...`` pattern must start with (up to its first regex operator)."""
    out = []
    for ch in pattern[1:]:
        if ch in "\\.[](){}*+?|^$":
            break
        out.append(ch)
    return "".join(out)


def parse_run_log(df: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``ts_us, level, kind, job_id, status, latency_s, message``; lines
    that match no layout get ``kind = 'other'`` and null fields."""
    v = F.col(value)
    ts_txt = F.regexp_extract(v, LINE_PATTERN, 1)
    level = F.regexp_extract(v, LINE_PATTERN, 2)
    msg = F.regexp_extract(v, LINE_PATTERN, 3)
    out = (df.withColumn("__ts", ts_txt)
           .withColumn("__ok", F.col("__ts") != "")      # group 1 is empty only when the line does not match
           .withColumn("message", F.when(F.col("__ok"), msg))
           .withColumn("level", F.when(F.col("__ok"), level))
           .withColumn("ts_us", F.when(F.col("__ok"), micros(F.to_timestamp_ntz(F.col("__ts"),
                                                                                F.lit("yyyy-MM-dd HH:mm:ss,SSS"))))))
    m = F.col("message")
    kind = None
    for name, pat in KIND_PATTERNS:
        # the literal start of each pattern is a cheap pre-test before the regex
        test = m.startswith(_literal_prefix(pat)) & m.rlike(pat)
        kind = F.when(test, F.lit(name)) if kind is None else kind.when(test, F.lit(name))
    out = out.withColumn("kind", F.when(F.col("__ok"), kind.otherwise(F.lit("other"))).otherwise(F.lit("other")))
    pats = dict(KIND_PATTERNS)

    def field(groups: dict[str, int]):
        e = None
        for name, g in groups.items():
            x = F.regexp_extract(m, pats[name], g)
            e = F.when(F.col("kind") == name, x) if e is None else e.when(F.col("kind") == name, x)
        return e

    return (out.withColumn("job_id", field(JOB_ID_KINDS))
            .withColumn("status", field(STATUS_KINDS))
            .withColumn("latency_s", F.when(F.col("kind") == "state_latency",
                                            F.regexp_extract(m, pats["state_latency"], 1).cast("double")))
            .drop("__ok", "__ts"))


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """S7 on files: every line of the logs under ``path``, typed, with ``worker`` (the log's path) and ``line_no``.

    Files are read in splits whatever their size, and lines keep their exact 0-based number in the file.
    """
    lines = number_lines(spark, path)
    return parse_run_log(lines.select(F.col("path").alias("worker"), F.col("frame_idx").alias("line_no"), "value"))
