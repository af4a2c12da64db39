"""Job runs read from a worker's log (A7 from S7).

The lines between the call of a job and the next line that only the outer loop
writes belong to that job, though most do not name it. Read as an automaton, a
line is a map of states (idle, called, started): a closing line maps every
state to one (called for a job found ready, else idle), ``started`` lifts called
to started, all others keep the state. A composition of such maps is known from
its last closing line and from whether a start follows it, so running aggregates
of line numbers compose them, chunk by chunk, and no log needs one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.operators.scans import chunked_prefix, with_chunk

#: Lines of a log that one window reads at the first level.
LOG_CHUNK_LINES = 65_536
#: Kinds (S7) after which no earlier run goes on.
CLOSING_KINDS = ["processing_job", "max_wait", "error", "no_active_poll", "exit", "job_status"]


def job_runs(log: DataFrame, worker: str = "worker", line_no: str = "line_no",
             chunk_lines: int | None = LOG_CHUNK_LINES) -> DataFrame:
    """One row per job run of each worker's log.

    ``log``: lines as ``parse_run_log`` types them, with ``worker`` (one log) and
    ``line_no`` (its order, unique in a log, at least 0). A run is called by a
    ``processing_job`` line with status ready and exists once ``started`` follows
    before the next closing line (later starts of the same call change nothing).
    State reads and inferences count from the start on. The next closing line
    ends the run: ``max_wait`` or ``exception`` if that line names its job,
    else ``not_running`` (the loop went on without a word). A run that the log
    breaks off has a null end. Lines of other kinds, wherever they stand, and
    lines without a number change nothing; a null worker is a log of its own.

    Returns ``worker, first_line, job_id, called_us, start_us, end_us,
    n_states, n_inferences, latency_s (sum over state reads), max_latency_s,
    end_reason``. An empty log has no runs.
    """
    closing = F.col("kind").isin(CLOSING_KINDS)
    lines = log.filter(F.col(line_no).isNotNull()).select(worker, line_no, "ts_us", "kind", "job_id", "status", "latency_s")
    lines, ch = with_chunk(lines, line_no, chunk_lines, keys=[worker])
    if ch:
        # dealt once as the scan wants them: its windows and its summary read the typed lines, and none is parsed twice
        lines = lines.repartition(F.col(f"__chunk_key_{worker}"), F.col(ch))
    lines = lines.withColumns({
        "__closes": F.coalesce(closing, F.lit(False)).cast("bigint"), "__closed": F.when(closing, F.col(line_no)),
        "__started": F.when(F.col("kind") == "started", F.col(line_no))})
    lines = chunked_prefix(lines, [worker], ch, [line_no], {
        "__call": ("sum", "__closes"), "__last_closed": ("max", "__closed"), "__last_started": ("max", "__started")})
    under_way = F.col("__last_started") > F.col("__last_closed")
    # a closing line opens the call that has its number and ends the one before it
    itself = F.struct(F.col("__call").alias("call"), F.lit(False).alias("ends"))
    earlier = F.struct((F.col("__call") - 1).alias("call"), F.lit(True).alias("ends"))
    parts = lines.select(worker, line_no, "ts_us", "kind", "job_id", "status", "latency_s", under_way.alias("__on"),
                         F.explode(F.when(closing, F.array(itself, earlier)).otherwise(F.array(itself))).alias("__part"))

    def only(cond: Column, value: Column | str) -> Column:
        return F.when(cond, F.col(value) if isinstance(value, str) else value)

    ends = F.col("__part.ends")
    calls = ~ends & (F.col("kind") == "processing_job") & (F.col("status") == "ready")
    read = ~ends & F.col("__on") & (F.col("kind") == "state_latency")
    line = F.struct(F.col(line_no).alias("line"), F.col("ts_us").alias("us"), F.col("kind").alias("kind"), F.col("job_id").alias("job_id"))
    runs = parts.groupBy(worker, F.col("__part.call").alias("__call")).agg(
        F.max(only(calls, line)).alias("__from"),
        F.min(only(~ends & (F.col("kind") == "started"), line)).alias("__start"),
        F.max(only(ends, line)).alias("__end"),
        F.count_if(read).alias("n_states"),
        F.count_if(~ends & F.col("__on") & (F.col("kind") == "inference_result")).alias("n_inferences"),
        # whole µs, so that the sum does not depend on the order of the lines
        (F.sum(only(read, F.round(F.col("latency_s") * 1e6).cast("bigint"))) / 1e6).alias("latency_s"),
        F.max(only(read, "latency_s")).alias("max_latency_s"))
    same_job = F.col("__end.job_id") == F.col("__from.job_id")
    reason = (F.when(F.col("__end").isNull(), F.lit(None).cast("string"))
              .when(same_job & (F.col("__end.kind") == "max_wait"), F.lit("max_wait"))
              .when(same_job & (F.col("__end.kind") == "error"), F.lit("exception"))
              .otherwise(F.lit("not_running")))
    return runs.filter(F.col("__from").isNotNull() & F.col("__start").isNotNull()).select(
        worker, F.col("__from.line").alias("first_line"), F.col("__from.job_id").alias("job_id"), F.col("__from.us").alias("called_us"),
        F.col("__start.us").alias("start_us"), F.col("__end.us").alias("end_us"), "n_states", "n_inferences",
        "latency_s", "max_latency_s", reason.alias("end_reason"))
