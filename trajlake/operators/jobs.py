"""Job path: latest status (A3), collection rollup (A4), idle exit (W6),
ready queue (L1), bounded wait outcome (W8), run summary (A7), first device
assignment (A8) and observation skip reasons (P7).

Per-job results are aggregates (``groupBy`` with map-side partial
aggregation), not windows, wherever the semantics allow, so a hot job does
not pin one task. The only ordered scan (W6) goes through ``scans``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.operators.scans import attach_by_chunk, chunked_carry_last, chunked_running_sum, with_chunk
from trajlake.schemas import (ACTIVE_STATUSES, DEFAULT_IDLE_POLLS, DEFAULT_JOB_LIMIT_S, RC_EXCEPTION, RC_FAILURE,
                              RC_SUCCESS, RC_TIMEOUT, TERMINAL_STATUSES)

HOUR_US = 3_600_000_000


def poll_order(polls: DataFrame, ts: str) -> Column:
    """Order of polls: by time, then by ``poll_id`` where there is one."""
    return F.struct(F.col(ts), F.col("poll_id")) if "poll_id" in polls.columns else F.struct(F.col(ts))


def latest_job_status(polls: DataFrame, ts: str = "poll_ts_us") -> DataFrame:
    """A3: last polled status and device per job (records without a status are skipped)."""
    p = polls.filter(F.col("status").isNotNull())
    last = F.max_by(F.struct(F.col("status"), F.col("device.robot_id").alias("robot_id"), F.col(ts).alias("ts")),
                    poll_order(polls, ts))
    return (p.groupBy("job_id").agg(last.alias("__l"), F.count(F.lit(1)).alias("n_polls"))
            .select("job_id", F.col("__l.status").alias("status"), F.col("__l.robot_id").alias("robot_id"),
                    F.col("__l.ts").alias("last_poll_us"), "n_polls"))


def collection_rollup(collections: DataFrame) -> DataFrame:
    """A4: per poll of a collection, computed on the ``jobs`` array itself (no shuffle).

    ``has_active``: any job in assigned/prepare/ready/running; ``n_terminal``:
    finished/cancelled/failed; ``is_idle = not has_active and n_terminal = n_jobs``.
    An empty collection is idle; an unknown status is neither, so never idle.
    """
    active = F.array(*[F.lit(s) for s in ACTIVE_STATUSES])
    terminal = F.array(*[F.lit(s) for s in TERMINAL_STATUSES])
    jobs = F.coalesce(F.col("jobs"), F.array())
    has_active = F.exists(jobs, lambda j: F.array_contains(active, j["status"]))
    n_terminal = F.size(F.filter(jobs, lambda j: F.coalesce(F.array_contains(terminal, j["status"]), F.lit(False))))
    n_jobs = F.size(jobs)
    return (collections.withColumn("n_jobs", n_jobs.cast("int"))
            .withColumn("has_active", F.coalesce(has_active, F.lit(False)))
            .withColumn("n_terminal", n_terminal.cast("int"))
            .withColumn("is_idle", ~F.col("has_active") & (F.col("n_terminal") == F.col("n_jobs")))
            .drop("jobs"))


def idle_exit(rollup: DataFrame, n: int = DEFAULT_IDLE_POLLS, ts: str = "poll_ts_us",
              chunk_us: int | None = HOUR_US) -> DataFrame:
    """Per collection, the first poll at which ``n`` consecutive polls were idle.

    Run length at a poll = idle polls so far minus idle polls so far at the
    last non-idle poll (a non-idle poll resets the count). Both are prefix
    scans, done chunked. Returns ``collection_id, n_polls, exit_poll_id,
    exit_ts_us`` (null when the run never reaches ``n``).
    """
    order = [ts, "poll_id"]
    df = rollup.select("collection_id", "poll_id", ts, F.col("is_idle").cast("int").alias("__idle"))
    df, ch = with_chunk(df, ts, chunk_us, keys=["collection_id"])
    df = chunked_running_sum(df, ["collection_id"], ch, order, "__idle", "__c")
    df = df.withColumn("__reset", F.when(F.col("__idle") == 0, F.col("__c")))
    df = chunked_carry_last(df, ["collection_id"], ch, order, "__reset", "__l")
    df = df.withColumn("run", F.col("__c") - F.coalesce(F.col("__l"), F.lit(0)))
    first = F.min(F.when(F.col("run") >= n, F.struct(F.col(ts).alias("t"), F.col("poll_id").alias("p"))))
    return (df.groupBy("collection_id").agg(F.count(F.lit(1)).alias("n_polls"), first.alias("__x"))
            .select("collection_id", "n_polls", F.col("__x.p").alias("exit_poll_id"),
                    F.col("__x.t").alias("exit_ts_us")))


def ready_queue(flat_jobs: DataFrame, ordered: bool = False, ts: str = "poll_ts_us") -> DataFrame:
    """L1: jobs listed as ``ready``; processing order is ``(poll, pos)`` within a collection.

    By default no global sort is imposed (it would range-partition the whole
    output); ``ordered=True`` sorts by ``(collection_id, poll time, poll_id, pos)``."""
    out = flat_jobs.filter(F.col("status") == "ready")
    return out.orderBy("collection_id", ts, "poll_id", "pos") if ordered else out


def await_running_outcome(polls: DataFrame, starts: DataFrame, timeout_s: float = DEFAULT_JOB_LIMIT_S,
                          as_of_us: int | None = None, ts: str = "poll_ts_us",
                          chunk_us: int | None = HOUR_US) -> DataFrame:
    """Outcome code of waiting for a job to run after its start.

    Per job in ``starts(job_id, start_us)``, polls after the start and no later
    than ``start + timeout``: the first decisive one decides -- a failed poll
    (``poll_error``) gives 3; a status other than ``prepare`` gives 0 if
    ``running`` else 1; records without a status are ignored. No decisive poll
    within the limit gives 2. With ``as_of_us``, jobs still inside their
    window and undecided are left out (so a stream and a batch agree).
    Starts meet the polls on ``(job_id, chunk)``, so one job's polls are spread
    over its chunks, and the first decisive poll is combined per task.
    """
    lim = int(round(timeout_s * 1_000_000))
    p, ch = with_chunk(polls, ts, chunk_us)
    p = attach_by_chunk(p, starts.select("job_id", "start_us"), "job_id", ch)
    p = p.filter((F.col(ts) > F.col("start_us")) & (F.col(ts) <= F.col("start_us") + lim))
    decisive = F.col("poll_error") | (F.col("status").isNotNull() & (F.col("status") != "prepare"))
    first = (p.filter(decisive).groupBy("job_id")
             .agg(F.min_by(F.struct(F.col("poll_error").alias("err"), F.col("status").alias("st"),
                                    F.col(ts).alias("t")), poll_order(polls, ts)).alias("__f")))
    out = starts.select("job_id", "start_us").join(first, "job_id", "left")
    code = (F.when(F.col("__f").isNull(), F.lit(RC_TIMEOUT))
            .when(F.col("__f.err"), F.lit(RC_EXCEPTION))
            .when(F.col("__f.st") == "running", F.lit(RC_SUCCESS))
            .otherwise(F.lit(RC_FAILURE)))
    out = out.select("job_id", "start_us", code.alias("code"),
                     F.coalesce(F.col("__f.t"), F.col("start_us") + lim).alias("decided_us"),
                     F.col("__f.st").alias("status"))
    if as_of_us is not None:
        out = out.filter((F.col("code") != RC_TIMEOUT) | (F.col("decided_us") <= F.lit(int(as_of_us))))
    return out


def skip_reason(state: Column | str = "state", pending: Column | str = "pending_actions",
                state_ts: Column | str = "state_ts_us") -> Column:
    """Why an observation is not used for inference, first of
    ``no_state``, ``size_none``, ``not_normal``, ``pending`` (also when the count is
    null, which differs from 0); null when usable."""
    s = F.col(state) if isinstance(state, str) else state
    p = F.col(pending) if isinstance(pending, str) else pending
    t = F.col(state_ts) if isinstance(state_ts, str) else state_ts
    return (F.when(s.isNull() & t.isNull(), F.lit("no_state"))
            .when(s == "size_none", F.lit("size_none"))
            .when(s.isNull() | (s != "normal"), F.lit("not_normal"))   # present but no state: not normal
            .when(p.isNull() | (p != 0), F.lit("pending")))


def actionable_observations(obs: DataFrame) -> DataFrame:
    """Keep observations usable for inference; ``skip_reason`` is added before filtering."""
    return obs.withColumn("skip_reason", skip_reason()).filter(F.col("skip_reason").isNull())


def job_run_summary(run_log: DataFrame, starts: DataFrame, max_wait_s: float = DEFAULT_JOB_LIMIT_S,
                    ts: str = "poll_ts_us", chunk_us: int | None = HOUR_US) -> DataFrame:
    """One row per job run.

    A run exists when the job was ``ready`` and the start succeeded
    (``starts(job_id, start_us, start_ok)``). Each later poll is one loop
    turn, checked in this order: failed poll, missing status or missing device
    key (``has_device`` false; a null device is not missing) -> end ``exception``; status not running -> end ``not_running``; no observation ->
    skip; ``size_none`` -> end ``exception`` (the client calls a method it
    lacks); not normal / pending -> skip; else one inference, then end
    ``max_wait`` if more than ``max_wait_s`` passed since the start (tested
    only after a post). ``end_reason`` is null while the run is open. Starts
    and ends meet the polls on ``(job_id, chunk)``, so a hot job is spread.
    """
    lim = int(round(max_wait_s * 1_000_000))
    runs = starts.filter(F.col("start_ok")).select("job_id", "start_us")
    log, ch = with_chunk(run_log, ts, chunk_us)
    it = attach_by_chunk(log, runs, "job_id", ch).filter(F.col(ts) > F.col("start_us"))
    skip = skip_reason()
    infer = skip.isNull()
    no_device = ~F.col("has_device") if "has_device" in run_log.columns else F.lit(False)
    end = (F.when(F.col("poll_error") | F.col("status").isNull() | no_device, F.lit("exception"))
           .when(F.col("status") != "running", F.lit("not_running"))
           .when(skip == "size_none", F.lit("exception"))
           .when(infer & (F.col(ts) - F.col("start_us") > lim), F.lit("max_wait")))
    open_or_wait = F.col("__end").isNull() | (F.col("__end") == "max_wait")
    # a skip counts only in a turn that was not ended before the observation was used;
    # an inference happens in an open turn, and in the turn that then ends on max_wait
    it = (it.withColumn("__end", end)
          .withColumn("__skip", F.when(open_or_wait, skip))
          .withColumn("__infer", (F.col("__end").isNull() & infer) | (F.col("__end") == "max_wait")))
    ends = (it.filter(F.col("__end").isNotNull()).groupBy("job_id")
            .agg(F.min_by(F.struct(F.col(ts).alias("t"), F.col("__end").alias("r"), poll_order(run_log, ts).alias("turn")), poll_order(run_log, ts)).alias("__e")))
    ends = runs.select("job_id").join(ends, "job_id", "left")   # open runs keep all their turns
    it = attach_by_chunk(it, ends, "job_id", ch, log).filter(F.col("__e").isNull() | (poll_order(run_log, ts) <= F.col("__e.turn")))
    agg = it.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("n_iterations"),
        F.count_if(F.col("__infer")).alias("n_inferences"),
        F.count_if(F.col("__skip") == "no_state").alias("n_skip_no_state"),
        F.count_if(F.col("__skip") == "not_normal").alias("n_skip_not_normal"),
        F.count_if(F.col("__skip") == "pending").alias("n_skip_pending"),
        F.first("__e", ignorenulls=True).alias("__e"))
    out = runs.join(agg, "job_id", "left")
    return out.select("job_id", "start_us", F.col("__e.t").alias("end_us"),
                      *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in
                        ("n_iterations", "n_inferences", "n_skip_no_state", "n_skip_not_normal", "n_skip_pending")],
                      F.col("__e.r").alias("end_reason"))


def first_device_assignment(polls: DataFrame, ts: str = "poll_ts_us") -> DataFrame:
    """First poll that carries ``device.robot_id`` per job."""
    p = polls.filter(F.col("device.robot_id").isNotNull())
    return (p.groupBy("job_id").agg(F.min_by(F.col("device.robot_id"), poll_order(polls, ts)).alias("robot_id"),
                                    F.min(ts).alias("assigned_us")))
