"""A hot key (one robot with most of the log) is spread over tasks by the chunked scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajlake.operators import motion as mo


def test_hot_robot_is_split_across_partitions(spark):
    prev = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        # robot "hot" owns 90% of 40,000 actions spread over 40 hours; 9 cold robots share the rest
        n = 40_000
        df = (spark.range(n).select(
            F.when(F.col("id") % 10 != 0, F.lit("hot")).otherwise(F.concat(F.lit("cold"), (F.col("id") % 9).cast("string")))
             .alias("robot"),
            F.col("id").cast("string").alias("request_id"), F.lit(0).alias("seq"),
            (F.col("id") * 3_600_000).alias("ts_us"), F.lit(1_000_000).cast("bigint").alias("period_us")))
        tl = mo.execution_timeline(df, chunk_us=3_600_000_000)
        # the outputs are used, so that the optimiser keeps the windows whose tasks are counted
        used = tl.filter((F.col("robot") == "hot") & F.col("g_us").isNotNull() & F.col("e_us").isNotNull())
        assert "Window" in used._jdf.queryExecution().executedPlan().toString()
        counts = used.groupBy(F.spark_partition_id().alias("pid")).agg(F.count("*").alias("count"), F.sum("e_us")).collect()
        per_task = sorted((r["count"] for r in counts), reverse=True)
        hot_rows = sum(per_task)
        assert hot_rows == 36_000
        # the hot robot's rows are spread over many tasks, none holding most of them
        assert len(per_task) >= 8 and per_task[0] < 0.35 * hot_rows
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)


def test_chunked_plan_shuffles_large_side_once(spark):
    prev = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("robot"), F.col("id").cast("string").alias("request_id"),
                                      F.lit(0).alias("seq"), (F.col("id") * 1000).alias("ts_us"),
                                      F.lit(10).cast("bigint").alias("period_us"))
        plan = mo.execution_timeline(df, chunk_us=3_600_000_000)._jdf.queryExecution().executedPlan().toString()
        exchanges = [ln for ln in plan.split("\n") if "Exchange hashpartitioning" in ln]
        # large side once on (key, chunk); summaries: final aggregate, chunk windows, join back
        assert len(exchanges) <= 4, plan
        # more levels shuffle summaries only: the rows' own columns move once for the rows, and once, narrowed, for the summaries
        deep = mo.execution_timeline(df, chunk_us=1_000)._jdf.queryExecution().executedPlan().toString()
        wide = [ln for i, ln in enumerate(deep.split("\n")) if "Exchange hashpartitioning" in ln and "request_id" in deep.split("\n")[i + 1]]
        assert len([ln for ln in wide if "Reused" not in ln]) <= 2, deep
        assert "coalesce(" not in plan.split("SortMergeJoin")[1].split("\n")[0]   # plain equi-join keys
        plain = mo.execution_timeline(df, chunk_us=None)._jdf.queryExecution().executedPlan().toString()
        assert sum("Exchange hashpartitioning" in ln for ln in plain.split("\n")) == 1
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)


def test_hot_job_is_split_across_partitions(spark):
    """One job with 90% of the polls: no task of the join with the starts holds most of them."""
    from trajlake.operators.scans import attach_by_chunk, with_chunk
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    prev = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        polls = spark.range(40_000).select(
            F.when(F.col("id") % 10 != 0, F.lit("hot")).otherwise(F.concat(F.lit("j"), F.col("id") % 9)).alias("job_id"),
            (F.col("id") * 3_600_000).alias("poll_ts_us"))
        starts = polls.groupBy("job_id").agg(F.min("poll_ts_us").alias("start_us"))
        log, ch = with_chunk(polls, "poll_ts_us", 3_600_000_000)
        got = attach_by_chunk(log, starts, "job_id", ch)
        per_task = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(per_task) == 40_000 and len(per_task) >= 8 and max(per_task) < 0.35 * 40_000
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)


def test_summaries_of_a_hot_key_are_spread_at_every_level(spark, monkeypatch):
    """One-row chunks, one robot with 90% of them: no window above the first level holds most summaries."""
    from trajlake.operators import scans

    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    prev = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(20_000).select(
            F.struct(F.when(F.col("id") % 10 != 0, F.lit("hot")).when(F.col("id") % 20 == 0, F.lit("cold")).alias("robot")).alias("k"),
            F.col("id").alias("chunk"), (F.col("id") * 7 % 11).alias("v"))
        got = scans.before_chunk(rows, "k", "chunk", {"s": ("sum", "v"), "m": ("max", "v"), "l": ("last", "v")}, levels=2, fanout_bits=6)
        plan = got._jdf.queryExecution().executedPlan().toString()
        # below the top, windows are dealt by (key, group of chunks); the top one reads one row for each 4,096 chunks
        windows = [ln for ln in plan.split("\n") if "Window [" in ln]
        assert len(windows) == 3 and sum("chunk_up" in ln.rsplit("], [", 2)[1] for ln in windows) == 2, plan
        per_task = [r["n"] for r in got.where("k.robot = 'hot'").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.sum("s")).collect()]
        assert sum(per_task) == 18_000 and max(per_task) < 0.2 * 18_000
        seen = {}
        for r in sorted(got.collect(), key=lambda r: r["chunk"]):
            s, m, last = seen.get(r["k"]["robot"], (0, None, None))
            assert (r["s"], r["m"], r["l"]) == (s, m, last)
            seen[r["k"]["robot"]] = (s + r["v"], r["v"] if m is None else max(m, r["v"]), r["v"])
        back = scans.before_chunk(rows, "k", "chunk", {"x": ("min", "v")}, levels=2, fanout_bits=6, reverse=True)
        seen = {}
        for r in sorted(back.collect(), key=lambda r: -r["chunk"]):
            assert r["x"] == seen.get(r["k"]["robot"])
            seen[r["k"]["robot"]] = min(r["v"], seen.get(r["k"]["robot"], r["v"]))
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)


def test_ticks_of_a_long_episode_are_made_by_many_tasks(spark):
    """Ten million ticks of one episode: blocks are dealt before the ticks are made."""
    from trajlake.operators import align as al

    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "10485760"}
    prev = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        streams = spark.range(7).select(F.lit(1).alias("episode"), F.lit("left").alias("arm"), F.col("id").alias("frame_idx"), (F.col("id") * 3).alias("x"))
        ticks = spark.createDataFrame([(1, 10_000_000)], "episode int, n_ticks long")
        got = al.cyclic_align(F.broadcast(streams), ticks)
        per = got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.sum("x").alias("x"), F.max("tick").alias("t")).collect()
        n = [r["n"] for r in per]
        assert sum(n) == 10_000_000 and len(n) >= 8 and max(n) < 0.35 * sum(n) and max(r["t"] for r in per) == 9_999_999
        assert sum(r["x"] for r in per) == sum((i % 7) * 3 for i in range(10_000_000))
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)
