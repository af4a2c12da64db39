"""Rows met with a row of their group, whatever a group's share of all rows."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajlake.llm import components, shared


@pytest.mark.parametrize("few", [0, 3, 10**6])
def test_join_to_groups_equals_a_plain_join(spark, monkeypatch, few):
    """All groups large, some, or none; null keys, groups without rows, repeated rows, two key columns."""
    monkeypatch.setattr(shared, "LARGE_ROWS", few)
    rows = spark.createDataFrame([(k, j, i % 5) for i, (k, j) in enumerate([("a", 1)] * 40 + [("b", 1), ("b", 2), ("a", 2), (None, 1), ("a", None)])],
                                 "k string, j long, v long")
    groups = spark.createDataFrame([("a", 1, 40, "x"), ("b", 1, 1, None), ("b", 2, 1, "y"), ("c", 1, 0, "z"), (None, 1, 1, "n")],
                                   "k string, j long, size long, w string")
    got = shared.join_to_groups(rows, groups, ["k", "j"], "size", 45)
    want = rows.join(groups.drop("size"), ["k", "j"])
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    assert shared.join_to_groups(rows.limit(0), groups.limit(0), ["k", "j"], "size", 0).count() == 0


def test_rows_of_a_large_group_stay_where_they_are(spark):
    """A third of all rows under one key: no shuffled task holds them."""
    n, parts = 60_000, 40
    rows = spark.range(0, n, 1, parts).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    groups = rows.groupBy("k").agg(F.count("*").alias("size"), F.max("id").alias("last"))
    met = shared.join_to_groups(rows, groups, ["k"], "size", n)
    found = met.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.count("*").alias("n"), F.max("last"),
                                                                                F.sum((F.col("k") == 0).cast("int")).alias("of_key")).collect()
    assert sum(r["n"] for r in found) == n and sum(r["of_key"] for r in found) == n // 3
    assert max(r["of_key"] for r in found) <= n // 3 // parts + 1


@pytest.mark.parametrize("seed", range(2))
def test_components_with_large_hubs(spark, monkeypatch, seed):
    monkeypatch.setattr(shared, "LARGE_ROWS", 4)
    rng = np.random.default_rng(seed)
    edges = [(0, i) for i in range(1, 60)] + [(200 - i, 200) for i in range(30)] + [tuple(map(int, rng.integers(300, 400, 2))) for _ in range(60)]
    root = {v: v for e in edges for v in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {v for a, b in edges if a != b for v in (a, b)}
    assert got == {v: r for v, r in root.items() if v in linked}
