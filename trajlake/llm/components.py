"""Connected components of a distributed edge list (alternating large star and small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.shared import join_to_groups, stage


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Every node sends its larger neighbours to the smallest of itself and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count("*").alias("n"))
    return (join_to_groups(both.where("b > a"), least, ["a"], "n", 2 * total)
            .select(F.col("m").alias("a"), "b").where("a <> b").distinct())


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """Every node sends its smaller neighbours, and itself, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("n"), F.least("a", "b").alias("s"))
    least = down.groupBy("n").agg(F.min("s").alias("m"), F.count("*").alias("k"))
    return (join_to_groups(down, least, ["n"], "k", total)
            .select(F.col("m").alias("a"), F.explode(F.array("s", "n")).alias("b")).where("a <> b").distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns a and b, of one ordered type): root is the smallest reachable node.

    Both star steps only ever move an edge towards a smaller node, the minima
    combine before they are shuffled, a hub's edges meet its minimum where they
    are, and each step ends in a reliable checkpoint. It stops once a round changes nothing, when every component is
    a star around its root. Null nodes and self loops are left out.
    """
    edges = stage(edges.select("a", "b").where("a is not null and b is not null and a <> b")
                  .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = mark(edges)
    while before[0]:
        total = before[0]   # a large star makes no more edges than it gets
        edges = stage(_small_star(stage(_large_star(edges, total)), total))
        now = mark(edges)
        if now == before:
            break
        before = now
    return (edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
            .unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()))
