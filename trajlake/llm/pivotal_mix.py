"""Mixing sources to target weights by pivotal dependent rounding (DataFrame functions only).

A source of ``W`` words with a target of ``T`` words takes every document
``T / W`` times on average. The whole part is certain; the fraction ``p`` is
rounded dependently: two documents exchange mass (``p`` times size, so the
words of the pair stay the same), in a random direction with the odds that keep
each expectation, until one fraction is 0 or 1. What is left of a block of
documents is one fractional document, and blocks meet in a reduction tree of
fixed arity until one fractional document is left in a source.

Documents above the mean size of their source go first. The words by which the
last one of them is rounded off are spread over the fractions of the smaller
ones, so that a source misses its target by less than a small document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.llm.shared import WORD, free_name, join_to_groups, stage, with_uid

#: Units that meet in one task of the tree; also the bound of every collected list.
ARITY = 64
#: Upper bounds of the size strata after the first, as shares of the source's mean size.
STRATA = (1.0, 0.25)
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2

_UNIT = "struct<uid:bigint,h:bigint,doc_id:bigint,size:bigint,base:int,w:double,p:double>"
_DONE = "struct<uid:bigint,doc_id:bigint,size:bigint,copies:int>"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Targets of sources from ``_src, source_size`` (one row per source): adds ``target``.

    Sources in the order of ``_src`` weigh ``weights`` in turn and share
    ``share`` times all words by weight. No target exceeds ``most`` times its
    source; what is cut is shared out again by weight until none is above. That
    fixed point is ``least(most * size, level * weight)``: sources are full in
    the order of ``size / weight``, and ``level`` follows from running sums.
    All sums are over one row per source.
    """
    order = Window.orderBy("_src")
    n = len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_i") % n + 1).cast("int"))
    s = sizes.withColumn("_i", F.row_number().over(order) - 1).withColumn("_w", weight).withColumn(
        "_cap", (F.col("source_size") * most).cast("double"))
    by_fill = Window.orderBy(F.col("_cap") / F.col("_w"), "_i").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = (s.withColumn("_goal", F.sum("source_size").over(everything) * F.lit(float(share)))
         .withColumn("_wsum", F.sum("_w").over(everything))
         .withColumn("_full", F.coalesce(F.sum("_cap").over(by_fill), F.lit(0.0)))
         .withColumn("_wfull", F.coalesce(F.sum("_w").over(by_fill), F.lit(0.0)))
         # The level if exactly the sources before this one are full.
         .withColumn("_level", (F.col("_goal") - F.col("_full")) / (F.col("_wsum") - F.col("_wfull"))))
    # The first source that is not full at its own level fixes the level of all.
    level = F.first(F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level")), ignorenulls=True).over(
        Window.orderBy(F.col("_cap") / F.col("_w"), "_i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    s = s.withColumn("_lev", level)
    return s.select("_src", "source_size",
                    F.coalesce(F.least(F.col("_cap"), F.col("_lev") * F.col("_w")), F.col("_cap")).alias("target"))


def _uniform(seed: int, *cols: Column) -> Column:
    """A number in [0, 1) from a keyed hash of ``cols``."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11).cast("double") / F.lit(float(1 << 53))


def _unit(u: Column, p: Column) -> Column:
    return F.struct(u["uid"].alias("uid"), u["h"].alias("h"), u["doc_id"].alias("doc_id"), u["size"].alias("size"), u["base"].alias("base"),
                    u["w"].alias("w"), F.greatest(F.least(p, F.lit(1.0)), F.lit(0.0)).alias("p"))


def _done(u: Column, more: Column) -> Column:
    return F.struct(u["uid"].alias("uid"), u["doc_id"].alias("doc_id"), u["size"].alias("size"),
                    (u["base"] + more).cast("int").alias("copies"))


def _settled(u: Column) -> Column:
    return (u["w"] <= 0) | (u["p"] <= 0) | (u["p"] >= 1)


def _rounded(u: Column) -> Column:
    return F.when((u["w"] > 0) & (u["p"] >= 1), F.lit(1)).otherwise(F.lit(0))


def _fold(units: Column, seed: int) -> Column:
    """Pivotal rounding along an array of units: ``out`` (settled documents) and ``cur`` (the one left, or null)."""
    zero = F.struct(F.lit(None).cast(_UNIT).alias("cur"), F.array().cast(f"array<{_DONE}>").alias("out"))

    def merge(acc: Column, b: Column) -> Column:
        a, out = acc["cur"], acc["out"]
        room_a, has_a = (1 - a["p"]) * a["w"], a["p"] * a["w"]
        room_b, has_b = (1 - b["p"]) * b["w"], b["p"] * b["w"]
        up, down = F.least(room_a, has_b), F.least(has_a, room_b)
        to_a = _uniform(seed, a["h"], b["h"]) * (up + down) < down
        a_settles = F.when(to_a, room_a <= has_b).otherwise(has_a <= room_b)
        rest_b = F.when(to_a, has_b - room_a).otherwise(has_b + has_a) / b["w"]
        rest_a = F.when(to_a, has_a + has_b).otherwise(has_a - room_b) / a["w"]
        settled = F.when(a_settles, _done(a, F.when(to_a, 1).otherwise(0))).otherwise(_done(b, F.when(to_a, 0).otherwise(1)))
        left = F.when(a_settles, _unit(b, rest_b)).otherwise(_unit(a, rest_a))
        state = lambda cur, done: F.struct(cur.alias("cur"), done.alias("out"))
        return (F.when(_settled(b), state(a, F.array_append(out, _done(b, _rounded(b)))))
                .when(a.isNull(), state(b, out))
                .when(_settled(a), state(b, F.array_append(out, _done(a, _rounded(a)))))
                .otherwise(state(left, F.array_append(out, settled))))

    return F.aggregate(units, zero, merge)


def _tree(units: DataFrame, total: int, arity: int, seed: int) -> tuple[list[DataFrame], DataFrame]:
    """Reduce ``_src, _pos, unit`` to one unit a source; settled documents by level, and the last units."""
    settled, level = [], 0
    while True:
        level += 1
        top = total <= arity
        met = (units.withColumn("_pos", F.floor(F.col("_pos") / arity).cast("long"))
               .groupBy("_src", "_pos")
               .agg(F.array_sort(F.collect_list(F.struct(F.col("_pos0").alias("at"), "unit"))).alias("units"))
               .withColumn("fold", _fold(F.transform("units", lambda x: x["unit"]), seed + level)))
        met = stage(met.select("_src", "_pos", "fold.out", "fold.cur"))
        settled.append(met.select("_src", F.explode("out").alias("d")).select("_src", "d.*"))
        units = met.where("cur is not null").select("_src", "_pos", F.col("_pos").alias("_pos0"), F.col("cur").alias("unit"))
        total = -(-total // arity)
        if top:
            return settled, units


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
                seed: int = 31, arity: int = ARITY) -> DataFrame:
    """Copies of each document in a mix whose sources come near their target words.

    ``docs`` has ``doc_id``, ``text`` and ``source``. Returns one row for each
    input row: uid (its place in the scan), doc_id, source, size, source_size,
    target, copies (0 to ``most``) and taken (``copies * size``). Every document
    of a source is taken ``target / source_size`` times in expectation.

    The blocks of the tree follow a global order by source, size stratum and a
    hash of id and text, so a rerun agrees whatever the layout of the files
    (rows equal in id and text may swap places). No list holds more than
    ``arity`` units, however large a source is.

    Edge cases: a null source is a source of its own, last in order; a null,
    empty or blank text has size 0, is taken 0 words and gets the whole part of
    its rate as copies; a source without words has target 0; an empty table
    gives an empty result; rows repeated under one id are rounded as separate
    documents.
    """
    base = stage(with_uid(docs, "uid").select(
        "uid", F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("_h")))
    # Null sorts last: a prefix keeps code point order and sets null apart.
    base = base.withColumn("_src", F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1")))
    targets = source_targets(base.groupBy("_src").agg(F.sum("size").alias("source_size")), weights, share, most)
    mean = base.groupBy("_src").agg(F.avg("size").alias("_mean"), F.count("*").alias("_docs"))
    sources = stage(targets.join(mean, "_src").withColumn(
        "_rate", F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)))

    stratum = sum((F.col("size") <= F.col("_mean") * b).cast("int") for b in STRATA)
    order = ["_src", "_stratum", "_h", "doc_id", "uid"]
    total = base.count()
    placed = (join_to_groups(base, sources.select("_src", "_mean", "_rate", "_docs"), ["_src"], "_docs", total).withColumn("_stratum", stratum)
              .drop("_mean").repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    placed = stage(placed)
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    parts = placed.groupBy("_part").agg(F.count("*").alias("_n")).withColumn("_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
    ranked = placed.join(parts, "_part").withColumn("_pos", F.col("_ahead") + F.col("_row"))
    base_copies = F.floor("_rate").cast("int")
    ranked = stage(ranked.select("_src", "_stratum", "_pos", "uid", F.col("_h").alias("h"), "doc_id", "size", base_copies.alias("base"),
                                 (F.col("_rate") - base_copies).alias("_p")))
    words = ranked.groupBy("_src", "_stratum").agg(F.sum("size").alias("_words"))

    found: list[DataFrame] = []
    carry = sources.select("_src", "_docs", F.lit(0.0).alias("_carry"))
    for k in range(len(STRATA) + 1):
        shift = F.when(F.col("_words") > 0, F.col("_carry") / F.col("_words")).otherwise(0.0)
        shifts = carry.join(words.where(F.col("_stratum") == k), "_src", "left").select("_src", "_docs", shift.alias("_shift"))
        p = F.col("_p") + F.col("_shift")
        units = (join_to_groups(ranked.where(F.col("_stratum") == k), shifts, ["_src"], "_docs", total)
                 .select("_src", "_pos", F.col("_pos").alias("_pos0"),
                         F.struct("uid", "h", "doc_id", "size", "base", F.col("size").cast("double").alias("w"),
                                  F.greatest(F.least(p, F.lit(1.0)), F.lit(0.0)).alias("p")).alias("unit")))
        settled, last = _tree(units, total, arity, seed + 100 * k)
        ended = stage(last.withColumn("_up", F.when(
            _settled(F.col("unit")), _rounded(F.col("unit"))).otherwise(
            (_uniform(seed + 7 + k, F.col("unit.h")) < F.col("unit.p")).cast("int"))))
        found += settled
        found.append(ended.select("_src", _done(F.col("unit"), F.col("_up")).alias("d")).select("_src", "d.*"))
        off = ended.select("_src", ((F.col("unit.p") - F.col("_up")) * F.col("unit.w")).alias("_off"))
        # Carry what this stratum could not place; a source without one here keeps its carry.
        here = words.where((F.col("_stratum") == k) & (F.col("_words") > 0)).select("_src", F.lit(True).alias("_here"))
        carry = stage(carry.join(off, "_src", "left").join(here, "_src", "left").select(
            "_src", "_docs", (F.when(F.col("_here").isNull(), F.col("_carry")).otherwise(0.0) + F.coalesce("_off", F.lit(0.0))).alias("_carry")))

    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    source = F.when(F.col("_src") == "1", F.lit(None)).otherwise(F.substring("_src", 2, 1 << 30))
    return join_to_groups(out, sources.select("_src", "source_size", "target", "_docs"), ["_src"], "_docs", total).select(
        "uid", "doc_id", source.alias("source"), "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every document repeated as often as the mix takes it (dropped at 0 copies).

    ``docs`` has to be a table scan, as rows are matched by their place in it.
    """
    uid, copies, again = (free_name(docs, n) for n in ("_uid", "_copies", "_again"))
    mixed = mix_sources(docs, **options).where("copies > 0").select(F.col("uid").alias(uid), F.col("copies").alias(copies))
    return (with_uid(docs, uid).join(mixed, uid)
            .withColumn(again, F.explode(F.sequence(F.lit(1), F.col(copies)))).drop(uid, copies, again))
