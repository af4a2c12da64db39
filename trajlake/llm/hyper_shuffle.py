"""Uniform shuffle into shards of exact size through a hypergeometric communication matrix.

Partition ``p`` holds ``n_p`` rows and shard ``s`` takes ``c_s`` rows. A uniform
permutation of all rows sends a multivariate hypergeometric number of rows from
each partition to each shard, so the driver draws that matrix (partitions by
shards, counts only), each partition orders its rows by a keyed hash and cuts
that order by its row of the matrix, the rows are exchanged, and each shard
orders what it got by a second, independent keyed hash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.llm.shared import free_name, stage, with_uid

#: Rows that one block of a shard holds at the most on average while slots are dealt.
BLOCK_ROWS = 200_000
#: Populations that numpy's own generator draws from.
_NUMPY_LIMIT = 500_000_000
#: Top bits of a row's second key choose its block.
_KEY_BITS = 62


def draw_matrix(rows: list[int], capacity: list[int], seed: int) -> np.ndarray:
    """Multivariate hypergeometric counts: row sums ``rows``, column sums ``capacity``."""
    rng = np.random.Generator(np.random.PCG64(seed))
    left = np.asarray(capacity, np.int64)
    out = np.zeros((len(rows), len(capacity)), np.int64)
    for i, n in enumerate(rows):
        # The shards are halved again and again; a univariate draw says how many rows go to the first half.
        stack = [(0, len(capacity), int(n))]
        while stack:
            lo, hi, m = stack.pop()
            if hi - lo == 1:
                out[i, lo] = m
                continue
            mid = (lo + hi) // 2
            x = _hypergeometric(rng, int(left[lo:mid].sum()), int(left[mid:hi].sum()), m)
            stack += [(lo, mid, x), (mid, hi, m - x)]
        left = left - out[i]
    return out


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """One exact draw: how many of ``n`` drawn rows are among ``good``, the others among ``bad``.

    numpy's generator takes populations below 1e9. In larger ones a binomial
    number is drawn and kept with the ratio of the two probabilities, which is
    the hypergeometric law itself, at any size; few draws are thrown away as
    long as ``n`` is a small part of the population.
    """
    total = good + bad
    if n == 0 or good == 0:
        return 0
    if bad == 0:
        return n
    if max(good, bad) < _NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, n))
    if 2 * n > total:
        return good - _hypergeometric(rng, good, bad, total - n)

    def ratio(x: int) -> float:
        """Log of hypergeometric over binomial probability, but for a constant."""
        return _log_falling(good, x) + _log_falling(bad, n - x)

    top = ratio(min(max(-(-(n - 1) * good // total), n - bad, 0), good, n))   # where the ratio is largest
    while True:
        x = int(rng.binomial(n, good / total))
        if x <= good and n - x <= bad and np.log1p(-rng.random()) <= ratio(x) - top:
            return x


def _log_falling(total: int, k: int) -> float:
    """log of the product of 1 - i / total for i < k."""
    if k <= 1_000 or total - k <= 1_000:
        return float(np.log1p(-np.arange(k) / total).sum())
    return -((total - k + 0.5) * np.log1p(-k / total) + k) + (1 / total - 1 / (total - k)) / 12


def _hash(seed: int, *cols: Column) -> Column:
    return F.xxhash64(F.lit(seed), *cols)


def shuffle_shards(rows: DataFrame, n_shards: int, identity: list[str], seed: int = 17,
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Deal the rows of ``rows`` into ``n_shards`` shards by a uniform random permutation.

    Adds ``shard`` (0 to ``n_shards`` - 1) and ``slot`` (0, 1, ... without gaps
    inside a shard). Shard sizes differ by one row at most; the first shards
    hold the larger ones. The draw depends on ``seed``, on the ``identity``
    columns of each row and on how the input is split into partitions.

    ``rows`` should be narrow (ids and digests): it is staged once, so that the
    partition numbers behind the matrix can't change when a task is run again.
    Names ``_part``, ``_uid``, ``_key``, ``shard`` and ``slot`` are replaced if present.

    Edge cases: an empty input gives an empty result; with fewer rows than
    shards the last shards are empty; rows with equal or null identity are
    told apart by their place in the scan and never lost or joined together.
    """
    spark = rows.sparkSession
    keep = [c for c in rows.columns if c not in ("_part", "_uid", "_key", "_skey", "_n", "shard", "slot")]
    base = stage(with_uid(rows.select(*keep), "_uid")
                 .withColumn("_part", F.spark_partition_id())
                 # the place too: rows with equal identity are as far apart as any others
                 .withColumn("_key", _hash(seed, *identity, "_uid"))
                 .withColumn("_skey", _hash(seed + 1, *identity, "_uid")))
    sizes = {r["_part"]: r["n"] for r in base.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    parts = sorted(sizes)
    total = sum(sizes.values())
    capacity = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    matrix = draw_matrix([sizes[p] for p in parts], capacity, seed)
    # Cut points of each partition's own order; one row per partition.
    ends = np.cumsum(matrix, axis=1)
    cuts = spark.createDataFrame([(int(p), [int(x) for x in e]) for p, e in zip(parts, ends, strict=True)],
                                 "_part int, _ends array<bigint>")
    own = Window.partitionBy("_part").orderBy("_key", *identity, "_uid")
    dealt = (base.withColumn("_n", F.row_number().over(own))
             .join(F.broadcast(cuts) if len(parts) <= 20_000 else cuts, "_part")
             .withColumn("shard", F.size(F.filter("_ends", lambda e: e < F.col("_n"))).cast("int"))
             .drop("_ends", "_n", "_part", "_key"))
    return _slots(dealt, n_shards, max(1, -(-total // (n_shards * block_rows))), identity).select(*keep, "shard", "slot")


def _slots(dealt: DataFrame, n_shards: int, blocks: int, identity: list[str]) -> DataFrame:
    """Number the rows of each shard in the order of their second key, block by block."""
    width = (1 << _KEY_BITS) // blocks + 1
    dealt = stage(dealt.withColumn("_block", F.expr(f"shiftrightunsigned(_skey, {64 - _KEY_BITS}) div {width}").cast("long")))
    count = dealt.groupBy("shard", "_block").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    start = count.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    inside = Window.partitionBy("shard", "_block").orderBy("_skey", *identity, "_uid")
    return (dealt.withColumn("_at", F.row_number().over(inside) - 1)
            .join(start, ["shard", "_block"])
            .withColumn("slot", (F.col("_start") + F.col("_at")).cast("long"))
            .drop("_start", "_at", "_block", "_skey", "_uid"))


def shard_documents(docs: DataFrame, n_shards: int, seed: int = 17) -> DataFrame:
    """Shard a table of documents: doc_id, size, text_crc32, shard, slot.

    ``size`` is the UTF-8 bytes of the text (null: none) plus 8 and
    ``text_crc32`` the unsigned CRC-32 of those bytes (null: of none). Only
    these digests move; ``attach_shards`` puts the numbers back on whole rows.
    """
    raw = F.coalesce(F.encode("text", "UTF-8"), F.lit(b"").cast("binary"))
    rows = docs.select("doc_id", (F.length(raw) + 8).cast("long").alias("size"), F.crc32(raw).cast("long").alias("text_crc32"))
    return shuffle_shards(rows, n_shards, ["doc_id", "text_crc32", "size"], seed)


def attach_shards(docs: DataFrame, n_shards: int, seed: int = 17) -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` added (replacing columns of those names).

    ``docs`` has to be a table scan, as rows are matched by their place in it.
    """
    docs = docs.drop("shard", "slot")
    uid = free_name(docs, "_doc_uid")
    whole = with_uid(docs, uid)
    digest = F.xxhash64(F.col("doc_id"), F.col("text"))
    dealt = shuffle_shards(whole.select(F.col(uid).alias("_doc_uid"), digest.alias("_digest")), n_shards, ["_digest"], seed)
    return whole.join(dealt.select(F.col("_doc_uid").alias(uid), "shard", "slot"), uid).drop(uid)
