"""SimHash near-dedup with bit-sliced comparison.

Distinct fingerprints meet in buckets: of four 16-bit pieces, two fingerprints
within two bits agree in at least two, so each fingerprint joins one bucket for
every pair of pieces. A bucket's fingerprints are stored as bit planes, plane
``j`` holding bit ``j`` of all lanes in one integer. Shifting the planes by
``s`` lanes sets every fingerprint against the one ``s`` places on, a
carry-save counter (ones, twos, more) adds up the differing bits of all lanes at
once, and a block of lanes is abandoned as soon as all its counters exceed the
radius.

A bucket beyond ``BUCKET`` fingerprints is not compared but linked through the
words one bit away: two fingerprints lie within two bits exactly if they share
such a word (or lie there themselves), and at most 65 fingerprints share one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.components import connected_components
from trajlake.llm.shared import free_name, join_to_groups, stage, text_arrays, with_uid

BITS = 64
SHINGLE = 3
RADIUS = 2
#: Fingerprints that a bucket compares; larger buckets go by shared neighbours.
BUCKET = 4096
#: Lanes in a block: few enough that a block is soon abandoned.
LANES = 1024

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of UTF-8 ``text``: a bit is set if more than half of the shingles' XXH64 (seed 42) have it."""
    words = text.translate(_LOWER).split()   # splits at the six ASCII white space characters
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    else:
        line = b" ".join(words)
        at = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=at[1:])
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(line[a:b], 42) for a, b in zip(at[:-shingle].tolist(), (at[shingle:] - 1).tolist(), strict=True)], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[i:i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    out = 0
    for j in np.flatnonzero(ones * 2 > len(hashes)).tolist():
        out |= 1 << j
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = text_arrays(batch.column("text"))
        raw = data.tobytes()
        got = np.array([fingerprint(raw[a:b], shingle) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("doc_id"), pa.array(got.view(np.int64), pa.int64())], ["uid", "doc_id", "fp"])


def _planes(values: np.ndarray) -> list[int]:
    """Bit planes of 64-bit values: lane ``i`` is bit ``i`` of each plane."""
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    return [int.from_bytes(p.tobytes(), "little") for p in packed]


def bit_sliced_links(values: np.ndarray, group: np.ndarray, radius: int = RADIUS, lanes: int = LANES) -> np.ndarray:
    """Pairs of places (i, j) with equal ``group`` (sorted) whose values differ in ``radius`` (0 to 2) bits at most.

    For each group a spanning set of its links comes out, not all of them: a
    pair is left out if earlier links of the group already connect it.
    """
    n = len(values)
    if n < 2:
        return np.zeros((0, 2), np.int64)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.concatenate([starts, [n]]))
    end = np.repeat(starts + size, size)             # first place after one's group
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found = []
    # Blocks overlap to the right by the longest shift that one of their lanes needs.
    for lo in range(0, n, lanes):
        hi = min(lo + lanes, n)
        reach = int((end[lo:hi] - np.arange(lo, hi)).max()) - 1   # longest shift inside a group
        if reach < 1:
            continue
        top = min(n, hi + reach)
        planes = _planes(values[lo:top])
        width = hi - lo
        room = end[lo:hi] - np.arange(lo, hi)                     # shifts below this stay in the group
        valid_at = np.sort(room)
        whole = (1 << width) - 1
        for s in range(1, reach + 1):
            if s >= valid_at[-1]:
                break
            alive = int.from_bytes(np.packbits(room > s, bitorder="little").tobytes(), "little") & whole
            ones = twos = more = 0
            for p in planes:
                diff = (p ^ (p >> s)) & alive
                carry = ones & diff
                ones ^= diff
                more |= twos & carry
                twos ^= carry
                over = more if radius == 2 else (more | twos if radius == 1 else more | twos | ones)
                if radius == 2:
                    over |= ones & twos
                if over == alive:
                    break
            else:
                near = alive & ~over
                while near:
                    low = near & -near
                    i = lo + low.bit_length() - 1
                    near ^= low
                    a, b = find(i), find(i + s)
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        found.append((i, i + s))
    return np.array(found, np.int64).reshape(-1, 2)


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of one partition sorted by bucket: buckets are cut off as they end, several small ones share the planes."""
    held_key, held_fp, rows = [], [], 0

    def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        ids = np.cumsum(np.concatenate([[True], keys[1:] != keys[:-1]]))
        at = bit_sliced_links(fps, ids, radius)
        return pa.RecordBatch.from_arrays([pa.array(fps[at[:, 0]].view(np.int64)), pa.array(fps[at[:, 1]].view(np.int64))], ["a", "b"])

    for batch in batches:
        held_key.append(batch.column("key").to_numpy())
        held_fp.append(batch.column("fp").to_numpy().view(np.uint64))
        rows += batch.num_rows
        if rows >= 8 * BUCKET:
            keys, fps = np.concatenate(held_key), np.concatenate(held_fp)
            cut = int(np.searchsorted(keys, keys[-1], "left"))   # the last bucket may go on
            if cut:
                yield links(keys[:cut], fps[:cut])
            held_key, held_fp, rows = [keys[cut:]], [fps[cut:]], len(keys) - cut
    if rows:
        yield links(np.concatenate(held_key), np.concatenate(held_fp))


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` between distinct 64-bit fingerprints (column ``fp``) that span all components at ``radius`` (2 at most)."""
    if not 0 <= radius <= 2:
        raise ValueError("four pieces, two of them equal, find differences of up to two bits")
    pieces = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    keys = F.array(*[F.lit(k << 32).bitwiseOR(F.shiftleft(pieces[i], 16)).bitwiseOR(pieces[j])
                     for k, (i, j) in enumerate(combinations(range(4), 2))])
    placed = fps.select("fp").withColumn("key", F.explode(keys))
    sizes = placed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    large = stage(sizes.where(F.col("n") > bucket).select("key"))
    small = placed.join(sizes.where(F.col("n") <= bucket).select("key"), "key")
    found = (small.repartition("key").sortWithinPartitions("key", "fp").select("key", "fp")
             .mapInArrow(lambda b: _compare(b, radius), "a long, b long"))
    if large.isEmpty():
        return found
    rest = placed.join(large, "key", "left_semi").select("fp").distinct()
    flips = F.expr(f"concat(array(fp), transform(sequence(0, {BITS - 1}), i -> fp ^ shiftleft(1L, i)))")
    near = rest.select("fp", F.explode(flips).alias("word"))
    if radius == 2:
        first = near.groupBy("word").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
        linked = near.join(first, "word").select("a", F.col("fp").alias("b"))
    else:   # a word one bit away, or none, that is a fingerprint itself
        linked = near.join(rest.select(F.col("fp").alias("a")), F.col("word") == F.col("a")).select("a", F.col("fp").alias("b"))
        linked = linked.where(F.lit(radius == 1))
    return found.unionByName(linked.where("a <> b"))


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """One row for each input row: uid (place in the scan), doc_id, fp, fingerprint (hex) and component_id.

    Words are runs of characters other than ASCII white space, in A-Z
    lower-cased text; shingles are ``shingle`` words, repeats included, joined by
    spaces; fewer words make one shingle of all. ``component_id`` is the
    smallest doc_id of a row whose fingerprint can be reached through links of
    ``radius`` differing bits at most.

    Edge cases: a null, empty or blank text has fingerprint zero and links like
    any other; equal fingerprints are compared once however many rows share
    them; rows with a null doc_id take part, and a group of them only has a
    null component_id; an empty table gives an empty result.
    """
    base = stage(with_uid(docs, "uid").select("uid", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                 .mapInArrow(lambda b: _fingerprints(b, shingle), "uid long, doc_id long, fp long"))
    classes = stage(base.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("rows")))
    roots = connected_components(fingerprint_links(classes, radius, bucket)).withColumnRenamed("node", "fp")
    classes = stage(classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    ids = classes.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("members"))
    n_classes, n_rows = classes.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    named = stage(join_to_groups(classes.select("fp", "root", "rows"), ids, ["root"], "members", n_classes))
    return (join_to_groups(base, named, ["fp"], "rows", n_rows)
            .select("uid", "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest doc_id (null last, then the first in the scan).

    ``docs`` has to be a table scan, as rows are matched by their place in it.
    """
    groups = simhash_groups(docs, shingle, radius)
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid")).alias("first"))
    uid = free_name(docs, "_uid")
    return with_uid(docs, uid).join(first.select(F.col("first.uid").alias(uid)), uid, "left_semi").drop(uid)
