"""Embedding near-dedup by Euclidean p-stable hashing with exact cosine checks.

Normalised vectors with cosine ``c`` lie ``sqrt(2 - 2c)`` apart. A table hashes
a vector by ``FUNCTIONS`` quantised Gaussian projections ``floor((a.v + b) / w)``;
vectors of one label that share all of them share a bucket. Pairs in a bucket
are checked by cosine in double precision and counted in the first table where
they meet, so no list of pairs is built up.

Equal vectors are one row with a number of copies. A bucket beyond ``BLOCK``
vectors is cut into blocks, and each pair of its blocks is a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.components import connected_components
from trajlake.llm.shared import join_to_groups, stage, with_uid

TABLES = 24
FUNCTIONS = 8
#: Bucket width in units of the largest distance that has to be found.
WIDTH = 4.0
BLOCK = 2048
SEED = 97


def _projections(dim: int, tables: int, functions: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64([seed, dim]))
    return rng.standard_normal((dim, tables * functions)), rng.uniform(0, width, tables * functions)


def _mix(cells: np.ndarray) -> np.ndarray:
    """One 64-bit hash of each row of integers."""
    h = np.full(cells.shape[:-1], 0x9E3779B97F4A7C15, np.uint64)
    for k in range(cells.shape[-1]):
        h = (h ^ cells[..., k].astype(np.int64).view(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def _valid(vector: list | None) -> bool:
    if not vector or any(x is None for x in vector):
        return False
    v = np.asarray(vector, np.float64)
    return bool(np.isfinite(v).all() and np.any(v != 0))


def _sign(batches: Iterator[pa.RecordBatch], tables: int, functions: int, width: float, seed: int) -> Iterator[pa.RecordBatch]:
    """Bucket hashes of each vector in all tables."""
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        vectors = batch.column("v")
        at = np.asarray(vectors.offsets)
        flat = np.asarray(vectors.values.to_numpy(zero_copy_only=False), np.float64)
        sizes = np.diff(at)
        out = np.zeros((batch.num_rows, tables), np.int64)
        for dim in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == dim)
            v = flat[at[rows][:, None] + np.arange(dim)]
            v = v / np.abs(v).max(1, keepdims=True)
            v /= np.sqrt((v * v).sum(1, keepdims=True))
            a, b = known.setdefault(dim, _projections(dim, tables, functions, width, seed))
            cells = np.floor((v @ a + b) / width).astype(np.int64).reshape(len(rows), tables, functions)
            out[rows] = _mix(cells)
        sig = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * tables, pa.int32()), pa.array(out.ravel()))
        yield pa.RecordBatch.from_arrays([*batch.columns, sig], [*batch.schema.names, "sig"])


def _matrix(column: pa.ListArray, kind: type) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), kind).reshape(len(column), -1)


def _check(table: pa.Table, cosine: float) -> pa.Table:
    """Links inside one bucket, or between two of its blocks: other copies for each vector, and edges that span them."""
    t = int(table.column("t")[0].as_py())
    rep = table.column("rep").to_numpy()
    side = table.column("side").to_numpy()
    copies = table.column("copies").to_numpy()
    v = _matrix(table.column("v").combine_chunks(), np.float64)
    sig = _matrix(table.column("sig").combine_chunks(), np.int64)
    v = v / np.abs(v).max(1, keepdims=True)   # no overflow in the norm
    norm = np.sqrt((v * v).sum(1))
    links = np.zeros(len(rep), np.int64)
    parent = np.arange(len(rep))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    own = side.max() == side.min()
    left = np.arange(len(rep)) if own else np.flatnonzero(side == 0)
    right = left if own else np.flatnonzero(side == 1)
    for i in range(0, len(left), 512):
        a = left[i:i + 512]
        for j in range(i if own else 0, len(right), 512):
            b = right[j:j + 512]
            near = (v[a] @ v[b].T) / (norm[a][:, None] * norm[b][None, :]) >= cosine
            if own and j == i:
                near = np.triu(near, 1)
            x, y = np.nonzero(near)
            x, y = a[x], b[y]
            first = np.ones(len(x), bool)
            for k in range(t):   # met in an earlier table: counted there
                first &= sig[x, k] != sig[y, k]
            x, y = x[first], y[first]
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            for p, q in zip(x.tolist(), y.tolist(), strict=True):
                p, q = find(p), find(q)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    edges.append((p, q))
    hit = np.flatnonzero(links)
    e = np.array(edges, np.int64).reshape(-1, 2)
    return pa.table({
        "a": pa.array(np.concatenate([rep[hit], rep[e[:, 0]]]), pa.int64()),
        "b": pa.array([None] * len(hit) + rep[e[:, 1]].tolist(), pa.int64()),
        "n": pa.array(links[hit].tolist() + [None] * len(e), pa.int64())})


def near_vectors(vectors: DataFrame, cosine: float = 0.98, tables: int = TABLES, functions: int = FUNCTIONS,
                 width: float = WIDTH, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """Vectors (vec_id, embedding, label) linked at ``cosine`` or more within their label.

    Returns one row for each input row: vec_id, n_links (other rows linked
    directly), component_id (smallest vec_id reachable) and kept (vec_id equals
    component_id). No pair below ``cosine`` is linked. At the defaults a pair
    just at the threshold shares a bucket in some table with a chance of 98%;
    closer pairs more often.

    Edge cases: a null or empty vector, one of zeros only, or with a null, NaN or
    infinite component links with nothing, and neither does a vector without a
    label; vectors of different lengths never link; equal vectors of one label
    link with each other, whatever their number; repeated or null vec_ids stay
    rows of their own (a component of null ids only has a null component_id); an
    empty table gives an empty result.
    """
    spark = vectors.sparkSession
    distance = float(np.sqrt(2 - 2 * cosine))
    base = with_uid(vectors, "uid").select(
        "uid", F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"))
    fine = F.coalesce(F.col("label").isNotNull() & (F.size("v") > 0)
                      & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
                      & F.exists("v", lambda x: x != 0), F.lit(False))
    base = stage(base.withColumn("fine", fine).withColumn("v", F.when(F.col("fine"), F.transform("v", lambda x: x + 0.0))))
    # Equal vectors of a label are one row, named by the first of them; the hash pair stands for the vector in later joins.
    key = [F.xxhash64("label", "v").alias("h1"), F.xxhash64(F.lit(seed), "v", "label").alias("h2")]
    rows = stage(base.select("uid", "vec_id", "fine", *key))
    classes = (base.where("fine").groupBy("label", "v").agg(F.min("uid").alias("rep"), F.min("vec_id").alias("first_id"), F.count("*").alias("copies")))
    classes = stage(classes.select("rep", "label", "v", "first_id", "copies", *key))
    signed = stage(classes.select("rep", F.col("copies"), "v", F.xxhash64("label").alias("lab"))
                   .mapInArrow(lambda b: _sign(b, tables, functions, width * distance, seed),
                               "rep long, copies long, v array<double>, lab long, sig array<bigint>"))
    placed = signed.select("rep", "lab", F.size("v").alias("dim"), F.posexplode("sig").alias("t", "cell"))
    place = ["lab", "dim", "t", "cell"]
    crowds = placed.groupBy(*place).agg(F.count("*").alias("n")).where("n > 1")
    # Blocks of a large bucket: each vector of block x meets the blocks y >= x, one task for each pair.
    n_blocks = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    met = (placed.join(crowds.withColumn("blocks", n_blocks).drop("n"), place)
           .withColumn("x", mine).withColumn("y", F.explode(F.expr("sequence(0, blocks - 1)")))
           .select("rep", *place, F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), (F.col("x") > F.col("y")).cast("int").alias("side")))
    whole = met.join(signed.select("rep", "copies", "v", "sig"), "rep")
    found = stage(whole.groupBy(*place, "x", "y").applyInArrow(lambda t: _check(t, cosine), "a long, b long, n long"))
    counts = found.where("n is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    roots = connected_components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "rep")
    classes = (classes.drop("v", "label").join(counts, "rep", "left").join(roots, "rep", "left")
               .withColumn("root", F.coalesce("root", "rep")).withColumn("n", F.coalesce("n", F.lit(0)) + F.col("copies") - 1))
    classes = stage(classes.select("h1", "h2", "root", "n", "first_id", "copies"))
    n_classes, n_rows = classes.agg(F.count("*"), F.coalesce(F.sum("copies"), F.lit(0))).first()
    ids = classes.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("members"))
    named = stage(join_to_groups(classes.drop("first_id"), ids, ["root"], "members", n_classes)
                  .select("h1", "h2", F.col("n").alias("n_links"), "component_id", "copies"))
    return (join_to_groups(rows.where("fine"), named, ["h1", "h2"], "copies", n_rows).select("vec_id", "n_links", "component_id")
            .unionByName(rows.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
