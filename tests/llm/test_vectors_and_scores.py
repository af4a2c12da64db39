"""Whitening, centroid clustering and language-model scores against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trajlake.llm import elias_fano, ngram_trie, pivot_clusters, spectrum_whiten
from trajlake.llm import queries as llm

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def vectors(spark):
    return [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]


def odd_vectors(d=64):
    """Nulls, non-finite and huge entries, other lengths, repeated rows and ids; one vector holds a third of the rows."""
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(d)]) for i in range(60)]
    common = [0.25] * d
    rows += [(100 + i, common) for i in range(30)]
    rows += [(5, rows[5][1]), (None, rows[6][1]), (None, common), (5, rows[7][1])]
    bad = [(200, None), (201, [None] * d), (202, [1.0] * (d - 1) + [None]), (203, [float("nan")] * d), (204, [float("inf")] + [0.0] * (d - 1)), (205, [1e300] + [0.0] * (d - 1))]
    return rows, bad


# ---------------------------------------------------------------- 11 whitening

def check_whitening(got, rows, d):
    """``got``: (vec_id, component, n, deviation, whitened, explained, identity_error) of ``rows`` of one length."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows], object)
    fit = sorted({tuple(r) for r in x})
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[float(c * n - t) / n for c, t in zip(r, s, strict=True)] for r in fit])
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1], turn[:, ::-1]
    k = min(16, int((values > 1e-9 * values[0]).sum()))
    assert {r[1] for r in got} == set(range(1, k + 1)) and len(got) == k * len(rows)
    assert {r[2] for r in got} == {n}
    want = Counter((v, sum((n * c - t) ** 2 for c, t in zip(r, s, strict=True))) for (v, _), r in zip(rows, x, strict=True))
    assert Counter((r[0], int(r[3])) for r in got if r[1] == 1) == want
    ours = np.array([[float(c * n - t) / n for c, t in zip(r, s, strict=True)] for r in x]) @ turn[:, :k] / np.sqrt(values[:k])
    for j in range(1, k + 1):
        mine = sorted((str(r[0]), abs(r[4])) for r in got if r[1] == j)
        theirs = sorted((str(v), abs(o)) for (v, _), o in zip(rows, ours[:, j - 1], strict=True))
        assert [a for a, _ in mine] == [a for a, _ in theirs]
        assert np.allclose(sorted(b for _, b in mine), sorted(b for _, b in theirs), atol=1e-6)
        assert np.allclose([r[5] for r in got if r[1] == j], values[j - 1] / values.sum(), rtol=1e-9)
    assert {r[6] for r in got}.pop() < 1e-9 and len({r[6] for r in got}) == 1


def test_whitening_query(spark):
    got = [tuple(r) for r in llm.op11_spectrum_whitening(spark, SF01).select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error").collect()]
    rows = vectors(spark)
    check_whitening(got, rows, 64)
    # one sign for all rows: the whitened covariance is the identity
    w = np.zeros((len(rows), 16))
    place = {v: i for i, (v, _) in enumerate(rows)}
    for r in got:
        w[place[r[0]], r[1] - 1] = r[4]
    _, first = np.unique(np.array([[math.floor(64 * c) for c in v] for _, v in rows]), axis=0, return_index=True)
    assert np.abs(w[first].T @ w[first] / len(first) - np.eye(16)).max() < 1e-9


def exploded(frame):
    return [(r["vec_id"], k + 1, r["n"], r["deviation"], w, e, r["identity_error"]) for r in frame.collect() for k, (w, e) in enumerate(zip(r["whitened"], r["explained"], strict=True))]


def test_whitening_odd_rows(spark):
    rows, bad = odd_vectors(20)
    frame = spark.createDataFrame([(*r, 7, 1.0) for r in rows + bad], "vec_id long, embedding array<double>, n int, whitened double").repartition(3)
    check_whitening(exploded(spectrum_whiten.whiten(frame)), rows, 20)


def test_whitening_lengths_and_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    none = spectrum_whiten.whiten(spark.createDataFrame([], schema))
    assert none.count() == 0 and none.columns == ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"]
    one = spectrum_whiten.whiten(spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [])], schema)).collect()
    assert [(r["n"], int(r["deviation"]), r["whitened"], r["identity_error"]) for r in one] == [(1, 0, [], 0.0)] * 2
    rng = np.random.default_rng(1)
    two = [(i, v) for i, v in enumerate(rng.normal(size=(30, 3)).tolist())]
    three = [(100 + i, v) for i, v in enumerate(rng.normal(size=(40, 5)).tolist())]
    both = spectrum_whiten.whiten(spark.createDataFrame(two + three, "vec_id long, embedding array<double>"))
    check_whitening(exploded(both.where("vec_id < 100")), two, 3)
    check_whitening(exploded(both.where("vec_id >= 100")), three, 5)
    # a large common offset and large entries lose nothing
    far = [(i, (1e9 + 1e3 * v).tolist()) for i, v in enumerate(rng.normal(size=(50, 4)))]
    check_whitening(exploded(spectrum_whiten.whiten(spark.createDataFrame(far, "vec_id long, embedding array<double>"))), far, 4)


@given(st.integers(1, 12), st.integers(0, 10 ** 6), st.sampled_from(["plain", "close", "equal", "low"]))
@settings(max_examples=60, deadline=None)
def test_slicing_finds_leading_eigenvalues(d, seed, kind):
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
    values = np.sort(rng.exponential(size=d))[::-1] * 10 ** rng.uniform(-3, 3)
    if kind == "close" and d > 2:
        values[1] = values[0] * (1 - 1e-7)
    if kind == "equal" and d > 3:
        values[1:4] = values[1]
    if kind == "low":
        values[d // 2 + 1:] = 0
    v = (turn * values) @ turn.T
    v = (v + v.T) / 2
    want = np.linalg.eigvalsh(v)[::-1]
    for s in [(want[i] + want[i + 1]) / 2 for i in range(d - 1) if want[i] - want[i + 1] > 1e-9 * want[0]]:
        assert spectrum_whiten.count_above(v, s) == (want > s).sum()
    found, vecs = spectrum_whiten.leading(v, 5)
    want = want[:5][want[:5] > 1e-10 * want[0]]
    assert np.allclose(found, want[:len(found)], rtol=0, atol=1e-12 * want[0]) and len(found) == len(want)
    assert np.abs(vecs @ v @ vecs.T - np.diag(found)).max() < 1e-8 * want[0]
    assert np.abs(vecs @ vecs.T - np.eye(len(found))).max() < 1e-6


def test_count_needs_two_by_two_pivots():
    assert spectrum_whiten.count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    assert spectrum_whiten.count_above(np.zeros((3, 3)), 0.0) == 0


# ---------------------------------------------------------------- 12 clusters

def brute_clusters(rows, clusters=16, rounds=3):
    kept = [(i, [math.floor(64 * c) for c in v]) for i, v in rows]
    first = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:clusters]
    cent = [v for _, v in first]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(cent))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for k, g in groups.items():
            cent[k] = [sum(c) // len(g) for c in zip(*g, strict=True)]
    at = [near(v) for _, v in kept]
    per = Counter()
    for d, k in at:
        per[k] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return Counter((i, k, d, per[k], sum(per.values()), sha[k]) for (i, _), (d, k) in zip(kept, at, strict=True))


def test_clusters_query(spark):
    got = llm.op12_ptolemaic_clusters(spark, SF01)
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(map(tuple, got.select(names).collect())) == brute_clusters(vectors(spark))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{SF01}/embeddings.parquet')")
    assert Counter(con.sql(f"select {', '.join(names)} from ({llm.ORACLE['op12_ptolemaic_clusters']})").fetchall()) == Counter(map(tuple, got.select(names).collect()))


def test_clusters_odd_rows(spark):
    rows, bad = odd_vectors()
    other = [(300, [0.0] * 63), (301, [0.0] * 65), (302, [])]
    schema = "vec_id long, embedding array<double>, cluster int, y int"
    frame = spark.createDataFrame([(*r, 1, None) for r in rows + bad + other], schema).repartition(3)
    got = Counter((r[0], r[1], r[2], int(r[3]), int(r[4]), r[5]) for r in pivot_clusters.cluster_vectors(frame).collect())
    assert got == brute_clusters(rows)
    few = rows[:3] + rows[60:70]   # fewer vectors than clusters, most of them equal
    got = Counter((r[0], r[1], r[2], int(r[3]), int(r[4]), r[5]) for r in pivot_clusters.cluster_vectors(spark.createDataFrame([(*r, 1, None) for r in few], schema)).collect())
    assert got == brute_clusters(few)
    none = pivot_clusters.cluster_vectors(spark.createDataFrame([], schema))
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@given(st.integers(0, 10 ** 6), st.sampled_from([2, 50, 1 << 20, 1 << 27]))
@settings(max_examples=30, deadline=None)
def test_bounds_never_pass_over_the_nearest(seed, size):
    rng = np.random.default_rng(seed)
    groups = rng.integers(-size, size, (6, 64))
    y = np.concatenate([groups.repeat(5, 0) + rng.integers(-1, 2, (30, 64)), rng.integers(-size, size, (20, 64))])
    centroids, pivots = y[rng.permutation(len(y))[:8]], pivot_clusters.choose_pivots(y[:9])
    to = pivot_clusters.distances_to(y, pivots)
    exact = np.stack([pivot_clusters.squared(y, c) for c in centroids], 1)
    low = pivot_clusters.lower_bounds(to, centroids, pivots)
    assert (low <= np.sqrt(exact.astype(np.float64))).all()
    cluster, distance, checked = pivot_clusters.nearest(y, to, centroids, pivots)
    assert (cluster == exact.argmin(1)).all() and (distance == exact.min(1)).all() and checked <= exact.size


def test_bounds_save_distances_between_groups():
    rng = np.random.default_rng(0)
    groups = rng.integers(-500, 500, (16, 64))
    y = groups.repeat(100, 0) + rng.integers(-3, 4, (1600, 64))
    pivots = pivot_clusters.choose_pivots(groups)
    *_, checked = pivot_clusters.nearest(y, pivot_clusters.distances_to(y, pivots), groups, pivots)
    assert checked < 0.6 * 1600 * 16


# ---------------------------------------------------------------- 13 language model

@given(st.lists(st.integers(0, 2 ** 64 - 1), max_size=60, unique=True), st.sampled_from([1, 3, 1 << 20, 1 << 44]))
@settings(max_examples=80, deadline=None)
def test_sequence_round_trip(values, part):
    values = np.array(sorted({v // part for v in values}), np.uint64)
    seq = elias_fano.Sequence(elias_fano.mapped(elias_fano.Sequence.encode(values)))
    assert seq.n == len(values) and (seq.get(np.arange(len(values))) == values).all()
    ask = np.array(sorted({0, 2 ** 64 - 1, *(int(v) for v in values), *(max(0, int(v) - 1) for v in values), *(min(2 ** 64 - 1, int(v) + 1) for v in values)}), np.uint64)
    for start, stop in ((0, len(values)), (len(values) // 3, len(values) - len(values) // 4)):
        place, found = seq.successor(ask, np.full(len(ask), start), np.full(len(ask), stop))
        inside = values[start:stop]
        assert (found == np.isin(ask, inside)).all()
        assert (place == start + np.searchsorted(inside, ask)).all()


def test_sequence_repeats_and_size():
    starts = np.sort(np.random.default_rng(0).integers(0, 50_000, 20_000))
    raw = elias_fano.Sequence.encode(starts)
    assert (elias_fano.Sequence(raw).get(np.arange(20_000)) == starts.astype(np.uint64)).all() and len(raw) < 20_000


def test_trie_from_a_mapped_file(tmp_path):
    rng = np.random.default_rng(3)
    words = np.unique(rng.integers(2, 2 ** 64 - 1, 50, dtype=np.uint64))
    grams = np.unique(rng.integers(0, 50, (3000, 3)), axis=0)
    pairs = np.unique(grams[:, 0] * 50 + grams[:, 1])
    triples = np.unique(np.searchsorted(pairs, grams[:, 0] * 50 + grams[:, 1]) * 50 + grams[:, 2])
    codes = np.arange(len(triples)) % 60000
    path = tmp_path / "trie"
    path.write_bytes(elias_fano.Trie.encode(words, [pairs, triples], np.arange(len(pairs)), codes))
    trie = elias_fano.Trie.open(str(path))
    ask = np.array([(a, b, c) for a in range(50) for b in range(0, 50, 7) for c in range(50)])
    node = trie.child(0, trie.word(words[ask[:, 0]]), trie.word(words[ask[:, 1]]))
    leaf = trie.child(1, node, trie.word(words[ask[:, 2]]))
    have = {tuple(g): i for i, g in enumerate(grams.tolist())}
    assert leaf.tolist() == [have.get(tuple(a), -1) for a in ask.tolist()]
    assert trie.word(np.array([1], np.uint64)).tolist() == [-1] and (trie.codes == codes).all()


def brute_scores(rows, learn, order, smoothing):
    """rows: (doc_id, text). The same quantised model from plain dictionaries."""
    grid = ngram_trie.GRID

    def code(p):
        return int(min(np.rint(-np.log10(p) * grid), 65535))

    texts = [[*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None] for _, t in rows]
    counts = [Counter() for _ in range(order + 1)]
    for words, use in zip(texts, learn, strict=True):
        if use:
            counts[1].update((w,) for w in words)
            for o in range(2, order + 1):
                padded = [None, *words]
                counts[o].update(tuple(padded[i:i + o]) for i in range(len(padded) - o + 1))
    n, v = sum(counts[1].values()), len(counts[1])

    def coded(gram):
        if len(gram) == 1:
            return code((counts[1][gram] + 1) / (n + v + 1))
        before, o = gram[:-1], len(gram)
        c, lower = counts[len(before)][before], coded(gram[1:])
        if not c:
            return lower
        if counts[o][gram]:
            return code((counts[o][gram] + smoothing * 10.0 ** (-lower / grid)) / (c + smoothing))
        return code(smoothing / (c + smoothing)) + lower

    out = []
    for (doc, _), words, use in zip(rows, texts, learn, strict=True):
        padded = [None, *words]
        score = -sum(coded(tuple(padded[max(0, i + 1 - order):i + 1])) for i in range(1, len(padded))) / grid
        base = sum(math.log10((counts[1][w,] + 1) / (n + v + 1)) for w in words)
        out.append((doc, not use, len(words), sum(counts[1][w,] > 0 for w in words), n, round(base, 6), score))
    return Counter(out)


def as_counter(frame):
    return Counter((*tuple(r)[:5], round(r[5], 6), r[6]) for r in frame.collect())


def test_scores_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()]
    learn = [zlib.crc32(str(d).encode()) % 7 != 2 for d, _ in rows]
    got = llm.op13_trie_scores(spark, SF01)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert as_counter(got) == brute_scores(rows, learn, ngram_trie.ORDER, ngram_trie.SMOOTHING)
    held = got.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


ODD_SCHEMA = "doc_id long, text string, unit long, score double, learn boolean"


def odd_texts():
    rng = random.Random(9)
    vocabulary = ["a", "b", "B", "the", "The", "x,", "é", "日本", "\x1c", "q\xa0r", "İ"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40))), rng.random() < 0.8) for i in range(60)]
    rows += [(70, None, True), (71, "", True), (72, " \t\n\x0b", None), (None, "a b the", True), (None, None, None), (5, "a b the a b", True), (5, "a b the a b", True)]
    rows += [(80, "the a " * 5000, True), (81, " ".join(f"w{i}" for i in range(3000)), False)]
    return [(d, t, 3, 0.5, x) for d, t, x in rows]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_odd_rows(spark, order, monkeypatch):
    rows = odd_texts()
    frame = spark.createDataFrame(rows, ODD_SCHEMA).repartition(3)
    monkeypatch.setattr(ngram_trie, "SHARD_WORDS", 1000)
    scores, model = ngram_trie.fit_and_score(frame, F.col("learn"), order, 5.0, unit_tokens=300, shard_tokens=3000)
    assert as_counter(scores) == brute_scores([r[:2] for r in rows], [bool(r[4]) for r in rows], order, 5.0)
    for r in model.where("gram > 1").collect():
        assert elias_fano.Trie(r["trie"]).order == r["gram"]
    assert model.select("gram").distinct().count() == order


def test_hot_contexts_are_dealt_by_the_next_word(spark):
    """A word before a third of all words goes to many shards, with the same scores."""
    rng = random.Random(2)
    rows = [(i, " ".join(w for _ in range(100) for w in ("the", f"w{rng.randint(0, 400)}", f"v{rng.randint(0, 50)}")), 0, 0.0, i % 5 > 0) for i in range(40)]
    request = ngram_trie._Unit.climb

    def hot(self, *args):
        ngram_trie.HOT = 100   # in the worker
        return request(self, *args)

    plain, _ = ngram_trie.fit_and_score(spark.createDataFrame(rows, ODD_SCHEMA), F.col("learn"), 3, 5.0, shard_tokens=1000)
    ngram_trie._Unit.climb = hot
    try:
        split, model = ngram_trie.fit_and_score(spark.createDataFrame(rows, ODD_SCHEMA), F.col("learn"), 3, 5.0, shard_tokens=1000)
        want = brute_scores([r[:2] for r in rows], [r[4] for r in rows], 3, 5.0)
        assert as_counter(split) == want and as_counter(plain) == want
    finally:
        ngram_trie._Unit.climb = request


def unit_row(rng, n_words, n_tokens):
    """A unit of documents of 100 words from ``n_words`` (0 is the end), two of three in training."""
    tokens = rng.integers(1, n_words, n_tokens).astype("<u4")
    tokens[99::100] = 0
    docs = n_tokens // 100
    return {"n_words": n_words, "doc_ids": list(range(docs)), "train": [i % 3 > 0 for i in range(docs)], "sizes": [100] * docs,
            "tokens": zstandard.ZstdCompressor().compress(tokens.view(np.uint8).reshape(-1, 4).T.tobytes())}


def most_bytes(work):
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_of_units_and_shards_stays_near_their_rows():
    """Bytes of work space for each token of a unit and for each n-gram asked of a shard (121 and 239 when numbers were wide and levels handled whole)."""
    rng = np.random.default_rng(6)
    n_words, n_tokens = 3000, 300_000
    rows = [unit_row(rng, n_words, n_tokens) for _ in range(4)]
    known = ngram_trie.pack(np.full(n_words, 200), np.arange(n_words), np.diff(np.arange(n_words), prepend=0))
    corpus = ngram_trie.Corpus(800_000, n_words, {1: 1, 2: 4}, {0: 0})
    asked, units = {}, []
    for i, row in enumerate(rows):
        (found, _, _), peak = most_bytes(lambda row=row: ngram_trie._Unit(row).climb({1: {0: known}}, corpus, 2))
        units.append(peak / n_tokens)
        for s, raw in found:
            asked.setdefault(s, []).append((i, raw))
    shards = []
    for s, found in asked.items():
        shard = pa.table([pa.array([s] * 4, pa.int32()), pa.array([i for i, _ in found], pa.int64()), pa.array([r for _, r in found], pa.binary())], ["shard", "unit", "request"])
        built, peak = most_bytes(lambda shard=shard: ngram_trie.build_and_look_up(shard, 2, True, 5.0))
        grams = sum(len(ngram_trie.unpack(r)[4]) for _, r in found)
        assert built.num_rows == 5 and grams > 200_000
        shards.append(peak / grams)
    assert max(units) < 100
    assert max(shards) < 120


def test_scores_of_nothing(spark):
    none, model = ngram_trie.fit_and_score(spark.createDataFrame([], ODD_SCHEMA), F.col("learn"))
    assert none.count() == 0 and model.count() == 0
    rows = [(1, "a b", 0, 0.0, False), (2, None, 0, 0.0, None)]
    got, _ = ngram_trie.fit_and_score(spark.createDataFrame(rows, ODD_SCHEMA), F.col("learn"))
    assert sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got.collect()) == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]

