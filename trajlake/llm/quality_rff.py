"""Quality classifier: ridge regression on random Fourier features, with isotonic calibration.

Document statistics are standardised and mapped by ``cos(x W + b)``, whose inner
products approximate a Gaussian kernel. Each partition sums ``Z'Z`` and ``Z'y``
over its labelled rows, the sums are added up, and one small linear system gives
the ridge weights. Scores of labelled rows, binned, are made monotone by pooling
adjacent violators.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.lang_backoff import fold
from trajlake.llm.shared import stage, text_arrays, with_uid

FEATURES = 192
RIDGE = 1e-2
#: Kernel width in standardised units, for each root of a statistic.
WIDTH = 1.0
#: Labelled rows that the fit uses at the most, about; chosen by a hash of doc_id.
TRAIN_ROWS = 40_000
BINS = 400
SEED = 23
CUT = 0.3

_LETTER, _UPPER, _DIGIT, _SPACE, _LINE, _MARK, _SIGN, _HIGH = range(8)
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[[*range(97, 123)]] = _LETTER
_CLASS[[*range(65, 91)]] = _UPPER
_CLASS[[*range(48, 58)]] = _DIGIT
_CLASS[[32, 9, 11, 12, 13]] = _SPACE
_CLASS[10] = _LINE
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = _MARK
_CLASS[128:] = _HIGH
STATS = ("log_bytes", "log_words", "upper", "digit", "space", "line", "mark", "sign", "high", "word_length", "word_spread",
         "long_words", "signed_words", "distinct_words", "distinct_lines", "line_length", "shouted", "ends")


def statistics(text: bytes) -> list[float]:
    """Statistics of one whole text (UTF-8); an empty one has zeros."""
    n = len(text)
    words = text.split()
    if not words:
        return [float(np.log1p(n)), *[0.0] * (len(STATS) - 1)]
    kinds = _CLASS[np.frombuffer(text, np.uint8)]
    share = np.bincount(kinds, minlength=8) / n
    sizes = np.fromiter(map(len, words), np.float64, len(words))
    different = set(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    sign_words = np.count_nonzero((kinds[1:] == _SIGN) & (kinds[:-1] != _SIGN)) / len(words)
    return [float(np.log1p(n)), float(np.log1p(len(words))), *(float(share[k]) for k in (_UPPER, _DIGIT, _SPACE, _LINE, _MARK, _SIGN, _HIGH)),
            float(sizes.mean()), float(sizes.std()), float((sizes > 14).mean()), float(sign_words), len(different) / len(words),
            len(set(lines)) / len(lines), float(np.log1p(n / len(lines))), float(np.count_nonzero((kinds[1:] == _UPPER) & (kinds[:-1] == _UPPER)) / n),
            sum(x.rstrip()[-1:] in b".!?" for x in lines) / len(lines)]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, at = text_arrays(b.column("text"))
        raw = data.tobytes()
        rows = [statistics(raw[x:y]) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("uid"), b.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], ["uid", "doc_id", "stats"])


class Model:
    """Standardisation, random features, ridge weights and the calibration curve."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int, width: float, seed: int):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.mean, self.scale = mean, scale
        self.w = rng.standard_normal((len(mean), features)) / (width * np.sqrt(len(mean)))
        self.b = rng.uniform(0, 2 * np.pi, features)
        self.weights = np.zeros(features + 1)
        self.xs, self.ys = np.array([0.0]), np.array([0.5])

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.cos(z @ self.w + self.b) * np.sqrt(2 / len(self.b)), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.xs, self.ys), 0.0, 1.0)


def pool_adjacent(total: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Isotonic means: nondecreasing fit to ``total / weight`` under ``weight``."""
    blocks: list[list[float]] = []
    for t, w in zip(total.tolist(), weight.tolist(), strict=True):
        blocks.append([t, w, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            t, w, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + t, blocks[-1][1] + w, blocks[-1][2] + k]
    return np.repeat([t / w for t, w, _ in blocks], [k for *_, k in blocks])


def _rows(b: pa.RecordBatch) -> np.ndarray:
    return np.asarray(b.column("stats").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(b.num_rows, -1)


def _normal(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Sums of Z'Z and Z'y over a partition, row by row of the matrix."""
    n = len(model.weights)
    total = np.zeros((n, n + 1))
    for b in batches:
        if b.num_rows:
            z = model.features(_rows(b))
            total += z.T @ np.hstack([z, b.column("y").to_numpy().reshape(-1, 1)])
    i, j = np.divmod(np.arange(total.size), n + 1)
    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])


def _binned(batches: Iterator[pa.RecordBatch], model: Model, bins: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            k = np.clip(((model.raw(_rows(b)) + 0.5) * (bins / 2)).astype(np.int64), 0, bins - 1)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(b.column("y").to_numpy(), pa.float64())], ["bin", "y"])


def measure(docs: DataFrame) -> DataFrame:
    """uid (place in the scan), doc_id and stats of each row of documents (doc_id, text); staged."""
    return stage(with_uid(docs, "uid").select("uid", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                 .mapInArrow(_measure, "uid long, doc_id long, stats array<double>"))


def fit(measured: DataFrame, labels: DataFrame, features: int = FEATURES, ridge: float = RIDGE, width: float = WIDTH,
        train_rows: int = TRAIN_ROWS, bins: int = BINS, seed: int = SEED) -> Model:
    """Fit to ``labels`` (doc_id, quality 0 or 1) of the rows in ``measured``.

    About ``train_rows`` labelled rows at the most are used, by a hash of
    doc_id. The driver collects one matrix of ``features`` squared, and one row
    for each of ``bins`` bins. A document labelled more than once counts with
    the mean of its labels. Without labels every score is 0.5.
    """
    spark = measured.sparkSession
    y = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("y"))
    known = y.count()
    if known > train_rows:
        y = y.where(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1_000_003)) < F.lit(int(1_000_003 * train_rows / known)))
    rows = stage(measured.join(y, "doc_id").select("stats", "y"))
    k = len(STATS)
    s = rows.agg(F.count("*").alias("n"), *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(k)],
                 *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(k)], F.avg("y").alias("y")).first()
    mean = np.array([s[f"m{i}"] or 0.0 for i in range(k)])
    scale = np.array([max(s[f"s{i}"] or 0.0, 1e-6) for i in range(k)])
    model = Model(mean, scale, features, width, seed)
    if not s["n"]:
        return model
    shared = spark.sparkContext.broadcast(model)
    n = features + 1
    matrix = np.zeros((n, n + 1))
    for r in rows.mapInArrow(lambda b: _normal(b, shared.value), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toLocalIterator():
        matrix[r["i"], r["j"]] = r["v"]
    reg = np.eye(n) * (ridge * s["n"] / n)
    reg[-1, -1] = 1e-9
    model.weights = np.linalg.solve(matrix[:, :n] + reg, matrix[:, n])
    fitted = spark.sparkContext.broadcast(model)
    got = sorted((r["bin"], r["t"], r["w"]) for r in rows.mapInArrow(lambda b: _binned(b, fitted.value, bins), "bin int, y double")
                 .groupBy("bin").agg(F.sum("y").alias("t"), F.count("*").alias("w")).collect())
    at = np.array([g[0] for g in got])
    # One pseudo-observation at the mean keeps the ends of the curve off 0 and 1.
    t, w = np.array([g[1] for g in got]) + 0.02 * s["y"], np.array([g[2] for g in got], float) + 0.02
    model.xs, model.ys = (at + 0.5) * (2 / bins) - 0.5, pool_adjacent(t, w)
    # A hair of the raw score keeps the order of texts within a pooled block.
    model.ys = np.clip(model.ys * 0.998 + 0.001 * (np.arange(len(at)) + 1) / (len(at) + 1), 0, 1)
    return model


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = model.score(_rows(b)) if b.num_rows else np.zeros(0)
        yield pa.RecordBatch.from_arrays([b.column("uid"), b.column("doc_id"), pa.array(got, pa.float64())], ["uid", "doc_id", "score"])


def score(measured: DataFrame, model: Model) -> DataFrame:
    """uid, doc_id and score (0 to 1, higher: better) of every measured row.

    Edge cases: null and empty texts have the statistics of an empty text and
    are scored like any other; repeated rows score alike; an empty table gives
    an empty result.
    """
    shared = measured.sparkSession.sparkContext.broadcast(model)
    return measured.mapInArrow(lambda b: _score(b, shared.value), "uid long, doc_id long, score double")


def training_rows(measured: DataFrame, folds: int = 5) -> DataFrame:
    """The rows that may be learned from: crc32(doc_id as text) mod ``folds`` is not 0."""
    return measured.where(fold(F.col("doc_id"), folds) != 0)
