"""Language identification by words first, backing off to shorter and shorter character n-grams.

A word that the model knows scores by its log frequency in each language. Any
other word is scored by its character 4-grams that the model knows; if it has
none of those, by its 3-grams, then 2-grams, then characters.

Tasks hold the most frequent words and n-grams with their counts in every
language. Where there are more, the other words of a text are looked up by
joins on distinct words and n-grams, so that no entry counts as unseen that was
counted, and results do not depend on the bounds.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.llm.shared import free_name, with_uid, write_stage

#: Bounds of what tasks hold of the model: the most frequent words, and n-grams of each length; the rest is looked up by joins.
WORDS = 300_000
GRAMS = 40_000
#: Numbers that each of these tables holds at the most, whatever the number of languages.
CELLS = 2_000_000
ORDER = 4
UNKNOWN = "und"
#: Words by which the odds of a longer text are counted, so that scores don't all end at one.
EVIDENCE = 40
#: Distinct entries that a task counts before it passes them on.
_TASK_ENTRIES = 200_000
#: Steps of log frequencies. Sums of whole numbers are the same in any order.
_STEPS = 1 << 20
#: Languages whose sums are columns of one aggregate; with more, each language is a row.
_COLUMNS = 64
#: Distinct unseen words whose scores a task remembers.
_MEMO = 200_000
#: Texts that Spark hands to a task's Python at once. A batch is held several times over, in the JVM and in Python.
_BATCH = 1_000

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    return _WORD.findall((text or "").lower())


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of a word between marks; single characters without them."""
    if n == 1:
        return list(word)
    marked = f"<{word}>"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of at most ``_BATCH`` rows for what is run meanwhile."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), _BATCH) if int(before) > 0 else _BATCH))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _lists(column: pa.ListArray) -> list[list[int]]:
    """A column of lists of numbers."""
    flat, at = column.values.to_numpy(zero_copy_only=False).tolist(), column.offsets.to_numpy().tolist()
    return [flat[i:j] for i, j in zip(at, at[1:], strict=False)]


def _count_words(batches: Iterator[pa.RecordBatch], places: dict[str, int]) -> Iterator[pa.RecordBatch]:
    held: dict[int, Counter] = {}

    def out() -> pa.RecordBatch:
        rows = [(at, w, n) for at, c in held.items() for w, n in c.items()]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 3
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())], ["at", "word", "n"])

    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text"), strict=True):
            held.setdefault(places[lang], Counter()).update(words_of(text.as_py()))
            if sum(map(len, held.values())) > _TASK_ENTRIES:
                yield out()
    yield out()


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[int, int], Counter] = {}

    def out() -> pa.RecordBatch:
        rows = [(at, k, g, n) for (at, k), c in held.items() for g, n in c.items()]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.string(), pa.int64()), strict=True)], ["at", "k", "gram", "n"])

    for b in batches:
        for word, places, counts in zip(b.column("entry").to_pylist(), _lists(b.column("at")), _lists(b.column("n")), strict=True):
            for k in range(1, ORDER + 1):
                grams = grams_of(word, k)
                for at, n in zip(places or range(len(counts)), counts, strict=True):
                    if n:
                        c = held.setdefault((at, k), Counter())
                        for g in grams:
                            c[g] += n
        if sum(map(len, held.values())) > _TASK_ENTRIES:
            yield out()
    yield out()


def _steps(counts: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Smoothed log frequencies of rows of counts (one column for each language) as whole steps."""
    return np.rint(np.log((counts + 0.5) / base) * _STEPS).astype(np.int64)


class Model:
    """Log frequencies by language of the words and n-grams that tasks hold, and the frames to look up the others in."""

    def __init__(self, langs: list[str], words: tuple[list[str], np.ndarray], grams: list[tuple[list[str], np.ndarray]],
                 bases: np.ndarray | None = None, rest: tuple[DataFrame, DataFrame] | None = None, kept: np.ndarray | None = None):
        self.langs = langs
        self.kept = kept     # places in counts that are languages; None if all are
        self.index, self.table = {w: i for i, w in enumerate(words[0])}, words[1]
        self.grams = [({g: i for i, g in enumerate(entries)}, table) for entries, table in grams]   # of 1, 2, ... characters
        self.memo: dict[str, np.ndarray] = {}
        self.none = np.zeros(len(langs), np.int64)
        self.bases = bases   # what frequencies are divided by in each language, of words and of 1, 2, ... characters
        self.rest = rest     # counted words and n-grams; None if tasks hold them all

    def __getstate__(self) -> dict:
        return {**self.__dict__, "rest": None, "memo": {}}

    def counted(self, at: list[int], n: list[int], k: int) -> np.ndarray:
        """Steps of a looked up word (``k`` 0) or n-gram from its counts (places, counts; no places: a count for each)."""
        counts = np.zeros(self.kept.max() + 1 if at else len(n))
        counts[at or slice(None)] = n
        return _steps(counts[self.kept], self.bases[k])

    def unseen(self, word: str, extra: dict[str, np.ndarray] | None = None) -> np.ndarray:
        """Mean over the longest known n-grams of an unseen word, ``extra`` (looked up) among them; nothing known says nothing."""
        for k in range(ORDER, 0, -1):
            index, table = self.grams[k - 1]
            known = [table[index[g]] if g in index else extra[g] for g in grams_of(word, k) if g in index or extra and g in extra]
            if known:
                return np.rint(np.sum(known, axis=0) / len(known)).astype(np.int64)   # n-grams of different lengths differ
        return self.none

    def remembered(self, word: str) -> np.ndarray:
        got = self.memo.get(word)
        if got is None:
            if len(self.memo) >= _MEMO:
                self.memo.clear()
            got = self.memo[word] = self.unseen(word)
        return got

    def split(self, text: str | None) -> tuple[int, np.ndarray, Counter]:
        """Words of a text (0 if it is ``und``), the sum over those held, and the others."""
        words = words_of(text)
        if not self.langs or not any(map(str.isalpha, words)) and not any(c.isalpha() for w in words for c in w):
            return 0, self.none, Counter()
        get = self.index.get
        at = [get(w, -1) for w in words]
        known = np.array(at, np.int64)
        total = self.table[known[known >= 0]].sum(0) if len(self.index) else self.none
        return len(words), total, Counter(w for w, i in zip(words, at, strict=True) if i < 0)

    def decide(self, n: int, total: np.ndarray) -> tuple[str, float]:
        """Language and its probability from the sum over ``n`` words."""
        if not n:
            return UNKNOWN, 0.0
        total = total / _STEPS * (min(n, EVIDENCE) / n)
        p = np.exp(total - total.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.langs[best], float(p[best])

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its probability; ``und`` without a letter or without a model. Only if tasks hold all entries."""
        n, total, other = self.split(text)
        for w, times in other.items():
            total = total + times * self.remembered(w)
        return self.decide(n, total)


def _held(rows: pa.Table, places: int, kept: np.ndarray, base: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Entries and their steps, from rows (entry, places, counts; no places: a count for each)."""
    entries = rows.column("entry").to_pylist()
    counts = np.zeros((len(entries), places))
    if len(entries):
        n, at = rows.column("n").combine_chunks(), rows.column("at").combine_chunks()
        place = np.repeat(np.arange(len(entries)), np.diff(n.offsets.to_numpy()))
        counts[place, at.values.to_numpy() if len(at.values) else np.tile(np.arange(places), len(entries))] = n.values.to_numpy()
    return entries, _steps(counts[:, kept], base)


def _empty(kind: str) -> Column:
    """An empty list; a run of null lists is written to Arrow in time that grows with its square."""
    return F.array().cast(f"array<{kind}>")


def _by_entry(counts: DataFrame, entry: list[str], places: int, name: str) -> DataFrame:
    """One row for each entry, from a stage: places that have it (``at``), counts (``n``), their sum. At most one count for each place.

    With few places ``at`` is empty and ``n`` has all counts: plain sums take no
    objects on the heap, of which lists of pairs take several for each row.
    """
    dealt = counts.repartition(*entry)   # by the entry alone, so aggregates find their rows together; tasks counted before
    if places <= _COLUMNS:
        sums = dealt.groupBy(*entry).agg(*[F.sum(F.when(F.col("at") == i, F.col("n")).otherwise(0)).alias(f"c{i}") for i in range(places)])
        each = [F.col(f"c{i}") for i in range(places)]
        return write_stage(sums, name).select(*entry, _empty("int").alias("at"), F.array(*each).alias("n"), sum(each[1:], each[0]).alias("total"))
    pairs = F.array_sort(F.collect_list(F.struct("at", "n")))
    rows = dealt.groupBy(*entry, "at").agg(F.sum("n").alias("n")).groupBy(*entry).agg(pairs.alias("pairs"), F.sum("n").alias("total"))
    return write_stage(rows.select(*entry, F.col("pairs.at").alias("at"), F.col("pairs.n").alias("n"), "total"), name)


def _sizes(entries: DataFrame, places: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of entries of each length ``k`` (0: words), and sums of their counts for each place."""
    sizes, totals = np.zeros(ORDER + 1, np.int64), np.zeros((ORDER + 1, places), np.int64)
    if places <= _COLUMNS:
        for r in entries.groupBy("k").agg(F.count("*"), *[F.sum(F.col("n")[i]) for i in range(places)]).collect():
            sizes[r["k"]], totals[r["k"]] = r[1], r[2:]
        return sizes, totals
    for r in entries.groupBy("k").agg(F.count("*").alias("size")).collect():
        sizes[r["k"]] = r["size"]
    for r in entries.select("k", F.explode(F.arrays_zip("at", "n")).alias("p")).groupBy("k", F.col("p.at").alias("at")).agg(F.sum("p.n").alias("n")).collect():
        totals[r["k"], r["at"]] = r["n"]
    return sizes, totals


def learn(docs: DataFrame, words: int = WORDS, grams: int = GRAMS) -> Model:
    """Fit a model to ``text`` and non-null ``lang`` of all rows of ``docs``.

    Counts cover all rows, in any number of languages. The driver collects the
    names of the languages and their totals, and as Arrow tables the most
    frequent ``words`` and, of each length, ``grams`` (ties by the entry), but no
    more than ``CELLS`` numbers in each table; the others stay in frames that
    ``identify`` looks them up in. Results do not depend on these bounds.

    Edge cases: rows without a language or text are not learned from; a language
    whose texts hold no word is none; nothing to learn from gives a model that
    calls every text ``und``; rows that repeat count each time.
    """
    names = sorted(r["lang"] for r in docs.select("lang").where("lang is not null").distinct().collect())
    if not names:
        return Model([], ([], np.zeros((0, 0), np.int64)), [([], np.zeros((0, 0), np.int64))] * ORDER)
    place = {k: i for i, k in enumerate(names)}
    counts = docs.select("lang", "text").where("lang is not null and text is not null").mapInArrow(lambda b: _count_words(b, place), "at int, word string, n long")
    with _small_batches(docs.sparkSession):
        counted = _by_entry(counts, ["word"], len(names), "language-words").withColumnRenamed("word", "entry")
    pieces = counted.select("entry", "at", "n").mapInArrow(_count_grams, "at int, k int, gram string, n long")
    by_gram = _by_entry(pieces, ["k", "gram"], len(names), "language-grams")
    (n_words, of_words), (sizes, totals) = _sizes(counted.withColumn("k", F.lit(0)), len(names)), _sizes(by_gram, len(names))
    sizes, totals = sizes + n_words, totals + of_words
    kept = np.flatnonzero(totals[0])
    bases = 0.5 * sizes[:, None] + 0.5 + totals[:, kept]
    most = CELLS // len(names)
    # A word counts as one observation however it is scored: n-gram logs are means over a word.
    held = _held(_first(counted, min(words, most)), len(names), kept, bases[0])
    levels = [_held(_first(by_gram.where(F.col("k") == k).withColumnRenamed("gram", "entry"), min(grams, most)), len(names), kept, bases[k]) for k in range(1, ORDER + 1)]
    every = all(len(t[0]) == sizes[k] for k, t in enumerate([held, *levels]))
    return Model([names[i] for i in kept], held, levels, bases, None if every else (counted, by_gram), kept)


def _first(entries: DataFrame, most: int) -> pa.Table:
    """The most frequent entries, as one Arrow table of bounded size."""
    return entries.orderBy(F.desc("total"), "entry").limit(most).select("entry", "at", "n").toArrow()


def _split(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [model.split(t.as_py()) for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([
            b.column("uid"), b.column("doc_id"), pa.array([n for n, _, _ in got], pa.int64()), pa.array([t.tolist() for _, t, _ in got], pa.list_(pa.int64())),
            pa.array([list(c) for _, _, c in got], pa.list_(pa.string())), pa.array([list(c.values()) for _, _, c in got], pa.list_(pa.int64()))],
            ["uid", "doc_id", "n_words", "total", "words", "times"])


def _other_grams(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """n-grams of words that tasks do not hold."""
    for b in batches:
        rows = [(w, k, g) for w in b.column("word").to_pylist() for k in range(1, ORDER + 1) for g in dict.fromkeys(grams_of(w, k)) if g not in model.grams[k - 1][0]]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.string()), strict=True)], ["word", "k", "gram"])


def _entries(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Steps of each word, from rows sorted by it: its own counts (empty if it was not counted) and those of its n-grams."""
    word, own, extra = None, None, {}

    def out(rows: list[tuple[str, list[int]]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()), pa.array([v for _, v in rows], pa.list_(pa.int64()))], ["word", "logs"])

    def ended() -> tuple[str, list[int]]:
        return word, (model.unseen(word, extra) if own is None else own).tolist()

    for b in batches:
        done = []
        for w, k, gram, at, n in zip(*(b.column(c).to_pylist() for c in ("word", "k", "gram")), _lists(b.column("at")), _lists(b.column("n")), strict=True):
            if w != word:
                if word is not None:
                    done.append(ended())
                word, own, extra = w, None, {}
            if k:
                extra[gram] = model.counted(at, n, k)
            elif n:
                own = model.counted(at, n, 0)
        yield out(done)
    yield out([] if word is None else [ended()])


def _decide(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [model.decide(n, np.array(total)) for n, total in zip(b.column("n_words").to_pylist(), _lists(b.column("total")), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("uid"), b.column("doc_id"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                                         ["uid", "doc_id", "lang_pred", "score"])


def _summed(texts: DataFrame, of_words: DataFrame, langs: int) -> DataFrame:
    """``texts`` (uid, doc_id, n_words, total), with what their other words (uid, times, logs) add to ``total``; tasks add up their part before the shuffle."""
    if langs <= _COLUMNS:
        one = texts.select("uid", "doc_id", "n_words", *[F.col("total")[i].alias(f"s{i}") for i in range(langs)])
        other = of_words.select("uid", *[(F.col("times") * F.col("logs")[i]).alias(f"s{i}") for i in range(langs)])
        # a text has one row in ``texts``, so the largest value is its own
        sums = one.unionByName(other, allowMissingColumns=True).groupBy("uid").agg(
            F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(langs)])
        return sums.select("uid", "doc_id", "n_words", F.array(*[f"s{i}" for i in range(langs)]).alias("total"))
    sums = of_words.select("uid", "times", F.posexplode("logs").alias("i", "v")).groupBy("uid", "i").agg(F.sum(F.col("times") * F.col("v")).alias("s"))
    more = sums.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("i", "s"))).alias("p"))
    both = F.when(F.col("p").isNull(), F.col("total")).otherwise(F.zip_with("total", "p.s", lambda a, b: a + b))
    return texts.join(more, "uid", "left").select("uid", "doc_id", "n_words", both.alias("total"))


def _look_up(rows: DataFrame, model: Model) -> DataFrame:
    """Predictions for ``rows`` (uid, doc_id, text) by a model of which tasks hold a part."""
    counted, by_gram = model.rest
    shared = rows.sparkSession.sparkContext.broadcast(model)
    with _small_batches(rows.sparkSession):
        split = write_stage(rows.mapInArrow(lambda b: _split(b, shared.value), "uid long, doc_id long, n_words long, total array<bigint>, words array<string>, times array<bigint>"),
                            "language-texts")
    other = split.select("uid", F.explode(F.arrays_zip("words", "times")).alias("w")).select("uid", F.col("w.words").alias("word"), "w.times")
    words = write_stage(other.select("word").distinct().join(counted.select(F.col("entry").alias("word"), "at", "n"), "word", "left"), "language-unheld")
    found = (words.where("n is null").select("word").mapInArrow(lambda b: _other_grams(b, shared.value), "word string, k int, gram string")
             .join(by_gram.select("k", "gram", "at", "n"), ["k", "gram"]))
    # sorted rows rather than a list for each word, which would be objects on the heap
    rows = words.select("word", F.lit(0).alias("k"), F.lit(None).cast("string").alias("gram"),
                        F.coalesce("at", _empty("int")).alias("at"), F.coalesce("n", _empty("bigint")).alias("n")).unionByName(found)
    entries = rows.repartition("word").sortWithinPartitions("word").mapInArrow(lambda b: _entries(b, shared.value), "word string, logs array<bigint>")
    return (_summed(split.select("uid", "doc_id", "n_words", "total"), other.join(entries, "word"), len(model.langs))
            .mapInArrow(lambda b: _decide(b, shared.value), "uid long, doc_id long, lang_pred string, score double"))


def _predict(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [model.predict(t.as_py()) for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([b.column("uid"), b.column("doc_id"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                                         ["uid", "doc_id", "lang_pred", "score"])


def _accept(batches: Iterator[pa.RecordBatch], model: Model, least: float) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [model.predict(t.as_py()) for t in b.column("text")]
        yield b.filter(pa.array([lang != UNKNOWN and p >= least for lang, p in got], pa.bool_()))


def fold(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod ``n``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """uid (place in the scan), doc_id, lang_pred and score (0 to 1) of each row of documents (doc_id, text).

    Edge cases: a null text, or one without a letter, is ``und`` with score 0,
    as is every text if nothing could be learned; ties go to the language first
    in code point order; repeated rows are predicted each; an empty table gives
    an empty result.
    """
    rows = with_uid(docs, "uid").select("uid", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model.rest:
        return _look_up(rows, model)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(lambda b: _predict(b, shared.value), "uid long, doc_id long, lang_pred string, score double")


def drop_unidentified(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """``docs`` without rows whose language is ``und`` or less probable than ``least``; a table scan, as rows are told apart by place.

    Edge cases as in ``identify``: rows with a null text or one without a letter
    go, copies stay or go alike, an empty table stays empty; all columns are kept.
    """
    if model.rest:
        uid = free_name(docs, "uid")
        placed = with_uid(docs, uid)
        got = _look_up(placed.select(F.col(uid).alias("uid"), F.lit(None).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), model)
        kept = got.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(F.col("uid").alias(uid))
        return placed.join(kept, uid, "left_semi").select(*docs.columns)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(lambda b: _accept(b, shared.value, least), docs.schema)
