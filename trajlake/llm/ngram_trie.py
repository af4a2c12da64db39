"""Language-model scores of documents from an n-gram trie in Elias-Fano levels.

The probability of a word after a context h of one or more words is smoothed by
the one after the shorter context h'::

    p(w | h) = (c(h w) + K p(w | h')) / (c(h) + K),   p(w) = (c(w) + 1) / (N + V + 1)

so an n-gram never seen after a context that was has the back-off weight
K / (c(h) + K) times the shorter one. Probabilities and weights are quantised to
1/256 of a decade.

Documents are packed into units of about ``UNIT_TOKENS`` tokens. For each order,
a unit asks for its distinct n-grams once, with its counts of them in training
documents; requests are dealt to shards by context, a shard adds up the counts,
builds its part of the trie, looks all requests up in it, and answers the units.
A context that is frequent in the whole corpus is dealt to several shards by the
following word. The number of units and of shards grows with the corpus; no
task holds more than one unit or one shard, and nothing is cut.
"""

from __future__ import annotations

import struct
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.llm.elias_fano import Trie, blocks, mapped
from trajlake.llm.shared import one_thread, text_arrays, write_stage

ORDER = 2
#: Weight of the shorter context, in counts.
SMOOTHING = 500.0
#: Codes of a decade.
GRID = 256
#: Tokens of a unit (a longer document is a unit of its own), and of the corpus for each shard of an order.
UNIT_TOKENS = 2_000_000
SHARD_TOKENS = 4_500_000
SHARD_WORDS = 500_000
#: A context counted this often goes to one more shard for each such number.
HOT = 200_000

_U64 = np.uint64
_MIX = _U64(0x9E3779B97F4A7C15)
_UNITS = ("unit long, n_tokens long, n_train long, n_words long, doc_ids array<bigint>, train array<boolean>, "
          "sizes array<bigint>, tokens binary, words binary")
_ANSWERS = "gram int, shard int, unit long, answer binary, known long, distinct long, trie binary"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


# ---------------------------------------------------------------- packing

def pack(*parts: np.ndarray | bytes) -> bytes:
    """Arrays of whole numbers, each in the narrowest unsigned type, and byte strings, in one compressed block."""
    out = []
    for p in parts:
        if isinstance(p, bytes):
            kind, raw = b"b", p
        else:
            top = int(p.max()) if len(p) else 0
            code = next(c for c, most in (("B", 1 << 8), ("H", 1 << 16), ("I", 1 << 32), ("Q", 1 << 64)) if top < most)
            kind, raw = code.encode(), p.astype(f"<u{struct.calcsize(code)}").tobytes()
        out += [kind, struct.pack("<Q", len(raw)), raw]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(raw: bytes) -> list[np.ndarray | bytes]:
    """The parts again; arrays keep their narrow types, so widen them before adding to them."""
    raw, at, out = zstandard.ZstdDecompressor().decompress(raw), 0, []
    while at < len(raw):
        kind, n = raw[at:at + 1].decode(), struct.unpack_from("<Q", raw, at + 1)[0]
        body = raw[at + 9:at + 9 + n]
        out.append(body if kind == "b" else np.frombuffer(body, f"<u{struct.calcsize(kind)}"))
        at += 9 + n
    return out


def code_of(p: np.ndarray) -> np.ndarray:
    """Quantised -log10 of probabilities."""
    return np.minimum(np.rint(-np.log10(p) * GRID), 65535).astype(np.int64)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a context's hash and the next word's."""
    x = (a ^ (b >> _U64(31))) * _MIX + b
    x = (x ^ (x >> _U64(29))) * _U64(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U64(32))


def _sorted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts whole numbers, where each distinct one starts in it, and the place of each number among the distinct ones."""
    order = np.argsort(key)
    rising = key[order]
    new = np.empty(len(key), bool)
    new[:1] = True
    np.not_equal(rising[1:], rising[:-1], out=new[1:])
    del rising
    which = np.empty(len(key), np.int32)
    which[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return order, np.flatnonzero(new), which


# ---------------------------------------------------------------- units

class _Ids(dict):
    """Numbers of words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _units(batches: Iterator[pa.RecordBatch], unit_tokens: int) -> Iterator[pa.RecordBatch]:
    """Pack whole documents into units. Word 0 is the end of a document, and the context of its first word."""
    from pyspark import TaskContext

    first = TaskContext.get().partitionId() << 32
    ids, tokens, docs, train, sizes = _Ids({b"": 0}), array("I"), [], [], []

    def flush() -> pa.RecordBatch:
        n_train = sum(s for s, t in zip(sizes, train, strict=True) if t)
        planes = np.frombuffer(tokens.tobytes(), np.uint8).reshape(-1, 4).T.tobytes()   # low bytes first, then higher ones: they pack better
        values = (first, len(tokens), n_train, len(ids), docs, train, sizes, zstandard.ZstdCompressor(level=3).compress(planes), b"\n".join(ids))   # words hold no white space
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary())
        names = ("unit", "n_tokens", "n_train", "n_words", "doc_ids", "train", "sizes", "tokens", "words")
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], list(names))

    for b in batches:
        data, at = text_arrays(b.column("text"))
        for k, (doc, learn) in enumerate(zip(b.column("doc_id").to_pylist(), b.column("train").to_pylist(), strict=True)):
            before = len(tokens)
            tokens.extend(map(ids.__getitem__, data[at[k]:at[k + 1]].tobytes().lower().split()))   # A-Z alone, ASCII white space alone
            tokens.append(0)
            docs.append(doc)
            train.append(bool(learn))
            sizes.append(len(tokens) - before)
            if len(tokens) >= unit_tokens:
                yield flush()
                first += 1
                ids, tokens, docs, train, sizes = _Ids({b"": 0}), array("I"), [], [], []
    if docs:
        yield flush()


class Corpus(NamedTuple):
    """Training tokens, distinct training words, shards of each order, and the number of each word shard's first word."""

    n: int
    v: int
    shards: dict[int, int]
    first: dict[int, int]


class _Unit:
    """One unit's tokens and the n-grams in them."""

    def __init__(self, row: dict):
        self.n_words = row["n_words"]
        self.docs, self.sizes = row["doc_ids"], np.array(row["sizes"], np.int64)
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["tokens"]), np.uint8)
        self.tokens = planes.reshape(4, -1).T.copy().view("<i4").ravel()   # numbers of words in the unit
        self.train = np.array(row["train"], bool)
        self.learn = np.repeat(self.train, self.sizes)

    def word_requests(self, words: list[bytes], shards: int) -> Iterator[tuple[int, bytes]]:
        digest = np.fromiter(map(xxhash.xxh64_intdigest, words), _U64, len(words))
        counts = np.bincount(self.tokens[self.learn], minlength=len(words))
        for s, at in _dealt(digest % _U64(shards), shards):
            yield s, pack(b"\n".join(words[i] for i in at), counts[at], np.diff(at, prepend=0))

    def climb(self, answers: dict[int, dict[int, bytes]], corpus: Corpus, order: int):
        """Requests of the first order without answers, as (shard, request) pairs, or None; counts of words; codes of tokens."""
        shards, count, self.number = corpus.shards, np.zeros(self.n_words, np.int64), np.zeros(self.n_words, _U64)
        for s, raw in answers[1].items():
            counted, rank, steps = unpack(raw)
            at = np.cumsum(steps, dtype=np.int64)
            count[at], self.number[at] = counted, rank.astype(_U64) + _U64(corpus.first[s])
        words, known = self.n_words, count
        self.single = code_of((count + 1) / (corpus.n + corpus.v + 1)).astype(np.int32)
        code = self.single[self.tokens]
        gram, path, digest = self.tokens, np.arange(words)[:, None], self.number
        for o in range(2, order + 1):
            context = np.empty(len(gram), np.int32)
            context[0], context[1:] = 0, gram[:-1]
            at = (count > 0)[context]
            if o > 2:
                at &= (context >= 0) & (self._place() >= o - 2)   # contexts do not reach over the start of a document
            key = context[at].astype(np.int64)
            key *= words
            key += self.tokens[at]
            del context
            first, starts, which = _sorted(key)
            key = key[first[starts]]
            del first, starts
            above, word = key // words, key % words
            bucket = self.number[word] % (1 + count[above] // HOT).astype(_U64)
            deal = _dealt(_mix(digest[above], bucket) % _U64(shards[o]), shards[o])
            if o not in answers:
                own = np.bincount(which[self.learn[at]], minlength=len(key))
                lower = np.zeros(len(key), np.int32)
                lower[which] = code[at]
                return [(s, self._request(i, above, word, own, lower, path, count)) for s, i in deal], known, code
            found, total = np.zeros(len(key), np.int32), np.zeros(len(key), np.int64)
            for s, i in deal:
                found[i], counted = unpack(answers[o][s])
                if o < order:   # the last order's n-grams are no contexts
                    total[i] = counted
            code[at] = found[which]
            if o < order:
                gram = np.full(len(self.tokens), -1, np.int32)
                gram[at] = which
                path, digest, count = np.concatenate([path[above], word[:, None]], 1), _mix(digest[above], self.number[word]), total
        return None, known, code

    def _place(self) -> np.ndarray:
        """Of each token, in its document."""
        starts = np.cumsum(self.sizes) - self.sizes
        return np.arange(len(self.tokens), dtype=np.int32) - np.repeat(starts.astype(np.int32), self.sizes)

    def _request(self, at: np.ndarray, above: np.ndarray, word: np.ndarray, own: np.ndarray, lower: np.ndarray, path: np.ndarray, count: np.ndarray) -> bytes:
        """Words (numbers, as steps), contexts (words, count, number of n-grams here) and n-grams (last word, own count), codes by the shorter context.

        After one word the shorter context is none: the codes are one for each word then, else one for each n-gram.
        """
        starts = np.flatnonzero(np.concatenate([[True], np.diff(above[at]) != 0]))
        contexts = above[at][starts]
        asked = np.concatenate([path[contexts].ravel(), word[at]])
        used, place = np.unique(self.number[asked], return_inverse=True)
        cut = path.shape[1] * len(contexts)
        codes = np.zeros(len(used), np.int64)
        codes[place] = self.single[asked]
        return pack(np.diff(used, prepend=_U64(0)), place[:cut], count[contexts], np.diff(np.append(starts, len(at))), place[cut:], own[at],
                    codes if path.shape[1] == 1 else lower[at])


def _dealt(shard: np.ndarray, shards: int) -> list[tuple[int, np.ndarray]]:
    """Places of each shard that has any, in their own order."""
    order = np.argsort(shard, kind="stable")
    ends = np.searchsorted(shard[order], np.arange(shards + 1).astype(shard.dtype))
    return [(s, order[ends[s]:ends[s + 1]]) for s in range(shards) if ends[s] < ends[s + 1]]


# ---------------------------------------------------------------- shards

def _answers(gram: int, shard: int, units: list[int], answers: list[bytes], trie: bytes, known: int = 0, distinct: int = 0) -> pa.Table:
    n = len(units)
    return pa.table([pa.array([gram] * (n + 1), pa.int32()), pa.array([shard] * (n + 1), pa.int32()), pa.array([*units, None], pa.int64()),
                     pa.array([*answers, None], pa.binary()), pa.array([0] * n + [known], pa.int64()), pa.array([0] * n + [distinct], pa.int64()),
                     pa.array([None] * n + [trie], pa.binary())], ["gram", "shard", "unit", "answer", "known", "distinct", "trie"])


def count_words(table: pa.Table) -> pa.Table:
    """One shard of words: counts over all units, and the words' places by falling count."""
    requests = [(words.split(b"\n"), counts, steps) for words, counts, steps in (unpack(r) for r in table.column("request").to_pylist())]
    total: dict[bytes, int] = {}
    for words, counts, _ in requests:
        for w, c in zip(words, counts.tolist(), strict=True):
            total[w] = total.get(w, 0) + c
    ordered = sorted(total, key=lambda w: (-total[w], w))
    rank = {w: i for i, w in enumerate(ordered)}
    return _answers(1, table.column("shard")[0].as_py(), table.column("unit").to_pylist(),
                    [pack(np.fromiter((total[w] for w in words), np.int64, len(words)), np.fromiter((rank[w] for w in words), np.int64, len(words)), steps) for words, _, steps in requests],
                    pack(b"\n".join(ordered), np.array([total[w] for w in ordered], np.int64)), sum(c > 0 for c in total.values()), len(total))


def build_and_look_up(table: pa.Table, order: int, last: bool, smoothing: float) -> pa.Table:
    """One shard of contexts: add up its n-grams, build its trie, answer every request from it."""
    one_thread()
    requests = [unpack(r.as_py()) for r in table.column("request")]   # narrow numbers; widened one request at a time
    words = np.unique(np.concatenate([np.cumsum(r[0], dtype=_U64) for r in requests]))
    v, ends = len(words), np.cumsum([0, *(len(r[4]) for r in requests)])
    own, lower, path, before = np.empty(ends[-1], np.int32), np.empty(ends[-1], np.int32), [], []
    key = np.empty(ends[-1], np.int64)   # the last words; the nodes of their contexts are added below
    follow = []
    for r, a, b in zip(requests, ends[:-1], ends[1:], strict=True):
        rank = np.searchsorted(words, np.cumsum(r[0], dtype=_U64))
        path.append(rank[r[1]].astype(np.int32).reshape(-1, order - 1))
        before.append(r[2].astype(np.int64))
        follow.append(r[3].astype(np.int32))
        key[a:b], own[a:b], lower[a:b] = rank[r[4]], r[5], r[6][r[4]] if order == 2 else r[6]
        r.clear()   # the joined arrays hold all that is needed
    path, before, follow = np.concatenate(path), np.concatenate(before), np.concatenate(follow)

    node, levels, nodes = path[:, 0], [], v
    for j in range(1, order - 1):
        walk = node.astype(np.int64) * v + path[:, j]
        first, starts, node = _sorted(walk)
        levels.append(walk[first[starts]])
        nodes = len(starts)
    context = np.zeros(nodes, np.int64)
    context[node] = before
    key += np.repeat(node.astype(np.int64) * v, follow)
    del before, follow
    first, starts, which = _sorted(key)
    key = key[first[starts]]
    count = np.add.reduceat(own[first], starts, dtype=np.int64)
    shorter = lower[first[starts]]   # one for an n-gram, whichever unit asks
    del own, lower, first, starts
    seen = count > 0
    codes = [np.zeros(0, np.uint16)]
    for at in blocks(len(key)):
        i = np.flatnonzero(seen[at]) + at.start
        codes.append(code_of((count[i] + smoothing * 10.0 ** (-shorter[i] / GRID)) / (context[key[i] // v] + smoothing)).astype(np.uint16))
    raw = Trie.encode(words, [*levels, key[seen]], code_of(smoothing / (context + smoothing)), np.concatenate(codes))

    trie = Trie(mapped(raw))
    # every distinct context is walked once, every distinct n-gram looked up once
    sample = np.full(nodes, -1, np.int32)
    sample[node] = np.arange(len(node), dtype=np.int32)
    contexts = np.flatnonzero(sample >= 0)
    sample = sample[contexts]
    at = trie.word(words[path[sample, 0]])
    for j in range(1, order - 1):
        at = trie.child(j - 1, at, trie.word(words[path[sample, j]]))
    walked = np.full(nodes, -1, np.int64)
    walked[contexts] = at
    code = np.empty(len(key), np.int32)
    for at in blocks(len(key)):
        parent, ending = np.divmod(key[at], v)
        leaf = trie.child(order - 2, walked[parent], ending)
        code[at] = np.where(leaf >= 0, trie.codes[np.maximum(leaf, 0)] if trie.leaves else 0, trie.back_off[walked[parent]].astype(np.int64) + shorter[at])
    nothing = np.zeros(0, np.int64)
    answers = [pack(code[which[a:b]], nothing if last else count[which[a:b]]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return _answers(order, table.column("shard")[0].as_py(), table.column("unit").to_pylist(), answers, raw)


# ---------------------------------------------------------------- Spark

def _answered(answers: pa.Table) -> dict[int, dict[int, bytes]]:
    out: dict[int, dict[int, bytes]] = {}
    for o, s, raw in zip(answers.column("gram").to_pylist(), answers.column("shard").to_pylist(), answers.column("answer").to_pylist(), strict=True):
        out.setdefault(o, {})[s] = raw
    return out


def _word_requests(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.to_pylist():
            for s, raw in _Unit(row).word_requests(row["words"].split(b"\n"), shards):
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([row["unit"]], pa.int64()), pa.array([raw], pa.binary())], ["shard", "unit", "request"])


def _requests(units: pa.Table, answers: pa.Table, corpus: Corpus, order: int) -> pa.Table:
    row = units.to_pylist()[0]
    asked, _, _ = _Unit(row).climb(_answered(answers), corpus, order)
    return pa.table([pa.array([s for s, _ in asked], pa.int32()), pa.array([row["unit"]] * len(asked), pa.int64()), pa.array([raw for _, raw in asked], pa.binary())],
                    ["shard", "unit", "request"])


def _score(units: pa.Table, answers: pa.Table, corpus: Corpus, order: int) -> pa.Table:
    unit = _Unit(units.to_pylist()[0])
    _, count, code = unit.climb(_answered(answers), corpus, order)
    starts, n = np.cumsum(unit.sizes) - unit.sizes, corpus.n
    base = np.log10((count + 1) / (n + corpus.v + 1))
    return pa.table([
        pa.array(unit.docs, pa.int64()), pa.array(~unit.train, pa.bool_()), pa.array(unit.sizes, pa.int64()),
        pa.array(np.add.reduceat((count > 0)[unit.tokens], starts, dtype=np.int64), pa.int64()), pa.array(np.full(len(starts), n), pa.int64()),
        pa.array(np.add.reduceat(base[unit.tokens], starts), pa.float64()),
        pa.array(-np.add.reduceat(code, starts, dtype=np.int64) / GRID, pa.float64())], [c.split()[0] for c in _SCORES.split(", ")])


def _asker(corpus: Corpus, order: int):
    return lambda u, a: _requests(u, a, corpus, order)


def _builder(order: int, last: bool, smoothing: float):
    return lambda t: build_and_look_up(t, order, last, smoothing)


def fit_and_score(docs: DataFrame, train: Column, order: int = ORDER, smoothing: float = SMOOTHING,
                  unit_tokens: int = UNIT_TOKENS, shard_tokens: int = SHARD_TOKENS) -> tuple[DataFrame, DataFrame]:
    """Scores of all rows of ``docs`` (doc_id, text) by a model of those where ``train`` holds, and the model.

    Scores: doc_id, held_out, n_tokens (words and the end), n_known (seen in
    training), train_tokens, base_score (words alone) and score (log10
    probability of the text, end included). Model: gram (order), shard and trie
    (bytes for ``Trie``; for words the packed words and counts by falling count,
    whose places, shard after shard, number the words in all tries).

    Edge cases: a null text counts as empty and scores its end; a null ``train``
    is held out; rows that repeat are each learned and scored; without training
    rows every score is 0; an empty table gives empty results; a text of any
    length is one document of one unit; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.col("text").cast("string").alias("text"))
    units = write_stage(rows.mapInArrow(lambda b: _units(b, unit_tokens), _UNITS), "lm-units")
    size = units.agg(F.sum("n_tokens").alias("tokens"), F.sum("n_train").alias("train"), F.sum("n_words").alias("words")).first()
    if size["tokens"] is None:
        return spark.createDataFrame([], _SCORES), spark.createDataFrame([], "gram int, shard int, trie binary")
    shards = {1: -(-size["words"] // SHARD_WORDS), **{o: -(-size["tokens"] // shard_tokens) for o in range(2, order + 1)}}
    request = "shard int, unit long, request binary"
    asked = units.mapInArrow(lambda b: _word_requests(b, shards[1]), request)
    answers = write_stage(asked.groupBy("shard").applyInArrow(count_words, _ANSWERS), "lm-words")
    found = answers.where("unit is null").select("shard", "known", "distinct").orderBy("shard").collect()   # one row for each shard of words
    units = units.drop("words")   # the answers say which words they are about
    ends = np.cumsum([r["distinct"] for r in found]).tolist()
    corpus = Corpus(size["train"], sum(r["known"] for r in found), shards, {r["shard"]: e - r["distinct"] for r, e in zip(found, ends, strict=True)})
    for o in range(2, order + 1):
        asked = units.groupBy("unit").cogroup(_replies(answers).groupBy("unit")).applyInArrow(_asker(corpus, o), request)
        answers = answers.unionByName(write_stage(asked.groupBy("shard").applyInArrow(_builder(o, o == order, smoothing), _ANSWERS), f"lm-{o}-grams"))
    scores = units.groupBy("unit").cogroup(_replies(answers).groupBy("unit")).applyInArrow(lambda u, a: _score(u, a, corpus, order), _SCORES)
    return scores, answers.where("unit is null").select("gram", "shard", "trie")


def _replies(answers: DataFrame) -> DataFrame:
    return answers.where("unit is not null").select("unit", "gram", "shard", "answer")


def score_documents(docs: DataFrame, train: Column, order: int = ORDER) -> DataFrame:
    """The scores of ``fit_and_score``."""
    return fit_and_score(docs, train, order)[0]
