"""Token-id files coded by a static range asymmetric numeral system (rANS).

Layout of one data set (``write_token_files``), a folder with three tables:

``blocks``  one row for each block: ``part`` and ``block`` (their order is the
            order of documents), ``start`` (ids before the block in its part),
            ``n_tokens``, ``doc_ids``, ``doc_tokens`` and ``payload``, the coded
            bytes. Every block decodes on its own.
``parts``   ids before each part, so that parts can be read in parallel.
``table``   the shared frequency of each id that occurs, out of ``1 << SCALE_BITS``.

A payload is little-endian: magic, lanes, ids, checkpoints, then for each
segment its first word's place, its CRC-32 and the states of all lanes, then
32-bit words. Id ``i`` of a block belongs to lane ``i % lanes``; a segment is
``STEPS`` ids of each lane, and may be decoded without the segments before it,
since its checkpoint holds the states with which its decoder begins.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajlake.llm.shared import one_thread, shared_dir, spans, text_arrays

MAGIC = b"RNS1"
SCALE_BITS = 20
LANES = 1024
STEPS = 128          # a checkpoint every LANES * STEPS ids
BLOCK_TOKENS = 524_288
LOW = np.uint64(1 << 31)   # states stay in [LOW, LOW << 32)
CACHE_PIECES = 500_000     # pieces that one worker remembers; beyond that, only those of the last call
SPAN_BYTES = 1 << 24       # text that is cut into words at once: the more, the fewer lookups of one word

U = np.uint64


# ---------------------------------------------------------------- coding

def quantise(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Frequencies that sum to ``1 << bits``; every id that occurs gets 1 at least."""
    total, scale = int(counts.sum()), 1 << bits
    if total == 0:
        return np.zeros(len(counts), np.int64)
    if int((counts > 0).sum()) > scale:
        raise ValueError("more ids than the scale has places")
    freq = np.where(counts > 0, np.maximum(1, (counts.astype(np.float64) * (scale / total)).astype(np.int64)), 0)
    # Rounding differences go to the largest frequencies, which bear them best.
    diff = scale - int(freq.sum())
    order = np.argsort(-freq, kind="stable")
    i = 0
    while diff:
        k = order[i % len(order)]
        room = diff if diff > 0 else -min(-diff, int(freq[k]) - 1, max(1, int(freq[k]) // 2))
        freq[k] += room
        diff -= room
        i += 1
    return freq


class Table:
    """Shared frequencies with what coding and decoding look up."""

    def __init__(self, freq: np.ndarray, bits: int = SCALE_BITS):
        self.bits = bits
        self.freq = freq.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.limit = self.freq << U(63 - bits)   # a state from here on gives off a word first
        self._symbols: np.ndarray | None = None

    @property
    def symbols(self) -> np.ndarray:
        if self._symbols is None:
            kind = np.uint16 if len(self.freq) <= 1 << 16 else np.uint32   # small enough for a core's cache
            self._symbols = np.repeat(np.arange(len(self.freq), dtype=kind), self.freq.astype(np.int64))
        return self._symbols


def encode_block(ids: np.ndarray, table: Table, lanes: int = LANES, steps: int = STEPS) -> bytes:
    """Code one block of ids (at least one)."""
    n = len(ids)
    rows = -(-n // lanes)
    grid = np.zeros(rows * lanes, np.int64)
    grid[:n] = ids
    grid = grid.reshape(rows, lanes)
    freq, cum, limit = table.freq[grid], table.cum[grid], table.limit[grid]
    scale, word = U(table.bits), U(0xFFFFFFFF)
    state = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = []
    marks: list[tuple[np.ndarray, int]] = []   # from the last segment to the first
    for r in range(rows - 1, -1, -1):
        k = lanes if r < rows - 1 else n - r * lanes   # the last row may be short
        x, f = state[:k], freq[r, :k]
        full = x >= limit[r, :k]
        if full.any():
            words.append((x[full] & word).astype(np.uint32))
            x = np.where(full, x >> U(32), x)
        q = x // f
        state[:k] = (q << scale) + (x - q * f) + cum[r, :k]
        if r % steps == 0:
            marks.append((state.copy(), len(words)))
    total = [0]
    for w in reversed(words):
        total.append(total[-1] + len(w))
    body = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    head = [MAGIC, struct.pack("<III", lanes, n, len(marks))]
    tail = []
    for s, (at_state, emitted) in enumerate(reversed(marks)):
        seg = ids[s * steps * lanes:(s + 1) * steps * lanes]
        head.append(struct.pack("<II", total[len(words) - emitted], zlib.crc32(np.ascontiguousarray(seg, "<u4").tobytes())))
        tail.append(at_state.astype("<u8").tobytes())
    return b"".join([*head, *tail, body.astype("<u4").tobytes()])


def decode_block(payload: bytes, table: Table, segments: list[int] | None = None, steps: int = STEPS) -> np.ndarray:
    """Ids of a block, or of some of its segments; raises ValueError where a checksum does not hold."""
    if payload[:4] != MAGIC:
        raise ValueError("not a token block")
    lanes, n, n_marks = struct.unpack_from("<III", payload, 4)
    firsts = np.frombuffer(payload, "<u4", 2 * n_marks, 16).reshape(n_marks, 2)
    at = 16 + 8 * n_marks
    states = np.frombuffer(payload, "<u8", lanes * n_marks, at).reshape(n_marks, lanes)
    body = np.frombuffer(payload, "<u4", offset=at + 8 * lanes * n_marks)
    mask, scale, freq, cum, symbols = U((1 << table.bits) - 1), U(table.bits), table.freq, table.cum, table.symbols
    out = []
    for s in range(n_marks) if segments is None else segments:
        state, w = states[s].astype(np.uint64), int(firsts[s, 0])
        size = min(n - s * steps * lanes, steps * lanes)
        got = np.empty(size, np.uint32)
        for r in range(-(-size // lanes)):
            k = min(lanes, size - r * lanes)
            x = state[:k]
            slot = x & mask
            sym = symbols.take(slot.view(np.int64))
            got[r * lanes:r * lanes + k] = sym
            x = freq.take(sym) * (x >> scale) + slot - cum.take(sym)
            low = x < LOW
            m = int(np.count_nonzero(low))
            if m:
                x[low] = (x[low] << U(32)) | body[w:w + m]
                w += m
            state[:k] = x
        if zlib.crc32(got.astype("<u4").tobytes()) != int(firsts[s, 1]):
            raise ValueError(f"checksum of segment {s} does not hold")
        out.append(got)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


# ---------------------------------------------------------------- tokenizing

# The pre-tokenizer's pattern of the 49k vocabulary, over lower-cased text in the plain ranges below.
_LETTERS, _NUMBERS = "a-zªµºß-öø-ɏ", "0-9²³¹¼½¾"
_PIECES = rf"[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_NUMBERS}]|[^\x09-\x0d {_LETTERS}{_NUMBERS}]+"
# Texts in these ranges are the same before and after NFC, and lower-casing them is per character.
_NOT_PLAIN = re.compile(r"[^\x09-\x0d\x20-\x7e\xa1-įı-ɏ‐-‧‰-⁞]")
_PLAIN_ASCII = bytes([*range(9, 14), *range(32, 127)])
# The vocabulary spells the bytes of a piece as letters: visible ones stand for themselves, the others follow from 256 on.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_LETTERS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
_state: dict = {}


def _plain(text: str) -> str | None:
    """The text lower-cased, if it and its lower case are in the plain ranges."""
    if text.isascii():
        return None if text.encode().translate(None, _PLAIN_ASCII) else text.lower()
    if _NOT_PLAIN.search(text):
        return None
    low = text.lower()   # some letters of the plain ranges have lower cases outside them
    return None if _NOT_PLAIN.search(low) else low


def _binary(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """Binary values of bytes and offsets (int64, one more than values)."""
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])


class WordCoder:
    """Token ids of whole texts, piece by piece: a piece seen before is not coded again.

    The vocabulary's pre-tokenizer cuts a text into pieces that are coded
    independently and hold no white space. So the ids of a text are those of its
    words (runs without white space) in a row, and the ids of a word those of
    its pieces. The texts of a call are cut together: each distinct word is cut
    once, each distinct piece looked up once, and what is new goes to the
    library in one call. Texts outside the plain ranges, before or after lower-casing, and
    texts that may hold an added token, go to the library whole. Memory is
    bounded by the texts of a call and ``CACHE_PIECES``.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        one_thread()
        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.kind = np.dtype("<u2") if max(vocab.values()) < 1 << 16 else np.dtype("<u4")
        self.size = max(vocab.values()) + 1
        normal = str(type(self.tok.normalizer).__name__), str(type(self.tok.pre_tokenizer).__name__)
        spec = self.tok.to_str()
        self.by_word = normal == ("Sequence", "Sequence") and "[\\\\p{L}]+|[\\\\p{N}]|" in spec and '"ByteLevel","add_prefix_space":false' in spec and '"end_of_word_suffix":"</w>"' in spec
        # Added tokens are found in the raw or in the normalised text; every such text holds one of these lower-cased.
        added = {t.content.lower() for t in self.tok.get_added_tokens_decoder().values()}
        self.by_word = self.by_word and not any(_NOT_PLAIN.search(a) or re.search(r"\s", a) for a in added)
        self.added = sorted(added - {""})
        spelling = [_BYTE_LETTERS.get(b, b) for b in range(256)]
        self.by_word = self.by_word and all(f"{chr(c)}</w>" in vocab for c in spelling)   # so each piece has one last id, known by its suffix
        self.last = np.zeros(self.size, bool)
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.merges = Tokenizer(self.tok.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.cut = re.compile(_PIECES + r"|\n")
        self.known = pa.array(["\n"], pa.large_string())   # what parts words has no ids; it stays in the first place
        self.ids = pa.array([b""], pa.large_binary())

    def _raw(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _learn(self, pieces: list[str]) -> pa.Array:
        """Code pieces with the vocabulary's merges alone: they are normalised and cut already."""
        spelt = [p if p.isascii() else p.encode("utf-8").decode("latin-1").translate(_BYTE_LETTERS) for p in pieces]
        lines = [" ".join(spelt[k:k + 100]) for k in range(0, len(spelt), 100)]
        ids = np.fromiter(chain.from_iterable(e.ids for e in self.merges.encode_batch_fast(lines, add_special_tokens=False)), self.kind)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(pieces) or ends[-1] != len(ids):
            raise ValueError("a piece without a last id")
        return _binary(ids.view(np.uint8), np.concatenate([[0], ends * self.kind.itemsize]))

    def _pieces(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces as binary values; those not remembered are learned."""
        at = pc.index_in(pieces, value_set=self.known)
        new = pieces.filter(at.is_null())
        known, ids = self.known, self.ids
        if len(new):
            known, ids = pa.concat_arrays([known, new]), pa.concat_arrays([ids, self._learn(new.to_numpy(zero_copy_only=False).tolist())])
            place = at.fill_null(-1).to_numpy().copy()
            place[place < 0] = np.arange(len(self.known), len(known))
            at = pa.array(place)
        got = ids.take(at)
        if len(known) > CACHE_PIECES:
            known, ids = pa.concat_arrays([known[:1], pieces]), pa.concat_arrays([ids[:1], got])
        self.known, self.ids = known, ids
        return got

    def _words(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words (at least one) as binary values."""
        each = pa.array(self.cut.findall("\n".join(words.to_numpy(zero_copy_only=False))), pa.large_string()).dictionary_encode()
        line = pc.index(each.dictionary, pa.scalar("\n", pa.large_string())).as_py()
        data, at = text_arrays(self._pieces(each.dictionary).take(each.indices))
        return _binary(data, np.concatenate([[0], at[np.flatnonzero(each.indices.to_numpy() == line)], at[-1:]]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian integers of ``kind``; the texts' words are cut and told apart together."""
        if not self.by_word:
            return [np.asarray(e.ids, self.kind).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        lows = [None if (low := _plain(text)) is None or any(a in low for a in self.added) else low for text in texts]
        words = pc.ascii_split_whitespace(pa.array([low or "" for low in lows], pa.large_string()))   # plain texts hold no other white space
        each = words.values.dictionary_encode()
        if not len(each):
            return []
        data, at = text_arrays(self._words(each.dictionary).take(each.indices))
        ends = at[words.offsets.to_numpy()].tolist()
        return [self._raw(text) if low is None else data[i:j].tobytes() for text, low, i, j in zip(texts, lows, ends[:-1], ends[1:], strict=True)]


def _coder(path: str) -> WordCoder:
    """One coder for each worker process, kept from task to task."""
    if path not in _state:
        _state[path] = WordCoder(path)
    return _state[path]


# ---------------------------------------------------------------- Spark

def _raw_blocks(batches: Iterator[pa.RecordBatch], path: str, end_id: int, block_tokens: int) -> Iterator[pa.RecordBatch]:
    """Tokenize documents in order and pack whole documents into blocks of about ``block_tokens`` ids."""
    from pyspark import TaskContext

    coder = _coder(path)
    end = np.asarray([end_id], coder.kind).tobytes()
    width, part = coder.kind.itemsize, TaskContext.get().partitionId()
    ids: list[int | None] = []
    sizes: list[int] = []
    raw: list[bytes] = []
    held, block, start = 0, 0, 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()), "start": pa.array([start], pa.int64()),
            "n_tokens": pa.array([held], pa.int64()), "doc_ids": pa.array([ids], pa.list_(pa.int64())),
            "doc_tokens": pa.array([sizes], pa.list_(pa.int64())), "raw": pa.array([b"".join(raw)], pa.binary())})

    for batch in batches:
        data, at = text_arrays(batch.column("text"))
        keys = batch.column("doc_id").to_pylist()
        for i, j in spans(at, SPAN_BYTES):
            texts = [data[at[k]:at[k + 1]].tobytes().decode("utf-8", "replace") for k in range(i, j)]
            for key, got in zip(keys[i:j], coder.encode(texts), strict=True):
                n = len(got) // width + 1
                ids.append(key)
                sizes.append(n)
                raw += [got, end]
                held += n
                if held >= block_tokens:
                    yield flush()
                    start, block = start + held, block + 1
                    ids, sizes, raw, held = [], [], [], 0
    if ids:
        yield flush()


def _count(batches: Iterator[pa.RecordBatch], kind: str, size: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(size, np.int64)
    for batch in batches:
        for raw in batch.column("raw"):
            total += np.bincount(np.frombuffer(raw.as_buffer(), kind), minlength=size)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"id": pa.array(used, pa.int32()), "n": pa.array(total[used], pa.int64())})


def _pack(batches: Iterator[pa.RecordBatch], kind: str, freq: np.ndarray, names: list[str]) -> Iterator[pa.RecordBatch]:
    table = Table(freq)
    for batch in batches:
        payload = [encode_block(np.frombuffer(raw.as_buffer(), kind), table) for raw in batch.column("raw")]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(payload, pa.binary())], [*names, "payload"])


def _unpack(batches: Iterator[pa.RecordBatch], freq: np.ndarray) -> Iterator[pa.RecordBatch]:
    table = Table(freq)
    for batch in batches:
        for k in range(batch.num_rows):
            ids = decode_block(batch.column("payload")[k].as_py(), table)
            sizes = np.asarray(batch.column("doc_tokens")[k].as_py(), np.int64)
            if len(ids) != int(sizes.sum()):
                raise ValueError("a block does not hold the ids of its documents")
            ends = np.cumsum(sizes)
            raw, at = ids.astype("<u4").tobytes(), np.concatenate([[0], ends])
            values = [raw[4 * a:4 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_ids")[k].values, pa.array(at[:-1] + batch.column("start")[k].as_py() + batch.column("part_start")[k].as_py(), pa.int64()),
                pa.array(sizes, pa.int64()), pa.array([zlib.crc32(v) for v in values], pa.int64()), pa.array(values, pa.binary())],
                ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, block_tokens: int = BLOCK_TOKENS) -> str:
    """Tokenize ``docs`` (doc_id, text) and write them to folder ``path`` in ascending doc_id order.

    Documents are dealt to tasks by ranges of (doc_id, hash of text, place in
    the scan), so rows that share an id are spread like any others. Ids are
    counted over everything that was tokenized; the table of frequencies has one
    row for each id of the vocabulary at the most, which bounds what the driver
    collects and sends out. A null text counts as empty, a null doc_id sorts
    first, an empty table makes a data set without blocks.
    """
    spark = docs.sparkSession
    coder = _coder(tokenizer_path)
    kind, size = coder.kind.str, coder.size
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .withColumn("tie", F.xxhash64("text")).withColumn("uid", F.monotonically_increasing_id())
               .repartitionByRange("doc_id", "tie", "uid").sortWithinPartitions("doc_id", "tie", "uid")
               .select("doc_id", "text"))
    head = "part int, block int, start long, n_tokens long, doc_ids array<bigint>, doc_tokens array<bigint>"
    raw_path = f"{path}/raw"
    (ordered.mapInArrow(lambda b: _raw_blocks(b, tokenizer_path, end_id, block_tokens), f"{head}, raw binary")
     .write.option("compression", "zstd").parquet(raw_path))
    raw = spark.read.schema(f"{head}, raw binary").parquet(raw_path)

    counts = np.zeros(size, np.int64)
    for r in raw.select("raw").mapInArrow(lambda b: _count(b, kind, size), "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r["id"]] = r["n"]
    freq = quantise(counts)
    used = np.flatnonzero(freq)
    spark.createDataFrame([(int(i), int(freq[i])) for i in used], "id int, freq long").coalesce(1).write.parquet(f"{path}/table")

    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # one row for each part
    (raw.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
     .withColumn("part_start", F.coalesce(F.sum("n_tokens").over(ahead), F.lit(0))).write.parquet(f"{path}/parts"))

    names = ["part", "block", "start", "n_tokens", "doc_ids", "doc_tokens"]
    shared = spark.sparkContext.broadcast(freq)
    (raw.mapInArrow(lambda b: _pack(b, kind, shared.value, names), f"{head}, payload binary")
     .write.option("compression", "none").parquet(f"{path}/blocks"))
    return path


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Decode a data set: doc_id, start, n_tokens, ids_crc32 and ids (little-endian unsigned 32-bit) of each document."""
    head = "part int, block int, start long, n_tokens long, doc_ids array<bigint>, doc_tokens array<bigint>, payload binary"
    rows = spark.read.schema("id int, freq long").parquet(f"{path}/table").collect()   # one for each id of the vocabulary at the most
    freq = np.zeros(max([r["id"] for r in rows], default=0) + 1, np.int64)
    for r in rows:
        freq[r["id"]] = r["freq"]
    shared = spark.sparkContext.broadcast(freq)
    parts = spark.read.schema("part int, n_tokens long, part_start long").parquet(f"{path}/parts").select("part", "part_start")
    blocks = spark.read.schema(head).parquet(f"{path}/blocks").join(parts, "part")
    return blocks.select("start", "part_start", "doc_ids", "doc_tokens", "payload").mapInArrow(
        lambda b: _unpack(b, shared.value), "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None) -> DataFrame:
    """Write the token files of ``docs`` (to the shared folder unless ``path`` is given) and read them back."""
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark).rstrip('/')}/trajlake-tokens-{uuid.uuid4().hex}"
    return read_token_files(spark, write_token_files(docs, path, tokenizer_path, end_id))
