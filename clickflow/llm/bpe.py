"""Byte-level BPE encoding and decoding over length-bucketed, padded numpy matrices.

A text is split by the vocabulary's pattern; every match is encoded by itself, a match that is a
token as that token. The distinct other matches of a run of texts become rows of matrices, one for
each bucket of lengths. Each round merges, in every row, the leftmost pair of minimum rank: the pair
ranks come from an open-addressing hash table probed for all rows at once, the merged pair's second
place is compacted out of every row (so the matrix narrows by one), and rows without a mergeable
pair leave.

A match of more than ``LONG`` bytes (say, a megabyte of one letter) would need as many rounds as it
has bytes; it merges in the same order through a heap, in n log n steps.

No special tokens: their strings in a text are ordinary text. Null is the empty text, whose ids are
empty. No shuffle; a row is encoded where it is read; memory is bounded by the longest text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm.common import arrow_text, columns_but, python_path, text_chunks

LONG = 512
BUCKETS = (4, 8, 12, 16, 24, 32, 64, 128, 256, LONG)
NONE = np.iinfo(np.int32).max
CACHED_PIECES = 100_000
CHUNK_CHARS = 1 << 19
#: Cells of one matrix.
MATRIX_CELLS = 1 << 20


class PairTable:
    """Rank of the token that two adjacent tokens merge to: open addressing, probed for whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        bits = max(8, int(4 * max(len(rank), 1) - 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << bits, NONE, dtype=np.int32)
        keys = (left.astype(np.int64) << 32) | right
        slot, pending = self._slot(keys), np.arange(len(keys))
        while len(pending):
            free = pending[self.keys[slot[pending]] == -1]
            self.keys[slot[free]] = keys[free]
            self.ranks[slot[free]] = rank[free]
            pending = pending[self.keys[slot[pending]] != keys[pending]]
            slot[pending] = (slot[pending] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.ranks[slot], NONE).astype(np.int32)
        open_ = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            held = self.keys[slot[open_]]
            same = held == keys[open_]
            out[open_[same]] = self.ranks[slot[open_[same]]]
            open_ = open_[~same & (held != -1)]
        return out


class Encoder:
    """Ranks file (``base64 rank`` lines) and split pattern."""

    def __init__(self, ranks_file: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines()) if a}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items()
                 for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        self.pairs = PairTable(*np.array(pairs or [(0, 0, NONE)], dtype=np.int64).T)
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= CHUNK_CHARS):
                size += len(texts[end])
                end += 1
            split = [self.split(t) for t in texts[at:end]]
            if len(self.known) > CACHED_PIECES:
                self.known.clear()
            self._learn(list(set().union(*split).difference(self.known)))
            known = self.known.__getitem__
            for pieces in split:
                yield b"".join(map(known, pieces))
            at = end

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def _learn(self, pieces: list[str]) -> None:
        rows: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            data = piece.encode()
            rank = self.ranks.get(data)
            if rank is not None:
                self.known[piece] = rank.to_bytes(4, "little")
            elif len(data) > LONG:
                self.known[piece] = self._by_heap(data)
            else:
                rows.setdefault(next(b for b in BUCKETS if b >= len(data)), []).append((piece, data))
        for width, bucket in rows.items():
            for lo in range(0, len(bucket), MATRIX_CELLS // width):
                part = bucket[lo:lo + MATRIX_CELLS // width]
                for (piece, _), ids in zip(part, self._by_matrix([d for _, d in part], width)):
                    self.known[piece] = ids

    def _by_matrix(self, pieces: list[bytes], width: int) -> list[bytes]:
        lengths = np.array([len(p) for p in pieces])
        flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8)
        ids = self.bytes[flat].reshape(len(pieces), width)
        ids[np.arange(width) >= lengths[:, None]] = -1
        ranks = np.full((len(pieces), width), NONE, dtype=np.int32)  # of the pair that begins there
        inner = np.flatnonzero((ids[:, 1:] >= 0).ravel())
        left, right = ids[:, :-1].ravel()[inner], ids[:, 1:].ravel()[inner]
        r, c = np.divmod(inner, width - 1)
        ranks[r, c] = self.pairs.of(left, right)
        out: list[bytes] = [b""] * len(pieces)
        row = np.arange(len(pieces))
        while len(row):
            at = ranks.argmin(axis=1)
            every = np.arange(len(row))
            best = ranks[every, at]
            ended = best == NONE
            if ended.any():
                for i in np.flatnonzero(ended).tolist():
                    out[row[i]] = ids[i, :lengths[i]].astype("<u4").tobytes()
                going = ~ended
                row, ids, ranks, lengths, at, best = (x[going] for x in (row, ids, ranks, lengths, at, best))
                every = np.arange(len(row))
                if not len(row):
                    break
            ids[every, at] = best
            keep = np.ones(ids.shape, dtype=bool)
            keep[every, at + 1] = False
            ids = ids[keep].reshape(len(row), -1)
            ranks = ranks[keep].reshape(len(row), -1)  # the merged pair's place now is its right pair's
            lengths = lengths - 1
            ranks[every, at] = NONE
            i = np.flatnonzero(at + 1 < lengths)
            ranks[i, at[i]] = self.pairs.of(best[i], ids[i, at[i] + 1])
            i = np.flatnonzero(at > 0)
            ranks[i, at[i] - 1] = self.pairs.of(ids[i, at[i] - 1], best[i])
            width = int(lengths.max())
            if width < ids.shape[1]:
                ids, ranks = ids[:, :max(width, 1)], ranks[:, :max(width, 1)]
        return out

    def _by_heap(self, data: bytes) -> bytes:
        ids = self.bytes[np.frombuffer(data, np.uint8)]
        first = self.pairs.of(ids[:-1], ids[1:])
        heap = [(r, i) for i, r in enumerate(first.tolist()) if r != NONE]
        heapq.heapify(heap)
        ids, rank = ids.tolist(), [*first.tolist(), NONE]
        right, left = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]

        def put(i: int) -> None:
            token = self.tokens[ids[i]] + self.tokens[ids[right[i]]] if i >= 0 and right[i] >= 0 else b""
            if i >= 0:
                rank[i] = self.ranks.get(token, NONE)
                if rank[i] != NONE:
                    heapq.heappush(heap, (rank[i], i))

        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or rank[i] != r:
                continue  # stale: merged or changed since
            gone = right[i]
            ids[i], ids[gone], right[i] = r, -1, right[gone]
            if right[i] >= 0:
                left[right[i]] = i
            put(i)
            put(left[i])
        return np.array([x for x in ids if x >= 0], dtype="<u4").tobytes()


_encoders: dict[tuple[int, str], Encoder] = {}


def _encoder(ranks_file: bytes, pattern: str) -> Encoder:
    """One encoder for each vocabulary in a Python worker."""
    key = (hash(ranks_file), pattern)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(ranks_file, pattern)
    return _encoders[key]


def _vocabulary(spark: SparkSession, ranks_path: str):
    python_path(spark)
    with open(ranks_path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())  # the vocabulary file: its size is fixed


def _parts(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of whole rows of a few MB of text: a worker holds the lists of one run."""
    for batch in batches:
        for lo, hi, _, _ in text_chunks(arrow_text(batch.column(batch.schema.get_field_index(text_col)))):
            yield batch.slice(lo, hi - lo)
    pa.default_memory_pool().release_unused()  # a worker that waits for its next task holds no freed batches


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col`` (array of int). Every other column passes through; a column called
    ``ids_col`` is replaced. Null and empty texts have no ids; repeated rows are encoded each."""
    ranks = _vocabulary(docs.sparkSession, ranks_path)
    given = docs.select(*columns_but(docs, ids_col), F.lit(None).cast("array<int>").alias(ids_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks.value, pattern)
        for batch in _parts(batches, text_col):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            ids = pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in encoder.encode(texts)],
                           pa.list_(pa.int32()))
            at = batch.schema.get_field_index(ids_col)
            yield batch.set_column(at, pa.field(ids_col, ids.type), ids)

    return given.mapInArrow(run, given.schema)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids",
           bytes_col: str = "decoded") -> DataFrame:
    """``encoded`` with ``bytes_col`` (binary): the tokens' bytes, joined. Null ids give null."""
    ranks = _vocabulary(encoded.sparkSession, ranks_path)
    given = encoded.select(*columns_but(encoded, bytes_col), F.lit(None).cast("binary").alias(bytes_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks.value, pattern)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            data = pa.array([None if x is None else b"".join(map(encoder.tokens.__getitem__, x)) for x in ids],
                            pa.binary())
            at = batch.schema.get_field_index(bytes_col)
            yield batch.set_column(at, pa.field(bytes_col, data.type), data)

    return given.mapInArrow(run, given.schema)


def digest(docs: DataFrame, ranks_path: str, pattern: str, ids_col: str | None = None) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit
    integers), decoded_sha256 (of the bytes that the ids decode to), and the ids if ``ids_col`` names
    a column for them."""
    ranks = _vocabulary(docs.sparkSession, ranks_path)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *([ids_col] if ids_col else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks.value, pattern)
        for batch in _parts(batches, "text"):
            n, ids_hex, text_hex, kept = [], [], [], []
            for ids in encoder.encode([t or "" for t in batch.column(1).to_pylist()]):
                n.append(len(ids) // 4)
                ids_hex.append(hashlib.sha256(ids).hexdigest())
                text_hex.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                if ids_col:
                    kept.append(np.frombuffer(ids, "<u4").astype(np.int32))
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())]
            if ids_col:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    given = docs.select("doc_id", "text")
    schema = f"doc_id {dict(given.dtypes)['doc_id']}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return given.mapInArrow(run, schema + (f", `{ids_col}` array<int>" if ids_col else ""))
