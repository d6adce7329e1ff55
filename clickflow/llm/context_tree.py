"""Language-model scores by context-tree weighting over bytes.

Each byte is eight binary decisions; the 255 places of a decision (the bits before it) have a context tree
each. A node is a decision behind up to ``depth`` preceding bytes, the nearest first. It counts the zeros
and ones seen there and gives them the Krichevsky-Trofimov probability KT; its weighted probability is the
mean of KT and the product of its children's weighted probabilities (KT alone at full depth). KT's part of
the weighted probability is the posterior weight of stopping at the node. The prediction of a bit mixes the
KT estimates of all depths by these weights along the actual context; what lies behind a node without a
child for the context predicts one half. The code length of a text is the sum over its bytes and one end.

Training and scoring are Spark jobs; nothing of the model goes through the driver but a few sums:

1. Texts are written in blocks, compressed, a block being some rows of one task.
2. Each block is reduced to its distinct byte strings of depth + 1 and its distinct words, with how often
   training texts have them. They are dealt to buckets, a string by its nearest SPLIT bytes of context, a
   word by its hash, as one packed row per block and bucket. Buckets grow in number with the texts.
3. A bucket's task adds up all blocks' counts. It holds whatever lies deeper in the trees than SPLIT bytes,
   and sends up the nodes of that depth (at most 256 ** (depth + 1 - SPLIT) strings are behind one of them).
   Spark sums and joins the few levels above, where a node has at most 256 children.
4. With what the levels above give each of its nodes in front, a bucket answers each block's packed row:
   the log probability of every string's last byte, training texts having it or not. Word buckets answer
   with the words' counts.
5. The answers to a block are sorted to the front of its texts, which are scored in one task.

The model has no size limit: it grows with the distinct strings of the corpus, a block's part of it with
the block. Texts are read with A-Z lower-cased; the first bytes of a text follow ``depth`` zero bytes, the
end is the byte 0xFF. Words are told apart by 64-bit hashes (among 10^8 different words two of equal hash
have a chance of 3 in 10,000). Null is the empty text. Rows are trained on and scored each, repeated ones
too; a row with a null doc_id is not held out. Without training texts every bit is one half. An empty
table gives no rows; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clickflow.llm.common import arrow_text, python_path, text_chunks, written
from clickflow.llm.filter_audit import representatives
from clickflow.llm.words import LOWER

DEPTH = 5
END = 0xFF
BLOCK_BYTES = 64 << 20
BUCKET_BYTES, LEAST_BUCKETS = 64 << 20, 32
SPLIT = 3
MIX = 40503  # spreads contexts over buckets
PIECE = 2 << 20
STRING, WORD, TOTAL, TEXTS = range(4)  # kinds of rows
HELD_OUT_OF, HELD_OUT = 7, 2

IN_WORD = np.ones(256, dtype=bool)
IN_WORD[[0x20, *range(0x09, 0x0E)]] = False


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training, by the CRC-32 of its id in decimal."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == HELD_OUT, F.lit(False))


def in_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (doc_id, text, held_out) as written, some rows in one: block, ids, held_out (arrays), sizes
    (bytes of each text), data (the lower-cased texts, compressed)."""
    python_path(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size, pack = TaskContext.get().partitionId() << 32, 0, zstandard.ZstdCompressor()
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(arrow_text(batch.column(1)), PIECE):
                row = [pa.array([block + size // block_bytes]),
                       *(pa.array([batch.column(i).slice(lo, hi - lo).to_pylist()], pa.list_(batch.column(i).type)) for i in (0, 2)),
                       pa.array([np.diff(offsets)]), pa.array([pack.compress(LOWER[data].tobytes())], pa.binary())]
                size += len(data)
                yield pa.RecordBatch.from_arrays(row, ["block", "ids", "held_out", "sizes", "data"])

    schema = f"block bigint, ids array<{dict(docs.dtypes)['doc_id']}>, held_out array<boolean>, sizes array<bigint>, data binary"
    return written(docs.select("doc_id", "text", "held_out").mapInArrow(run, schema), "blocks")


class Piece:
    """Some whole texts, or a part of one that ends between words: ``keys`` are its byte strings of
    depth + 1, each with its text ``of``; ``words`` the hash of each distinct word, ``word`` the place there
    of every word, ``word_of`` its text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, depth: int, before: bytes, last: bool):
        texts = len(offsets) - 1
        parts = []
        for i in range(texts):
            parts += [np.frombuffer(before, dtype=np.uint8), data[offsets[i]:offsets[i + 1]], np.array([END] * last, dtype=np.uint8)]
        stream = np.concatenate(parts)
        sizes = np.diff(offsets) + depth + last
        ends = np.cumsum(sizes)
        keys = np.zeros(max(0, len(stream) - depth), dtype=np.uint64)
        for i in range(depth + 1):
            keys = (keys << np.uint64(8)) | stream[i:len(stream) - depth + i]
        inside = np.ones(len(keys), dtype=bool)
        for end in ends[:-1].tolist():
            inside[end - depth:end] = False  # strings that reach into the next text's front
        self.keys = keys[inside].view(np.int64)
        self.of = np.repeat(np.arange(texts), sizes - depth)
        space = ~IN_WORD[data]
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[offsets] = True
        begins = np.flatnonzero(~space & (cut[:-1] | np.concatenate([[True], space[:-1]])))
        stops = np.flatnonzero(~space & (cut[1:] | np.concatenate([space[1:], [True]]))) + 1
        self.word_of = np.searchsorted(offsets, begins, side="right") - 1
        same_as = representatives(data, begins, stops, np.zeros(len(begins), dtype=np.int64))
        first, self.word = np.unique(same_as, return_inverse=True)
        raw = memoryview(np.ascontiguousarray(data))
        hashes = [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(begins[first].tolist(), stops[first].tolist())]
        self.words = np.array(hashes, dtype=np.uint64).view(np.int64)


def pieces(sizes: list[int], data: bytes, depth: int) -> Iterator[Piece]:
    """The texts of a packed row; a text of over twice PIECE comes in several."""
    low = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    if len(sizes) > 1 or len(low) <= 2 * PIECE:
        yield Piece(low, np.concatenate([[0], np.cumsum(sizes)]), depth, bytes(depth), True)
        return
    at, before = 0, bytes(depth)
    while at < len(low):
        end = min(len(low), at + PIECE)
        while end < len(low):  # on to the next end of a word
            spaces = np.flatnonzero(~IN_WORD[low[end:end + PIECE]])
            if len(spaces):
                end += int(spaces[0])
                break
            end = min(len(low), end + PIECE)
        part = low[at:end]
        yield Piece(part, np.array([0, len(part)]), depth, before, end == len(low))
        before, at = (before + part[-depth:].tobytes())[-depth:], end


def _packed(values: np.ndarray) -> bytes:
    """Sorted integers by their differences, others as they are; compressed."""
    return zstandard.compress(np.diff(values, prepend=0).tobytes() if values.dtype == np.int64 else values.tobytes())


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    values = np.frombuffer(zstandard.decompress(data), dtype=kind)
    return np.cumsum(values) if kind is np.int64 else values


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct items, sorted, and the sums of their counts."""
    items, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return items, np.bincount(place, np.concatenate([p[1] for p in parts]), len(items))


PACKED = "block bigint, bucket bigint, kind int, items binary, amounts binary"


def _row(block: int, bucket: int, kind: int, items: np.ndarray, amounts: np.ndarray) -> pa.RecordBatch:
    values = [[block], [bucket], [kind], [_packed(items)], [_packed(amounts)]]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], [c.split()[0] for c in PACKED.split(", ")])


def gathered(blocks: DataFrame, depth: int, buckets: int) -> DataFrame:
    """PACKED rows: the distinct strings and words of each block, by bucket, with how often its training texts
    have them. A block that two tasks read has two rows for a bucket."""
    near = (1 << (8 * min(SPLIT, depth))) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = None, ([], []), [0, 0]

        def done() -> Iterator[pa.RecordBatch]:
            for kind in (STRING, WORD):
                if not held[kind]:
                    continue
                items, n = _merged(held[kind])
                bucket = ((items >> 8) & near) * MIX % buckets if kind == STRING else items % buckets
                order = np.argsort(bucket, kind="stable")
                items, n, bucket = items[order], n[order], bucket[order]
                for lo, hi in _runs(bucket):
                    yield _row(block, int(bucket[lo]), kind, items[lo:hi], n[lo:hi])

        for batch in batches:
            for number, train, sizes, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if block is not None and block != number:
                    yield from done()
                    held, size = ([], []), [0, 0]
                block, learnt = number, ~np.array(train, dtype=bool)
                for piece in pieces(sizes, data, depth):
                    keys, place = np.unique(piece.keys, return_inverse=True)
                    held[STRING].append((keys, np.bincount(place, learnt[piece.of], len(keys))))
                    held[WORD].append((piece.words, np.bincount(piece.word, learnt[piece.word_of], len(piece.words))))
                    for kind in (STRING, WORD):
                        size[kind] += len(held[kind][-1][0])
                        if size[kind] > 4 * len(held[kind][0][0]) + (1 << 20):
                            held[kind][:] = [_merged(held[kind])]
                            size[kind] = len(held[kind][0][0])
        if block is not None:
            yield from done()

    return blocks.select("block", "held_out", "sizes", "data").mapInArrow(run, PACKED)


def _runs(numbers: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of each run of equal numbers."""
    cuts = np.flatnonzero(np.diff(numbers)) + 1
    bounds = [0, *cuts.tolist(), len(numbers)] if len(numbers) else [0]
    return list(zip(bounds[:-1], bounds[1:]))


def _log_gamma(x, log):
    """By Stirling's series at x + 8, for x of 0.5 or more; of columns or arrays, with their ``log``."""
    z = x + 8
    series = (z - 0.5) * log(z) - z + 0.9189385332046727  # half the log of 2 pi
    for sign, divisor, power in ((1, 12, 1), (-1, 360, 3), (1, 1260, 5), (-1, 1680, 7), (1, 1188, 9)):
        series = series + sign / (divisor * z ** power)
    product = x
    for i in range(1, 8):
        product = product * (x + i)
    return series - log(product)


def log_kt(zeros, ones, log):
    """Natural logarithm of the Krichevsky-Trofimov probability of a sequence of such counts."""
    return _log_gamma(zeros + 0.5, log) + _log_gamma(ones + 0.5, log) - _log_gamma(zeros + ones + 1.0, log) - 1.1447298858494002  # log pi


def _mask(depth: int) -> int:
    """Of a node, the decision and the nearest ``depth`` bytes: eight bits each."""
    return (1 << (8 * depth + 8)) - 1


class Branches:
    """The nodes of some strings (``keys``, each ``n`` times in training) for the ``at``-th decision of their
    last byte, from ``depth`` up to ``least`` preceding bytes: all strings of a context of ``least`` bytes are
    here. ``levels``, the deepest first: (nodes, for each node below its place among them, zeros, ones,
    weighted, stop). A string that no training text has makes nodes without counts: those weigh one and
    predict one half, as what a tree does not have."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, at: int, depth: int, least: int):
        byte = keys & 255
        self.bit = (byte >> (7 - at)) & 1
        nodes, place = np.unique((keys >> 8 << 8) | (1 << at) | (byte >> (8 - at)), return_inverse=True)
        zeros, ones = (np.bincount(place, n * (self.bit == bit), len(nodes)) for bit in (0, 1))
        weighted = log_kt(zeros, ones, np.log)
        self.levels = [(nodes, place, zeros, ones, weighted, np.ones(len(nodes)))]
        for d in range(depth - 1, least - 1, -1):
            nodes, place = np.unique(nodes & _mask(d), return_inverse=True)
            zeros, ones, below = (np.bincount(place, x, len(nodes)) for x in (zeros, ones, weighted))
            own = log_kt(zeros, ones, np.log)
            weighted = np.logaddexp(own, below) - np.log(2)
            self.levels.append((nodes, place, zeros, ones, weighted, np.exp(own - np.log(2) - weighted)))

    def log_probability(self, heads: np.ndarray, so_far: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Of the strings' bits. ``heads``: the nodes of the least depth, sorted, with what shorter contexts
        give to a next bit of 1 and the weight they leave."""
        nodes = self.levels[-1][0]
        at = np.searchsorted(heads, nodes)
        so_far, left = so_far[at], left[at]
        for _, place, zeros, ones, _, stop in reversed(self.levels):
            so_far = (so_far + left * stop * (ones + 0.5) / (zeros + ones + 1))[place]
            left = (left * (1 - stop))[place]
        one = so_far
        return np.log(np.where(self.bit == 1, one, 1 - one))


def _by_bucket(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[int, list[tuple]]]:
    """(bucket, its rows) of batches that are sorted by their first column."""
    at, rows = None, []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(columns))):
            if at is not None and at != row[0]:
                yield at, rows
                rows = []
            at = row[0]
            rows.append(row[1:])
    if at is not None:
        yield at, rows


def _counted(rows: list[tuple[bytes, bytes]]) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(_unpacked(items, np.int64), _unpacked(n, np.float64)) for items, n in rows]


def branch_tops(parts: DataFrame, depth: int, least: int) -> DataFrame:
    """(node, zeros, ones, weighted) of all nodes behind ``least`` bytes, of the strings of ``parts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_bucket(batches, 3):
            keys, n = _merged(_counted(rows))
            for at in range(8):
                nodes, _, zeros, ones, weighted, _ = Branches(keys, n, at, depth, least).levels[-1]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (nodes, zeros, ones, weighted)], ["node", "zeros", "ones", "weighted"])

    rows = parts.where(F.col("kind") == STRING).select("bucket", "items", "amounts")
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        run, "node bigint, zeros double, ones double, weighted double")


def heads(tops: DataFrame, least: int) -> DataFrame:
    """(node, so_far, left) for each of ``tops``: what contexts of less than ``least`` bytes give to a next bit
    of 1 and the weight they leave. Level by level up to the empty context and down again."""
    if not least:
        return tops.select("node", F.lit(0.0).alias("so_far"), F.lit(1.0).alias("left"))
    levels = [tops]
    for d in range(least - 1, -1, -1):
        nodes = levels[0].groupBy(F.col("node").bitwiseAND(F.lit(_mask(d))).alias("node")).agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("below"))
        own, below = F.col("own"), F.col("below")
        nodes = nodes.withColumn("own", log_kt(F.col("zeros"), F.col("ones"), F.log)).withColumn(
            "weighted", F.greatest(own, below) + F.log1p(F.exp(-F.abs(own - below))) - F.log(F.lit(2.0)))
        stop = F.exp(own - F.log(F.lit(2.0)) - F.col("weighted"))
        levels.insert(0, written(nodes.select("node", "zeros", "ones", "weighted", stop.alias("stop")), f"nodes-{d}"))
    above = None
    for d, level in enumerate(levels):
        if above is None:
            level = level.withColumns({"so_far": F.lit(0.0), "left": F.lit(1.0)})
        else:
            above = above.withColumnRenamed("node", "parent")
            level = level.withColumn("parent", F.col("node").bitwiseAND(F.lit(_mask(d - 1)))).join(above, "parent")
        if d == least:
            return level.select("node", "so_far", "left")
        estimate = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
        above = written(level.select("node", (F.col("so_far") + F.col("left") * F.col("stop") * estimate).alias("so_far"),
                                     (F.col("left") * (1 - F.col("stop"))).alias("left")), f"mixture-{d}")


def string_answers(parts: DataFrame, depth: int, buckets: int) -> DataFrame:
    """PACKED rows that answer those of ``parts``: the natural logarithms of the probabilities of the
    strings' last bytes behind the others."""
    least = min(SPLIT, depth)
    tops = written(branch_tops(parts, depth, least), "tops")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_bucket(batches, 7):
            front = [np.array(x) for x in zip(*sorted(r[3:] for r in rows if r[3] is not None))]
            rows = [r for r in rows if r[3] is None]
            counted = _counted([r[1:3] for r in rows])
            keys, n = _merged(counted)
            logp = np.zeros(len(keys))
            for at in range(8):
                logp += Branches(keys, n, at, depth, least).log_probability(*front)
            for (block, *_), (items, _) in zip(rows, counted):
                yield _row(block, bucket, STRING, items, logp[np.searchsorted(keys, items)])

    rows = parts.where(F.col("kind") == STRING).select("bucket", "block", "items", "amounts")
    front = heads(tops, least).select((F.shiftright("node", 8) * MIX % buckets).alias("bucket"), "node", "so_far", "left")
    rows = rows.unionByName(front, allowMissingColumns=True).repartition("bucket").sortWithinPartitions("bucket")
    return rows.select("bucket", "block", "items", "amounts", "node", "so_far", "left").mapInArrow(run, PACKED)


def word_answers(parts: DataFrame) -> DataFrame:
    """PACKED rows that answer those of ``parts``: the words' counts in all training texts; and a TOTAL row a
    bucket, of its words in training texts the sum and the number (in ``items``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_bucket(batches, 4):
            counted = _counted([r[1:] for r in rows])
            words, n = _merged(counted)
            yield _row(0, bucket, TOTAL, np.array([n.sum(), (n > 0).sum()], dtype=np.int64), n[:0])
            for (block, *_), (items, _) in zip(rows, counted):
                yield _row(block, bucket, WORD, items, n[np.searchsorted(words, items)])

    rows = parts.where(F.col("kind") == WORD).select("bucket", "block", "items", "amounts")
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, PACKED)


RESULT = ("doc_id {}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
          "score double, n_bytes bigint, bits_per_byte double")


def scored(docs: DataFrame, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens (words and one end), n_known (of them, in
    training texts), train_tokens, base_score (log10 of the words' smoothed probabilities), score (log10 of
    the text's probability by the context trees), n_bytes, bits_per_byte (code length per byte, the end
    counted as one). ``depth`` is 6 at most."""
    blocks = in_blocks(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), block_bytes)
    size, ends = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)),
                            F.sum(F.size(F.filter("held_out", lambda x: ~x)))).first()
    buckets = max(LEAST_BUCKETS, (size or 0) // BUCKET_BYTES)
    parts = written(gathered(blocks, depth, buckets), "gathered")
    words = written(word_answers(parts), "word-counts")
    totals = words.where(F.col("kind") == TOTAL).select("items").toLocalIterator()  # two numbers a bucket
    tokens, distinct = ends or 0, int(bool(ends))
    for row in totals:
        n, different = _unpacked(row.items, np.int64).tolist()
        tokens, distinct = tokens + n, distinct + different
    answers = string_answers(parts, depth, buckets).unionByName(words.where(F.col("kind") == WORD)).drop("bucket")
    rows = answers.unionByName(blocks.withColumn("kind", F.lit(TEXTS)), allowMissingColumns=True)
    rows = rows.repartition("block").sortWithinPartitions("block", "kind")
    result = RESULT.format(dict(docs.dtypes)["doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, model = None, ([], []), None
        for batch in batches:
            for row in batch.to_pylist():
                if block != row["block"]:
                    block, held, model = row["block"], ([], []), None
                if row["kind"] != TEXTS:
                    held[row["kind"]].append((_unpacked(row["items"], np.int64), _unpacked(row["amounts"], np.float64)))
                    continue
                model = model or [Lookup(x) for x in held]
                yield scores(row, *model)

    def scores(row: dict, strings: Lookup, words: Lookup) -> pa.RecordBatch:
        n = len(row["ids"])
        score, base, n_tokens, n_known = np.zeros(n), np.zeros(n), np.ones(n, dtype=np.int64), np.full(n, int(ends > 0))
        for piece in pieces(row["sizes"], row["data"], depth):
            score += np.bincount(piece.of, strings.of(piece.keys), n)
            c = words.of(piece.words)[piece.word]
            n_tokens += np.bincount(piece.word_of, minlength=n)
            n_known += np.bincount(piece.word_of, c > 0, n).astype(np.int64)
            base += np.bincount(piece.word_of, np.log10(c + 1), n)
        base += np.log10(ends + 1) - n_tokens * np.log10(tokens + distinct + 1)
        size = np.array(row["sizes"], dtype=np.int64)
        columns = [row["ids"], row["held_out"], n_tokens, n_known, np.full(n, tokens), base, score / np.log(10), size,
                   -score / np.log(2) / (size + 1)]
        return pa.RecordBatch.from_arrays([pa.array(c) if c is not row["ids"] else pa.array(c, ids) for c in columns],
                                          [c.split()[0] for c in result.split(", ")])

    ids = to_arrow_type(docs.schema["doc_id"].dataType)
    return rows.mapInArrow(run, result)


class Lookup:
    """The amounts of given distinct items, by an open-addressing hash table over arrays."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]]):
        items, amounts = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0))
        bits = max(1, int(2 * len(items)).bit_length())
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.items, self.amounts = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits)
        free = np.ones(1 << bits, dtype=bool)
        slot = self._slots(items)
        while len(items):
            open_here = free[slot]
            self.items[slot[open_here]], self.amounts[slot[open_here]] = items[open_here], amounts[open_here]
            free[slot] = False
            left = self.items[slot] != items  # another item is there; one of two rows of an item is enough
            items, amounts, slot = items[left], amounts[left], (slot[left] + 1) & self.mask

    def _slots(self, items: np.ndarray) -> np.ndarray:
        return ((items.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def of(self, items: np.ndarray) -> np.ndarray:
        """Amounts of items that all are in the table."""
        slot = self._slots(items)
        other = np.flatnonzero(self.items[slot] != items)
        while len(other):
            slot[other] = (slot[other] + 1) & self.mask
            other = other[self.items[slot[other]] != items[other]]
        return self.amounts[slot]
