"""Removal of every byte covered by a LENGTH-byte string that also starts anywhere else, by suffix
arrays built per shard.

Sharding. Every LENGTH-byte window of a text is keyed by the smallest hash among the GRAM-byte strings
in it (a minimizer), so equal windows, wherever they are, have one key. Consecutive windows with one
key form a segment; a segment's bytes hold all its windows and every window lies in one segment. A
window can only repeat if its key occurs in two segments, or has two places within one.

1. Every text is scanned once: (document, first and last window start, key, hash of the segment).
2. Keys are counted (combined on the map side). Segments whose key occurs once are done: nothing in
   them repeats. Where all segments of a key are the same bytes, all of them are covered.
3. The distinct segments of the other keys are cut out of their texts and dealt by key. A task joins
   them, with separators, to texts of about SHARD_BYTES, builds the suffix array of each by induced
   sorting (``sais``) and the permuted common prefixes; a window repeats if its suffix shares LENGTH
   bytes or more with a neighbour's. Keys never need each other, so shards are complete.
4. Covered ranges go back to the documents, are united and cut.

Copies collapse before the shards (a segment is taken there once, with a count), so groups of copies
cost what one copy costs. A key with over SHARD_BYTES of distinct segments (one passage inside very
many different texts) does not fit one task: its windows are counted by 128-bit hash instead, spread
over all tasks. No row is dropped; nothing goes through the driver.

Texts are UTF-8 bytes, null is the empty text, and texts shorter than LENGTH lose nothing. Matches
never cross documents. Strings are judged on the input. Rows with equal texts are copies of each
other whatever their ids; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import arrow_text, columns_but, python_path, text_chunks, written
from clickflow.llm.sais import permuted_lcp, suffix_array
from clickflow.llm.words import RangeHash

LENGTH, GRAM = 400, 128
SHARD_BYTES = 1 << 20
SCAN_BYTES = 1 << 20
PIECE = 2 << 20
#: A window of more copies than FREQUENT is looked up by SPREAD tasks.
FREQUENT, SPREAD = 1000, 64
PLACE_BITS = np.uint64((1 << 24) - 1)
RANGES = "array<struct<lo:int,hi:int>>"


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (width - have)], x[width - have:]) if have < width else x


def _segments(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, first window start, last window start, key, key has two places) for the windows of a run
    of texts; a text longer than PIECE goes piece by piece, each piece with its own windows."""
    for base in range(0, max(1, len(data) - length + 1), PIECE):
        piece = data[base:base + PIECE + length - 1]
        n = len(piece) - length + 1
        if n <= 0:
            return
        at = np.arange(len(piece) - gram + 1)
        h = RangeHash(piece).of(at, at + gram)
        least = _sliding_min((h & ~PLACE_BITS) | at.astype(np.uint64), length - gram + 1)
        place = (least & PLACE_BITS).astype(np.int64)
        key = h[place]
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(np.clip(offsets, base, base + n)))
        whole = at[:n] + base + length <= offsets[text + 1]
        begins = np.ones(n, dtype=bool)
        begins[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1]) | ~whole[:-1]
        bounds = np.append(np.flatnonzero(begins | ~whole), n)
        first = np.flatnonzero(begins & whole)
        last = bounds[np.searchsorted(bounds, first, side="right")] - 1
        own = offsets[text[first]]
        yield text[first], first + base - own, last + base - own, key[first], place[first] != place[last]


def scanned(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """One row per segment: id (hash of the whole text, binary), a, b (first and last window start),
    key, seg (hash of the segment), twice (the key has two places in it). ``docs``: (doc_id, text)."""
    python_path(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(arrow_text(batch.column(0)), SCAN_BYTES):
                raw = data.tobytes()
                ids: dict[int, bytes] = {}
                for text, a, b, key, twice in _segments(data, offsets, length, gram):
                    for t in np.unique(text).tolist():
                        if t not in ids:
                            ids[t] = hashlib.sha256(raw[offsets[t]:offsets[t + 1]]).digest()[:16]
                    begin, end = offsets[text] + a, offsets[text] + b + length
                    seg = [xxhash.xxh3_64_intdigest(raw[x:y]) for x, y in zip(begin.tolist(), end.tolist())]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([ids[t] for t in text.tolist()], pa.binary()), pa.array(a, pa.int32()),
                        pa.array(b, pa.int32()), pa.array(key.view(np.int64)),
                        pa.array(np.array(seg, dtype=np.uint64).view(np.int64)), pa.array(twice),
                    ], ["id", "a", "b", "key", "seg", "twice"])

    return docs.select("text").mapInArrow(run, "id binary, a int, b int, key bigint, seg bigint, twice boolean")


def with_text_id(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__id``: 128 bits of the SHA-256 of the whole text; a column of that name is replaced."""
    return docs.withColumn("__id", F.expr("substring(unhex(sha2(coalesce(text, ''), 256)), 1, 16)"))


def _repeated(segments: list[bytes], length: int) -> list[np.ndarray]:
    """For each segment, whether the window at each start comes twice or more among all of them."""
    sizes = np.array([len(x) for x in segments])
    joined = np.frombuffer(b"\0".join(segments) + b"\0", dtype=np.uint8).astype(np.uint16) + 2
    ends = np.cumsum(sizes + 1) - 1
    joined[ends] = 1
    joined[-1] = 0
    sa = suffix_array(joined)
    phi, plcp = permuted_lcp(joined, sa)
    long = np.flatnonzero(plcp >= length)
    hit = np.zeros(len(joined), dtype=bool)
    hit[long] = hit[phi[long]] = True
    return [hit[e - n:e - length + 1] for e, n in zip(ends.tolist(), sizes.tolist())]


def _ranges(hit: np.ndarray, length: int) -> list[dict]:
    """Bytes covered by the windows at the hit starts."""
    at = np.flatnonzero(hit)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > length)
    return [{"lo": int(lo), "hi": int(hi) + length}
            for lo, hi in zip(at[np.concatenate([[0], cut + 1])], at[np.append(cut, len(at) - 1)])]


def _in_shards(segments: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """(key, seg, ranges) of distinct segments (key, seg, bytes) by suffix arrays, key by key."""

    def solved(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        hits = _repeated([x[2] for x in held], length)
        ranges = [_ranges(hit, length) for hit in hits]
        some = [i for i, r in enumerate(ranges) if r]
        return pa.RecordBatch.from_arrays([
            pa.array([held[i][0] for i in some], pa.int64()), pa.array([held[i][1] for i in some], pa.int64()),
            pa.array([ranges[i] for i in some], pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())])))],
            ["key", "seg", "ranges"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for key, seg, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if held and (key, seg) == held[-1][:2]:
                    continue  # the same segment of a repeated row
                if size + len(data) > shard_bytes and held and held[-1][0] != key:
                    yield solved(held)
                    held, size = [], 0
                held.append((key, seg, data))
                size += len(data)
        if held:
            yield solved(held)

    return segments.select("key", "seg", "bytes").repartition("key").sortWithinPartitions("key", "seg").mapInArrow(
        run, f"key bigint, seg bigint, ranges {RANGES}")


def _by_window(segments: DataFrame, length: int) -> DataFrame:
    """The same for keys too large for a task: windows counted by 128-bit hash over all tasks, no task
    getting all copies of a frequent one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, seg, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                n = len(data) - length + 1
                yield pa.RecordBatch.from_arrays([
                    pa.array([key] * n, pa.int64()), pa.array([seg] * n, pa.int64()), pa.array(np.arange(n), pa.int32()),
                    pa.array([xxhash.xxh3_128_digest(data[i:i + length]) for i in range(n)], pa.binary())],
                    ["key", "seg", "at", "window"])

    distinct = segments.select("key", "seg", "bytes").dropDuplicates(["key", "seg"])
    windows = written(distinct.mapInArrow(run, "key bigint, seg bigint, at int, window binary"), "windows")
    counted = written(windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1"), "twice")
    # Copies of a frequent window are looked up over SPREAD tasks; the few left of any other by the window alone.
    hot = counted.where(F.col("n") > FREQUENT).select(
        "window", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("part"), F.lit(True).alias("hot"))
    told = written(windows.withColumn("part", F.expr(f"CAST(pmod(xxhash64(key, seg), {SPREAD}) AS INT)")).join(
        hot, ["window", "part"], "left"), "told")
    rest = told.where("hot IS NULL").join(counted.where(F.col("n") <= FREQUENT), "window", "left_semi")
    return told.where("hot").unionByName(rest).groupBy("key", "seg").agg(
        F.collect_list(F.struct(F.col("at").alias("lo"), (F.col("at") + length).alias("hi"))).alias("ranges"))


def covered(docs: DataFrame, length: int = LENGTH, gram: int | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(id, ranges): for each distinct text (by ``with_text_id``) that has any, the byte ranges covered
    by repeated strings of ``length`` bytes; ranges may overlap. ``docs`` has ``text`` and ``__id``. ``gram``
    grows with the length where it is not given."""
    gram = gram or max(1, length * GRAM // LENGTH)
    places = written(scanned(docs, length, gram), "places")
    keys = places.groupBy("key").agg(
        F.count("*").alias("n"), F.min("seg").alias("low"), F.max("seg").alias("high"), F.max("twice").alias("twice"))
    keys = written(keys.where("n > 1 OR twice").selectExpr("key", "low <> high OR twice AS many"), "keys")
    shared = written(places.join(keys, "key").groupBy("key", "seg", "many", "id", "a", "b").agg(
        F.count("*").alias("copies")), "shared")
    whole = F.array(F.struct(F.col("a").alias("lo"), (F.col("b") + length).alias("hi")))
    plain = shared.where("NOT many").select("id", whole.cast(RANGES).alias("ranges"))

    segments = shared.where("many").groupBy("key", "seg").agg(
        F.sum("copies").alias("copies"), F.min(F.struct("id", "a", "b")).alias("at"))
    segments = written(segments.select("key", "seg", "copies", "at.*"), "segments")
    cut = written(_cut(docs, segments, length), "cut")
    sizes = cut.groupBy("key").agg(F.sum(F.octet_length("bytes")).alias("size"))
    large = written(sizes.where(F.col("size") > shard_bytes).select("key"), "large")
    found = _in_shards(cut.join(large, "key", "left_anti"), length, shard_bytes).unionByName(
        _by_window(cut.join(large, "key", "left_semi"), length))
    ranges = written(segments.select("key", "seg", "copies").join(found, ["key", "seg"], "left").where(
        "copies > 1 OR ranges IS NOT NULL"), "ranges")
    many = shared.where("many").join(ranges.withColumnRenamed("copies", "all"), ["key", "seg"]).select(
        "id", F.when(F.col("all") > 1, whole.cast(RANGES)).otherwise(F.transform("ranges", lambda r: F.struct(
            (r.lo + F.col("a")).alias("lo"), (r.hi + F.col("a")).alias("hi")))).alias("ranges"))
    return plain.unionByName(many).groupBy("id").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))


def _cut(docs: DataFrame, segments: DataFrame, length: int) -> DataFrame:
    """(key, seg, bytes) of the given segments, cut out of their texts."""
    wanted = segments.groupBy("id").agg(F.collect_list(F.struct("key", "seg", "a", "b")).alias("wanted"))
    texts = docs.select(F.col("__id").alias("id"), "text").join(wanted, "id").dropDuplicates(["id"])
    return texts.selectExpr(f"""inline(transform(wanted, w -> struct(w.key, w.seg,
        substring(CAST(text AS BINARY), w.a + 1, w.b - w.a + {length}) AS bytes)))""")


def _united(ranges: list[dict] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((r["lo"], r["hi"]) for r in ranges or ()):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _kept(data: bytes, gone: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for lo, hi in gone:
        kept.append(data[at:lo])
        at = hi
    return b"".join([*kept, data[at:]])


def _with_ranges(docs: DataFrame, length: int) -> DataFrame:
    found = covered(docs, length).withColumnRenamed("id", "__id").withColumnRenamed("ranges", "__ranges")
    return docs.join(found, "__id", "left")


def digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (of the
    remaining bytes, joined)."""
    joined = _with_ranges(with_text_id(docs.select("doc_id", "text")), length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, spans, kept = [], [], [], []
            for text, ranges in zip(arrow_text(batch.column(1)), batch.column(2).to_pylist()):
                data, gone = text.as_py(), _united(ranges)
                n.append(len(data))
                removed.append(sum(hi - lo for lo, hi in gone))
                spans.append(len(gone))
                kept.append(hashlib.sha256(_kept(data, gone)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, removed, spans)), pa.array(kept, pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.select("doc_id", "text", "__ranges").mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the bytes covered by repeated strings of ``length`` cut out of ``text`` (all other columns as they are, but for any
    called ``__id`` or ``__ranges``, which go). A character of which a cut leaves only some bytes goes
    too. Null texts stay null."""
    docs = docs.select(*columns_but(docs, "__id", "__ranges"))
    joined = _with_ranges(with_text_id(docs), length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            ranges = batch.column(batch.schema.get_field_index("__ranges")).to_pylist()
            texts = batch.column(at).to_pylist()
            for i, r in enumerate(ranges):
                if r:
                    texts[i] = _kept(texts[i].encode(), _united(r)).decode(errors="ignore")
            batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            yield batch.select([c for c in batch.schema.names if c not in ("__ranges", "__id")])

    return joined.mapInArrow(run, docs.schema)
