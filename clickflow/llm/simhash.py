"""SimHash near-duplicates by anchor-point covering.

Fingerprint: 64 bits; a bit is 1 if it is set in over half the XXH64 hashes (seed 42) of the text's
word shingles, repeats included. Documents link when their fingerprints differ in at most
``MAX_BITS`` = 4 bits.

The 64 bits are cut into parts of 23, 23 and 18 bits. Two fingerprints that differ in at most 4 bits
differ in at most 1 bit of the first part, or in at most 1 of the second, or not at all in the third
(2 + 2 + 1 would be 5). So each part has its own covering code and threshold t:

* 23 bits, t = 1: the [15,11] Hamming code on 15 bits, every word on the other 8: 2^19 anchors of
  covering radius R = 1;
* 18 bits, t = 0: every word is an anchor, R = 0.

A fingerprint's home is its nearest anchor (within R); it is replicated to every anchor within R + t
that can be the home of a fingerprint t away (15.6 on average, and 1 in the last part). Fingerprints
are compared per anchor, homes against all that were sent there: whatever differs from a home by t or
less in that part is there. An anchor of over ``BLOCK`` fingerprints is cut into blocks of homes against
blocks of all, each a group of its own, so no task holds a whole anchor.

Only distinct fingerprints are replicated, so exact copies cost nothing. Per anchor, linked
fingerprints are joined to the smallest of their local component (a star, never all pairs), and the
stars to global components by grouped minima. Nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import arrow_text, columns_but, python_path, written
from clickflow.llm.components import components

SHINGLE, MAX_BITS, SEED = 4, 4, 42
SHINGLES_AT_ONCE = 1 << 14
SMALL_GROUP = 64
BLOCK = 1 << 14
PAIRS_AT_ONCE = 1 << 18

HAMMING, RAW, EXACT = 15, 8, 18


def _code_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each 15-bit word its nearest code word, and the code words (padded with -1) that are the
    nearest of a word at most one bit away."""
    word = np.arange(1 << HAMMING)
    syndrome = np.zeros_like(word)
    for bit in range(HAMMING):
        syndrome ^= np.where((word >> bit) & 1, bit + 1, 0)
    home = np.where(syndrome > 0, word ^ (1 << np.maximum(syndrome - 1, 0)), word)
    near = np.sort(np.stack([home, *(home[word ^ (1 << bit)] for bit in range(HAMMING))], axis=1), axis=1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
    near[near == home[:, None]] = -1
    near = np.sort(near, axis=1)[:, ::-1]
    return home, near[:, :int((near >= 0).sum(axis=1).max())]


HOME, NEAR = _code_tables()


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp bigint) for each row. Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a
    text of fewer than ``shingle`` words is one shingle; one of no words (or null) has fingerprint 0."""
    python_path(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.zeros(batch.num_rows, dtype=np.uint64)
            for rows, hashes, counts in _shingle_hashes(arrow_text(batch.column(1)), shingle):
                _majority(fps, rows, hashes, counts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    given = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return given.mapInArrow(run, f"doc_id {dict(given.dtypes)['doc_id']}, fp bigint")


def _shingle_hashes(texts: pa.Array, n: int) -> Iterator[tuple[list[int], list[int], list[int]]]:
    """Rows with words, their shingles' hashes one after another, and how many each has; a row of very
    many shingles comes in several pieces, so a piece is bounded."""
    rows, hashes, counts, xx = [], [], [], xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        words = text.as_py().lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        last = max(1, len(words) - n + 1)
        begin, end = starts[:last].tolist(), ends[min(n, len(words)) - 1:].tolist()
        for at in range(0, last, SHINGLES_AT_ONCE):
            some = [xx(joined[a:b], SEED) for a, b in zip(begin[at:at + SHINGLES_AT_ONCE], end[at:at + SHINGLES_AT_ONCE])]
            rows.append(i)
            counts.append(len(some))
            hashes += some
            if len(hashes) >= SHINGLES_AT_ONCE:
                if at + SHINGLES_AT_ONCE >= last:
                    yield rows, hashes, counts
                    rows, hashes, counts = [], [], []
    if rows:
        yield rows, hashes, counts


def _majority(fps: np.ndarray, rows: list[int], hashes: list[int], counts: list[int]) -> None:
    h = np.array(hashes, dtype=np.uint64)
    n = np.array(counts)
    ones = np.zeros((len(rows), 64), dtype=np.int64)
    first = np.cumsum(n) - n
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    row = np.array(rows)
    begins = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    ones, n, row = np.add.reduceat(ones, begins, axis=0), np.add.reduceat(n, begins), row[begins]
    fps[row] = np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _sent(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchors, fingerprints, home) of batches of fingerprints: one home and the anchors around it, per part."""
    for batch in batches:
        all_ = batch.column(0).to_numpy(zero_copy_only=False)
        for lo in range(0, len(all_), 1 << 13):
            fp = all_[lo:lo + (1 << 13)]
            x = fp.view(np.uint64)
            out = [((np.int64(3) << 40) | (x >> np.uint64(46)).astype(np.int64), fp, True)]
            for part in (0, 1):
                bits = (x >> np.uint64(23 * part)).astype(np.int64) & ((1 << 23) - 1)
                code, raw = bits & ((1 << HAMMING) - 1), bits >> HAMMING
                tag = np.int64(part + 1) << 40
                out.append((tag | (raw << HAMMING) | HOME[code], fp, True))
                for bit in range(RAW):
                    out.append((tag | ((raw ^ (1 << bit)) << HAMMING) | HOME[code], fp, False))
                for k in range(NEAR.shape[1]):
                    has = NEAR[code, k] >= 0
                    out.append((tag | (raw[has] << HAMMING) | NEAR[code[has], k], fp[has], False))
            yield (np.concatenate([a for a, _, _ in out]), np.concatenate([f for _, f, _ in out]),
                   np.concatenate([np.full(len(a), h) for a, _, h in out]))


def replicated(fps: DataFrame) -> DataFrame:
    """(anchor, fp, home) for distinct fingerprints ``fp``: one home and the anchors around it, per part."""
    python_path(fps.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sent in _sent(batches):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in sent], ["anchor", "fp", "home"])

    return fps.select("fp").mapInArrow(run, "anchor bigint, fp bigint, home boolean")


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links among distinct fingerprints that give the components of all links of at most
    ``max_bits`` (up to 4) bits; per anchor, or block of a large anchor, a star, not all pairs."""
    if max_bits > MAX_BITS:
        raise ValueError(f"the parts cover up to {MAX_BITS} bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)))
            anchor, cell, fp, home = (np.concatenate(x) for x in zip(*held))
            group = np.cumsum(np.concatenate([[False], (anchor[1:] != anchor[:-1]) | (cell[1:] != cell[:-1])]))
            whole = int(np.searchsorted(group, group[-1]))  # the last group may go on
            held = [(anchor[whole:], cell[whole:], fp[whole:], home[whole:])]
            if whole:
                yield _edges(group[:whole], fp[:whole], home[:whole], max_bits)
        if held:
            _, _, fp, home = held[0]
            yield _edges(np.zeros(len(fp), int), fp, home, max_bits)

    sent = in_blocks(fps).repartition("anchor", "cell").sortWithinPartitions("anchor", "cell")
    return sent.mapInArrow(run, "a bigint, b bigint").distinct()


def anchor_sizes(fps: DataFrame) -> DataFrame:
    """(anchor, n, homes): fingerprints sent to each anchor, and those at home there; added up in the tasks that
    send them, so a task has one Python worker."""
    python_path(fps.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sent, _, home in _sent(batches):
            anchor, place = np.unique(sent, return_inverse=True)
            yield pa.RecordBatch.from_arrays([
                pa.array(anchor), pa.array(np.bincount(place, minlength=len(anchor))),
                pa.array(np.bincount(place, home, minlength=len(anchor)).astype(np.int64))], ["anchor", "n", "homes"])

    counted = fps.select("fp").mapInArrow(run, "anchor bigint, n bigint, homes bigint")
    return counted.groupBy("anchor").agg(F.sum("n").alias("n"), F.sum("homes").alias("homes"))


def in_blocks(fps: DataFrame) -> DataFrame:
    """(anchor, cell, fp, home): ``replicated`` with the anchors of over BLOCK fingerprints cut into cells, a
    block of homes against a block of all that were sent there, so that every home still meets every other in
    one cell, and no cell holds much more than twice BLOCK however many fingerprints share an anchor."""
    large = written(anchor_sizes(fps).where(F.col("n") > BLOCK).select(
        "anchor", F.ceil(F.col("homes") / BLOCK).alias("across"), F.ceil(F.col("n") / BLOCK).alias("down")), "anchors")
    across, down = F.greatest("across", F.lit(1)), F.col("down")
    mine = F.pmod(F.xxhash64("fp"), down)                       # its block among all
    as_other = F.transform(F.sequence(F.lit(0).cast("bigint"), across - 1),
                           lambda h: F.struct((h * down + mine).alias("cell"), F.lit(False).alias("home")))
    at = F.pmod(F.xxhash64("fp", F.lit(1)), across)             # its block among the homes
    as_home = F.transform(F.sequence(F.lit(0).cast("bigint"), down - 1),
                          lambda m: F.struct((at * down + m).alias("cell"), F.lit(True).alias("home")))
    alone = F.array(F.struct(F.lit(0).cast("bigint").alias("cell"), F.col("home").alias("home")))
    cells = F.when(down.isNull(), alone).when(F.col("home"), F.concat(as_home, as_other)).otherwise(as_other)
    # a row for each large anchor: there are 2^20 + 2^18 anchors at all
    return replicated(fps).join(F.broadcast(large), "anchor", "left").select(
        "anchor", "fp", F.explode(cells).alias("_")).select("anchor", "_.cell", "fp", "_.home")


def _edges(group: np.ndarray, fp: np.ndarray, home: np.ndarray, max_bits: int) -> pa.RecordBatch:
    """Stars of the linked fingerprints of each group (numbered from 0, in order)."""
    x = fp.view(np.uint64)
    begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, int)
    size = np.diff(np.append(begin, len(group)))
    a, b = [], []
    small = (size > 1) & (size <= SMALL_GROUP)
    # Small groups: each home against its whole group, many groups at once.
    group = np.repeat(np.arange(len(begin)), size)
    homes = np.flatnonzero(home & small[group]) if len(group) else np.zeros(0, int)
    width = size[group[homes]]
    cuts = np.searchsorted(np.cumsum(width), np.arange(PAIRS_AT_ONCE, int(width.sum()) + PAIRS_AT_ONCE, PAIRS_AT_ONCE))
    for lo, hi in zip([0, *(cuts + 1)[:-1]], cuts + 1):
        h, w = homes[lo:hi], width[lo:hi]
        if len(h):
            left = np.repeat(h, w)
            right = np.arange(len(left)) - np.repeat(np.cumsum(w) - w, w) + np.repeat(begin[group[h]], w)
            near = np.flatnonzero((np.bitwise_count(x[left] ^ x[right]) <= max_bits) & (left != right))
            if len(near):
                root = _local_roots(len(x), left[near], right[near])
                ends = np.unique(np.concatenate([left[near], right[near]]))
                a.append(fp[ends])
                b.append(fp[root[ends]])
    for g in np.flatnonzero(size > SMALL_GROUP).tolist():
        s = slice(begin[g], begin[g] + size[g])
        for members in _spread(x[s], home[s], max_bits):
            a.append(members.view(np.int64))
            b.append(np.full(len(members), members.view(np.int64).min()))
    a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a, b))
    keep = a != b
    return pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])


def _local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each index by the given links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if (root == before).all():
            return root


def _spread(x: np.ndarray, home: np.ndarray, max_bits: int) -> Iterator[np.ndarray]:
    """Components of one large group: each home not yet reached spreads to what is linked to it. What
    has been reached is not compared again, so a dense group costs far less than its square."""
    homes, others = x[home], x[~home]
    while len(homes):
        front, homes = homes[:1], homes[1:]
        from_home, members = True, [front]
        queue: list[tuple[np.ndarray, bool]] = [(front, True)]
        while queue:
            front, from_home = queue.pop()
            for at in range(0, len(front), 256):
                some = front[at:at + 256]
                near = _near(some, homes, max_bits)
                if near.any():
                    members.append(homes[near])
                    queue.append((homes[near], True))
                    homes = homes[~near]
                if from_home and len(others):
                    near = _near(some, others, max_bits)
                    if near.any():
                        members.append(others[near])
                        queue.append((others[near], False))
                        others = others[~near]
        if len(members) > 1:
            yield np.concatenate(members)


def _near(some: np.ndarray, rest: np.ndarray, max_bits: int) -> np.ndarray:
    """Which of ``rest`` are within ``max_bits`` of one of ``some``."""
    out = np.zeros(len(rest), dtype=bool)
    step = max(1, PAIRS_AT_ONCE // max(1, len(some)))
    for lo in range(0, len(rest), step):
        part = rest[lo:lo + step]
        out[lo:lo + step] = (np.bitwise_count(some[:, None] ^ part) <= max_bits).any(axis=0)
    return out


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id: the smallest doc_id reachable by links, its
    own included) for each row of ``docs`` (doc_id, text; other columns are ignored). Texts without
    words link like any others. Repeated rows give repeated results; a null doc_id is never a
    component's id unless all of it are null. An empty table gives no rows."""
    fps = written(fingerprints(docs, shingle), "fingerprints")
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    joined = _rooted(classes, max_bits)
    least = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = written(joined.join(least, "root").select("fp", "component_id"), "components")
    return fps.join(of_class, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _rooted(classes: DataFrame, max_bits: int) -> DataFrame:
    """``classes`` (fp and other columns, each fp once) with the ``root`` of its component."""
    roots = components(links(classes, max_bits))
    return classes.join(roots, classes.fp == roots.node, "left").select(
        *classes.columns, F.coalesce("root", "fp").alias("root"))


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component with all its columns (but for any called ``__key``): the one
    with the smallest (doc_id, fingerprint, SHA-256 of the text), null ids last. It is chosen by its
    row, not by its id alone, so texts of different components that share an id, or have none, all
    stay; rows equal in id and text are one. Documents move once: the join and the removal of
    repeated rows share one partitioning."""
    keyed = docs.select(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                                 _digest().alias("digest")).alias("row"), "text")
    fps = fingerprints(keyed, shingle, id_col="row").withColumnRenamed("doc_id", "row")
    classes = written(fps.groupBy("fp").agg(F.min("row").alias("row")), "classes")
    first = _rooted(classes, max_bits).groupBy("root").agg(
        F.min(F.struct("row.none", "row.id", "fp", "row.digest")).alias("first"))
    keep = first.select(_key(F.col("first.id"), F.col("first.digest")).alias("__key"))
    rows = docs.select(*columns_but(docs, "__key"), _key(F.col("doc_id"), _digest()).alias("__key"))
    return rows.join(written(keep, "kept"), "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")


def _digest() -> Column:
    """Hash of the text; null is the empty text."""
    return F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)


def _key(doc_id: Column, digest: Column) -> Column:
    """A row's id as text, null apart from any id, and text hash: equal rows, and only they, have equal keys."""
    return F.concat(digest, F.coalesce(F.concat(F.lit("="), doc_id.cast("string")), F.lit("")))
