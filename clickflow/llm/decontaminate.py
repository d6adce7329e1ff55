"""Benchmark decontamination: a broadcast hash set of normalised benchmark word windows, scanned over
every whole training text; hash hits are verified on the words, then spans or documents go.

Words: A-Z lower-cased, runs of letters, digits and non-ASCII characters. A window is ``n``
consecutive words of an item; an item of fewer words, but at least one, is one window.

The benchmark is a stated query set. Its items are dealt into blocks of about ``block_bytes`` of
text; each block's windows are one broadcast of that bounded size, and the documents are scanned
once for each block (one block for any usual benchmark). No shuffle: a document's row is judged
where it is read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import arrow_text, columns_but, python_path, text_chunks, written
from clickflow.llm.words import Words, words_of

WINDOW = 10
BLOCK_BYTES = 32 << 20
FILTER_BITS = 22
SPANS, ITEMS = "array<struct<start:bigint,words:bigint>>", "array<string>"


class WindowSet:
    """Windows of benchmark items by length: sorted hashes, a bitmap in front of them, and for every
    hash its windows' words and items."""

    def __init__(self, items: list[tuple[str | None, str | None]], n: int):
        self.by_length: dict[int, dict[int, dict[bytes, set[str | None]]]] = {}
        for item, text in items:
            words = words_of(text)
            if not len(words):
                continue
            k = min(n, len(words))
            at, hashes = words.windows(k)
            held = self.by_length.setdefault(k, {})
            for w, h in zip(at.tolist(), hashes.tolist()):
                held.setdefault(h, {}).setdefault(words.bytes_of(w, k), set()).add(item)
        self.sorted = {k: np.array(sorted(v), dtype=np.uint64) for k, v in self.by_length.items()}
        self.bitmap = {}
        for k, v in self.sorted.items():
            bits = np.zeros(1 << FILTER_BITS, dtype=bool)
            bits[v >> np.uint64(64 - FILTER_BITS)] = True
            self.bitmap[k] = bits

    def hits(self, words: Words) -> list[tuple[int, int, tuple[int, bytes]]]:
        """(first word, length, window) of every occurrence, verified on the words themselves; the window is
        for ``items``."""
        found = []
        for k, known in self.sorted.items():
            at, hashes = words.windows(k)
            maybe = np.flatnonzero(self.bitmap[k][hashes >> np.uint64(64 - FILTER_BITS)])
            if not len(maybe):
                continue
            place = np.minimum(np.searchsorted(known, hashes[maybe]), len(known) - 1)
            maybe = maybe[known[place] == hashes[maybe]]
            for w, h in zip(at[maybe].tolist(), hashes[maybe].tolist()):
                text = words.bytes_of(w, k)
                if text in self.by_length[k][h]:
                    found.append((w, k, (h, text)))
        return sorted(found)

    def items(self, windows: set[tuple[int, tuple[int, bytes]]]) -> set[str]:
        """The ids of all items that hold one of some windows (length, window)."""
        return set().union(*(self.by_length[k][h][text] for k, (h, text) in windows)) - {None}


def window_blocks(bench: DataFrame, n: int = WINDOW, id_col: str = "item_id", text_col: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> Iterator[WindowSet]:
    """The benchmark's windows, a block of items at a time; null and empty texts have none."""
    items = bench.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    for b in range(blocks):
        rows = dealt.where(F.col("block") == b).select("item", "text").collect()
        yield WindowSet(sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] or "", r[1])), n)


def with_spans(docs: DataFrame, bench: DataFrame, n: int = WINDOW, text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
               spans_col: str = "hit_spans", items_col: str = "hit_items") -> DataFrame:
    """``docs`` with ``spans_col``: every place where a benchmark window stands, as (first word, number of
    words), each once however many items hold the window; and ``items_col``: the ids of all those items, each
    once, in no order (an item without an id makes spans, and is in no list). All columns pass through, whatever
    their names; columns of these two names are replaced. The benchmark's blocks are made, sent and scanned one
    by one. Null and empty texts have no occurrence; repeated rows are judged each; an empty benchmark hits
    nothing."""
    spark = docs.sparkSession
    python_path(spark)
    out = docs.select(*columns_but(docs, spans_col, items_col), F.lit(None).cast(SPANS).alias(spans_col),
                      F.lit(None).cast(ITEMS).alias(items_col))
    shared = None
    for block in window_blocks(bench, n, item_id, item_text, block_bytes):
        if shared is not None:
            out = written(out, "decontaminate")
            shared.unpersist()
        shared = spark.sparkContext.broadcast(block)
        out = _scan(out, shared, text_col, spans_col, items_col)
    return out


def _scan(docs: DataFrame, shared: Broadcast, text_col: str, spans_col: str, items_col: str) -> DataFrame:
    """``docs`` with one block's places and items added to those that its columns hold."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = arrow_text(batch.column(batch.schema.get_field_index(text_col)))
            at = [batch.schema.get_field_index(c) for c in (spans_col, items_col)]
            spans, items = (batch.column(i).to_pylist() for i in at)
            for lo, hi, data, offsets in text_chunks(texts):
                words = Words(data, offsets)
                places: dict[int, set[tuple[int, int]]] = {}
                windows: dict[int, set[tuple[int, tuple[int, bytes]]]] = {}
                for w, k, window in known.hits(words):
                    doc = int(np.searchsorted(words.first, w, side="right")) - 1
                    places.setdefault(lo + doc, set()).add((w - int(words.first[doc]), k))
                    windows.setdefault(lo + doc, set()).add((k, window))
                for doc in places:
                    found = places[doc] | {(x["start"], x["words"]) for x in spans[doc] or ()}
                    spans[doc] = [{"start": w, "words": k} for w, k in sorted(found)]
                    items[doc] = list(known.items(windows[doc]).union(items[doc] or ()))
            for i, values in zip(at, ([x or [] for x in spans], [x or [] for x in items])):
                batch = batch.set_column(i, batch.schema.field(i), pa.array(values, batch.schema.field(i).type))
            yield batch

    return docs.mapInArrow(scan, docs.schema)


def covered(spans: list[dict]) -> list[tuple[int, int]]:
    """The union of spans as sorted, disjoint (first word, end) ranges."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((s["start"], s["start"] + s["words"]) for s in spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def remove_documents(docs: DataFrame, bench: DataFrame, n: int = WINDOW, text_col: str = "text", **kw) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; the rest unchanged."""
    spans, items = "__hit_spans", "__hit_items"
    return with_spans(docs, bench, n, text_col, spans_col=spans, items_col=items, **kw).where(
        F.size(F.coalesce(F.col(spans), F.array())) == 0).drop(spans, items)


def remove_spans(docs: DataFrame, bench: DataFrame, n: int = WINDOW, text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with the hit words cut out of their texts (from the first hit word's first byte to the
    last one's end; the text around stays as it is). Documents without a hit are unchanged."""
    spans, items = "__hit_spans", "__hit_items"
    found = with_spans(docs, bench, n, text_col, spans_col=spans, items_col=items, **kw).drop(items)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text_col)
            texts = batch.column(place).to_pylist()
            for i, hit in enumerate(batch.column(batch.schema.get_field_index(spans)).to_pylist()):
                if hit:
                    data = texts[i].encode()
                    words = words_of(texts[i])
                    at, kept = 0, []
                    for lo, hi in covered(hit):
                        kept.append(data[at:words.raw_starts[lo]])
                        at = int(words.raw_ends[hi - 1])
                    texts[i] = b"".join([*kept, data[at:]]).decode()
            batch = batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))
            yield batch.select([c for c in batch.schema.names if c != spans])

    return found.mapInArrow(cut, found.drop(spans).schema)


def digest(docs: DataFrame, bench: DataFrame, n: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside an occurrence), n_items, items_sha256 (the
    items' ids sorted as strings, comma-joined), contaminated. Null text has no words; an item without an id
    counts for n_hit only."""
    found = with_spans(docs.select("doc_id", "text"), bench, n)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = arrow_text(batch.column(1))
            counts = np.zeros(len(texts), dtype=np.int64)
            for lo, hi, data, offsets in text_chunks(texts):
                counts[lo:hi] = np.diff(Words(data, offsets).first)
            items = [sorted(x or []) for x in batch.column(3).to_pylist()]
            n_hit = [sum(hi - lo for lo, hi in covered(x or [])) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(counts), pa.array(n_hit, pa.int64()),
                pa.array([len(x) for x in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
                pa.array([x > 0 for x in n_hit], pa.bool_()),
            ], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return found.mapInArrow(summed, "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, "
                                    "items_sha256 string, contaminated boolean")
