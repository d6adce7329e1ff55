"""Audit of filters that overlap: what every filter removes at every place in every order.

Texts are measured by one pass of a table-driven byte transducer over their UTF-8 bytes. Its states say
whether a word is open and how many continuation bytes are due; each (state, byte class) gives the next
state and what to emit: a word begins, a word has ended, a code point, a capital, a symbol. Many lanes of
the bytes run in step (one table lookup for all lanes at a time); a lane's first state is guessed from the
few bytes before it and verified against the state its predecessor ends in, and lanes with a wrong guess
run again. The word spans go into an open-addressing hash table, all pending spans a round: a span whose
slot holds another one is compared with it byte by byte and counts as a repeat or moves to the next slot.

Each document becomes a bit pattern of the filters it fails. Equal texts are found by their SHA-256 with
the smallest doc_id of each (combined on the map side, so a hot text costs a row per part and task), and
what is left is at most one row per part, pattern and label. All orders of the filters are read off
those: a filter at its step removes what fails it and none of the filters before it.

Null texts are empty, null parts are the empty string, a null doc_id is no copy and makes none. Rows with
one doc_id are no copies of each other. A document has a label if any of its label rows says so. An empty
table has no parts and gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import arrow_text, python_path, text_chunks, written
from clickflow.llm.words import RangeHash

#: What a measured text fails, by filter; a copy fails the last one.
FILTERS = {
    "A": "n_words < 200",
    "B": "100 * n_distinct < 50 * n_words",
    "C": "100 * n_capitals > 2 * n_points",
    "D": "n_symbols > 0",
}
COPY = "E"

BEGIN, ENDED, POINT, CAPITAL, SYMBOL = 1, 2, 4, 8, 16
LANES, LOOK_BACK = 4096, 4
SHORT_WORD = 64


class Transducer:
    """States: between words, in a word, and in a word with 1, 2 or 3 continuation bytes due. A byte that
    does not fit (a stray continuation, a byte that UTF-8 never has) is a code point of its own."""

    SPACE, UPPER, SIGN, PLAIN, CONTINUED, LEAD2, LEAD3, LEAD4, STOP = range(9)
    BETWEEN, WITHIN = 0, 1

    def __init__(self, symbols: str = "#$%&*|"):
        self.classes = np.full(256, self.PLAIN, dtype=np.uint8)
        self.classes[[0x20, *range(0x09, 0x0E)]] = self.SPACE
        self.classes[0x41:0x5B] = self.UPPER
        self.classes[list(symbols.encode())] = self.SIGN
        self.classes[0x80:0xC0] = self.CONTINUED
        self.classes[0xC2:0xE0] = self.LEAD2
        self.classes[0xE0:0xF0] = self.LEAD3
        self.classes[0xF0:0xF5] = self.LEAD4
        self.width = self.STOP + 1
        states = range(5)
        # a state is stored as its first row in the table, so state + class is the place to look
        self.next = np.zeros(len(states) * self.width, dtype=np.uint8)
        self.emit = np.zeros(len(states) * self.width, dtype=np.uint8)
        for state in states:
            for kind in range(self.width):
                target, emit = self._step(state, kind)
                self.next[state * self.width + kind] = target * self.width
                self.emit[state * self.width + kind] = emit

    def _step(self, state: int, kind: int) -> tuple[int, int]:
        if state > self.WITHIN and kind == self.CONTINUED:
            return state - 1, 0
        open_word = state != self.BETWEEN
        if kind in (self.SPACE, self.STOP):
            return self.BETWEEN, (ENDED if open_word else 0) | (POINT if kind == self.SPACE else 0)
        target = {self.LEAD2: 2, self.LEAD3: 3, self.LEAD4: 4}.get(kind, self.WITHIN)
        emit = POINT | (0 if open_word else BEGIN)
        return target, emit | {self.UPPER: CAPITAL, self.SIGN: SYMBOL}.get(kind, 0)

    def _run(self, lanes: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place looked up for each symbol, last states) of lanes, one a column, run in step."""
        places = np.empty_like(lanes)
        for row, symbols in enumerate(lanes):
            np.add(state, symbols, out=places[row])
            state = self.next[places[row]]
        return places, state

    def emitted(self, symbols: np.ndarray) -> np.ndarray:
        """What each symbol emits, read from the first one on."""
        n = len(symbols)
        steps = max(LOOK_BACK, -(-n // LANES))
        count = -(-n // steps)
        padded = np.full(count * steps, self.STOP, dtype=np.uint8)
        padded[:n] = symbols
        lanes = np.ascontiguousarray(padded.reshape(count, steps).T)
        start = np.zeros(count, dtype=np.uint8)
        _, start[1:] = self._run(lanes[-LOOK_BACK:, :-1], np.zeros(count - 1, dtype=np.uint8))
        places, last = self._run(lanes, start)
        wrong = np.flatnonzero(start[1:] != last[:-1]) + 1
        while len(wrong):
            start[wrong] = last[wrong - 1]
            places[:, wrong], last[wrong] = self._run(np.ascontiguousarray(lanes[:, wrong]), start[wrong])
            wrong = np.flatnonzero(start[1:] != last[:-1]) + 1
        return self.emit[places.T.reshape(-1)[:n]]


def _equal(data: np.ndarray, left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes at ``left`` and at ``right`` are the same, eight at a time."""
    same = np.ones(len(size), dtype=bool)
    for i in np.flatnonzero(size > SHORT_WORD).tolist():
        a, b, n = int(left[i]), int(right[i]), int(size[i])
        same[i] = bool(np.array_equal(data[a:a + n], data[b:b + n]))
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    todo, done = np.flatnonzero(size <= SHORT_WORD), 0
    while len(todo):
        over = np.maximum(0, 8 - (size[todo] - done)).astype(np.uint64) * np.uint64(8)
        same[todo] &= (eight[left[todo] + done] ^ eight[right[todo] + done]) << over == 0
        done += 8
        todo = todo[(size[todo] > done) & same[todo]]
    return same


def representatives(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each span the first span of the same bytes within its group (itself, if it is the first), by
    inserting all into a hash table."""
    same_as = np.arange(len(starts))
    if not len(starts):
        return same_as
    hashes = RangeHash(data).of(starts, ends) ^ (group.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    hashes ^= hashes >> np.uint64(29)
    mask = np.uint64((1 << int(2 * len(starts)).bit_length()) - 1)
    owner = np.full(int(mask) + 1, -1, dtype=np.int64)
    pending, slot = np.arange(len(starts)), (hashes & mask).astype(np.int64)
    sizes = ends - starts
    while len(pending):
        free = owner[slot] < 0
        owner[slot[free][::-1]] = pending[free][::-1]
        held = owner[slot]
        other = held != pending
        pending, slot, held = pending[other], slot[other], held[other]
        alike = (hashes[pending] == hashes[held]) & (group[pending] == group[held]) & (sizes[pending] == sizes[held])
        some = np.flatnonzero(alike)
        alike[some] = _equal(data, starts[pending[some]], starts[held[some]], sizes[pending[some]])
        same_as[pending[alike]] = held[alike]
        pending, slot = pending[~alike], (slot[~alike] + 1) & int(mask)
    return same_as


MEASURES = ["n_words", "n_distinct", "n_points", "n_capitals", "n_symbols"]


def measures(data: np.ndarray, offsets: np.ndarray, transducer: Transducer) -> dict[str, np.ndarray]:
    """MEASURES of each text of a run of texts."""
    texts = len(offsets) - 1
    symbols = np.full(len(data) + texts, Transducer.STOP, dtype=np.uint8)
    begin = offsets[:-1] + np.arange(texts)  # each text is followed by one STOP
    of_text = np.ones(len(symbols), dtype=bool)
    of_text[offsets[1:] + np.arange(texts)] = False
    symbols[of_text] = transducer.classes[data]
    emitted = transducer.emitted(symbols)
    starts, ends = np.flatnonzero(emitted & BEGIN), np.flatnonzero(emitted & ENDED)
    text = np.searchsorted(begin, starts, side="right") - 1
    first = representatives(data, starts - text, ends - text, text) == np.arange(len(starts))

    def count(bit: int) -> np.ndarray:
        return np.add.reduceat((emitted & bit) != 0, begin, dtype=np.int64)

    return {"n_words": np.bincount(text, minlength=texts), "n_distinct": np.bincount(text[first], minlength=texts),
            "n_points": count(POINT), "n_capitals": count(CAPITAL), "n_symbols": count(SYMBOL)}


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Per row of ``docs``: doc_id, part, digest (128 bits of the text's SHA-256) and MEASURES. Where the
    texts are stored; nothing is moved."""
    python_path(docs.sparkSession)
    given = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                        F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = Transducer()
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(arrow_text(batch.column(2))):
                raw = memoryview(data)
                digests = [hashlib.sha256(raw[a:b]).digest()[:16]
                           for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                found = measures(data, offsets, transducer)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(digests, pa.binary()),
                     *(pa.array(found[m], pa.int64()) for m in MEASURES)], ["doc_id", "part", "digest", *MEASURES])

    return given.mapInArrow(run, f"doc_id {dict(given.dtypes)['doc_id']}, part string, digest binary, "
                                 + ", ".join(f"{m} bigint" for m in MEASURES))


def _bit(letter: str) -> int:
    return 1 << [*FILTERS, COPY].index(letter)


def patterns(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, pattern, n, good, toxic): how many documents of each part fail exactly the filters of each
    pattern, and how many of them are labelled good (quality 1) or toxic."""
    fails = sum((F.when(F.expr(rule), F.lit(_bit(name))).otherwise(F.lit(0)) for name, rule in FILTERS.items()), F.lit(0))
    rows = measured(docs).select("doc_id", "part", "digest", fails.alias("pattern"))
    rows = written(rows.groupBy("doc_id", "part", "digest", "pattern").agg(F.count("*").alias("n")), "audit")
    marks = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                                         F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # rows without an id have no label and would meet in one task of the join
    marked = rows.where("doc_id IS NOT NULL").join(marks, "doc_id", "left").fillna(0, ["good", "toxic"])
    marked = marked.unionByName(rows.where("doc_id IS NULL").withColumns({"good": F.lit(0), "toxic": F.lit(0)}))
    groups = marked.groupBy("digest", "part", "pattern", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("n_least"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("n_null"))
    smallest = F.min("least").over(Window.partitionBy("digest"))
    originals = F.col("n_null") + F.when(F.col("least") == F.col("smallest"), F.col("n_least")).otherwise(0)
    groups = groups.withColumn("smallest", smallest).withColumn("originals", originals)
    cells = F.array(F.struct(F.col("pattern").alias("pattern"), F.col("originals").alias("n")),
                    F.struct((F.col("pattern") + _bit(COPY)).alias("pattern"), (F.col("n") - F.col("originals")).alias("n")))
    return (groups.select("part", "good", "toxic", F.inline(cells)).groupBy("part", "pattern").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic")))


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of all filters and step: filter_order, step, and of the documents of the part:
    kept (after the step), removed (at it), redundant (fail its filter, removed before), unique_fails (fail
    its filter only), good_lost and toxic_lost (of the removed), shapley (its filter's removed over all
    orders). ``docs``: (doc_id, text, source), ``labels``: (doc_id, quality, toxic); more columns do no harm."""
    letters = [*FILTERS, COPY]
    cells = patterns(docs, labels).groupBy("part").agg(  # at most one cell per pattern
        F.collect_list(F.struct("pattern", "n", "good", "toxic")).alias("cells"))
    orders = F.array(*[F.lit("".join(o)) for o in permutations(letters)])
    rows = cells.select("part", "cells", F.explode(orders).alias("filter_order"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))

    def bits(text: Column) -> Column:
        return sum((F.when(F.instr(text, x) > 0, F.lit(_bit(x))).otherwise(F.lit(0)) for x in letters), F.lit(0))

    rows = rows.withColumns({"own": bits(F.expr("substring(filter_order, step, 1)")),
                             "before": bits(F.expr("substring(filter_order, 1, step - 1)"))})
    own, before = F.col("own"), F.col("before")
    turns = len(list(permutations(letters)))

    def total(which, value: str = "n", weight=lambda c: F.lit(1)) -> Column:
        zero = F.lit(0).cast("bigint")
        return F.aggregate("cells", zero, lambda acc, c: acc + F.when(which(c.pattern), c[value] * weight(c.pattern)).otherwise(zero))

    def here(p: Column) -> Column:
        return (p.bitwiseAND(own) > 0) & (p.bitwiseAND(before) == 0)

    return rows.select(
        "part", "filter_order", "step",
        total(lambda p: p.bitwiseAND(own.bitwiseOR(before)) == 0).alias("kept"),
        total(here).alias("removed"),
        total(lambda p: (p.bitwiseAND(own) > 0) & (p.bitwiseAND(before) > 0)).alias("redundant"),
        total(lambda p: p == own).alias("unique_fails"),
        total(here, "good").alias("good_lost"), total(here, "toxic").alias("toxic_lost"),
        # of a document's k failed filters each comes first in one k-th of the orders
        total(lambda p: p.bitwiseAND(own) > 0, weight=lambda p: F.floor(F.lit(turns) / F.bit_count(p))).alias("shapley"))
