"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on each text. Expectation-maximisation over
the counts of all vote patterns of the corpus estimates each labeller's accuracy and the share of good
texts, without any given label, and so a posterior for each pattern. The posteriors are the training
labels of a hashed linear scorer over words and word shapes, which scores every text.

Vote patterns are counted over all rows (combined on the map side; 3 ** labellers patterns at most
reach the driver). The scorer is fitted on a bounded sample: ``sample`` texts of at most MAX_TEXT
bytes, chosen by a hash of their ids, one for each id (where an id repeats, the text of the smallest
hash). Their features are hashed and added up in tasks. Every whole text is scored where it is stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import arrow_text, python_path, text_chunks, written
from clickflow.llm.words import RangeHash

SAMPLE, MAX_TEXT = 4000, 1 << 16
KEEP = 0.5
BITS = 18
EPOCHS, RATE, DECAY = 60, 0.5, 1e-5

SPACE, UPPER, LETTER, DIGIT, SYMBOL, MARK = range(6)
CLASS = np.full(256, MARK, dtype=np.uint8)
CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
CLASS[65:91], CLASS[97:123], CLASS[128:], CLASS[48:58] = UPPER, LETTER, LETTER, DIGIT
CLASS[np.frombuffer(b"#*$%&|<>", dtype=np.uint8)] = SYMBOL

#: Labeller -> (its measure is bad above, good up to or None for never); no vote between.
LABELLERS = {"symbols": (0.03, None), "capitals": (0.3, None), "repeats": (0.2, None), "sameness": (0.8, 0.6),
             "lines": (0.4, None), "shapes": (0.5, 0.1), "sentences": (2.6, 1.6)}
#: Shapes of ordinary words: letters, perhaps a capital first, perhaps one mark behind.
PLAIN = [[LETTER], [UPPER, LETTER], [LETTER, MARK], [UPPER, LETTER, MARK], [UPPER], [UPPER, MARK], [DIGIT], [DIGIT, MARK]]


class Texts:
    """Words, shapes and measures of a run of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.n = len(offsets) - 1
        kind = CLASS[data]
        inside = kind != SPACE
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        first = inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]]))
        last = inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.doc = np.searchsorted(offsets, starts, side="right") - 1
        self.words = RangeHash(data).of(starts, ends)
        change = first | (inside & np.concatenate([[False], kind[1:] != kind[:-1]]))
        places = np.flatnonzero(change)
        cuts = np.append(np.searchsorted(places, starts), len(places))
        self.shapes = RangeHash(kind[places]).of(cuts[:-1], cuts[1:]) if len(starts) else self.words
        self.count = np.bincount(self.doc, minlength=self.n)
        self.same = np.zeros(len(starts), dtype=bool)
        self.same[1:] = (self.words[1:] == self.words[:-1]) & (self.doc[1:] == self.doc[:-1])
        sizes = np.diff(offsets)
        owner = np.repeat(np.arange(self.n), sizes)
        solid = np.maximum(np.bincount(owner[inside], minlength=self.n), 1)
        words = np.maximum(self.count, 1)
        distinct = np.bincount(self._distinct(self.doc, self.words), minlength=self.n)
        ending = np.isin(data, np.frombuffer(b".!?", dtype=np.uint8))
        self.measures = np.stack([
            np.bincount(owner[kind == SYMBOL], minlength=self.n) / solid,
            np.bincount(owner[kind == UPPER], minlength=self.n) / solid,
            np.bincount(self.doc[self.same], minlength=self.n) / words,
            np.where(self.count >= 50, 1 - distinct / words, 0.0),
            self._repeated_lines(data, offsets, owner),
            np.bincount(self.doc[~np.isin(self.shapes, _PLAIN_HASHES)], minlength=self.n) / words,
            np.abs(np.log2(words / np.maximum(np.bincount(owner[ending], minlength=self.n), 1) / 12)),
        ], axis=1)

    @staticmethod
    def _distinct(doc: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The document of each distinct (document, value)."""
        by = np.lexsort((value, doc))
        doc, value = doc[by], value[by]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
        return doc[new]

    def _repeated_lines(self, data: np.ndarray, offsets: np.ndarray, owner: np.ndarray) -> np.ndarray:
        cuts = np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1]))
        starts, ends = cuts[:-1], cuts[1:]
        doc = owner[starts]
        breaks = data[ends - 1] == 10
        lines = RangeHash(data).of(starts, ends - breaks)
        full = ends - breaks > starts
        doc, lines = doc[full], lines[full]
        total = np.bincount(doc, minlength=self.n)
        return 1 - np.bincount(self._distinct(doc, lines), minlength=self.n) / np.maximum(total, 1)

    def patterns(self) -> np.ndarray:
        """Each text's votes as digits of base 3: 0 bad, 1 no vote, 2 good; no vote on a text without words."""
        out = np.zeros(self.n, dtype=np.int64)
        for i, (bad, good) in enumerate(LABELLERS.values()):
            m = self.measures[:, i]
            fine = 2 if good is not None else 1
            out = out * 3 + np.where(self.count == 0, 1, np.where(m > bad, 0, np.where(m <= (good or 0), fine, 1)))
        return out

    def features(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, hashed feature, weight): words, shapes, and words equal to the one before."""
        top = np.uint64(64 - BITS)
        shape = (self.shapes * np.uint64(0x9E3779B97F4A7C15)) >> top
        size = 1.0 / self.count[self.doc]
        same = self.doc[self.same]
        return (np.concatenate([self.doc, self.doc, same]),
                np.concatenate([self.words >> top, shape, np.full(len(same), 1, np.uint64)]).astype(np.int64),
                np.concatenate([size, size, 1.0 / self.count[same]]))


_PLAIN_HASHES = np.array([RangeHash(np.array(x, dtype=np.uint8)).of(np.array([0]), np.array([len(x)]))[0] for x in PLAIN])


def posteriors(counts: dict[int, int], rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation over vote patterns: (posterior of good by pattern, P(vote | class) as
    [labeller, class, vote], share of good). Starts from texts with any bad vote as bad."""
    m = len(LABELLERS)
    every = np.arange(3 ** m)
    votes = np.stack([every // 3 ** (m - 1 - i) % 3 for i in range(m)], axis=1)
    weight = np.array([counts.get(int(p), 0) for p in every], dtype=float)
    good = np.where((votes == 0).any(1), 0.05, 0.95)
    table, share = np.full((m, 2, 3), 1 / 3), 0.5
    for _ in range(rounds):
        share = (weight @ good + 1) / (weight.sum() + 2)
        for i in range(m):
            for v in range(3):
                is_v = votes[:, i] == v
                table[i, 1, v] = weight @ (good * is_v) + 1
                table[i, 0, v] = weight @ ((1 - good) * is_v) + 1
        table /= table.sum(2, keepdims=True)
        log = np.log(table)
        odds = np.log(share / (1 - share)) + sum(log[i, 1, votes[:, i]] - log[i, 0, votes[:, i]] for i in range(m))
        before, good = good, 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(good - before).max() < 1e-9:
            break
    return good, table, float(share)


class Scorer:
    """Logistic regression over hashed features; ``weights`` has 2 ** BITS entries and a bias."""

    def __init__(self):
        self.weights, self.bias = np.zeros(1 << BITS), 0.0

    def fit(self, doc: np.ndarray, feature: np.ndarray, size: np.ndarray, good: np.ndarray) -> "Scorer":
        """From (text, hashed feature, weight) triples and each text's posterior of good."""
        used, feature = np.unique(feature, return_inverse=True)
        feature, n = feature.astype(np.int32), len(good)
        w, bias = np.zeros(len(used)), 0.0
        seen, seen_bias = np.full(len(used), 1e-8), 1e-8
        for _ in range(EPOCHS):
            p = 1 / (1 + np.exp(-np.clip(np.bincount(doc, size * w[feature], minlength=n) + bias, -30, 30)))
            slope = (p - good) / n
            g = np.bincount(feature, size * slope[doc], minlength=len(used)) + DECAY * w
            seen += g * g
            w -= RATE * g / np.sqrt(seen)
            seen_bias += slope.sum() ** 2
            bias -= RATE * slope.sum() / np.sqrt(seen_bias)
        self.weights[used], self.bias = w, bias
        return self

    def score(self, texts: Texts) -> np.ndarray:
        doc, feature, size = texts.features()
        odds = np.bincount(doc, size * self.weights[feature], minlength=texts.n) + self.bias
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def voted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, pattern) of each row."""
    python_path(docs.sparkSession)
    given = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Texts(data, offsets).patterns() for _, _, data, offsets in text_chunks(arrow_text(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.zeros(0, np.int64), *found]))],
                                             ["doc_id", "pattern"])

    return given.mapInArrow(run, f"doc_id {dict(given.dtypes)['doc_id']}, pattern bigint")


def train(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, Scorer]:
    """(posterior by vote pattern, scorer). Votes of all rows count; the scorer sees ``sample`` of them.
    Of an empty table nothing is learnt: every score is 0.5."""
    votes = written(voted(docs, id_col, text_col), "votes")
    good, _, _ = posteriors(dict(votes.groupBy("pattern").count().collect()))
    texts = sampled(docs, votes, sample, id_col, text_col)
    # At most ``sample`` rows, each of a text's distinct features.
    rows = sorted(texts.mapInArrow(_features, "pattern bigint, feature binary, size binary").collect())
    if not rows:
        return good, Scorer()
    feature = [np.frombuffer(r[1], np.int32) for r in rows]
    doc = np.repeat(np.arange(len(rows), dtype=np.int32), [len(x) for x in feature])
    size = np.concatenate([np.frombuffer(r[2], np.float32) for r in rows])
    return good, Scorer().fit(doc, np.concatenate(feature), size, good[[r[0] for r in rows]])


def sampled(docs: DataFrame, votes: DataFrame, sample: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text) of the ``sample`` ids of ``votes`` of smallest hash: of each id the text of the smallest
    hash among those of at most MAX_TEXT bytes, whatever the rows' order."""
    ids = votes.where("doc_id IS NOT NULL").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).where(
        F.octet_length("text") <= MAX_TEXT).join(F.broadcast(ids), "doc_id", "left_semi")
    return rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")).select("least.text")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its vote pattern and its distinct hashed features (int32) with their weights (float32)."""
    for batch in batches:
        rows = []
        for _, _, data, offsets in text_chunks(arrow_text(batch.column(0))):
            texts = Texts(data, offsets)
            doc, feature, size = texts.features()
            key, place = np.unique((doc.astype(np.int64) << BITS) + feature, return_inverse=True)
            weight = np.bincount(place, size, minlength=len(key)).astype(np.float32)
            cuts = np.searchsorted(key >> BITS, np.arange(texts.n + 1))
            feature = (key & ((1 << BITS) - 1)).astype(np.int32)
            rows += [(int(p), feature[lo:hi].tobytes(), weight[lo:hi].tobytes())
                     for p, lo, hi in zip(texts.patterns(), cuts[:-1], cuts[1:])]
        columns = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()))],
                                         ["pattern", "feature", "size"])


def scored(docs: DataFrame, sample: int = SAMPLE, keep: float = KEEP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, posterior (of good, from its votes), score (0 to 1, of the scorer) and kept
    (score >= ``keep``). Null is the empty text: no vote, the scorer's bias. Repeated rows are scored
    alike; other columns do not matter; an empty table gives no rows."""
    model = train(docs, sample, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS weights and 3 ** labellers posteriors
    given = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, scorer = shared.value
        for batch in batches:
            p, s = [np.zeros(0)], [np.zeros(0)]
            for _, _, data, offsets in text_chunks(arrow_text(batch.column(1))):
                texts = Texts(data, offsets)
                p.append(good[texts.patterns()])
                s.append(scorer.score(texts))
            score = np.concatenate(s)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(p)), pa.array(score), pa.array(score >= keep)],
                                             ["doc_id", "posterior", "score", "kept"])

    return given.mapInArrow(run, f"doc_id {dict(given.dtypes)['doc_id']}, posterior double, score double, kept boolean")
