"""Toxicity by compression distance.

Two zstandard dictionaries are trained, on toxic and on ordinary text. A text is cut into windows of
WINDOW words; each is compressed with either dictionary, and the bytes that the toxic one saves are
the window's gain. A logistic curve over counts and sizes of a text's gains, fitted on labelled texts
that the dictionaries have not seen, turns them into a score, so thresholds are calibrated.

* The ordinary dictionary is zstandard's trainer on ordinary texts. The toxic one is that with, in
  front, the word beginnings that toxic text has far more often than ordinary text: without the shared
  part, ordinary words would cost differently under the two, and drown the gains.
* How often a beginning comes is counted by the different words before it, so copies of one text do
  not make its words look typical.
* Both dictionaries end with, and every window begins with, PRIMER: a window then always holds a
  match, and a few bytes' gain are not lost to zstandard's way of storing what hardly shrinks.

Training takes a bounded sample: at most ``per_class`` labelled texts of each class, chosen by a hash
of their ids, of at most MAX_TEXT bytes each and MAX_CLASS_BYTES a class; two thirds (by a hash of the text) train the
dictionaries, one third calibrates. Scoring reads every whole text where it is stored: no shuffle.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import columns_but, python_path

PER_CLASS, MAX_TEXT, MAX_CLASS_BYTES = 4000, 1 << 16, 16 << 20
WINDOW = 6
DICTIONARY_BYTES = 4000
BEGINNINGS = (4, 5, 6, 7, 8)
LEAST_CONTEXTS, LEAST_RATIO = 3, 10.0
PRIMER = bytes(range(1, 9)) + bytes(range(14, 26))
LEVEL, MIN_MATCH = 9, 5


class Model:
    """Dictionary contents and the calibrated curve; small, and sent to every task."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = toxic + ordinary + PRIMER, ordinary + PRIMER
        self.mean = self.scale = self.weights = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "compressors"}

    def gains(self, text: bytes) -> np.ndarray:
        """Bytes saved by the toxic dictionary, for each window of the whole text (one if it is empty)."""
        if not hasattr(self, "compressors"):
            self.compressors = tuple(_compressor(x) for x in (self.ordinary, self.toxic))
        ordinary, toxic = (c.compress for c in self.compressors)
        words = text.lower().split()
        windows = [PRIMER + b" " + b" ".join(words[i:i + WINDOW]) for i in range(0, len(words), WINDOW)] or [PRIMER]
        return np.array([len(ordinary(w)) - len(toxic(w)) for w in windows])

    def score(self, text: bytes) -> float:
        if self.weights is None:
            return 0.0
        return float(_curve((_features(self.gains(text)) - self.mean) / self.scale @ self.weights))


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, min_match=MIN_MATCH, write_checksum=False, write_content_size=False, write_dict_id=False,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    return zstandard.ZstdCompressor(compression_params=parameters, dict_data=zstandard.ZstdCompressionDict(
        content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))


def _features(gains: np.ndarray) -> np.ndarray:
    n, top = len(gains), np.sort(gains)[::-1][:3]
    over = [(gains >= t).sum() for t in (1, 2, 3, 4)]
    return np.array([*top, *[0] * (3 - len(top)), *np.log1p(over), *(10 * x / n for x in over[:3]), np.log(n), 1.0])


def _curve(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _contexts(texts: list[bytes]) -> Counter:
    """Word -> how many different words come before it."""
    pairs = set()
    for text in texts:
        before = b""
        for word in text.lower().split():
            pairs.add((before, word))
            before = word
    return Counter(word for _, word in pairs)


def _beginnings(contexts: Counter) -> Counter:
    out: Counter = Counter()
    for word, n in contexts.items():
        spaced = b" " + word
        for k in BEGINNINGS:
            if k < len(spaced):
                out[spaced[:k]] += n
        out[spaced] += n
    return out


def _typical(toxic: list[bytes], ordinary: list[bytes]) -> bytes:
    """The beginnings far more frequent in toxic text, most frequent last; of those that extend one
    another, the longest that keeps at least half of the shortest one's uses."""
    a, b = _beginnings(_contexts(toxic)), _beginnings(_contexts(ordinary))
    total = (sum(a.values()), max(1, sum(b.values())))
    often = {g: n for g, n in a.items()
             if n >= LEAST_CONTEXTS and (n - n ** 0.5) / total[0] >= LEAST_RATIO * (b[g] + 1) / total[1]}
    found = set()
    for g in often:
        if not any(g[:k] in often for k in range(1, len(g))):
            while longer := [h for h in often if len(h) > len(g) and h.startswith(g) and 2 * often[h] >= often[g]]:
                g = max(longer, key=lambda h: (often[h], len(h), h))
            found.add(g)
    return b"".join(g + b"\0" for g in sorted(found, key=lambda g: (often[g], g)))[-DICTIONARY_BYTES:]


def _trained(texts: list[bytes]) -> bytes:
    """Content of a dictionary trained by zstandard; of too little text, its end."""
    samples = [t[i:i + 2048].lower() for t in texts for i in range(0, len(t), 2048)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=24, d=6).as_bytes()[-DICTIONARY_BYTES:]
    except zstandard.ZstdError:
        return b" ".join(samples)[-DICTIONARY_BYTES:]


def fit(texts: list[bytes], labels: list[int], share: float | None = None) -> Model:
    """A model from labelled texts; ``share`` is the share of label 1 where the texts are not drawn
    evenly. Without both labels every score is 0."""
    train = [zlib.crc32(t) % 3 > 0 for t in texts]
    toxic = [t for t, y, x in zip(texts, labels, train) if x and y]
    ordinary = [t for t, y, x in zip(texts, labels, train) if x and not y]
    if not toxic or not ordinary:
        return Model(b"", b"")
    model = Model(_typical(toxic, ordinary), _trained(ordinary))
    held = [(t, y) for t, y, x in zip(texts, labels, train) if not x] or list(zip(texts, labels))
    x = np.array([_features(model.gains(t)) for t, _ in held])
    y = np.array([float(v) for _, v in held])
    weight = np.ones(len(y))
    if share is not None and 0 < y.mean() < 1:
        weight = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-9
    model.mean[-1], model.scale[-1] = 0.0, 1.0
    x = (x - model.mean) / model.scale
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = _curve(x @ w)
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(len(w)), x.T @ (weight * (y - p)) - w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    model.weights = w
    return model


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, class_bytes: int = MAX_CLASS_BYTES) -> Model:
    """A model from ``labels`` (doc_id, toxic) and the texts of ``docs``. Rows with a null id, label or
    text do not count; an id with several labels is toxic if one of them says so. See :func:`sampled` for the
    texts that are read."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    counts = dict(known.groupBy("toxic").count().collect())
    if len(counts) < 2:
        return Model(b"", b"")
    rows = sampled(docs, known, per_class, class_bytes).collect()
    return fit([r.text.encode() for r in rows], [int(r.toxic) for r in rows], counts[True] / sum(counts.values()))


def sampled(docs: DataFrame, known: DataFrame, per_class: int = PER_CLASS, class_bytes: int = MAX_CLASS_BYTES) -> DataFrame:
    """(toxic, text), ordinary ones first: the training sample of ``known`` (doc_id, toxic; each id once). Of
    each class the ``per_class`` ids of smallest hash; of an id the text of smallest hash among those of at most
    MAX_TEXT bytes; of these texts, in the order of their CRC-32, the first ``class_bytes`` bytes a class (the
    text that passes the bound is the last). So the driver gets at most twice ``class_bytes`` and MAX_TEXT."""
    ids = None
    for toxic in (False, True):
        some = known.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        ids = some if ids is None else ids.unionByName(some)
    rows = docs.select("doc_id", "text").where(F.octet_length("text") <= MAX_TEXT).join(F.broadcast(ids), "doc_id")
    least = rows.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    texts = least.select("doc_id", "toxic", "least.text", F.crc32(F.col("least.text").cast("binary")).alias("crc"))
    # at most per_class rows a class, each with a text of at most MAX_TEXT bytes
    order = Window.partitionBy("toxic").orderBy("crc", "text", "doc_id")
    before = F.coalesce(F.sum(F.octet_length("text")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return texts.withColumn("before", before).where(F.col("before") <= class_bytes).orderBy(
        "toxic", "crc", "text", "doc_id").select("toxic", "text")


def scored(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col``, 0 to 1, of the whole text alone. Null is scored as the empty text;
    equal texts score alike. Other columns pass through; one called ``score_col`` is replaced."""
    python_path(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(*columns_but(docs, score_col), F.lit(None).cast("double").alias(score_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(score_col)
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            scores = [shared.value.score((t or "").encode()) for t in texts]
            yield batch.set_column(at, pa.field(score_col, pa.float64()), pa.array(scores, pa.float64()))

    return given.mapInArrow(run, given.schema)


def digest(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Per document: doc_id, held_out (crc32 of the id as text, modulo 4, is 2), score, predicted.
    Labels of held-out ids are never read."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = train(docs, labels.where(~held_out))
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
