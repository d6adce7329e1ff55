"""Licence scan by a positional rare-token index of licence templates.

Index: for every word of the templates its postings, the places (template, position) where it stands. Words
weigh by inverse document frequency over all files.

A template is found in a file where its mandatory key phrase stands word for word, and at least OTHER_SHARE
of its other words stand at their places relative to it. A file that lacks too many of a template's
words is done with it. In any other, of the template's words that the file has, the rarest are looked up: so
many that an alignment (place in the file minus place in the template) without any of them could not have
enough words. Each place of those words in the file is an alignment to try; the postings of all the template's
words are intersected with the file's words by relative position, and the key phrase is verified on the
words. So no alignment is missed whatever else the file holds, and a key phrase alone is no licence.

Plain licence phrases are found as well (base labels), with all their places.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Two scans of the texts
where they are stored; the only shuffle is one count per licence word and task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import arrow_text, python_path, text_chunks
from clickflow.llm.words import Words, words_of

#: Fixed values of the query's contract: phrase -> label.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Public licence notices as (label, notice, mandatory key phrase).
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at", "apache license version 2 0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met", "redistribution and use in source and binary forms"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License",
     "creative commons attribution 4 0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc"),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License",
     "either version 2 of the license"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3",
     "gnu general public license version 3"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted", "with or without fee is hereby granted"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction",
     "permission is hereby granted free of charge"),
    ("mit", "Released under the MIT License", "mit license"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     "mozilla public license v 2 0"),
]
OTHER_SHARE, PHRASE_SCORE = 0.25, 0.5
ALIGNMENTS = 1 << 16


class Index:
    """Templates' words, positions and key phrases; a few hundred entries, sent to every task. ``templates``:
    (label, notice, mandatory key phrase); ``share`` of a notice's words outside the phrase must be there."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES, share: float = OTHER_SHARE):
        self.labels = [label for label, _, _ in templates]
        texts = [words_of(notice) for _, notice, _ in templates]
        split = [[text.bytes_of(i, 1) for i in range(len(text))] for text in texts]
        self.words = sorted({w for text in split for w in text})
        number = {w: i for i, w in enumerate(self.words)}
        self.sequences = [np.array([number[w] for w in text], dtype=np.int64) for text in split]
        #: postings by count: how often a word stands in a template
        self.counts = np.array([np.bincount(x, minlength=len(self.words)) for x in self.sequences]).T
        self.keys = []
        for (_, notice, key), text in zip(templates, texts):
            k = words_of(key)
            at = next(i for i in range(len(text)) if text.bytes_of(i, len(k)) == k.bytes_of(0, len(k)))
            self.keys.append((at, len(k), k.bytes_of(0, len(k))))
        self.needed = [size + math.ceil(share * (len(sequence) - size)) for sequence, (_, size, _) in zip(self.sequences, self.keys)]
        self.phrases = [(len(w := words_of(p)), int(w.windows(len(w))[1][0]), w.bytes_of(0, len(w)), label)
                        for p, label in phrases.items()]
        hashes = np.array([words_of(w.decode()).windows(1)[1][0] for w in self.words], dtype=np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def known(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(word position, index of the licence word) of every licence word."""
        h = words.windows(1)[1]
        place = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        at = np.flatnonzero(self.hashes[place] == h)
        return at, self.order[place[at]]

    def places(self, words: Words) -> list[tuple[int, str]]:
        """(first word, label) of every place of a phrase, verified on the words."""
        found = []
        for n, h, text, label in self.phrases:
            at, hashes = words.windows(n)
            found += [(w, label) for w in at[hashes == np.uint64(h)].tolist() if words.bytes_of(w, n) == text]
        return sorted(found)

    def matched(self, words: Words, at: np.ndarray, word: np.ndarray, idf: np.ndarray) -> dict[int, dict[str, float]]:
        """Text -> label -> share of its template's words that agree at the best alignment. ``at``, ``word``: the
        licence words of all texts."""
        here = np.full(len(words), -1, dtype=np.int64)
        here[at] = word
        texts = len(words.first) - 1
        present = np.zeros((texts, len(self.words)), dtype=bool)
        present[np.searchsorted(words.first, at, side="right") - 1, word] = True
        most = present @ self.counts  # places of a template whose words the text has
        out: dict[int, dict[str, float]] = {}
        for text, template in zip(*(x.tolist() for x in np.nonzero(most >= self.needed))):
            share = self._aligned(words, here, text, template, present[text], idf)
            if share:
                found, label = out.setdefault(text, {}), self.labels[template]
                found[label] = max(found.get(label, 0.0), share)
        return out

    def _aligned(self, words: Words, here: np.ndarray, text: int, template: int, present: np.ndarray, idf: np.ndarray) -> float:
        """The best share of the template's words that stand in the text at one alignment with the key phrase."""
        sequence, needed, (place, size, key) = self.sequences[template], self.needed[template], self.keys[template]
        low, high = int(words.first[text]), int(words.first[text + 1])
        places = np.flatnonzero(present[sequence])
        rarest = places[np.argsort(-idf[sequence[places]], kind="stable")][:len(places) - needed + 1]
        own = here[low:high]
        begins = [np.flatnonzero(own == w) - i for w in np.unique(sequence[rarest]).tolist() for i in rarest[sequence[rarest] == w].tolist()]
        begins = np.unique(np.concatenate(begins)) + low
        best = 0
        for some in range(0, len(begins), ALIGNMENTS // len(sequence) + 1):
            begin = begins[some:some + ALIGNMENTS // len(sequence) + 1]
            where = begin[:, None] + np.arange(len(sequence))
            agrees = (where >= low) & (where < high)
            agrees &= here[np.clip(where, low, high - 1)] == sequence
            votes = agrees.sum(axis=1)
            enough = np.flatnonzero((votes >= max(needed, best + 1)) & agrees[:, place:place + size].all(axis=1))
            for k in enough[np.argsort(-votes[enough], kind="stable")].tolist():
                if words.bytes_of(int(begin[k]) + place, size) == key:
                    best = int(votes[k])
                    break
        return best / len(sequence)


def document_frequencies(docs: DataFrame, index: Index, text_col: str = "text") -> np.ndarray:
    """Inverse document frequency of each licence word over all of ``docs``."""
    python_path(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(index.words), dtype=np.int64), 0
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(arrow_text(batch.column(0))):
                words = Words(data, offsets)
                at, word = index.known(words)
                file = np.searchsorted(words.first, at, side="right")
                total += np.bincount(np.unique(file * len(index.words) + word) % len(index.words), minlength=len(index.words))
                n += hi - lo
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(total))), pa.array([n, *total.tolist()])], ["word", "n"])

    counted = docs.select(F.col(f"`{text_col}`")).mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n"))
    n = dict(counted.collect())  # one row per licence word
    return np.array([np.log((1 + n.get(-1, 0)) / (1 + n.get(i, 0))) for i in range(len(index.words))])


RESULT = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double")


def scanned(docs: DataFrame, index: Index | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, n_words, n_base (places of phrases), first_word and last_word (their
    smallest and largest start; else null), base_labels, labels (with the templates' ones), score: 0
    without a label, PHRASE_SCORE for a phrase, for a template the share of its words that agree (1: the whole
    notice); the largest. Null is the empty text; repeated rows are scanned each; an empty table gives no rows."""
    index = index or Index()
    idf = document_frequencies(docs, index, text_col)
    shared = docs.sparkSession.sparkContext.broadcast((index, idf))  # a few hundred words
    given = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, idf = shared.value
        for batch in batches:
            rows = []
            for lo, hi, data, offsets in text_chunks(arrow_text(batch.column(1))):
                words = Words(data, offsets)
                first = words.first
                at, word = index.known(words)
                matched = index.matched(words, at, word, idf)
                places = index.places(words)
                place_cut = np.searchsorted([p for p, _ in places], first)
                for i in range(hi - lo):
                    base = places[place_cut[i]:place_cut[i + 1]]
                    found = matched.get(i, {})
                    labels = {label for _, label in base}
                    starts = [p - int(first[i]) for p, _ in base]
                    rows.append((int(first[i + 1] - first[i]), len(base), min(starts, default=None), max(starts, default=None),
                                 ",".join(sorted(labels)), ",".join(sorted(labels | found.keys())),
                                 max([0.0, *found.values(), *([PHRASE_SCORE] if base else [])])))
            columns = list(zip(*rows)) or [()] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))],
                                             ["doc_id", *(c.split()[0] for c in RESULT.split(", "))])

    return given.mapInArrow(run, f"doc_id {dict(given.dtypes)['doc_id']}, {RESULT}")
