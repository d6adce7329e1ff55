"""Context-tree scores against a plain recursion over the trees, and their edge cases."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

from clickflow.llm import context_tree as ct
from clickflow.llm.common import table


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def is_held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


class Trees:
    """The trees as dictionaries: (context, nearest byte last; bits before) -> [zeros, ones]."""

    def __init__(self, texts, depth):
        self.depth, self.counts = depth, {}
        for text in texts:
            for context, byte in self.symbols(text):
                for before, bit in self.bits(byte):
                    for d in range(depth + 1):
                        node = (context[depth - d:], before)
                        self.counts.setdefault(node, [0, 0])[bit] += 1
        self.children = {}
        for context, before in self.counts:
            if context:
                self.children.setdefault((context[1:], before), []).append((context, before))
        self.memo = {}

    def symbols(self, text):
        data = bytes(self.depth) + text.encode() + b"\xff"
        return [(data[i - self.depth:i], data[i]) for i in range(self.depth, len(data))]

    @staticmethod
    def bits(byte):
        return [(f"{byte:08b}"[:i], int(f"{byte:08b}"[i])) for i in range(8)]

    def kt(self, node):
        a, b = self.counts[node]
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, node):
        if len(node[0]) == self.depth:
            return self.kt(node)
        if node not in self.memo:
            below = sum(self.weighted(c) for c in self.children[node])
            self.memo[node] = float(np.logaddexp(self.kt(node), below)) - math.log(2)
        return self.memo[node]

    def one(self, context, before, d=0):
        node = (context[self.depth - d:], before)
        if node not in self.counts:
            return .5
        a, b = self.counts[node]
        own = (b + .5) / (a + b + 1)
        if d == self.depth:
            return own
        stop = math.exp(self.kt(node) - math.log(2) - self.weighted(node))
        return stop * own + (1 - stop) * self.one(context, before, d + 1)

    def score(self, text):
        total = 0.0
        for context, byte in self.symbols(text):
            for before, bit in self.bits(byte):
                p = self.one(context, before)
                total += math.log10(p if bit else 1 - p)
        return total


def by_hand(rows, depth):
    trees = Trees([low(t) for i, t in rows if not is_held_out(i)], depth)
    words = {j: re.findall(r"[^\x20\x09-\x0D]+", low(t)) for j, (_, t) in enumerate(rows)}
    counts = Counter(x for j, (i, _) in enumerate(rows) if not is_held_out(i) for x in [*words[j], " end "])
    n, v = sum(counts.values()), len(counts)
    out = []
    for j, (i, t) in enumerate(rows):
        tokens = [*words[j], " end "]
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in tokens)
        out.append((i, is_held_out(i), len(tokens), sum(counts[x] > 0 for x in tokens), n, base, trees.score(low(t)), len((t or "").encode())))
    return out


def check(got, want):
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=repr), sorted(want, key=repr)):
        assert tuple(g)[:5] == w[:5] and g.n_bytes == w[7]
        assert g.base_score == pytest.approx(w[5], abs=1e-9) and g.score == pytest.approx(w[6], abs=1e-8)
        assert g.bits_per_byte == pytest.approx(-w[6] * math.log2(10) / (w[7] + 1), abs=1e-8)


@pytest.mark.parametrize("depth,block", [(2, 300), (4, 1 << 20)])
def test_scores_against_the_plain_recursion(spark, depth, block):
    rng = random.Random(depth)
    texts = [None, "", " \t\n", "é€𝄞", "The cat sat", "the CAT sat on\x0bthe mat", "x" * 90, "\x00\x00a"]
    texts += [" ".join(rng.choices(["the", "cat", "dog", "ran", "É"], k=12)) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (3, texts[3]), (3, "other text")]
    docs = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id bigint, text string, block int, KEY string, held_out string")
    check(ct.scored(docs, depth, block).collect(), by_hand(rows, depth))
    assert ct.scored(docs.limit(0), depth).count() == 0


def test_without_training_texts_every_bit_is_a_half(spark):
    held = next(i for i in range(100) if is_held_out(i))
    (row,) = ct.scored(spark.createDataFrame([(held, "Ab c")], "doc_id bigint, text string"), 2).collect()
    assert row.held_out and row.n_known == 0 and row.train_tokens == 0 and row.n_tokens == 3
    assert row.score == pytest.approx(-40 * math.log10(2)) and row.base_score == pytest.approx(0)


def test_a_long_text_in_pieces(monkeypatch):
    """Pieces of a long text have the byte strings and words of the whole, each once."""
    rng = random.Random(5)
    text = (" ".join(rng.choices(["a", "bcd", "é" * 30, "q" * 500], k=4000)) + "z" * 5000).encode()
    row = [len(text)], zstandard.compress(text), 3
    whole = list(ct.pieces(*row))
    monkeypatch.setattr(ct, "PIECE", 1000)
    parts = list(ct.pieces(*row))
    assert len(whole) == 1 and len(parts) > 50
    assert np.concatenate([p.keys for p in parts]).tolist() == whole[0].keys.tolist()

    def count(some):
        return Counter(p.words[k] for p in some for k in p.word.tolist())
    assert count(parts) == count(whole)


def test_held_out_texts_cost_less_than_by_a_shallow_tree(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")

    def bits(depth):
        r = ct.scored(docs, depth).where("held_out").selectExpr("sum(bits_per_byte * (n_bytes + 1)) / sum(n_bytes + 1)").first()
        return r[0]
    assert bits(3) < bits(1) < 8


def test_lookup_of_colliding_and_repeated_items():
    rng = np.random.default_rng(3)
    items = np.unique(np.concatenate([rng.integers(-1 << 62, 1 << 62, 5000), np.arange(3000) << 40, np.arange(100)]))
    amounts = rng.random(len(items))
    found = ct.Lookup([(items, amounts), (items[::7], amounts[::7])])
    order = rng.integers(0, len(items), 20_000)
    assert np.array_equal(found.of(items[order]), amounts[order])
    assert len(ct.Lookup([]).of(np.zeros(0, dtype=np.int64))) == 0
