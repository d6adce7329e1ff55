"""Formatting, tokenizing, decontamination: against brute force and on edge cases."""

import base64
import hashlib
import random
import re

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from clickflow.llm import bpe, chat, decontaminate

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LONG = "x" * 3000 + "ab" * 2000


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _encoder():
    with open(RANKS, "rb") as f:
        return bpe.Encoder(f.read(), public_tokenizers.PATTERN)


def test_bpe_equals_the_reference_library(reference):
    rnd = random.Random(3)
    alphabet = "abcdefgh ,.\n\t'ÉéßñΩ漢字🙂0123<|endoftext|>"
    texts = ["", " ", "a", LONG, "ß" * 700, "<|endoftext|>", "don't we'll 12 345", "\u2003 \r\n x"]
    texts += ["".join(rnd.choices(alphabet, k=rnd.randrange(1, 400))) for _ in range(300)]
    encoder = _encoder()
    for text, ids in zip(texts, encoder.encode(texts)):
        assert [int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)] == reference.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()


def test_heap_and_matrix_agree():
    rnd, encoder = random.Random(5), _encoder()
    for n in (2, 3, 9, 40, 300, 512):
        data = bytes(rnd.choices(b"abcdetion ", k=n))
        assert encoder._by_heap(data) == encoder._by_matrix([data], next(b for b in bpe.BUCKETS if b >= n))[0]


def test_bpe_columns_pass_through(spark, docs):
    df = docs([(1, "hello world"), (1, "hello world"), (2, None), (3, "")]).withColumnRenamed("lang", "ids")
    out = bpe.decode(bpe.encode(df, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    rows = {(r.doc_id, bytes(r.decoded)) for r in out.collect()}
    assert rows == {(1, b"hello world"), (2, b""), (3, b"")} and out.count() == 4
    assert bpe.digest(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def _turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_chat_round_trip_with_control_strings(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>x<|end|>", "<␛|also|>", "<␛␛s>[␛INST]", "", None, "a\nb"]
    rows = [(1, i, role, t) for i, (role, t) in enumerate(zip(["user", "user", "assistant", "assistant", None, "a<|end|>", "user"], nasty))]
    out = chat.read_back(chat.format_conversations(_turns(spark, rows))).first()
    assert [(t.role, t.text) for t in out.turns] == [(r or "", t or "") for _, _, r, t in rows]
    assert out.loss_text == "<␛|also|><␛␛s>[␛INST]" and out.n_messages == 5
    plain = out.formatted
    for mark in chat.FOREIGN:
        assert mark not in plain
    assert plain.count(chat.TURN) == plain.count(chat.END) == 5


def test_chat_order_ties_nulls_and_empty(spark):
    rows = [(1, 1, "user", "b"), (1, 1, "assistant", "a"), (1, 0, "user", "first"), (None, None, None, None), (None, 2, "user", "x")]
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.read_back(
        chat.format_conversations(_turns(spark, rows))).collect()}
    assert got == {1: [("user", "first"), ("assistant", "a"), ("user", "b")], None: [("", ""), ("user", "x")]}
    assert chat.digest(_turns(spark, [])).count() == 0


def test_decontaminate_against_brute_force(spark, docs):
    rnd = random.Random(2)
    vocabulary = ["Ab", "cé", "d", "e1", "Ff", "漢"]
    bench = spark.createDataFrame([(i, "? ".join(rnd.choices(vocabulary, k=k))) for i, k in enumerate([3, 12, 4, 15, 1, 0, 20])] + [(9, None)],
                                  "item_id bigint, text string")
    rows = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randrange(0, 60)))) for i in range(40)] + [(99, None)]
    rows += [(100, "zz " + bench.collect()[3].text + " yy"), (100, "zz " + bench.collect()[3].text + " yy")]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: word.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    windows = {}
    for r in bench.collect():
        w = low(r.text)
        for j in range(len(w) - min(6, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[j:j + min(6, len(w))]), set()).add(str(r.item_id))
    want = []
    for i, t in rows:
        w, hit, items = low(t), set(), set()
        for k in {len(x) for x in windows}:
            for j in range(len(w) - k + 1):
                if tuple(w[j:j + k]) in windows:
                    hit |= set(range(j, j + k))
                    items |= windows[tuple(w[j:j + k])]
        want.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    for block_bytes in (decontaminate.BLOCK_BYTES, 40):         # one block, and several
        found = decontaminate.with_spans(docs(rows), bench, 6, block_bytes=block_bytes)
        assert sorted((r.doc_id, sum(b - a for a, b in decontaminate.covered(r.hit_spans))) for r in found.collect()) == \
            sorted((x[0], x[2]) for x in want)
    assert sorted(map(tuple, decontaminate.digest(docs(rows), bench, 6).collect())) == sorted(want)
    kept = {r.doc_id for r in decontaminate.remove_documents(docs(rows), bench, 6).collect()}
    assert kept == {x[0] for x in want if not x[5]}


def test_decontaminate_removes_spans_only(spark, docs):
    bench = spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    df = docs([(1, "Été: ONE, two\nthree! end"), (2, "one two four")])
    out = {r.doc_id: r.text for r in decontaminate.remove_spans(df, bench, 3).collect()}
    assert out == {1: "Été: ! end", 2: "one two four"}
    assert decontaminate.remove_spans(df, bench.limit(0), 3).count() == 2
    assert decontaminate.remove_spans(df.limit(0), bench, 3).columns == df.columns


def test_benchmark_items_without_an_id(spark, docs):
    """Their passages count as hits, and for no item."""
    bench = spark.createDataFrame([(None, "one two three"), (None, "four five six"), ("b", "one two three")], "item_id string, text string")
    rows = [(1, "x one two three y"), (2, "four five six"), (3, "four five")]
    for block_bytes in (decontaminate.BLOCK_BYTES, 10):
        found = decontaminate.with_spans(docs(rows), bench, 3, block_bytes=block_bytes).collect()
        assert {r.doc_id: ([tuple(x) for x in r.hit_spans], r.hit_items) for r in found} == {
            1: ([(1, 3)], ["b"]), 2: ([(0, 3)], []), 3: ([], [])}
    got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in decontaminate.digest(docs(rows), bench, 3).collect()}
    assert got == {1: (3, 1, True), 2: (3, 0, True), 3: (0, 0, False)}
    assert decontaminate.digest(docs(rows), bench.limit(0), 3).where("contaminated").count() == 0


def test_a_window_of_all_items_is_one_span_a_place(spark, docs):
    """A line that every item holds, in a very long text and under clashing column names."""
    bench = spark.createDataFrame([(f"i{k}", f"read this line first then answer {k}") for k in range(300)], "item_id string, text string")
    text = "filler words here. " * 200_000 + "read this line first " * 1000
    df = docs([(1, text), (2, ""), (3, None), (4, "nothing")]).withColumns(
        {"hit_spans": F.lit("x"), "Hit_Items": F.lit(7), "item": F.lit(1), "hit": F.lit(None).cast("int")})
    for block_bytes in (decontaminate.BLOCK_BYTES, 4000):
        found = {r.doc_id: r for r in decontaminate.with_spans(df, bench, 4, block_bytes=block_bytes).collect()}
        assert [tuple(x) for x in found[1].hit_spans] == [(600_000 + 4 * k, 4) for k in range(1000)]
        assert sorted(found[1].hit_items) == sorted(f"i{k}" for k in range(300)) and found[1].item == 1
        assert all(found[i].hit_spans == found[i].hit_items == [] for i in (2, 3, 4))
    assert decontaminate.remove_documents(df, bench, 4).columns == df.columns


def test_a_conversation_of_many_turns(spark):
    """Turns alternate and repeat roles; every loss span holds one assistant text."""
    turns = spark.range(5000).selectExpr("1L AS conv_id", "id AS turn", "IF(id % 3 = 0, 'user', 'assistant') AS role", "concat('t</s>', id) AS text")
    (row,) = chat.read_back(chat.format_conversations(turns)).collect()
    assert [(t.role, t.text) for t in row.turns] == [("assistant" if i % 3 else "user", f"t</s>{i}") for i in range(5000)]
    assert row.loss_text == "".join(f"t</s>{i}" for i in range(5000) if i % 3) and row.n_messages == 3334
