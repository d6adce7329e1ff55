"""Filter audit and Merkle manifest against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest

from clickflow.llm import filter_audit, merkle

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def measure(texts):
    raw = [t if isinstance(t, bytes) else t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    found = filter_audit.measures(data, offsets, filter_audit.Transducer())
    return [tuple(int(found[m][i]) for m in filter_audit.MEASURES) for i in range(len(texts))]


def by_hand(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return (len(words), len(set(words)), len(text), len(re.findall("[A-Z]", text)), len(re.findall(r"[#$%&*|]", text)))


def test_transducer_against_regular_expressions():
    rng = random.Random(1)
    alphabet = "aAbZ #$|\t\n\x0b\x1c\x85\xa0é€𝄞漢\x00"
    texts = ["", " ", "a", "€", "𝄞 𝄞", "A" * 100] + ["".join(rng.choices(alphabet, k=rng.randrange(200))) for _ in range(300)]
    assert measure(texts) == [by_hand(t) for t in texts]


def test_one_very_long_text_and_long_words():
    rng = random.Random(2)
    words = ["w" * 70, "w" * 69 + "x", "é" * 500, *(f"v{i}" for i in range(3000))]
    text = " ".join(rng.choices(words, k=600_000))
    assert measure([text, "a a", text[:-1]])[0] == by_hand(text)


def test_bytes_that_are_not_utf8():
    """A stray continuation byte and a byte that UTF-8 never has count as code points; a cut character counts once."""
    assert [m[2] for m in measure([b"\x80", b"\xff\xff", b"\xc3", b"\xe2\x82a", b"\xc3\xa9", b"\xf0\x9f"])] == [1, 2, 1, 2, 1, 1]


def test_wrong_guesses_are_run_again():
    """A state that no look-back finds: every lane starts wrong and is repaired."""
    machine = filter_audit.Transducer()
    n = filter_audit.LANES * filter_audit.LOOK_BACK * 3
    symbols = np.full(n, machine.CONTINUED, dtype=np.uint8)
    state, want = 0, []
    # a table in which the state depends on the first symbol only
    machine.next[:] = np.repeat(np.arange(5, dtype=np.uint8) * machine.width, machine.width)
    machine.next[machine.LEAD4] = 3 * machine.width
    machine.emit[:] = np.repeat(np.arange(5, dtype=np.uint8), machine.width)
    symbols[0] = machine.LEAD4
    for x in symbols.tolist():
        want.append(int(machine.emit[state + x]))
        state = int(machine.next[state + x])
    assert machine.emitted(symbols).tolist() == want


def audit_by_hand(docs, labels):
    marks = {}
    for i, quality, toxic in labels:
        good, bad = marks.get(i, (0, 0))
        marks[i] = (max(good, int(quality == 1)), max(bad, int(toxic == 1)))
    first = {}
    for i, text, *_ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    rows = []
    for i, text, _, source, *_ in docs:
        words, distinct, points, capitals, symbols = by_hand(text or "")
        fails = {x for x, bad in zip("ABCDE", (
            words < 200, 100 * distinct < 50 * words, 100 * capitals > 2 * points, symbols > 0,
            i is not None and i > first[text or ""])) if bad}
        rows.append((source or "", fails, *(marks.get(i, (0, 0)) if i is not None else (0, 0))))
    out, removed_at = {}, {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                here = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                before = set(order[:step - 1])
                removed_at[part, f] = removed_at.get((part, f), 0) + len(here)
                out[part, order, step] = [len(left), len(here), sum(f in r[1] and bool(r[1] & before) for r in own),
                                          sum(r[1] == {f} for r in own), sum(r[2] for r in here), sum(r[3] for r in here)]
    return {(p, o, s): tuple(v) + (removed_at[p, o[s - 1]],) for (p, o, s), v in out.items()}


def test_audit_against_brute_force(spark):
    rng = random.Random(3)
    long = " ".join(f"w{i}" for i in range(210))
    texts = [None, "", long, long.upper(), long + " #", "a b " * 150, "Q", "x | y", long + " A" * 40]
    rows = [(rng.choice([None, *range(60)]), rng.choice(texts), "en", rng.choice([None, "", "s", "t"]), 1, "x", 7) for _ in range(150)]
    rows += rows[:10]  # repeated rows
    docs = spark.createDataFrame(rows, DOC + ", digest string, PATTERN int")
    labels = [(rng.choice([None, *range(80)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(60)]
    marks = spark.createDataFrame([(*x, 1) for x in labels], "doc_id bigint, quality int, toxic int, n int")
    got = {tuple(r)[:3]: tuple(r)[3:] for r in filter_audit.audited(docs, marks).collect()}
    assert got == audit_by_hand(rows, labels)
    assert filter_audit.audited(docs.limit(0), marks).count() == 0
    assert filter_audit.audited(docs, marks.limit(0)).count() == 3 * 120 * 5


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest_by_hand(rows):
    def leaf(doc_id, text, lang, source, n_chars):
        fields = [doc_id, source, lang, n_chars, text]
        return H(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))

    def up(nodes):
        """(root, for each node its [(before, after)])"""
        groups = [[i] for i in range(len(nodes))]
        proofs = [[] for _ in nodes]
        while len(nodes) > 1:
            runs = [nodes[i:i + 8] for i in range(0, len(nodes), 8)]
            for k, run in enumerate(runs):
                for j in range(len(run)):
                    for i in groups[8 * k + j]:
                        proofs[i].append((run[:j], run[j + 1:]))
            groups = [sum(groups[8 * k:8 * k + 8], []) for k in range(len(runs))]
            nodes = [H(*run) for run in runs]
        return nodes[0], proofs

    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r, leaf(*r)))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    subs = []
    for lang in order:
        trees[lang].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        subs.append(up([d for _, d in trees[lang]]))
    root, tops = up([s for s, _ in subs])
    out = []
    for lang, (sub, proofs), top in zip(order, subs, tops):
        for (r, d), proof in zip(trees[lang], proofs):
            path = proof + top
            fold = d
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                fold = leaf(r[0], re.sub("[A-Z]", lambda m: m[0].lower(), r[1]), *r[2:])
            for left, right in path:
                fold = H(*left, fold, *right)
            out.append((r[0], d, sub, root, H(*(x for left, right in path for x in left + right)), fold, fold == root))
    return out


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_manifest_against_brute_force(spark, depth):
    rng = random.Random(depth)
    langs = [None, "", "en", "de", "é"] + [f"l{i}" for i in range(12)]
    rows = [(rng.choice([None, -5, *range(900)]), rng.choice([None, "", "Aé", "b", "Long " * 50]), "hot" if rng.random() < .5 else rng.choice(langs),
             rng.choice([None, "s", ""]), rng.choice([None, 3])) for _ in range(700)]
    rows += rows[:20]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], DOC + ", tree string, POS int")
    got = [tuple(r) for r in merkle.digest(docs, depth).collect()]
    assert sorted(got, key=repr) == sorted(manifest_by_hand(rows), key=repr)


def test_manifest_of_few_rows(spark):
    docs = spark.createDataFrame([(3, "Text", None, None, None)], DOC)
    (row,) = merkle.digest(docs).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == H()
    assert merkle.digest(docs.limit(0)).count() == 0


def test_a_witness_leads_to_the_root_and_no_other_leaf_does(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "en", "s", 6) for i in range(100)], DOC)
    for r in merkle.manifest(docs, ["text"], depth=1).collect():
        assert merkle.folded(r.digest, r.witness) == r.root and r.pos == r.doc_id and r.text == f"text {r.doc_id}"
        assert merkle.folded(bytes(32), r.witness) != r.root
