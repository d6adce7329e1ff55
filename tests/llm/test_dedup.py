"""SimHash and suffix-array deduplication against brute force; suffix arrays; components."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from clickflow.llm import sais, simhash, suffix_dedup
from clickflow.llm.components import components


def _fingerprint(text, n=4):
    w = (text or "").encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i:i + n]), 42) for i in range(max(1, len(w) - n + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(fps, bits=4):
    x = np.array([f for _, f in fps], dtype=np.uint64)
    near = np.bitwise_count(x[:, None] ^ x) <= bits
    ids = np.array([i for i, _ in fps])
    while True:
        low = np.array([ids[row].min() for row in near])
        if (low == ids).all():
            return ids.tolist()
        ids = low


def test_near_duplicates_against_brute_force(spark, docs):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rnd.choices(words, k=300)) for _ in range(12)]
    texts = list(base) + ["", None, " \n", "one", "One", "one two three"]
    for t in base:
        for _ in range(6):
            w = t.split()
            w[rnd.randrange(300)] = "zz"
            texts.append(" ".join(w))
        texts.append(t)
    rows = list(enumerate(texts, start=10))
    rnd.shuffle(rows)
    fps = [(i, _fingerprint(t)) for i, t in rows]
    want = {i: (f"{f:016x}", c) for (i, f), c in zip(fps, _components(fps))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs(rows)).collect()}
    assert got == want
    kept = simhash.deduplicated(docs(rows + rows[:3]))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in want.values()})
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert simhash.near_duplicates(docs([])).count() == 0


def test_near_duplicates_of_a_long_text_with_clashing_columns(spark, docs, monkeypatch):
    """A text whose shingles come in several pieces, columns named as the operator's own, and null ids."""
    rnd = random.Random(5)
    long = " ".join(rnd.choices([f"w{i}" for i in range(3000)], k=60_000))
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 1 << 12)
    rows = [(1, long), (2, long + " end"), (None, long), (3, "Short text of six words"), (4, None)]
    df = docs(rows).selectExpr("*", "1 AS fp", "2 AS root", "'x' AS fingerprint", "3 AS component_id", "4 AS anchor", "5 AS __key")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()}
    assert got == {i: (f"{_fingerprint(t):016x}", 1 if t and len(t) > 99 else i) for i, t in rows}
    kept = simhash.deduplicated(df)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4] and kept.columns == df.columns[:-1]


def test_deduplication_keeps_rows_without_or_with_repeated_ids(spark, docs):
    rnd = random.Random(2)
    text = [" ".join(rnd.choices([f"w{i}" for i in range(400)], k=300)) for _ in range(6)]
    near = text[0] + " zz"
    assert bin(_fingerprint(text[0]) ^ _fingerprint(near)).count("1") <= 4
    rows = [(None, text[1]), (None, text[2]), (None, text[2]), (3, text[0]), (5, near), (5, text[3]), (5, text[4]), (7, text[5]), (None, text[5])]
    want = sorted([("None", text[1]), ("None", text[2]), ("3", text[0]), ("5", text[3]), ("5", text[4]), ("7", text[5])])
    for order in (rows, rows[::-1]):
        assert sorted((str(r.doc_id), r.text) for r in simhash.deduplicated(docs(order)).collect()) == want


@pytest.mark.parametrize("flips", [1, 2, 3, 4])
def test_anchors_cover_every_pair_within_four_bits(flips):
    rnd = random.Random(flips)
    homes = lambda x: [(3, x >> 46)] + [(p, (b >> 15, int(simhash.HOME[b & 32767]))) for p in (1, 2) for b in [(x >> 23 * (p - 1)) & 8388607]]

    def visits(x):
        out = set(homes(x))
        for p in (1, 2):
            b = (x >> 23 * (p - 1)) & 8388607
            raw, code = b >> 15, b & 32767
            out |= {(p, (raw ^ 1 << i, int(simhash.HOME[code]))) for i in range(8)}
            out |= {(p, (raw, int(c))) for c in simhash.NEAR[code] if c >= 0}
        return out

    for _ in range(3000):
        x = rnd.getrandbits(64)
        y = x
        for bit in rnd.sample(range(64), flips):
            y ^= 1 << bit
        assert set(homes(x)) & visits(y)


def test_large_groups_spread_like_small_ones():
    rnd = np.random.default_rng(4)
    seeds = rnd.integers(0, 1 << 63, 5, dtype=np.uint64)
    x = np.unique(np.concatenate([s ^ (np.uint64(1) << rnd.integers(0, 64, 60).astype(np.uint64)) for s in seeds] +
                                 [rnd.integers(0, 1 << 63, 40, dtype=np.uint64)]))
    home = np.ones(len(x), dtype=bool)
    batch = simhash._edges(np.zeros(len(x), dtype=np.int64), x.view(np.int64), home, 4)
    root = {}
    for a, b in zip(*(c.to_pylist() for c in batch.columns)):
        root[a] = b
    groups = {}
    for f in x.view(np.int64).tolist():
        groups.setdefault(root.get(f, f), set()).add(f)
    ids = _components(list(enumerate(x.tolist())))
    want = {}
    for i, c in enumerate(ids):
        want.setdefault(c, set()).add(int(x.view(np.int64)[i]))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_anchors_of_many_fingerprints_are_cut_into_blocks(spark, monkeypatch):
    """Fingerprints that share their first 23 bits, so one anchor, in clusters and alone: the components are
    those of the whole anchor, and no group is much larger than two blocks."""
    rnd = np.random.default_rng(7)
    same = np.uint64(0x2A5A5A)
    seeds = (rnd.integers(0, 1 << 41, 60, dtype=np.uint64) << np.uint64(23)) | same
    flips = [s ^ (np.uint64(1) << np.uint64(b)) for s in seeds[:25] for b in rnd.choice(np.arange(23, 64), 12, replace=False)]
    x = np.unique(np.concatenate([seeds, np.array(flips, dtype=np.uint64), rnd.integers(0, 1 << 63, 100, dtype=np.uint64)]))
    fps = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp bigint")
    ids = _components(list(enumerate(x.tolist())))
    want = {}
    for f, c in zip(x.view(np.int64).tolist(), ids):
        want.setdefault(c, set()).add(f)
    for block in (1 << 14, 100, 40):
        monkeypatch.setattr(simhash, "BLOCK", block)
        sizes = simhash.in_blocks(fps).groupBy("anchor", "cell").count()
        largest = sizes.agg({"count": "max"}).first()[0]
        assert largest > 300 if block > len(x) else largest <= 3 * block
        root = {r.node: r.root for r in components(simhash.links(fps)).collect()}
        groups = {}
        for f in x.view(np.int64).tolist():
            groups.setdefault(root.get(f, f), set()).add(f)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(20)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("short", [3, 1 << 16])
def test_suffix_array_and_common_prefixes(short, monkeypatch):
    monkeypatch.setattr(sais, "SHORT", short)
    rnd = random.Random(short)
    for _ in range(150):
        t = [rnd.randint(1, rnd.choice([1, 2, 5])) for _ in range(rnd.randint(1, 70))] * rnd.randint(1, 3) + [0]
        s = np.array(t, dtype=np.uint16)
        sa = sais.suffix_array(s)
        assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:])
        phi, plcp = sais.permuted_lcp(s, sa)
        for a, b in zip(sa.tolist(), sa.tolist()[1:]):
            n = next(k for k in range(len(t)) if t[a + k] != t[b + k])
            assert plcp[b] == n and phi[b] == a


def _brute(texts, n):
    seen = {}
    for t in texts:
        for i in range(len(t) - n + 1):
            seen[t[i:i + n]] = seen.get(t[i:i + n], 0) + 1
    out = []
    for t in texts:
        gone = set()
        for i in range(len(t) - n + 1):
            if seen[t[i:i + n]] > 1:
                gone |= set(range(i, i + n))
        spans = sum(1 for i in gone if i - 1 not in gone)
        out.append((len(t), len(gone), spans, hashlib.sha256(bytes(b for i, b in enumerate(t) if i not in gone)).hexdigest()))
    return out


def _repeating(rnd):
    word = lambda: "".join(rnd.choices("abcdeé ", k=rnd.randrange(3, 9)))
    passage = [" ".join(word() for _ in range(90)) for _ in range(3)]
    texts = [" ".join(word() for _ in range(rnd.randrange(1, 40))) + rnd.choice(["", *passage]) + " ".join(word() for _ in range(rnd.randrange(1, 40)))
             for _ in range(40)]
    return texts + [texts[0], texts[1] + "!", "a" * 900, "ab" * 700, "", None, passage[0] * 2, passage[1][:399]]


@pytest.mark.parametrize("shard_bytes,frequent", [(suffix_dedup.SHARD_BYTES, 1000), (3000, 1000), (3000, 2)])
def test_repeats_against_brute_force(spark, docs, shard_bytes, frequent, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "FREQUENT", frequent)
    """Also with keys larger than a shard, which are counted window by window."""
    monkeypatch.setattr(suffix_dedup.covered, "__defaults__", (400, 128, shard_bytes))
    texts = _repeating(random.Random(8))
    want = {i: r for i, r in enumerate(_brute([(t or "").encode() for t in texts], 400))}
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.digest(docs(list(enumerate(texts)))).collect()}
    assert got == want


@pytest.mark.parametrize("length", [40, 240])
def test_shorter_passages_against_brute_force(spark, docs, length):
    texts = _repeating(random.Random(10))
    want = {i: r for i, r in enumerate(_brute([(t or "").encode() for t in texts], length))}
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.digest(docs(list(enumerate(texts))), length).collect()}
    assert got == want


def test_repeats_removed_from_texts(spark, docs):
    rows = list(enumerate(_repeating(random.Random(9))))
    df = docs(rows).withColumnRenamed("lang", "__ranges")
    out = suffix_dedup.deduplicated(docs(rows)).collect()
    assert len(out) == len(rows) and {r.doc_id: r.text for r in out}[len(rows) - 3] is None
    assert suffix_dedup.deduplicated(df).count() == len(rows)
    assert suffix_dedup.digest(docs([])).count() == 0


def test_anchors_are_counted_by_the_worker_that_sends_them(spark):
    rnd = random.Random(5)
    fps = [rnd.getrandbits(64) - (1 << 63) for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in fps], "fp bigint")
    sizes = simhash.anchor_sizes(df)
    # before: two Python workers a task, one after the other
    assert sizes._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    want = {}
    for r in simhash.replicated(df).collect():
        n, homes = want.get(r.anchor, (0, 0))
        want[r.anchor] = n + 1, homes + r.home
    assert {r.anchor: (r.n, r.homes) for r in sizes.collect()} == want


def test_fingerprints_hold_little_beside_the_texts():
    import tracemalloc

    import pyarrow as pa

    rnd = random.Random(6)
    texts = pa.array([" ".join(str(rnd.random()) for _ in range(400)).encode() for _ in range(400)], pa.large_binary())
    fps = np.zeros(len(texts), dtype=np.uint64)
    tracemalloc.start()
    for rows, hashes, counts in simhash._shingle_hashes(texts, 4):
        simhash._majority(fps, rows, hashes, counts)
        hashes = rows = counts = None
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20  # before: 83 MB
    assert [f"{x:016x}" for x in fps[:5].tolist()] == [f"{_fingerprint(t.as_py().decode()):016x}" for t in texts[:5]]
