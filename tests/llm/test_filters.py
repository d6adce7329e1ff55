"""Filters and classifiers: rules against brute force, learnt models on held-out rows, edge cases."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from clickflow.llm import license_scan, quality_rules, toxicity, url_filter, weak_quality
from clickflow.llm.common import table

SF = "/root/testdata/sf0.01"


def test_quality_counts_against_brute_force(spark, docs):
    line = "one two three four five six seven eight nine\n"
    texts = [None, "", " \t\n", "a # b", line * 3 + "tail", "x " * 40, "É|<b>\n\x0b\nÉ|<b>", "w1 " * 7, line + "other " * 3 + line]
    got = {r.doc_id: tuple(r)[1:6] for r in quality_rules.digest(docs(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t or "") if x]
        windows = [tuple(w[j:j + 8]) for j in range(len(w) - 7)]
        often, covered = Counter(windows), set()
        for j, x in enumerate(windows):
            covered |= set(range(j, j + 8)) if often[x] > 1 else set()
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert got[i] == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered)), t


def test_quality_keeps_clean_and_drops_junk(spark):
    labels = table(spark, SF, "labels")
    found = {(r.quality, r.kept): r["count"] for r in quality_rules.digest(table(spark, SF, "documents")).join(
        labels, "doc_id").where("NOT base_failed").groupBy("quality", "kept").count().collect()}
    assert found.get((1, False), 0) == 0 and found[(0, False)] >= 5 * found.get((0, True), 0)


def test_quality_threshold_follows_the_group(spark):
    """A measure that is usual in its group is no outlier there; null groups are groups."""
    usual = " ".join(f"w{i}#" for i in range(30))
    rows = [(i, usual, "code", None, 1) for i in range(20)] + [(100 + i, " ".join(f"v{i}x{j}" for j in range(30)), "en", "s", 1) for i in range(20)]
    rows += [(200, usual, "en", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, __q bigint")
    kept = quality_rules.filtered(df)
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {200}
    assert quality_rules.filtered(df.limit(0)).count() == 0


def test_urls_against_brute_force(spark):
    urls = [None, "", "example.net/x", "http://EXAMPLE.net/en/a", "https://a.b.example.com/de/?q", "x://org", "http://org/fr/",
            "http://xorg/fr/", "http://a.org#f", "ftp://", "http://notexample.com/de/", "http://net", "a\nhttp://q.net/", "://h/p://z/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r.page_id: (r.host, r.path, r.rule) for r in url_filter.with_rule(pages).collect()}
    for i, u in enumerate(urls):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host):])[0]
            host = host.lower()
        fits = [(a, b) for a, b, _ in url_filter.RULES if (host == a or host.endswith("." + a)) and path.startswith(b)]
        best = max(fits, key=lambda r: (len(r[0]), len(r[1])), default=None)
        assert got[i] == (host, path, best and best[0] + best[1]), u
    assert url_filter.judged(pages.limit(0)).count() == 0


def test_reputation_shrinks_to_domain_and_suffix(spark):
    outcomes = [(f"h{i}.bad.com", 1) for i in range(40) for _ in range(5)] + [(f"h{i}.good.org", 0) for i in range(40) for _ in range(5)]
    outcomes += [(None, 1), ("x.good.org", None)]
    pages = [(1, "http://new.bad.com/"), (2, "http://new.good.org/"), (3, "http://other.com/"), (4, "http://other.org/"), (5, None)]
    out = url_filter.judged(spark.createDataFrame(pages, "page_id bigint, url string"),
                            spark.createDataFrame(outcomes, "host string, bad int"), rules=[])
    got = {r.page_id: (r.verdict, r.reputation) for r in out.collect()}
    assert got[1][0] == "block" and got[2][0] == "allow"
    assert got[1][1] > 0.9 and got[2][1] < 0.1 and abs(got[5][1] - 0.5) < 0.05 and got[5][0] == "allow"
    none = spark.createDataFrame([], "host string, bad int")
    assert {r.verdict for r in url_filter.judged(spark.createDataFrame(pages, "page_id bigint, url string"), none, rules=[]).collect()} == {"allow"}


def test_toxicity_on_held_out_rows(spark):
    scored = toxicity.digest(table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels"))
    rows = scored.join(table(spark, "/root/testdata/sf0.1", "labels"), "doc_id").where("held_out").select("toxic", "predicted").collect()
    caught = [r.predicted for r in rows if r.toxic]
    clean = [r.predicted for r in rows if not r.toxic]
    assert np.mean(caught) > 0.85 and np.mean(clean) < 0.03


def test_toxicity_edge_cases(spark, docs):
    df = docs([(1, None), (2, ""), (3, "word " * 20000), (3, "word " * 20000)])
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = toxicity.digest(df, none).collect()
    assert len(rows) == 4 and all(r.score == 0 and r.predicted == 0 for r in rows)
    model = toxicity.fit([b"awful scoundrel %d" % i for i in range(30)] + [b"a mild day %d" % i for i in range(30)], [1] * 30 + [0] * 30)
    scores = {r.doc_id: r.score for r in toxicity.scored(df, model).collect()}
    assert all(0 <= s <= 1 for s in scores.values()) and scores[1] == scores[2]
    assert toxicity.scored(df.limit(0), model).count() == 0


def test_toxicity_scores_against_the_written_out_rule(spark, docs):
    """Given a model: every window compressed anew under either dictionary, the curve added up term by term."""
    rnd = random.Random(3)
    mild, harsh = ["a", "mild", "day", "in", "spring", "with", "rain"], ["awful", "scoundrel", "vermin", "filthy"]
    texts = [" ".join(rnd.choices(mild, k=40)).encode() for _ in range(60)]
    texts += [" ".join(rnd.choices(mild + harsh, k=40)).encode() for _ in range(60)]
    model = toxicity.fit(texts, [0] * 60 + [1] * 60)

    def size(content, window):
        parameters = zstandard.ZstdCompressionParameters.from_level(
            9, min_match=5, write_checksum=False, write_content_size=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(compression_params=parameters, dict_data=raw).compress(window))

    def score(text):
        words = (text or "").encode().lower().split()
        windows = [toxicity.PRIMER + b" " + b" ".join(words[i:i + 6]) for i in range(0, len(words), 6)] or [toxicity.PRIMER]
        gains = sorted((size(model.ordinary, w) - size(model.toxic, w) for w in windows), reverse=True)
        over = [sum(g >= t for g in gains) for t in (1, 2, 3, 4)]
        x = (gains + [0, 0])[:3] + [math.log(1 + n) for n in over] + [10 * n / len(gains) for n in over[:3]] + [math.log(len(gains)), 1]
        odds = sum((v - m) / s * w for v, m, s, w in zip(x, model.mean, model.scale, model.weights))
        return 1 / (1 + math.exp(-max(-30, min(30, odds))))

    given = [None, "", " \n", "Awful day", *(t.decode() for t in texts[::7]), "rain in spring " * 30_000 + "vermin"]
    df = docs(list(enumerate(given))).selectExpr("*", "'x' AS score", "1 AS toxic", "2 AS predicted")
    found = {r.doc_id: r.score for r in toxicity.scored(df, model).collect()}
    for i, t in enumerate(given):
        assert found[i] == pytest.approx(score(t), abs=1e-9), t


def test_toxicity_trains_on_one_text_of_each_id_within_its_bytes(spark, docs):
    """Repeated ids and labels make no more rows; the bytes of a class are bounded in Spark."""
    rows = [(i, f"text {i} {k} " * 10) for i in range(20) for k in range(30)] + [(None, "x"), (21, None), (22, "y" * (1 << 17))]
    labels = spark.createDataFrame([(i, i % 2) for i in range(24)] * 20 + [(0, 1), (None, 1), (3, None)], "doc_id bigint, toxic int")
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    runs = []
    for order in (rows, rows[::-1]):
        got = [tuple(r) for r in toxicity.sampled(docs(order).repartition(3), known).collect()]
        ids = [int(t.split()[1]) for _, t in got]
        assert sorted(ids) == list(range(20)) and all(y == (i % 2 == 1 or i == 0) for i, (y, _) in zip(ids, got))
        runs.append(got)
    assert runs[0] == runs[1] and runs[0] == sorted(runs[0], key=lambda r: (r[0], zlib.crc32(r[1].encode()), r[1]))
    cut = [tuple(r) for r in toxicity.sampled(docs(rows), known, class_bytes=300).collect()]
    for y in (False, True):
        mine, whole = ([t for c, t in some if c == y] for some in (cut, runs[0]))
        assert mine == whole[:len(mine)] and sum(map(len, mine[:-1])) <= 300 < sum(map(len, mine))
    assert toxicity.sampled(docs(rows), known.where("doc_id < 20"), per_class=4).count() == 8


def test_licences_against_brute_force(spark, docs):
    texts = ["", None, "Released under the MIT License.", "cc by licensed cc BY-nc 4", "the GNU general PUBLIC license gnu general public license",
             "apache, license; version 2.0 alone", "x " * 5000 + "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use",
             "Permission is hereby granted, free of charge, to any person obtaining a copy", "mit gnu apache cc"]
    got = {r.doc_id: r for r in license_scan.scanned(docs(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
        places = [(j, label) for phrase, label in license_scan.PHRASES.items() for j in range(len(w)) if w[j:j + len(phrase.split())] == phrase.split()]
        starts = [j for j, _ in places]
        assert (got[i].n_words, got[i].n_base, got[i].first_word, got[i].last_word) == (
            len(w), len(places), min(starts, default=None), max(starts, default=None))
        assert got[i].base_labels == ",".join(sorted({x for _, x in places}))
        assert set(got[i].base_labels.split(",")) - {""} <= set(got[i].labels.split(",")) and 0 <= got[i].score <= 1
    assert got[2].labels == "mit" and got[6].labels == "apache,apache-2.0" and got[7].labels == "mit" and got[8].labels == ""
    assert got[3].labels == "cc-by,cc-by-nc"
    assert license_scan.scanned(docs([])).count() == 0


def test_licences_of_files_with_several_notices(spark, docs):
    """Each notice is found whatever else stands in the file: other notices, or their words before it."""
    notices = license_scan.TEMPLATES
    groups = [g for n in (1, 2, 3) for g in itertools.combinations(range(len(notices)), n)]
    texts = [("\n\n".join(notices[t][1] for t in g), g) for g in groups]
    every = sorted({w for _, notice, _ in notices for w in re.findall(r"[a-z0-9]+", notice.lower())}, reverse=True)
    texts += [(" filler ".join(every * 3) + " filler words " * 9000 + notices[t][1], (t,)) for t in range(len(notices))]
    # A common notice must not push out a rare one.
    texts += [(notices[0][1] + " " + notices[5][1], (0, 5))] * 300
    got = {r.doc_id: r for r in license_scan.scanned(docs([(i, t) for i, (t, _) in enumerate(texts)])).collect()}
    for i, (text, g) in enumerate(texts):
        assert set(got[i].labels.split(",")) - set(got[i].base_labels.split(",")) | {"mit"} == {notices[t][0] for t in g} | {"mit"}, text[:200]
        assert ("mit" in got[i].labels.split(",")) == any(notices[t][0] == "mit" for t in g) and got[i].score == 1


def _template_labels(text):
    """Label -> best share, trying every alignment of every template."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
    found = {}
    for label, notice, key in license_scan.TEMPLATES:
        t, k = re.findall(r"[a-z0-9]+", notice.lower()), key.split()
        place = next(i for i in range(len(t)) if t[i:i + len(k)] == k)
        for begin in range(-len(t), len(w)):
            agree = sum(0 <= begin + i < len(w) and w[begin + i] == x for i, x in enumerate(t))
            lo = begin + place
            if lo >= 0 and w[lo:lo + len(k)] == k and agree - len(k) >= license_scan.OTHER_SHARE * (len(t) - len(k)):
                found[label] = max(found.get(label, 0), agree / len(t))
    return found


def test_licence_labels_against_every_alignment(spark, docs):
    rnd = random.Random(6)
    texts = [None, "", *(key for _, _, key in license_scan.TEMPLATES), *(notice for _, notice, _ in license_scan.TEMPLATES)]
    for _ in range(400):
        words = []
        for _ in range(rnd.randrange(1, 4)):
            part = rnd.choice(license_scan.TEMPLATES)[1].split()
            lo = rnd.randrange(len(part)) if rnd.random() < .4 else 0
            part = part[lo:lo + rnd.randrange(1, len(part) + 1)] if rnd.random() < .6 else part
            words += [rnd.choice([x, x.upper()]) if rnd.random() > .08 else rnd.choice(["other", "the", "software"]) for x in part]
            if rnd.random() < .1:
                words.insert(rnd.randrange(len(words)), "inserted")
        texts.append(" ".join(words))
    got = {r.doc_id: r for r in license_scan.scanned(docs(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        want = _template_labels(t)
        base = set(filter(None, got[i].base_labels.split(",")))
        assert got[i].labels == ",".join(sorted(base | want.keys())), t
        assert got[i].score == pytest.approx(max([0, *want.values(), *([license_scan.PHRASE_SCORE] if base else [])]))
    keys = range(2, 2 + len(license_scan.TEMPLATES))
    assert all(got[i].labels == got[i].base_labels for i in keys)  # a key phrase alone is no licence


def test_weak_quality_agrees_with_labels(spark):
    found = {(r.quality, r.kept): r["count"] for r in weak_quality.scored(table(spark, SF, "documents")).join(
        table(spark, SF, "labels"), "doc_id").groupBy("quality", "kept").count().collect()}
    assert found.get((1, False), 0) == 0 and found[(0, False)] >= 9 * found.get((0, True), 0)


def test_weak_quality_edge_cases(spark, docs):
    rows = weak_quality.scored(docs([(1, None), (2, ""), (3, "\n \t"), (3, "\n \t"), (None, "Some words here. " * 9), (5, "é")])).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert weak_quality.scored(docs([])).count() == 0


def test_weak_quality_trains_on_one_fixed_text_of_each_id(spark, docs):
    assert weak_quality.SAMPLE == 4000
    rows = [(i, f"text {i} {k} of several rows. " * 4) for i in range(6) for k in range(9)]
    models = []
    for order in (rows, rows[::-1], rows[::2] + rows[1::2]):
        df = docs(order).repartition(3)
        assert weak_quality.sampled(df, weak_quality.voted(df), 4).count() == 4
        models.append(weak_quality.train(df, 4)[1])
    assert all(np.array_equal(m.weights, models[0].weights) and m.bias == models[0].bias for m in models) and models[0].weights.any()


def test_expectation_maximisation_finds_the_accuracies():
    rnd = np.random.default_rng(1)
    good = rnd.random(20000) < 0.8
    m = len(weak_quality.LABELLERS)
    votes = np.where(good[:, None], np.where(rnd.random((20000, m)) < 0.9, 2, 1), np.where(rnd.random((20000, m)) < 0.6, 0, 2))
    patterns = (votes * 3 ** np.arange(m - 1, -1, -1)).sum(1)
    posterior, table_, share = weak_quality.posteriors(Counter(patterns.tolist()))
    assert abs(share - 0.8) < 0.02 and abs(table_[:, 0, 0] - 0.6).max() < 0.05
    assert ((posterior[patterns] > 0.5) == good).mean() > 0.97


def test_posteriors_against_plain_expectation_maximisation():
    """The same rounds with a row for each text and a loop for each vote."""
    rnd = random.Random(8)
    m = len(weak_quality.LABELLERS)
    texts = [[rnd.choice([0, 1, 1, 2, 2, 2]) for _ in range(m)] for _ in range(150)] + [[1] * m, [0] * m]
    digits = lambda votes: sum(v * 3 ** (m - 1 - i) for i, v in enumerate(votes))
    got, table_, share = weak_quality.posteriors(Counter(map(digits, texts)), rounds=7)
    good = [0.05 if 0 in v else 0.95 for v in texts]
    for _ in range(7):
        part = (sum(good) + 1) / (len(texts) + 2)
        p = [[[1.0] * 3 for _ in range(2)] for _ in range(m)]
        for votes, g in zip(texts, good):
            for i, v in enumerate(votes):
                p[i][1][v] += g
                p[i][0][v] += 1 - g
        p = [[[x / sum(row) for x in row] for row in two] for two in p]
        odds = [part / (1 - part) * math.prod(p[i][1][v] / p[i][0][v] for i, v in enumerate(votes)) for votes in texts]
        good = [o / (1 + o) for o in odds]
    assert share == pytest.approx(part) and table_.tolist() == [[pytest.approx(row) for row in two] for two in p]
    assert [got[digits(v)] for v in texts] == pytest.approx(good, abs=1e-9)


def test_scorer_against_plain_gradient_steps(spark, docs):
    """Every text's words hashed, weighed and added up one by one; scores of all rows by the query's path."""
    rnd = random.Random(9)
    texts = [" ".join(rnd.choices(["Some", "words", "here", "ab#c", "XYZ", "12", "end."], k=rnd.randrange(1, 60))) for _ in range(25)]
    texts += ["same " * 40_000, "é" * 300_000]
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    whole = weak_quality.Texts(np.concatenate(data), np.concatenate([[0], np.cumsum([len(x) for x in data])]))
    doc, feature, size = whole.features()
    good = np.array([rnd.random() for _ in texts])
    scorer = weak_quality.Scorer().fit(doc, feature, size, good)
    rows = [Counter() for _ in texts]
    for d, f, w in zip(doc.tolist(), feature.tolist(), size.tolist()):
        rows[d][f] += w
    for i, t in enumerate(texts):  # a word and a shape for each word, and one for each word equal to the one before
        words = t.split()
        again = sum(a == b for a, b in zip(words, words[1:]))
        assert sum(rows[i].values()) == pytest.approx(2 + again / len(words))
    w, seen, bias, seen_bias = Counter(), Counter(), 0.0, 1e-8
    odds = lambda row: sum(x * w[f] for f, x in row.items()) + bias
    for _ in range(weak_quality.EPOCHS):
        slope = [(1 / (1 + math.exp(-odds(row))) - g) / len(rows) for row, g in zip(rows, good)]
        step = Counter()
        for row, s in zip(rows, slope):
            for f, x in row.items():
                step[f] += x * s
        for f in {f for row in rows for f in row}:
            g = step[f] + weak_quality.DECAY * w[f]
            seen[f] += g * g
            w[f] -= weak_quality.RATE * g / math.sqrt(seen[f] + 1e-8)
        seen_bias += sum(slope) ** 2
        bias -= weak_quality.RATE * sum(slope) / math.sqrt(seen_bias)
    want = [1 / (1 + math.exp(-odds(row))) for row in rows]
    assert scorer.score(whole).tolist() == pytest.approx(want, abs=1e-6)


def test_a_blocked_path_does_not_block_its_host(spark):
    """Pages beside the path are good outcomes, at any table size; where the path is most of a host, it counts."""
    def verdict(de, beside, n):
        urls = [f"http://example.com/de/{i}" for i in range(de * n)] + [f"http://example.com/x/{i}" for i in range(beside * n)]
        pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
        return {r.verdict for r in url_filter.digest(pages).where("rule IS NULL").collect()}
    assert verdict(1, 2, 1) == verdict(1, 2, 30) == {"allow"}
    assert verdict(9, 1, 30) == {"block"}


def test_registered_domains_of_two_label_suffixes(spark):
    hosts = ["a.b.co.uk", "b.co.uk", "co.uk", "x.example.com", "example.com", "com", ""]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = [tuple(r) for r in df.select(*(c.alias(k) for k, c in url_filter._levels(F.col("host")).items())).collect()]
    assert [x[:2] for x in got] == [("co.uk", "b.co.uk"), ("co.uk", "b.co.uk"), ("co.uk", "co.uk"), ("com", "example.com"),
                                    ("com", "example.com"), ("com", "com"), ("", "")]


def test_urls_with_null_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, "x", 1), (1, None, "x", 1), (2, "http://q.org/", "y", 2)], "page_id bigint, url string, HOST string, rule int")
    rows = url_filter.judged(df).collect()
    assert sorted((r.page_id, r.host, r.verdict) for r in rows) == [(1, "", "allow"), (1, "", "allow"), (2, "q.org", "allow")]
