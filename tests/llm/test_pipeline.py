"""The pipeline's rows against stages computed plainly; every stage on edge cases."""

import base64
import hashlib
import struct

import public_tokenizers
import tiktoken

import corpus_pipeline
from clickflow.llm import decontaminate, quality_rules

from .conftest import DOC, SF
from .test_dedup import _components, _fingerprint


def test_pipeline_against_brute_force(spark, con):
    docs = {i: t for i, t in con.sql("select doc_id, text from documents").fetchall()}
    kept = {r.doc_id for r in quality_rules.digest(spark.read.parquet(f"{SF}/documents.parquet")).where("kept").collect()}
    rows = [(i, _fingerprint(docs[i])) for i in sorted(kept)]
    first = sorted(set(_components(rows)))
    texts = [docs[i].encode() for i in first]
    n = corpus_pipeline.PASSAGE_BYTES
    want = {}
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    seen = {}
    for t in texts:
        for i in range(len(t) - n + 1):
            seen[t[i:i + n]] = seen.get(t[i:i + n], 0) + 1
    left = {}
    for i, t in zip(first, texts):
        gone = {k for j in range(len(t) - n + 1) if seen[t[j:j + n]] > 1 for k in range(j, j + n)}
        left[i] = bytes(b for k, b in enumerate(t) if k not in gone).decode(errors="ignore")
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in left.items()], DOC)
    leaks = {r.doc_id for r in decontaminate.digest(frame, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").collect()}
    for i, t in left.items():
        if i not in leaks:
            ids = encoding.encode_ordinary(t)
            want[i] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "some words " * 30, "en", "s", 1),
            (4, "a" * 5000, "en", "s", 1), (5, "x", None, "s", None)]
    for given in (rows, []):
        docs = spark.createDataFrame([(*r, "extra") for r in given], DOC + ", ids string")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= len(given), name
            if name != corpus_pipeline.STAGES[-1][0]:
                assert set(out.columns) == set(docs.columns), name
