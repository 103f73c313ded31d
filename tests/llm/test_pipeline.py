"""Each stage against a slow version of itself, on the stage's own input."""

import base64
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from quillstone.llm import bpe, mixing, pii, quality, simhash
from quillstone.llm.common import materialize


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], sf_dir)))
    return out


def test_columns(tables):
    assert [t.columns for t in tables[:-1]] == [tables[0].columns] * 5


def test_quality(spark, sf_dir, tables):
    docs, kept = tables[0].collect(), {r.doc_id for r in tables[1].collect()}
    model = quality.fit_quality(tables[0], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    x = np.array([quality.statistics((r.text or "").encode()) for r in docs])
    want = {r.doc_id for r, s in zip(docs, model.scores(x)) if s >= quality.THRESHOLD}
    assert kept == want and 0 < len(kept) < len(docs)
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    right = [(d in kept) == (q == 1) for d, q in marks.items()]
    assert sum(right) > 0.95 * len(right)


def test_near_dups(tables):
    rows = {r.doc_id: r.text for r in tables[1].collect()}
    ids, sets = list(rows), {}
    for d, t in rows.items():
        w = t.encode().lower().split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    root = {d: d for d in ids}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    assert sorted(r.doc_id for r in tables[2].collect()) == sorted({find(d) for d in ids})


def test_pii(tables):
    before, after = ({r.doc_id: r for r in t.collect()} for t in tables[2:4])
    back = pii.Pseudonyms(corpus_pipeline.CONTRACT_KEY.encode(), back=True)
    assert before.keys() == after.keys()
    assert all(back.replace(after[d].text)[0] == r.text and after[d].n_chars == len(after[d].text) for d, r in before.items())


def test_mixing(tables):
    docs, mixed = tables[3].collect(), tables[4].collect()
    size = {r.doc_id: len(r.text.encode().split()) for r in docs}
    times = Counter(r.doc_id for r in mixed)
    assert max(times.values()) <= 2 and {(r.doc_id, r.text) for r in mixed} <= {(r.doc_id, r.text) for r in docs}
    plan = {r.doc_id: r for r in mixing.mix(tables[3]).collect()}
    for d, r in plan.items():
        assert times[d] == r.copies + (r.partial > 0 and 2 * r.partial >= size[d])


def test_tokens(tables):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(bpe.VOCABULARY), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = Counter((r.doc_id, r.text, bytes(r.ids)) for r in tables[5].collect())
    want = Counter((r.doc_id, r.text, np.array(enc.encode_ordinary(r.text), "<u4").tobytes()) for r in tables[4].collect())
    assert got == want


def test_run_equals_stages(spark, sf_dir, tables):
    assert Counter((r.doc_id, bytes(r.ids)) for r in corpus_pipeline.run(spark, sf_dir).collect()) == Counter((r.doc_id, bytes(r.ids)) for r in tables[5].collect())


def test_empty(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
        assert docs.count() == 0
    assert simhash.unique_documents
