import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from quillstone.llm import bpe, queries


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(bpe.VOCABULARY), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_query_equals_tiktoken(spark, sf_dir, reference):
    got = {r.doc_id: r for r in queries.op9_byte_level_bpe(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d, text in docs:
        ids = reference.encode_ordinary(text or "")
        r = got[d]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60) | st.text("ab c\n", max_size=400) | st.text("éüñ漢🙂'sA1 ", max_size=80), max_size=6))
def test_encode_decode(texts):
    ranks = bpe.Bpe.get(P.path(bpe.VOCABULARY))
    enc = _encoding()
    ids, n = ranks.encode(texts)
    want = [enc.encode_ordinary(t) for t in texts]
    assert n.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]
    assert bpe.Words.get(P.path(bpe.VOCABULARY)).decode(ids.astype(np.int64))[0].tobytes() == "".join(texts).encode()


_kept = []


def _encoding():
    if not _kept:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(bpe.VOCABULARY), "rb"))}
        _kept.append(tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}))
    return _kept[0]


def test_edge_cases(spark, reference, monkeypatch):
    long = "ab" * 3000 + " " * 700 + "wort " * 5000
    rows = [(1, None, "x"), (2, "", "x"), (3, long, "x"), (3, long, "x"), (None, "a b", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.decode(bpe.encode(df.withColumnRenamed("ids", "k0")).select("doc_id", "k0", "ids"))
    got = {(r.doc_id, bytes(r.decoded)): np.frombuffer(bytes(r.ids), "<u4").tolist() for r in out.collect()}
    assert got[(1, b"")] == [] and got[(2, b"")] == []
    assert got[(3, long.encode())] == reference.encode_ordinary(long)
    assert bpe.encode(df.limit(0).select("doc_id", "text")).count() == 0
    monkeypatch.setattr(bpe, "SLICE_BYTES", 1000)
    ids, n = bpe.Bpe.get(P.path(bpe.VOCABULARY)).encode([long, "x"])
    assert ids.tolist() == reference.encode_ordinary(long) + reference.encode_ordinary("x")
