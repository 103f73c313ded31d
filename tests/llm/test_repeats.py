import hashlib
import random
from collections import Counter

import numpy as np

from quillstone.llm import queries, repeats

W = repeats.WINDOW


def brute(rows):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(hash(t[i : i + W]) for _, t in texts for i in range(len(t) - W + 1))
    out = []
    for d, t in texts:
        mask = bytearray(len(t))
        for i in range(len(t) - W + 1):
            if seen[hash(t[i : i + W])] > 1:
                mask[i : i + W] = b"\1" * W
        spans = sum(1 for i in range(len(t)) if mask[i] and (i == 0 or not mask[i - 1]))
        kept = bytes(c for c, m in zip(t, mask) if not m)
        out.append((d, len(t), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdeéñ", k=rng.randrange(1, 7))) for _ in range(n))


def corpus(rng):
    passage = words(rng, 120)
    line = words(rng, 60).encode()[:185].decode("utf-8", "ignore")
    rows = []
    for i in range(40):
        t = words(rng, rng.randrange(10, 200))
        if i % 3 == 0:
            cut = rng.randrange(0, 200)
            t = t + passage[cut : cut + rng.randrange(150, 500)] + words(rng, 30)
        if i % 2 == 0:
            t = t + line + words(rng, 20)
        rows.append((i, t))
    near = words(rng, 300)
    for i in range(40, 60):
        k = rng.randrange(len(near))
        rows.append((i, near[:k] + "X" * rng.randrange(3) + near[k + 1 :]))
    rows += [(60, "ab " * 400), (61, "xy" * 90), (62, "z" * 199), (63, "z" * 200), (64, "q" * 201), (65, None), (66, ""), (67, near), (67, near), (None, near[:250]), (68, passage[:200]), (69, "\x00" * 230)]
    return rows


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert result(queries.op8_suffix_array_dedup(spark, sf_dir)) == brute(rows)


def test_edge_cases(spark, monkeypatch):
    rows = corpus(random.Random(11))
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, k1 int")
    assert result(repeats.dedup_repeats(df)) == brute(rows)
    assert repeats.dedup_repeats(df.limit(0)).count() == 0
    monkeypatch.setattr(repeats, "BIG", 3)
    assert result(repeats.dedup_repeats(df)) == brute(rows)


def test_run_index_equals_brute_force():
    rng = random.Random(3)
    pieces = [bytes(rng.choices(b"ab\x00", k=rng.randrange(1, 60))) + rng.choice([b"", b"\xfe" + bytes(rng.choices(b"ab", k=30))]) for _ in range(40)]
    pieces += pieces[:5]
    index = repeats.RunIndex(pieces)
    got = index.matching_statistics(np.arange(len(index.text)))
    suffixes = [(int(s) + i, p[i:]) for s, p in zip(index.starts, pieces) for i in range(len(p))]
    for at, own in suffixes:
        best = 0
        for other, t in suffixes:
            if other != at:
                n = next((k for k, (a, b) in enumerate(zip(own, t)) if a != b), min(len(own), len(t)))
                best = max(best, n)
        assert got[at] == best
    assert index.runs < len(index.text)


def test_anchors_cover_every_window():
    rng = random.Random(5)
    texts = [words(rng, 200).encode(), b"ab" * 300, b"x" * 199, b"y" * 200]
    offsets = np.cumsum([0, *map(len, texts)])
    text, pos, _, far, near = repeats.anchors(np.frombuffer(b"".join(texts), np.uint8), offsets)
    for k, t in enumerate(texts):
        own = text == k
        governed = [i for p, f, n in zip(pos[own], far[own], near[own]) for i in range(p - f, p - n + 1)]
        assert governed == list(range(len(t) - W + 1))
        assert ((far[own] <= repeats.SPREAD) & (near[own] >= 0)).all()


def test_big_buffers_rank_by_pairs(monkeypatch):
    rng = random.Random(6)
    pieces = [bytes(rng.choices(b"ab", k=300)) for _ in range(30)] * 2
    want = repeats.RunIndex(pieces).samples
    monkeypatch.setattr(repeats, "TRIPLE", 1)
    assert all((a == b).all() for x, y in zip(want, repeats.RunIndex(pieces).samples) for a, b in zip(x, y))


def test_slices_of_a_long_text(monkeypatch):
    """Slices have the anchors of the whole text, each once."""
    rng = random.Random(11)
    data = np.frombuffer(b"".join(rng.choice([b"abab", b"x" * 300, rng.randbytes(90)]) for _ in range(400)), np.uint8)
    whole = repeats.anchors(data, np.array([0, len(data)]))
    for size in (1, 199, 1_000, 4_096):
        monkeypatch.setattr(repeats, "SLICE_BYTES", size)
        for a, b in zip(repeats.anchors_of(data, np.array([0, len(data)])), whole):
            assert a.tolist() == b.tolist()


def test_very_long_texts(spark):
    rng = random.Random(12)
    text = words(rng, 150_000)
    rows = [(1, text), (2, text[: len(text) // 2] + words(rng, 500)), (3, None)]
    got = {r.doc_id: r for r in repeats.dedup_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    n = len(text[: len(text) // 2].encode())
    assert n <= got[1].n_removed <= n + 10 and n <= got[2].n_removed <= n + 10 and got[1].n_spans == got[2].n_spans == 1 and got[3].n_bytes == 0
