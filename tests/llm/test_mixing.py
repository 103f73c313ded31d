import numpy as np
import pytest

from quillstone.llm import mixing, queries


def water_fill(sizes, weights, total):
    """By rounds: what exceeds a cap is shared again among the others."""
    caps, out, free = {k: 2 * s for k, s in sizes.items()}, {}, set(sizes)
    left = total
    while free:
        share = {k: left * weights[k] / sum(weights[j] for j in free) for k in free}
        over = {k for k in free if share[k] > caps[k] + 1e-12}
        if not over:
            return {**out, **share}
        for k in over:
            out[k] = caps[k]
            left -= caps[k]
        free -= over
    return out


def check(rows, got):
    size = lambda t: len((t or "").encode().split())
    sums = {}
    for _, t, s in rows:
        sums[s] = sums.get(s, 0) + size(t)
    order = sorted(sums, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    want = water_fill(sums, weights, 1.5 * sum(sums.values()))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted((d is None, d or 0, size(t)) for d, t, _ in rows)
    taken = dict.fromkeys(sums, 0)
    for r in got:
        assert r.source_size == sums[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size + r.partial
        taken[r.source] += r.taken
    for s in sums:
        assert abs(taken[s] - want[s]) <= 1


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()]
    got = queries.op10_source_mixing(spark, sf_dir)
    again = queries.op10_source_mixing(spark, sf_dir)
    assert sorted(got.collect()) == sorted(again.collect())
    check(rows, mixing.mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect())


@pytest.mark.parametrize("bucket", [20_000, 7])
def test_edge_cases_and_reduction_tree(spark, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    rng = np.random.default_rng(2)
    rows = [(int(i), "w " * int(rng.integers(0, 40)), ["a", "Z", "é", None][int(rng.integers(0, 4))]) for i in range(300)]
    rows += [(5, None, "a"), (5, "x y z", "a"), (5, "x y z", "a"), (None, "q " * 9, "b"), (7, "", "empty"), (8, "w " * 30_000, "huge")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, bucket string")
    check(rows, mixing.mix(df).collect())
    assert mixing.mix(df.limit(0)).count() == 0
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns


def test_pivot_keeps_mass_and_expectation():
    rng = np.random.default_rng(3)
    size = rng.integers(1, 50, 200).astype(float)
    mass = size * 0.3
    total = np.zeros(200)
    for _ in range(3000):
        out, held = mixing.pivot(mass, size, rng.random(200))
        assert abs(out.sum() - mass.sum()) < 1e-6
        open_ = np.flatnonzero((out > 1e-9) & (out < size - 1e-9))
        assert len(open_) <= 1 and (len(open_) == 0 or open_[0] == held)
        total += out
    assert np.abs(total / 3000 / size - 0.3).max() < 0.06


def test_one_id_in_most_rows(spark, monkeypatch):
    """Rows that look alike are dealt to many buckets; reruns agree however the
    input is dealt."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    monkeypatch.setattr(mixing, "ALIKE", 300)
    rows = [(1 if k % 3 else None, "w w w", "a") for k in range(2_000)] + [(k, "v " * (k % 9), "b") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one, two = (sorted(mixing.mix(df.repartition(n)).collect(), key=str) for n in (1, 5))
    check(rows, one)
    assert one == two
