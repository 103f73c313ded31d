import hashlib
import random

import xxhash

from quillstone.llm import fingerprints as fp
from quillstone.llm import queries


def check(rows, got):
    number = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) ^ 1 << 63) - (1 << 63)
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), number(r[1]), r[1]))
    want = {}
    for k, (d, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        e = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        want.setdefault(d, []).append((len(t), hashlib.sha256(e.encode()).hexdigest(), fp.fingerprint(t), fp.fingerprint(e), fp.likeness(fp.fingerprint(t), fp.fingerprint(e)), fp.likeness(fp.fingerprint(t), fp.fingerprint(nxt))))
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append(tuple(r[1:7]))
    assert {d: sorted(v) for d, v in have.items()} == {d: sorted(v) for d, v in want.items()}


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op2_document_fingerprints(spark, sf_dir).collect()
    check(rows, got)
    # Half of a text is left in its edit, nothing in the next document.
    assert sum(r.near_edited > r.near_next for r in got) > 0.9 * len(got)
    marks = {int(r.fingerprint, 16) for r in got}
    for r in got:
        own = int(r.fingerprint, 16)
        asked = any(int(x.fingerprint, 16) == own for x in got if x.doc_id % 100 == 0)
        assert r.n_near == (sum(0 < (own ^ m).bit_count() <= fp.RADIUS for m in marks) if asked else None)


def test_edge_cases(spark):
    rows = [(1, None), (5, ""), (5, "b c"), (5, "b c"), (None, "null id"), (None, None), (-3, "wort " * 30_000), (9, "x")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "doc_id long, text string, stretch string")
    check(rows, fp.fingerprint_edits(df).collect())
    check(rows[-1:], fp.fingerprint_edits(df.where("doc_id = 9")).collect())
    assert fp.fingerprint_edits(df.limit(0)).count() == 0
    # One id, and no id, in a third of the rows each, dealt to many tasks.
    rows = [(7 if k % 3 == 0 else None if k % 3 == 1 else k, f"text {k % 50} " * 40) for k in range(400)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = fp.fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string"))
        check(rows, out.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_near_equals_brute_force(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(fp.BITS) for _ in range(30)]
    marks = set()
    for b in base:
        for n in range(0, 10):
            x = b
            for bit in rng.sample(range(fp.BITS), n):
                x ^= 1 << bit
            marks.add(f"{x:0{fp.BITS // 4}x}")
    df = spark.createDataFrame([(m,) for m in marks] + [(None,)], "fingerprint string")
    df = df.unionAll(df.limit(20))
    for radius in (3, 6):
        want = {(a, b, d) for a in marks for b in marks if a != b and (d := (int(a, 16) ^ int(b, 16)).bit_count()) <= radius}
        got = [tuple(r) for r in fp.near(df, df, radius).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_near_texts_of_any_length():
    """Dropping the last word changes little, whatever the length."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9))) for _ in range(2000)]
    for n in [30, 40, 47, 48, 49, 60, 100, 191, 192, 193, 250]:
        got = []
        for _ in range(20):
            w = rng.choices(vocabulary, k=n)
            got.append(fp.likeness(fp.fingerprint(" ".join(w)), fp.fingerprint(" ".join(w[:-1]))))
        assert sum(got) / len(got) > 0.9, (n, got)
