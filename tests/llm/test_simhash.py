import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from quillstone.llm import queries, simhash


def slow_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute(rows, radius=4):
    prints = {}
    for d, t in rows:
        prints.setdefault(slow_fingerprint(t), []).append(d)
    keys = list(prints)
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for k, ds in prints.items():
        least[find(k)] = min([*ds, least.get(find(k), ds[0])])
    return {d: (f"{k:016x}", least[find(k)]) for k, ds in prints.items() for d in ds}


def result(df):
    return {r.doc_id: (r.fingerprint, r.component_id) for r in df.collect()}


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert result(queries.op1_simhash_near_dedup(spark, sf_dir)) == brute(rows)


@settings(max_examples=60, deadline=None)
@given(st.text("aB éÉ\t\n\x0b\x1c\xa0x", max_size=60))
def test_fingerprint(text):
    assert simhash.simhash(text.encode()) == slow_fingerprint(text)


def test_long_texts_in_pieces(monkeypatch):
    text = " ".join(str(i * i % 97) for i in range(5000))
    monkeypatch.setattr(simhash, "PIECE", 300)
    assert simhash.simhash(text.encode()) == slow_fingerprint(text)


def clusters(rng, n=40):
    prints = set()
    for _ in range(n):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 40])):
            prints.add(x)
            for bit in rng.sample(range(64), rng.randrange(0, 7)):
                x ^= 1 << bit
    return list(prints)


def test_walk_finds_every_pair():
    rng = random.Random(2)
    keys = np.sort(np.array(clusters(rng), np.uint64))
    for radius in (0, 1, 4, 7):
        got = set()
        simhash.walk(keys, np.array([[0, len(keys)]]), np.array([[0, len(keys)]]), 0, radius, lambda a, b: got.update(zip(a.tolist(), b.tolist())))
        assert got == {(i, j) for j in range(len(keys)) for i in range(j) if int(keys[i] ^ keys[j]).bit_count() <= radius}


def forest_components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    groups = {}
    for n in nodes:
        groups.setdefault(find(n), set()).add(n)
    return {frozenset(g) for g in groups.values()}


def test_links_with_cut_subtrees(spark, monkeypatch):
    prints = clusters(random.Random(4), 60)
    # A hot subtree: many fingerprints that agree on their first bits.
    rng = random.Random(9)
    prints = list({*prints, *(0xABCD << 48 | rng.getrandbits(10) << 20 for _ in range(300))})
    want = forest_components([(a, b) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= 4], prints)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints] + [(None,)], "fp long")
    for size, agree in ((10_000, 1), (16, 1), (16, 2)):
        monkeypatch.setattr(simhash, "SUBTREE", size)
        got = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(df, agree=agree).collect()]
        assert all((a ^ b).bit_count() for a, b in got)
        assert forest_components(got, prints) == want


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, 300), (300, 250), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in simhash.components(df).collect()}
    assert got == {**{i: 0 for i in range(101)}, 200: 200, 250: 200, 300: 200}


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "a b"), (5, "A  B"), (5, "A  B"), (6, "a b c d e"), (7, "wort " * 300_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fp string")
    assert result(simhash.near_duplicates(df)) == brute(rows)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def shingles(text, n=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))}


def test_unique_documents(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 8))) for _ in range(3000)]
    rows, group, n = [], {}, 0
    for g in range(40):
        base = rng.choices(vocabulary, k=rng.randrange(120, 300))
        for _ in range(rng.choice([1, 1, 2, 6])):
            w = list(base)
            if rng.random() < 0.7:
                for _ in range(max(1, len(w) // 100)):
                    w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((n, " ".join(w)))
            group[n] = g
            n += 1
    rows += [(500, None), (501, ""), (502, "a b"), (502, "a b"), (None, "null id text")]
    texts = dict(rows)
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, key int").repartition(3)
    kept = [r.doc_id for r in simhash.unique_documents(df).collect()]
    assert len(kept) == len(set(kept)) and {500, 502, None} <= set(kept) and 501 not in kept
    plan = simhash.unique_documents(df)._jdf.queryExecution().toString()
    assert "Bucketed" in plan
    # Brute force: components of Jaccard >= 0.8.
    ids = list(group)
    sets = {d: shingles(texts[d]) for d in ids}
    want = forest_components([(a, b) for a in ids for b in ids if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])], ids)
    assert sorted(min(g) for g in want) == sorted(d for d in kept if d in group)
    assert simhash.unique_documents(df.limit(0)).count() == 0


def kept_and_wanted(spark, texts):
    """doc_ids that the stage keeps, and the least of each brute-force component."""
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    sets = [shingles(t) for t in texts]
    pairs = [(a, b) for b in range(len(texts)) for a in range(b) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    return sorted(r.doc_id for r in simhash.unique_documents(df).collect()), sorted(min(g) for g in forest_components(pairs, range(len(texts))))


def made_words(rng, n):
    return ["".join(rng.choices("abcdefghij", k=rng.randrange(3, 9))) for _ in range(n)]


def test_whole_edits(spark):
    """Copies that are cut, extended or short, up to a similarity of 0.8."""
    rng, texts = random.Random(3), []
    for n in [12, 20, 40, 59, 90, 200, 400] * 4:
        w = made_words(rng, n)
        cut, more = w[: round(0.8 * (n - 4)) + 4 + rng.randrange(2)], w + made_words(rng, rng.randrange(n // 4 + 1))
        texts += [" ".join(x) for x in rng.sample([w, cut, more, w[rng.randrange(1, 3) :]], rng.randrange(2, 5))]
    got, want = kept_and_wanted(spark, texts)
    assert got == want


def test_families(spark):
    """Many versions of few texts, and reordered texts, which have the same
    words, with copies of their own."""
    rng, texts = random.Random(5), []
    for _ in range(4):
        base = made_words(rng, 150)
        for _ in range(25):
            w = list(base)
            for k in rng.sample(range(len(w)), rng.randrange(1, 7)):
                w[k] = made_words(rng, 1)[0]
            texts.append(" ".join(w))
    for _ in range(12):
        w = made_words(rng, 100)
        mixed = rng.sample(w, len(w))
        texts += [" ".join(x) for x in (w, mixed, mixed[:-1], w[:-1], [*w, "end"])]
    got, want = kept_and_wanted(spark, texts)
    assert got == want


def test_turns(spark, monkeypatch):
    """Groups in parts, pairs in several turns."""
    monkeypatch.setattr(simhash, "PART", 5)
    monkeypatch.setattr(simhash, "FEW", 2)
    monkeypatch.setattr(simhash, "TURNS", (2, 4))
    monkeypatch.setattr(simhash, "WORD_RADIUS", 1)
    rng = random.Random(6)
    line, texts = made_words(rng, 12), []
    for _ in range(5):
        w = made_words(rng, 60)
        texts += [" ".join([*line, *w[: rng.randrange(30, 61)]]) for _ in range(12)]
    got, want = kept_and_wanted(spark, texts)
    assert got == want


def test_texts_of_one_number_stay_apart(spark):
    rows = [(k, f"text {k % 40}") for k in range(100)] + [(None, "text 3"), (200, None), (201, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.distinct_texts(df, lambda text: F.pmod(F.xxhash64(text), F.lit(7))).collect()
    assert len({r._key for r in got}) == len(got) == 41
    assert sorted(r._row.doc_id for r in got) == [*range(40), 200]
