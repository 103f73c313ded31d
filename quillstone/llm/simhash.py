"""SimHash near-dedup by a binary trie self-join.

A fingerprint bit is 1 if it is set in over half of the XXH64 values of the
text's word shingles.  Distinct fingerprints meet in binary tries: pairs of
nodes are walked together, differing bits add up along the way, and a pair is
pruned once they exceed the error budget.

Distribution.  The 64 bits are cut into radius + agree blocks, so that two
fingerprints within the radius agree on ``agree`` blocks at least.  For each
choice of that many blocks there is a trie whose levels begin with them; its
topmost levels, where the two nodes must agree, deal the trie's subtrees out to
tasks, and each task walks the subtrees it holds, all of them at once, in
numpy.  A pair that agrees on an earlier choice too is left to that trie.  A
subtree of more than ``SUBTREE`` fingerprints is dealt into equal parts by a
hash; every part, and every pair of parts, is walked by a task of its own.
``agree`` is 1, and 2 where one block would give subtrees of more than
``TWO_BLOCKS`` fingerprints on average; the links are the same.

Each task reports a spanning forest of the links it finds, never all pairs, so
groups of copies cost as many rows as they have members.  Components of the
forests are found by hooking and pointer jumping in DataFrames.

Defined results: null and empty texts and those without words have fingerprint
zero; a text of fewer words than a shingle is one shingle; very long texts are
hashed piece by piece; copies share a fingerprint and are joined once; an
empty table gives an empty result; other columns pass by.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from .common import alone, bucketed, collect_garbage, column, drop, materialize, others

SHINGLE = 4
RADIUS = 4
SEED = 42
SUBTREE = 8_192
TWO_BLOCKS = 4_096  # fingerprints to a subtree
PIECE = 1 << 18
#: Pairs of nodes in one step of the walk, and leaves below which a pair of nodes is compared at once.
FRONT = 1 << 17
LEAF = 8


def simhash(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit fingerprint of a text, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, n, PIECE):
        some = words[lo : lo + PIECE + shingle - 1]
        joined = b" ".join(some)
        ends = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        k = min(n - lo, PIECE)
        to = ends[min(shingle, len(some)) - 1 :]
        h = np.fromiter([digest(joined[a:b], seed) for a, b in zip(starts[:k].tolist(), to[:k].tolist())], np.uint64, k)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > n, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", seeds: tuple[int, ...] = (SEED,), shingle: int = SHINGLE) -> DataFrame:
    """All other columns, and ``fp``, ``fp1`` ... : signed 64-bit fingerprints,
    one for each seed."""
    names = ["fp", *(f"fp{k}" for k in range(1, len(seeds)))]
    keep = others(docs, text, *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [[simhash(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle, s) for s in seeds] for t in column(b, "_text")]
            marks = np.array(made, np.uint64).reshape(len(b), len(seeds)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array(marks[:, k]) for k in range(len(seeds)))], names=[*(f"k{k}" for k in range(len(keep))), *names])

    given = docs.select(*[F.col(c).alias(f"k{k}") for k, c in enumerate(keep)], F.col(text).alias("_text"))
    schema = given.drop("_text").schema
    for name in names:
        schema = schema.add(name, "long")
    return given.mapInArrow(run, schema).toDF(*keep, *names)


Choice = tuple[tuple[int, int], ...]  # blocks: (lowest bit, bits)


def choices(radius: int, agree: int) -> list[Choice]:
    """The choices of ``agree`` of radius + agree blocks, from the top."""
    n = radius + agree
    edges = [round(64 * k / n) for k in range(n + 1)]
    return list(itertools.combinations([(64 - b, b - a) for a, b in zip(edges, edges[1:])], agree))


def rotate(fp: np.ndarray, choice: Choice) -> np.ndarray:
    """The trie order of a choice: its blocks first, the other bits behind."""
    chosen = [bit for low, wide in choice for bit in range(low + wide - 1, low - 1, -1)]
    runs, key, at = [], np.zeros_like(fp), 64
    for bit in [*chosen, *(b for b in range(63, -1, -1) if b not in chosen)]:
        if runs and runs[-1][0] == bit + 1:
            runs[-1][0], runs[-1][1] = bit, runs[-1][1] + 1
        else:
            runs.append([bit, 1])
    for low, wide in runs:
        at -= wide
        key |= (fp >> np.uint64(low) & np.uint64((1 << wide) - 1)) << np.uint64(at)
    return key


class Forest:
    """Spanning forest of links, given in batches of (a, b)."""

    def __init__(self, n: int):
        self.root, self.edges = np.arange(n), []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            if not len(a):
                return
            # Each root takes its least neighbour; the others wait for the next turn.
            hi, lo = np.maximum(ra, rb), np.minimum(ra, rb)
            order = np.lexsort((lo, hi))
            first = order[np.concatenate([[True], hi[order][1:] != hi[order][:-1]])]
            self.root[hi[first]] = lo[first]
            self.edges.append((a[first], b[first]))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The links that joined two trees."""
        if not self.edges:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = zip(*self.edges)
        return np.concatenate(a), np.concatenate(b)


def walk(keys: np.ndarray, left: np.ndarray, right: np.ndarray, depth: int, radius: int, report) -> None:
    """Walks pairs of trie nodes over sorted ``keys``.

    ``left`` and ``right``: (lo, hi) ranges, nodes of ``depth`` leading levels
    (equal ranges: a node with itself).  ``report(a, b)`` gets the index pairs
    a < b whose keys differ in at most ``radius`` bits."""
    ones: dict[int, np.ndarray] = {}  # per level: set bits before each index

    def split(level: int, node: np.ndarray) -> np.ndarray:
        if level not in ones:
            ones[level] = np.concatenate([[0], np.cumsum((keys >> np.uint64(63 - level)) & np.uint64(1), dtype=np.int64)])
        return node[:, 1] - (ones[level][node[:, 1]] - ones[level][node[:, 0]])

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        na, nb = a[:, 1] - a[:, 0], b[:, 1] - b[:, 0]
        total = na * nb
        at = 0
        ends = np.cumsum(total)
        while at < len(total):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 4 * FRONT, side="right")))
            t = total[at:to]
            k = np.arange(int(t.sum())) - np.repeat(np.cumsum(t) - t, t)
            wide = np.repeat(nb[at:to], t)
            i, j = np.repeat(a[at:to, 0], t) + k // wide, np.repeat(b[at:to, 0], t) + k % wide
            good = i < j
            i, j = i[good], j[good]
            near = np.bitwise_count(keys[i] ^ keys[j]) <= radius
            if near.any():
                report(i[near], j[near])
            at = to

    stack = [(depth, left, right, np.zeros(len(left), np.int64))]
    while stack:
        level, a, b, errors = stack.pop()
        if len(a) > FRONT:
            stack.append((level, a[FRONT:], b[FRONT:], errors[FRONT:]))
            a, b, errors = a[:FRONT], b[:FRONT], errors[:FRONT]
        na, nb = a[:, 1] - a[:, 0], b[:, 1] - b[:, 0]
        leaf = (na * nb <= LEAF * LEAF) | (level >= 64)
        if leaf.any():
            compare(a[leaf], b[leaf])
            a, b, errors = a[~leaf], b[~leaf], errors[~leaf]
        if not len(a):
            continue
        ma, mb = split(level, a), split(level, b)
        a0, a1 = np.stack([a[:, 0], ma], 1), np.stack([ma, a[:, 1]], 1)
        b0, b1 = np.stack([b[:, 0], mb], 1), np.stack([mb, b[:, 1]], 1)
        own = (a == b).all(1)
        cross = errors < radius
        parts = [(a0, b0, errors, slice(None)), (a1, b1, errors, slice(None)), (a0, b1, errors + 1, cross), (a1, b0, errors + 1, cross & ~own)]
        na = np.concatenate([x[s] for x, _, _, s in parts])
        nb = np.concatenate([y[s] for _, y, _, s in parts])
        ne = np.concatenate([e[s] for _, _, e, s in parts])
        some = (na[:, 0] < na[:, 1]) & (nb[:, 0] < nb[:, 1])
        single = (na == nb).all(1) & (na[:, 1] - na[:, 0] == 1)
        some &= ~single
        if some.any():
            stack.append((level + 1, na[some], nb[some], ne[some]))


def _same_earlier(a: np.ndarray, b: np.ndarray, earlier: list[Choice]) -> np.ndarray:
    x, same = a ^ b, np.zeros(len(a), bool)
    for choice in earlier:
        mask = sum(((1 << wide) - 1) << low for low, wide in choice)
        same |= (x & np.uint64(mask)) == 0
    return same


def links(prints: DataFrame, radius: int = RADIUS, agree: int | None = None, ident: str = "fp", extra: tuple[str, ...] = (), cost=None) -> DataFrame:
    """(a, b): idents of a forest with the same components as all links between
    the distinct fingerprints ``fp`` of ``prints`` within ``radius`` bits.

    ``cost(rows_a, rows_b)``, of the long columns ``extra``, puts links in
    order, cheapest first, and refuses those of infinite cost."""
    extra = tuple(dict.fromkeys([*extra, ident]))
    extra = tuple(c for c in extra if c != "fp")
    cols = ["fp", *extra]
    distinct = materialize(prints.select(*cols).where("fp is not null").distinct())
    table = choices(radius, agree or (1 if distinct.count() < TWO_BLOCKS << (64 // (radius + 1)) else 2))
    part = "shiftleft(shiftrightunsigned(fp, {}) & {}, {})"
    keys = [F.expr(" | ".join(part.format(low, (1 << wide) - 1, sum(w for _, w in choice[k + 1 :])) for k, (low, wide) in enumerate(choice))) for choice in table]
    dealt = distinct.select(*cols, F.posexplode(F.array(*keys)).alias("trie", "subtree"))
    counts = materialize(dealt.groupBy("trie", "subtree").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    # Fingerprints alone in a subtree have no partner there.
    dealt = dealt.join(counts.withColumn("cuts", F.ceil(F.col("n") / SUBTREE).cast("int")), ["trie", "subtree"])
    small = dealt.where("cuts = 1").select(*cols, "trie", "subtree", F.lit(0).alias("pair"), F.lit(0).alias("side"))
    rank = F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int")
    parts = dealt.where("cuts > 1").withColumn("range", rank)
    parts = parts.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    lo, hi = F.least("range", "with"), F.greatest("range", "with")
    parts = parts.select(*cols, "trie", "subtree", (lo * F.col("cuts") + hi + 1).alias("pair"), F.when(F.col("range") == F.col("with"), 2).when(F.col("range") < F.col("with"), 0).otherwise(1).alias("side"))
    rows = small.unionByName(parts).repartition("trie", "subtree", "pair").sortWithinPartitions("trie", "subtree", "pair")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone(__name__)
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            held.append(b)
            size += len(b)
            if size >= 200_000:
                t = pa.Table.from_batches(held).combine_chunks()
                last = t.slice(len(t) - 1)
                same = np.ones(len(t), bool)
                for c in ("trie", "subtree", "pair"):
                    same &= t[c].to_numpy() == last[c][0].as_py()
                cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
                if cut:
                    yield from solve(t.slice(0, cut))
                    rest = t.slice(cut)
                    held, size = rest.to_batches(), len(rest)
        if held:
            yield from solve(pa.Table.from_batches(held))

    def solve(t: pa.Table) -> Iterator[pa.RecordBatch]:
        fp = t["fp"].to_numpy().astype(np.uint64)
        trie, subtree, pair, side = (t[c].to_numpy().astype(np.int64) for c in ("trie", "subtree", "pair", "side"))
        more = {c: t[c].to_numpy() for c in extra}
        for k, choice in enumerate(table):
            rows = np.flatnonzero(trie == k)
            if not len(rows):
                continue
            key = rotate(fp[rows], choice)
            group = np.unique(np.stack([subtree[rows], pair[rows]], 1), axis=0, return_inverse=True)[1].ravel()
            order = np.lexsort((key, side[rows] % 2, group))
            rows, key, group = rows[order], key[order], group[order]
            sides = side[rows]
            bound = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (sides[1:] != sides[:-1]), [True]]))
            nodes = np.stack([bound[:-1], bound[1:]], 1)
            kind = sides[nodes[:, 0]]
            alone = pair[rows[nodes[:, 0]]] == 0
            inner = nodes[alone | (kind == 2)]
            first = np.flatnonzero((kind == 0) & ~alone)
            first = first[(first + 1 < len(nodes))]
            first = first[(kind[np.minimum(first + 1, len(nodes) - 1)] == 1) & (group[nodes[first, 0]] == group[nodes[np.minimum(first + 1, len(nodes) - 1), 0]])]
            left = np.concatenate([inner, nodes[first]])
            right = np.concatenate([inner, nodes[first + 1]])
            forest, own = Forest(len(rows)), fp[rows]
            priced: list = []
            name = own.astype(np.int64) if ident == "fp" else more[ident][rows]

            def report(a, b, forest=forest, own=own, rows=rows, k=k):
                new = ~_same_earlier(own[a], own[b], table[:k])
                a, b = a[new], b[new]
                if cost is None:
                    forest.add(a, b)
                    return
                price = cost({c: v[rows[a]] for c, v in more.items()}, {c: v[rows[b]] for c, v in more.items()})
                priced.append((price[np.isfinite(price)], a[np.isfinite(price)], b[np.isfinite(price)]))
                if sum(len(x[0]) for x in priced) > 8 * FRONT:
                    settle()

            def settle(forest=forest, priced=priced):
                # Of the dearer links only a forest is kept, to meet the cheaper
                # ones of later batches.
                price, a, b = (np.concatenate(x) for x in zip(*priced))
                fresh = Forest(len(forest.root))
                for limit in np.unique(price):
                    fresh.add(a[price == limit], b[price == limit])
                a, b = fresh.links()
                prices = cost({c: v[rows[a]] for c, v in more.items()}, {c: v[rows[b]] for c, v in more.items()})
                priced[:] = [(prices, a, b)]
                forest.root, forest.edges = fresh.root, fresh.edges

            walk(key, left, right, sum(w for _, w in choice), radius, report)
            if priced:
                settle()
            a, b = forest.links()
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(name[a]), pa.array(name[b])], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): the least node of its
    component, by hooking and pointer jumping; each round is a table in the
    shared folder."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = materialize(edges)
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    hook = edges.groupBy("a").agg(F.min("b").alias("b"))
    root = nodes.join(hook, F.col("node") == F.col("a"), "left").select("node", F.coalesce("b", "node").alias("root"))
    root = materialize(root)
    while True:
        # Pointer jumping until every node points at a root.
        while True:
            up = root.select(F.col("node").alias("root"), F.col("root").alias("up"))
            jumped = materialize(root.join(up, "root").select("node", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved")))
            moved = jumped.where("moved").limit(1).count()
            root = jumped.drop("moved")
            if not moved:
                break
        # Edges between different roots hook the larger root to the least smaller one.
        a = root.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = root.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        open_ = edges.join(a, "a").join(b, "b").where("ra <> rb").select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct()
        edges = materialize(open_)
        if not edges.limit(1).count():
            return root
        hook = edges.groupBy("a").agg(F.min("b").alias("to"))
        root = materialize(root.join(hook, F.col("node") == F.col("a"), "left").select("node", F.coalesce("to", "root").alias("root")))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint, component_id of every document: the least doc_id
    reachable over links of ``radius`` bits, itself included."""
    prints = materialize(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), shingle=shingle))
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    root = components(links(least, radius))
    # Tables of their own, so that Spark can split the root of a large component.
    rooted = materialize(least.join(root, least.fp == root.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    best = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    classes = materialize(rooted.join(best, "root").select("fp", "component_id"))
    return prints.join(classes, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


#: The near-duplicate stage: word fingerprints, prefixes of shingles, Jaccard.
WORD_SEEDS = 4
WORD_BITS = 40
WORD_RADIUS = 5
SIMILARITY = 0.8
STAGE_SHINGLE = 5
SKETCH = 512  # bits
#: Texts whose shingles are counted, and the most of them that count as common.
SAMPLE = 10_000
COMMON = 100_000
#: Texts of a shingle that are compared without their sketches, and the most
#: that are compared at once; partners that a text of a more common shingle
#: tries in the first turn and in the second.
FEW = 8
PART = 2_048
TURNS = (32, 512)


def word_simhash(words: list[bytes]) -> np.ndarray:
    """WORD_SEEDS fingerprints of a text's words; a word weighs 1 + log2 of its
    count.  An edit changes one word of many, but five 5-word shingles."""
    counts = Counter(words)
    if not counts:
        return np.zeros(WORD_SEEDS, np.int64)
    votes, total = np.zeros(64 * WORD_SEEDS, np.float32), 0.0
    items = list(counts.items())
    for lo in range(0, len(items), 50_000):
        some = items[lo : lo + 50_000]
        raw = b"".join([xxhash.xxh3_128_digest(w, k) for w, _ in some for k in range(WORD_SEEDS // 2)])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(len(some), -1), axis=1)
        n = np.fromiter((c for _, c in some), np.float32, len(some))
        once = n == 1
        weight = 1 + np.log2(n[~once])
        votes += bits[once].sum(axis=0, dtype=np.int32) + weight @ bits[~once].astype(np.float32)
        total += float(once.sum() + weight.sum())
    return np.packbits(votes * 2 > total).view(">i8").astype(np.int64)


def shingle_hashes(words: list[bytes], shingle: int = STAGE_SHINGLE) -> np.ndarray:
    """Distinct hashes of the word shingles; of fewer words, of them all."""
    n = max(1, len(words) - shingle + 1)
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(b" ".join(words[i : i + shingle])) for i in range(n)), np.uint64, n)).astype(np.int64)


def sketch(shingles: np.ndarray, bits: int = SKETCH) -> np.ndarray:
    """Parities of the shingles in each of so many buckets, a power of two; two
    sets differ in at least as many elements as parities."""
    odd = np.bincount(shingles & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def differing(a: np.ndarray, b: np.ndarray) -> int:
    """Parities that differ, the longer sketch folded to the shorter."""
    while len(a) != len(b):
        if len(a) < len(b):
            a, b = b, a
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count((a ^ b).view(np.uint64)).sum())


def prefix(shingles: np.ndarray, common: np.ndarray, rank: np.ndarray, similarity: float) -> tuple[np.ndarray, int]:
    """The first shingles of a set, and how many are not common; these come in
    the order of their hashes, common ones last.

    A set of n has at most s = (1 - similarity) n elements that a similar set
    lacks, so their least common element is one of the first s + 1 of both.  By
    hash the first k of r others all lack with a probability of at most
    (s / r)^k; as many as bring that below 2^-64, a hash collision, are enough."""
    n = len(shingles)
    most = n - int(np.ceil(similarity * n - 1e-9))
    where = np.minimum(np.searchsorted(common, shingles), max(0, len(common) - 1))
    order = np.where(common[where] == shingles, rank[where] + 1, 0) if len(common) else np.zeros(n, np.int64)
    others = int((order == 0).sum())
    size = most + 1
    if others > most > 0:
        size = min(size, int(np.ceil(64 / np.log2(others / most))))
    first = np.lexsort((shingles, order))[:size]
    return shingles[first], min(size, others)


def _words(text: pa.Scalar) -> list[bytes]:
    return (text.as_buffer().to_pybytes() if text.is_valid else b"").lower().split()


def _per_text(df: DataFrame, columns: str, of) -> DataFrame:
    """``of(words)`` of each row's text, as columns behind all others."""
    names = [c for c in df.columns if c != "text"]
    added = [f.split() for f in columns.split(", ")]
    kinds = {"long": pa.int64(), "array<long>": pa.list_(pa.int64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone(__name__)
        for b in batches:
            for i in range(0, len(b), 500):
                part = b.slice(i, 500)
                made = [of(_words(t)) for t in column(part, "_text")]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *(pa.array(x, kinds[t]) for x, (_, t) in zip(zip(*made), added))], names=[*(f"k{k}" for k in range(len(names))), *(n for n, _ in added)])

    given = df.select(*[F.col(c).alias(f"k{k}") for k, c in enumerate(names)], F.col("text").alias("_text"))
    schema = given.drop("_text").schema
    for name, kind in added:
        schema = schema.add(name, ArrayType(LongType()) if kind != "long" else LongType())
    return given.mapInArrow(run, schema).toDF(*names, *(n for n, _ in added))


def common_shingles(texts: DataFrame) -> np.ndarray:
    """Shingles that several of about SAMPLE texts share, rarest first.  They
    only set the order of the prefixes: any order gives the same links."""
    every = max(1, texts.count() // SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in column(b, "text"):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_hashes(_words(t)))], names=["token"])

    some = texts.where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0).select("text").mapInArrow(run, "token long")
    n = some.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 2")
    top = n.orderBy(F.col("n").desc(), "token").limit(COMMON).collect()
    return np.array([r["token"] for r in reversed(top)], np.int64)


def marked(texts: DataFrame) -> DataFrame:
    """What the stage keeps of each text (key, text): the word fingerprints f0
    to f3, n shingles, their sketch of n bits or more and one of SKETCH."""

    def of(words: list[bytes]) -> tuple:
        h = shingle_hashes(words)
        return *word_simhash(words).tolist(), len(h), sketch(h, max(SKETCH, 1 << (len(h) - 1).bit_length())), sketch(h)

    return materialize(_per_text(texts, "f0 long, f1 long, f2 long, f3 long, n long, sketch array<long>, small array<long>", of))


def word_links(marks: DataFrame) -> DataFrame:
    """(a, b) keys of candidate links between distinct texts, quick to find
    where single words were edited.

    Candidates differ in at most WORD_RADIUS bits of one of four word
    fingerprints and in at most WORD_BITS of all 256; each trie task keeps a
    minimum spanning forest of them, so near copies by the thousand cost no
    pairs."""
    names = [f"f{k}" for k in range(WORD_SEEDS)]
    prints = marks.select("key", *names)
    # Texts with the same fingerprints (reordered words) go with one of them.
    groups = materialize(prints.groupBy(*names).agg(F.min("key").alias("ident")))
    same = prints.join(groups, names).where("key <> ident").select(F.col("key").alias("a"), F.col("ident").alias("b"))

    def cost(a: dict, b: dict) -> np.ndarray:
        bits = sum(np.bitwise_count((a[n] ^ b[n]).astype(np.uint64)).astype(float) for n in names)
        return np.where(bits <= WORD_BITS, bits, np.inf)

    found = same
    for n in names:
        found = found.unionByName(links(groups.withColumn("fp", F.col(n)), WORD_RADIUS, ident="ident", extra=tuple(names), cost=cost))
    return found


def verified(texts: DataFrame, marks: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of ``found`` whose shingle sets are that similar; the
    sets of pairs whose sketches differ too much are not compared."""
    found = materialize(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    ka = marks.select(F.col("key").alias("a"), F.col("sketch").alias("ka"), F.col("n").alias("na"))
    kb = marks.select(F.col("key").alias("b"), F.col("sketch").alias("kb"), F.col("n").alias("nb"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            both = column(t, "na").to_numpy() + column(t, "nb").to_numpy()
            bits = np.fromiter((differing(np.array(x.values), np.array(y.values)) for x, y in zip(column(t, "ka"), column(t, "kb"))), np.int64, len(t))
            yield t.select(["a", "b"]).filter(pa.array(bits <= (1 - similarity) / (1 + similarity) * both + 1e-6))

    found = materialize(found.join(ka, "a").join(kb, "b").select("a", "b", "ka", "kb", "na", "nb").mapInArrow(close, "a long, b long"))
    involved = found.select(F.col("a").alias("key")).unionByName(found.select(F.col("b").alias("key"))).distinct()
    sets = materialize(_per_text(texts.join(involved, "key"), "shingles array<long>", lambda words: (shingle_hashes(words),)))
    sa = sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa"))
    sb = sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb"))
    both = found.join(sa, "a").join(sb, "b").withColumn("common", F.size(F.array_intersect("sa", "sb")))
    out = materialize(both.where(F.col("common") >= similarity * (F.size("sa") + F.size("sb") - F.col("common"))).select("a", "b"))
    drop(sets)
    return out


def _rooted(rows: DataFrame, root: DataFrame, key: str = "key", name: str = "root") -> DataFrame:
    root = root.select(F.col("node").alias(key), F.col("root").alias(name))
    return rows.join(root, key, "left").withColumn(name, F.coalesce(name, key))


def _draw(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number in [0, 1) for each pair of keys a < b, the same in every task."""
    h = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ b.astype(np.uint64)
    for odd in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ h >> np.uint64(33)) * np.uint64(odd)
    return (h >> np.uint64(11)) / float(1 << 53)


def _enough(size_a: np.ndarray, at_a: np.ndarray, size_b: np.ndarray, at_b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether two sets can be that similar by their sizes, and by what is left
    of them from a common shingle on."""
    both = similarity / (1 + similarity) * (size_a + size_b) - 1e-6
    return (np.minimum(size_a, size_b) >= both) & (np.minimum(size_a - at_a, size_b - at_b) >= both)


def shared_prefixes(texts: DataFrame, root: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(a, b) of texts of different components that share a prefix shingle of
    at most FEW texts and can be that similar by size and place; and
    (token, key, place) of the common shingles, those of more texts.

    place is the size of the set << 32, plus the position of the shingle; its
    bit 31 marks the shingles that ``common_shingles`` names."""
    listed = common_shingles(texts)
    common, rank = np.sort(listed), np.argsort(listed)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone(__name__)
        for b in batches:
            for lo in range(0, len(b), 500):
                part, made = b.slice(lo, 500), []
                for key, own, t in zip(column(part, "key").to_numpy(), column(part, "root").to_numpy(), column(part, "text")):
                    h = shingle_hashes(_words(t))
                    token, rare = prefix(h, common, rank, similarity)
                    at = np.arange(len(token))
                    made.append((token, np.full(len(token), key), (len(h) << 32) + at + ((at >= rare) << 31), np.full(len(token), own)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*made)], names=["token", "key", "place", "root"])

    def pairs(t: pa.Table, again: int | None) -> Iterator[pa.RecordBatch]:
        """``again``: a shingle of more than FEW texts that goes on in t."""
        token, key, place, own = (t[c].to_numpy() for c in ("token", "key", "place", "root"))
        n = np.unique(token, return_inverse=True, return_counts=True)
        many = (n[2][n[1]] > FEW) | (place >> 31 & 1 > 0)
        if again is not None:
            many |= token == again
        if many.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[many]) for x in (token, key, place & ~(1 << 31))], names=["token", "a", "b"])
        token, key, place, own = (x[~many] for x in (token, key, place, own))
        size, at = place >> 32, place & ((1 << 31) - 1)
        for step in range(1, FEW):
            i = np.flatnonzero(token[step:] == token[:-step])
            if not len(i):
                break
            j = i + step
            good = (own[i] != own[j]) & _enough(size[i], at[i], size[j], at[j], similarity)
            found = np.unique(np.stack([np.minimum(key[i], key[j]), np.maximum(key[i], key[j])], 1)[good], axis=0)
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.nulls(len(found), pa.int64()), pa.array(found[:, 0]), pa.array(found[:, 1])], names=["token", "a", "b"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, again = None, None
        for b in itertools.chain(batches, [None]):
            t = [x for x in (held, b) if x is not None and len(x)]
            if not t:
                continue
            t = pa.Table.from_batches(t).combine_chunks()
            token = t["token"].to_numpy()
            cut = len(t) if b is None else int(np.searchsorted(token, token[-1]))
            if len(t) - cut > FEW:  # the last shingle's rows go on as they come
                cut, last = len(t), int(token[-1])
            else:
                last = again
            yield from pairs(t.slice(0, cut), again)
            held, again = t.slice(cut).to_batches()[0] if cut < len(t) else None, last

    rows = _rooted(texts, root).select("key", "root", "text").mapInArrow(prefixes, "token long, key long, place long, root long")
    # Named ones are dealt out by text, the others meet their likes.
    salt = F.when(F.expr("place & 2147483648L") != 0, F.col("key")).otherwise(F.lit(0))
    out = materialize(rows.repartition("token", salt).sortWithinPartitions("token").mapInArrow(meet, "token long, a long, b long"))
    return out.where("token is null").select("a", "b"), out.where("token is not null").select("token", F.col("a").alias("key"), F.col("b").alias("place"))


def common_pairs(shared: DataFrame, marks: DataFrame, root: DataFrame, similarity: float, tried: float = 0, tries: float = float("inf")) -> DataFrame | None:
    """(a, b) of texts of different components that share a common prefix
    shingle and can be that similar by size, place and their sketches; None
    where no shingle has texts of different components any more.

    Of the pairs of a shingle that n texts have, those drawn from ``tried`` / n
    to ``tries`` / n.  A shingle of more than PART texts is dealt into parts by
    a hash; every part, and every pair of parts, is a group of its own."""
    rows = materialize(_rooted(shared, root))
    live = rows.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n"))
    live = materialize(live.where((F.col("lo") != F.col("hi")) & (F.col("n") > tried)).select("token", F.col("n").alias("texts"), F.ceil(F.col("n") / PART).cast("int").alias("cuts")))
    if not live.limit(1).count():
        return None
    rows = materialize(rows.join(live, "token").join(marks.select("key", "small"), "key"))
    parts = rows.withColumn("range", F.pmod(F.xxhash64("key"), F.col("cuts")).cast("int"))
    parts = parts.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    lo, hi = F.least("range", "with"), F.greatest("range", "with")
    parts = parts.select("token", "key", "place", "root", "texts", "small", (lo * F.col("cuts") + hi + 1).alias("pair"), F.when(F.col("range") == F.col("with"), 2).when(F.col("range") < F.col("with"), 0).otherwise(1).alias("side"))

    def solve(t: pa.Table) -> Iterator[pa.RecordBatch]:
        marks = np.asarray(t["small"].combine_chunks().flatten()).view(np.uint64).reshape(len(t), SKETCH // 64)
        token, key, place, own, texts, pair, side = (t[c].to_numpy().astype(np.int64) for c in ("token", "key", "place", "root", "texts", "pair", "side"))
        group = np.concatenate([[0], np.cumsum((token[1:] != token[:-1]) | (pair[1:] != pair[:-1]))])
        # Larger sets of the same group, as far as their size allows.
        size, at_place = place >> 32, place & 0xFFFFFFFF
        most = np.minimum(np.floor(size / similarity + 1e-6).astype(np.int64), (1 << 31) - 1)
        n = np.searchsorted((group << 31) + size, (group << 31) + most, side="right") - np.arange(len(group)) - 1
        ends = np.cumsum(n)
        at = 0
        while at < len(n):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + FRONT // 4, side="right")))
            some = n[at:to]
            i = np.repeat(np.arange(at, to), some)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(some) - some, some)
            at = to
            good = (own[i] != own[j]) & ((side[i] == 2) | (side[i] != side[j]))
            i, j = i[good], j[good]
            good = _enough(size[i], at_place[i], size[j], at_place[j], similarity)
            i, j = i[good], j[good]
            good = np.bitwise_count(marks[i] ^ marks[j]).sum(axis=1) <= (1 - similarity) / (1 + similarity) * (size[i] + size[j]) + 1e-6
            i, j = i[good], j[good]
            a, b = np.minimum(key[i], key[j]), np.maximum(key[i], key[j])
            draw = _draw(a, b) * texts[i]
            drawn = draw >= tried
            if np.isfinite(tries):
                drawn &= draw < tries
            pairs = np.unique(np.stack([a[drawn], b[drawn]], 1), axis=0)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in itertools.chain(batches, [None]):
            t = [x for x in (held, b) if x is not None and len(x)]
            if not t:
                continue
            t = pa.Table.from_batches(t).combine_chunks()
            token, pair = t["token"].to_numpy(), t["pair"].to_numpy()
            other = np.flatnonzero((token != token[-1]) | (pair != pair[-1]))
            cut = len(t) if b is None else int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield from solve(t.slice(0, cut))
            held = t.slice(cut).to_batches()[0] if cut < len(t) else None

    rows = parts.repartition("token", "pair").sortWithinPartitions("token", "pair", "place")
    return materialize(rows.mapInArrow(run, "a long, b long").distinct())


def similar_texts(texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b) keys of links between distinct texts (key, text): the components
    are those of all pairs whose 5-word shingle sets have at least that Jaccard
    similarity.

    Word fingerprints find most links, and quickly.  All others come from the
    prefixes: sets of that similarity share one of the first shingles, in an
    order that all texts follow, whatever the edit.  Only pairs of different
    components are compared, in three turns: of a shingle that many texts share
    each text tries about as many others as TURNS says, then all that the turns
    before have not joined with it."""
    marks = marked(texts)
    linked = verified(texts, marks, word_links(marks), similarity)
    collect_garbage(texts.sparkSession)
    root = components(linked)
    pairs, shared = shared_prefixes(texts, root, similarity)
    bounds = [0.0, *map(float, TURNS), float("inf")]
    for tried, tries in zip(bounds, bounds[1:]):
        more = common_pairs(shared, marks, root, similarity, tried, tries)
        if more is not None:
            pairs = pairs.unionByName(more) if tried == 0 else more
        elif tried:
            break
        linked = materialize(linked.unionByName(verified(texts, marks, pairs, similarity)))
        root = components(linked)
    drop(marks, shared)
    return linked


def distinct_texts(docs: DataFrame, number=F.xxhash64) -> DataFrame:
    """(_key, _row): a 64-bit name of each distinct text, and the row of the
    least doc_id that has it.

    Copies meet in a partial aggregate, by ``number`` of the text; where texts
    of another SHA-256 have the same number, each of them but one is named
    anew, so different texts never pass for copies."""
    text = F.coalesce(F.col("text"), F.lit(""))
    ident = F.col("doc_id").cast("long")
    given = docs.select(number(text).alias("_key"), F.sha2(text, 256).alias("_sha"), F.struct(*docs.columns).alias("_row"), ident.isNull().alias("_none"), ident.alias("_id"))
    row = F.min_by("_row", F.struct("_sha", "_none", "_id")).alias("_row")
    texts = bucketed(given.groupBy("_key").agg(row, F.min("_sha").alias("_least"), F.max("_sha").alias("_most")), "_key")
    clashes = texts.where("_least <> _most").select(F.col("_key").alias("_clash"), "_least")
    texts = texts.select("_key", "_row")
    if not clashes.limit(1).count():
        return texts
    more = given.join(clashes, (F.col("_key") == F.col("_clash")) & (F.col("_sha") != F.col("_least")))
    more = more.groupBy(F.xxhash64("_sha", "_key").alias("_key")).agg(row)
    return materialize(texts.unionByName(more))


def unique_documents(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document, of the least doc_id, of each group of exact
    and near copies; columns and other rows as they are.

    The texts are shuffled once.  That shuffle is a partial aggregate, which
    leaves one row for each distinct text, so copies don't meet in one task;
    the later steps look texts up in the bucketed table that it fills."""
    texts = distinct_texts(docs)
    plain = texts.select(F.col("_key").alias("key"), F.col("_row.text").alias("text"))
    root = components(similar_texts(plain, similarity))
    own = F.col("_row.doc_id").cast("long")
    ids = texts.select("_key", F.struct(own.isNull().alias("none"), own.alias("doc_id"), F.col("_key")).alias("order"))
    rooted = ids.join(root, ids._key == root.node, "left").select(F.coalesce("root", "_key").alias("root"), "order")
    kept = materialize(rooted.groupBy("root").agg(F.min("order").alias("order")).select(F.col("order._key").alias("_kept")))
    return texts.join(kept, texts._key == kept._kept, "left_semi").select("_row.*")
