"""Document fingerprints: SimHash with weighted terms, permuted block tables.

The terms of a text are its word pairs (words lower-cased, ASCII white space
apart), its words and its character triples.  A term weighs 1 + log2 of its
count; words and triples weigh less the longer the text, by a share that falls
evenly from 1 to 0 at ``LONG`` words, so texts of nearly the same length are
always compared on nearly the same weights.  A term's 128 hashed bits vote with
its weight for or against each bit of the fingerprint.  The likeness of two
texts is 1 - differing bits / 128.

``near`` finds all fingerprints within a Hamming radius: with radius + 1 blocks
two such fingerprints agree on one whole block, so a table for each block,
joined on it, misses none; the first block of agreement alone reports a pair.

Defined results: null text is empty; a text without terms has the fingerprint
of zeros; repeated rows give equal rows; rows of equal doc_id are ordered by
the text's hash; very long texts are read whole; the next of a single document
is itself; an empty table gives an empty
result; other columns are not used.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import alone, column, materialize, others, sha256

BITS = 128
LONG = 192
RADIUS = 6


def _share(n_words: int) -> float:
    """What words and character triples weigh in a text of so many words."""
    return max(0.0, 1 - n_words / LONG)


def _terms(words: list[bytes], text: bytes) -> Counter:
    terms = Counter(zip(words, words[1:]))
    if _share(len(words)):
        terms.update(words)
        chars = text.decode("utf-8", "replace")
        terms.update(chars[i : i + 3] for i in range(max(1, len(chars) - 2)) if chars)
    return terms


def _key(term) -> bytes:
    return b"\x00".join(term) if isinstance(term, tuple) else b"w" + term if isinstance(term, bytes) else b"c" + term.encode("utf-8", "replace")


def fingerprint(text: str | None) -> str:
    """128 bits as 32 hex digits."""
    raw = (text or "").encode("utf-8", "replace").lower()
    words = raw.split()
    terms = _terms(words, raw)
    if not terms:
        return "0" * (BITS // 4)
    share = _share(len(words))
    votes, total = np.zeros(BITS, np.float64 if share else np.float32), 0.0
    items = list(terms.items())
    for lo in range(0, len(items), 50_000):
        some = items[lo : lo + 50_000]
        keys = b"".join([xxhash.xxh3_128_digest(_key(t)) for t, _ in some])
        bits = np.unpackbits(np.frombuffer(keys, np.uint8).reshape(-1, BITS // 8), axis=1)
        counts = np.fromiter((c for _, c in some), np.int64, len(some))
        if share:
            weight = (1 + np.log2(counts)) * np.fromiter((1.0 if isinstance(t, tuple) else share for t, _ in some), np.float64, len(some))
            votes += weight @ bits
            total += float(weight.sum())
        elif counts.max() == 1:
            votes += bits.sum(axis=0, dtype=np.int32)
            total += len(some)
        else:
            once = counts == 1
            votes += bits[once].sum(axis=0, dtype=np.int32)
            weight = 1 + np.log2(counts[~once]).astype(np.float32)
            votes += weight @ bits[~once].astype(np.float32)
            total += float(once.sum() + weight.sum())
    return np.packbits(votes * 2 > total).tobytes().hex()


def likeness(a: str, b: str) -> float:
    return 1 - (int(a, 16) ^ int(b, 16)).bit_count() / BITS


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many (or all)
    of the following text."""
    n = len(text) // 2
    return text[: len(text) - n] + following[:n]


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [f.split()[0] for f in _RESULT.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _result(doc_id, text: str, own: str, following: str, mark: str) -> tuple:
    other = edited(text, following)
    there = own if other == text else fingerprint(other)
    return doc_id, len(text), sha256(other.encode("utf-8", "replace")), own, there, likeness(own, there), likeness(own, mark)


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next of every document.

    The texts are dealt once, by ranges of doc_id and of the text's hash, so
    rows of one doc_id, or of none, are dealt to several tasks as well.  A task
    streams its rows in order.  The first and the last row of each task go into
    a table of their own, where the last meets the first of the next task."""
    text = F.coalesce(F.col("text"), F.lit(""))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    rows = given.repartitionByRange(*order).sortWithinPartitions(*order, "text").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone(__name__)
        task = TaskContext.get().partitionId()
        held, done, ends = None, [], []  # held: doc_id, text, fingerprint

        def out() -> pa.RecordBatch:
            made = [(*r, None, None) for r in done] + [(d, None, None, own, None, None, None, t, e) for d, t, own, e in ends]
            done.clear(), ends.clear()
            kinds = [*_TYPES, pa.string(), pa.bool_()]
            cols = [pa.array(x, t) for x, t in zip(zip(*made), kinds)]
            return pa.RecordBatch.from_arrays([*cols, pa.array([task] * len(made), pa.int32())], names=[*_NAMES, "edge", "last", "task"])

        for batch in batches:
            for d, t in zip(*(c.to_pylist() for c in batch.columns)):
                mark = held[2] if held and held[1] == t else fingerprint(t)
                if held:
                    done.append(_result(*held, t, mark))
                else:
                    ends.append((d, t, mark, False))
                held = (d, t, mark)
                if len(done) >= 512:
                    yield out()
        if held:
            ends.append((*held, True))
            yield out()

    table = materialize(rows.mapInArrow(run, f"{_RESULT}, edge string, last boolean, task int"))
    inner = table.where("edge is null").select(*_NAMES)
    ends = table.where("edge is not null")
    first = ends.where("not last").select("task", F.col("edge").alias("next_text"), F.col("fingerprint").alias("next_mark"))
    # One number for each task; behind the last task comes the first again.
    tasks = first.select("task")
    after = tasks.select("task", F.coalesce(F.lead("task").over(Window.orderBy("task")), F.min("task").over(Window.partitionBy())).alias("next"))
    pairs = ends.where("last").join(after, "task").join(first.withColumnRenamed("task", "next"), "next")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [_result(*r) for r in zip(*(c.to_pylist() for c in b.columns))]
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made), _TYPES)], names=_NAMES)

    outer = pairs.select("doc_id", "edge", "fingerprint", "next_text", "next_mark").mapInArrow(close, _RESULT)
    return inner.unionByName(outer)


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """All other columns, and ``fingerprint``."""
    keep = others(docs, text, "fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = [fingerprint(t) for t in column(b, "_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(marks, pa.string())], names=[*(f"k{k}" for k in range(len(keep))), "fingerprint"])

    given = docs.select(*[F.col(c).alias(f"k{k}") for k, c in enumerate(keep)], F.col(text).alias("_text"))
    return given.mapInArrow(run, given.drop("_text").schema.add("fingerprint", "string")).toDF(*keep, "fingerprint")


def _blocks(radius: int) -> list[tuple[int, int, int]]:
    """radius + 1 blocks (word, lowest bit, bits) of the 128 bits; none lies in
    both words."""
    first = (radius + 2) // 2
    out = []
    for word, n in ((0, first), (1, radius + 1 - first)):
        edges = [round(64 * k / n) for k in range(n + 1)] if n else []
        out += [(word, lo, hi - lo) for lo, hi in zip(edges, edges[1:])]
    return out


def _mask(block: tuple[int, int, int]) -> int:
    mask = ((1 << block[2]) - 1) << block[1]
    return mask - (1 << 64) if mask >> 63 else mask


def near(queries: DataFrame, table: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Distinct pairs (query, found, distance) of different fingerprints within
    ``radius`` of each other, by radius + 1 block tables.

    Both inputs are reduced to distinct fingerprints first, so copies cost
    nothing; Spark's skew join splits blocks that many fingerprints share."""
    blocks = _blocks(radius)

    def tabled(df: DataFrame, side: str) -> DataFrame:
        df = df.select(F.col("fingerprint").alias("fp")).where("fp is not null").distinct()
        words = [F.conv(F.substring("fp", 1 + 16 * k, 16), 16, -10).cast("long").alias(f"{side}{k}") for k in (0, 1)]
        df = df.select(*words)
        values = [F.col(f"{side}{b[0]}").bitwiseAND(F.lit(_mask(b))) for b in blocks]
        return df.select("*", F.posexplode(F.array(*values)).alias("at", "value"))

    # The side that is joined is a table of its own: its size decides how.
    asked = materialize(tabled(queries, "q"))
    pairs = tabled(table, "t").join(asked, ["at", "value"])
    differ = [F.col(f"q{k}").bitwiseXOR(F.col(f"t{k}")) for k in (0, 1)]
    distance = F.bit_count(differ[0]) + F.bit_count(differ[1])
    # A pair that agrees on an earlier block too is left to that block.
    earlier = F.lit(False)
    for k, b in enumerate(blocks[:-1]):
        earlier = earlier | ((F.col("at") > k) & (differ[b[0]].bitwiseAND(F.lit(_mask(b))) == 0))
    pairs = pairs.withColumn("distance", distance).where((F.col("distance") > 0) & (F.col("distance") <= radius) & ~earlier)
    text = lambda s: F.concat(*[F.lpad(F.lower(F.hex(f"{s}{k}")), 16, "0") for k in (0, 1)])
    return pairs.select(text("q").alias("query"), text("t").alias("found"), "distance")


def with_neighbours(prints: DataFrame, asked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``prints`` (fingerprint, ...) with n_near: how many other fingerprints lie
    within the radius of one that ``asked`` holds, null for all others."""
    asked = materialize(asked.select("fingerprint").distinct())
    found = near(asked, prints, radius).groupBy(F.col("query").alias("fingerprint")).agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(asked.join(found, "fingerprint", "left").select(F.col("fingerprint").alias("_asked"), F.coalesce("n", F.lit(0)).alias("n_near")))
    return prints.join(counts, F.col("fingerprint") == F.col("_asked"), "left").drop("_asked")
