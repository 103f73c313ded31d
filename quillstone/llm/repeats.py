"""Suffix-array dedup on a run-length index: removes every byte covered by a
``WINDOW``-byte string that also starts anywhere else in the corpus.

1. Anchors.  Every window has a least hashed 32-byte gram, its anchor (the
   leftmost, on ties).  Equal windows have equal anchors at the same offset, so
   a window whose anchor occurs once is unique.  An anchor occurrence stands
   for the context that the windows it governs cover, which follow one another.
   About 1.2 % of the positions are anchors.
2. Counting.  Contexts are grouped by (anchor, content).  A context that occurs
   twice is covered whole; groups of copies end here, in a partial aggregate,
   however large they are.  Anchors with several contexts go on, one
   representative for each.
3. Index.  Contexts are dealt to tasks by anchor.  A task concatenates its
   pieces, with a mark at the anchor, sorts their suffixes and builds the
   run-compressed Burrows-Wheeler transform.  Longest common prefixes are
   computed at run ends only, the samples of the index; matching statistics
   stream from them along the text, one less for each position up to the next
   sample.  Where they reach the window's length, the window occurs in another
   piece.
4. Anchors with more than ``BIG`` contexts (a line in a large part of a corpus)
   are not indexed in one task: the windows that they govern are counted by a
   128-bit hash, in a partial aggregate.
5. The spans of each text are united and cut out.

Texts are named by two 64-bit hashes; copies are cut once.

Texts of any length are read in slices of 256 KB.

Defined results: null text is empty; matches never cross documents, may lie in
one document and may overlap themselves; repeated rows are copies; an empty
table gives an empty result; other columns are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, collect_garbage, column, drop, flat_bytes, materialize, ragged

WINDOW = 200
GRAM = 32
SPREAD = WINDOW - GRAM  # bytes of context before an anchor
BIG = 4_000
SLICE_BYTES = 1 << 18
POSITION_BITS = 19
INDEX_BYTES = 1 << 20
MARK = 255
#: Three ranks to a sort key, up to this many suffixes.
TRIPLE = 1 << 21
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the 32-byte gram at each position but the last 31."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _ODD[0]
    h ^= h >> np.uint64(29)
    for k in range(5):
        m = 1 << k
        h = h[:-m] * _ODD[k + 1] + h[m:]
        h ^= h >> np.uint64(31)
    h *= _ODD[0]
    h ^= h >> np.uint64(32)
    return h


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, position, gram hash, far, near) of the anchors of texts in one
    buffer that ``offsets``, from 0, cut it into; the windows that an anchor
    governs begin far, far - 1 ... near bytes before it."""
    none = np.zeros(0, np.int64)
    lens = np.diff(offsets)
    if len(data) < WINDOW or lens.max() < WINDOW:
        return none, none, none.astype(np.uint64), none, none
    h = gram_hashes(data)
    # The key's low bits hold the position: equal hashes give the leftmost, and
    # as many bits of the hash count in every buffer.
    wide = np.uint64(POSITION_BITS)
    low = (np.uint64(1) << wide) - np.uint64(1)
    m = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    n, span = SPREAD + 1, 1
    while span * 2 <= n:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    m = np.minimum(m[: len(h) - n + 1], m[n - span : n - span + len(h) - n + 1])
    # Windows that lie inside one text.
    long = np.flatnonzero(lens >= WINDOW)
    starts = ragged(offsets[:-1][long], lens[long] - WINDOW + 1)
    at = (m[starts] & low).astype(np.int64)
    edge = np.flatnonzero(at[1:] != at[:-1])
    first, last = np.concatenate([[0], edge + 1]), np.concatenate([edge, [len(at) - 1]])
    at, far, near = at[first], at[first] - starts[first], at[first] - starts[last]
    text = np.searchsorted(offsets, at, side="right") - 1
    return text, at - offsets[text], h[at], far, near


def anchors_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """As ``anchors``, for a single text of any length: slices that overlap by
    all but one byte of a window, an anchor of two slices taken together."""
    if len(data) <= SLICE_BYTES:
        return anchors(data, offsets)
    found = []
    for lo in range(0, len(data) - WINDOW + 1, SLICE_BYTES):
        part = data[lo : lo + SLICE_BYTES + WINDOW - 1]
        text, pos, gram, far, near = anchors(part, np.array([0, len(part)]))
        pos = pos + lo
        if found and len(pos) and found[-1][1][-1] == pos[0]:
            found[-1][4][-1] = near[0]
            text, pos, gram, far, near = (x[1:] for x in (text, pos, gram, far, near))
        if len(pos):
            found.append((text, pos, gram, far, near))
    return tuple(np.concatenate(x) for x in zip(*found))


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_64_intdigest
    for b in batches:
        data, all_offsets = flat_bytes(column(b, "text"))
        k1, k2 = column(b, "k1").to_numpy(), column(b, "k2").to_numpy()
        for i, j in byte_slices(all_offsets, SLICE_BYTES):
            offsets = all_offsets[i : j + 1]
            own = data[offsets[0] : offsets[-1]]
            text, pos, gram, far, near = anchors_of(own, offsets - offsets[0])
            if not len(text):
                continue
            at = (offsets - offsets[0])[:-1][text] + pos
            raw = own.tobytes()
            context = np.fromiter([digest(raw[a:z], n) for a, z, n in zip((at - far).tolist(), (at - near + WINDOW).tolist(), far.tolist())], np.uint64, len(text))
            yield pa.RecordBatch.from_arrays([pa.array(gram.astype(np.int64)), pa.array(context.astype(np.int64)), pa.array(k1[i:j][text]), pa.array(k2[i:j][text]), *(pa.array(x.astype(np.int32)) for x in (pos, far, near))], names=["anchor", "context", "k1", "k2", "pos", "far", "near"])


def suffix_order(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Suffix array of pieces, each ended by a 0, in one buffer; equal suffixes
    keep the order of their pieces.  Ranks of 8 bytes, then of ever longer prefixes."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    ends = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
    key = np.zeros(n, np.uint64)
    inside = np.ones(n, bool)
    for k in range(8):
        key = (key << np.uint64(8)) | np.where(inside, padded[k : k + n], 0).astype(np.uint64)
        inside &= padded[k : k + n] != 0
    rank = _ranks(key)
    h, at = 8, np.arange(n)
    longest = int(np.diff(np.append(starts, n)).max()) if len(starts) else 0
    while h < longest and int(rank.max()) < n - 1:
        key = rank
        # Prefixes of triple length in a round while three ranks fit in a key.
        for k in (1, 2) if n < TRIPLE else (1,):
            later = np.where(at + k * h < ends, rank[np.minimum(at + k * h, n - 1)] + 1, 0)
            key = key * np.int64(n + 1) + later
        rank = _ranks(key)
        h *= 3 if n < TRIPLE else 2
    return np.argsort(rank * np.int64(n) + at)


def _ranks(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    own = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(own[1:] != own[:-1])])
    return rank


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, up to the 0 that
    ends a piece."""
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)).view("<u8").ravel()
    out, todo = np.zeros(len(a), np.int64), np.arange(len(a))
    while len(todo):
        x, y = words[a[todo] + out[todo]], words[b[todo] + out[todo]]
        diff = x ^ y
        zero = (x - np.uint64(0x0101010101010101)) & ~x & np.uint64(0x8080808080808080)
        # First byte that differs, or that ends the piece in both.
        stop = np.where(diff != 0, diff & (~diff + np.uint64(1)), np.uint64(0))
        end = zero & (~zero + np.uint64(1))
        first = np.full(len(todo), 8)
        for s in (stop, end):
            some = s != 0
            first[some] = np.minimum(first[some], (np.bitwise_count(s[some] - np.uint64(1)) >> 3).astype(np.int64))
        out[todo] += first
        todo = todo[first == 8]
    return out


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of pieces with sampled run ends."""

    def __init__(self, pieces: list[bytes]):
        lens = np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1
        self.starts = np.cumsum(lens) - lens
        raw = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8)
        # UTF-8 has no byte above 244: 0 ends a piece, 255 is the anchor's mark.
        text = raw + np.uint8(1)
        text[self.starts + lens - 1] = 0
        marks = np.flatnonzero(raw == 254)
        text[marks] = MARK
        order = suffix_order(text, self.starts)
        before = text[order - 1]
        # What stands before a piece differs from all else: such rows are runs of one.
        sole = before == 0
        edge = (before[1:] != before[:-1]) | sole[1:] | sole[:-1]
        head = np.flatnonzero(np.concatenate([[True], edge]))
        tail = np.flatnonzero(np.concatenate([edge, [True]]))
        self.text, self.runs = text, len(head)
        self.samples = (self._sample(order, head, -1), self._sample(order, tail, 1))

    def _sample(self, order: np.ndarray, rows: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Text positions of run ends, ascending, with the common prefix of each
        suffix and its neighbour outside the run."""
        near = rows + step
        ok = (near >= 0) & (near < len(order))
        value = np.zeros(len(rows), np.int64)
        value[ok] = common_prefix(self.text, order[rows[ok]], order[near[ok]])
        by = np.argsort(order[rows])
        return order[rows][by], value[by]

    def matching_statistics(self, at: np.ndarray) -> np.ndarray:
        """For text positions: the longest match that starts there and occurs
        at another position too."""
        out = np.zeros(len(at), np.int64)
        for pos, value in self.samples:
            k = np.searchsorted(pos, at, side="right") - 1
            out = np.maximum(out, value[k] - (at - pos[k]))
        return out


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their representatives to pieces: the context of each, with
    the mark in front of its anchor."""
    names = ["anchor", "k1", "k2", "pos", "far", "near", "solo", "piece"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
    rows: list = []
    for b in batches:
        for k1, k2, text, found in zip(column(b, "k1").to_pylist(), column(b, "k2").to_pylist(), column(b, "text").cast(pa.binary()).to_pylist(), column(b, "found").to_pylist()):
            for f in found:
                if f["rep"]:
                    pos, far, near = f["pos"], f["far"], f["near"]
                    rows.append((f["anchor"], k1, k2, pos, far, near, f["solo"], text[pos - far : pos] + b"\xfe" + text[pos : pos - near + WINDOW]))
            if len(rows) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces, sorted by anchor, to (k1, k2, pos, far, near): the farthest and
    the nearest offset before the anchor at which a repeated window begins."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        for i in range(0, len(b), 1_000):
            part = b.slice(i, 1_000)
            held.append(part)
            size += int(np.diff(flat_bytes(column(part, "piece"))[1]).sum())
            if size >= INDEX_BYTES:
                t = pa.Table.from_batches(held).combine_chunks()
                anchor = t["anchor"].to_numpy()
                cut = int(np.searchsorted(anchor, anchor[-1], side="left"))
                if cut:
                    yield from _solve(t.slice(0, cut))
                    held = t.slice(cut).to_batches()
                    size = sum(len(x) for x in t["piece"].slice(cut).to_pylist())
    if held:
        yield from _solve(pa.Table.from_batches(held))


def _solve(t: pa.Table) -> Iterator[pa.RecordBatch]:
    index = RunIndex(t["piece"].to_pylist())
    far, near = t["far"].to_numpy().astype(np.int64), t["near"].to_numpy().astype(np.int64)
    # Window starts of the pieces that need an answer: from the first byte to
    # near bytes before the mark.
    asked = np.flatnonzero(t["solo"].to_numpy(zero_copy_only=False))
    n = (far - near + 1)[asked]
    at = ragged(index.starts[asked], n)
    owner = np.repeat(asked, n)
    hit = index.matching_statistics(at) >= WINDOW + 1
    owner, offset = owner[hit], (far[owner] - (at - index.starts[owner]))[hit]
    farthest, nearest = np.full(len(t), -1), np.full(len(t), WINDOW)
    np.maximum.at(farthest, owner, offset)
    np.minimum.at(nearest, owner, offset)
    rows = np.flatnonzero(farthest >= 0)
    if len(rows):
        some = t.take(pa.array(rows))
        yield pa.RecordBatch.from_arrays([some["k1"].combine_chunks(), some["k2"].combine_chunks(), some["pos"].combine_chunks(), pa.array(farthest[rows].astype(np.int32)), pa.array(nearest[rows].astype(np.int32))], names=["k1", "k2", "pos", "far", "near"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of big anchors to their windows, by 128-bit hash."""
    names = ["w1", "w2", "k1", "k2", "pos", "offset", "solo"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
    for b in batches:
        rows = []
        for k1, k2, pos, far, near, solo, piece in zip(*(column(b, c).to_pylist() for c in ("k1", "k2", "pos", "far", "near", "solo", "piece"))):
            for offset in range(near, far + 1):
                d = xxhash.xxh3_128_digest(piece[far - offset : far - offset + WINDOW + 1], offset)
                rows.append((int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True), k1, k2, pos, offset, solo))
            if len(rows) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their spans (from, to) to what is left of them."""
    names = ["k1", "k2", "n_removed", "n_spans", "kept_sha256", "kept"]
    for b in batches:
        rows = []
        for k1, k2, text, spans in zip(column(b, "k1").to_pylist(), column(b, "k2").to_pylist(), column(b, "text").cast(pa.binary()).to_pylist(), column(b, "spans").to_pylist()):
            removed, count, end, kept = 0, 0, -1, []
            for lo, hi in sorted((s["lo"], min(s["hi"], len(text))) for s in spans):
                if lo > end:
                    kept.append(text[max(end, 0) : lo])
                    count, end = count + 1, lo
                if hi > end:
                    removed, end = removed + hi - end, hi
            kept = b"".join([*kept, text[max(end, 0) :]])
            rows.append((k1, k2, removed, count, hashlib.sha256(kept).hexdigest(), kept))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.string(), pa.binary()])], names=names)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2"))


def cut_repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, cuts): doc_id, k1, k2, n_bytes, sha256 of each document, and
    k1, k2, n_removed, n_spans, kept_sha256, kept (bytes) of each distinct text
    that loses something."""
    keyed = _keyed(docs)
    info = materialize(keyed.select("doc_id", "k1", "k2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256")))
    occurrences = materialize(keyed.where(F.octet_length("text") >= WINDOW).select("text", "k1", "k2").mapInArrow(_occurrences, "anchor long, context long, k1 long, k2 long, pos int, far int, near int"))
    # Anchors that occur again, and whether in several contexts.  Small tables
    # of their own, so that Spark can split the hot keys of the joins.
    again = materialize(occurrences.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), (F.min("context") != F.max("context")).alias("several")).where("n > 1").select("anchor", "several"))
    spark = docs.sparkSession
    collect_garbage(spark)
    kept = materialize(occurrences.join(again, "anchor"))
    drop(occurrences, again)
    collect_garbage(spark)
    place = F.struct("k1", "k2", "pos")
    contexts = materialize(kept.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")))
    found = kept.distinct().join(contexts, ["anchor", "context"])
    solo, rep = F.col("n") == 1, F.col("several") & (place == F.col("first"))
    found = found.select("k1", "k2", "pos", "far", "near", F.when(rep, F.col("anchor")).alias("anchor"), solo.alias("solo"), rep.alias("rep")).where("rep or not solo")
    lists = found.groupBy("k1", "k2").agg(F.collect_list(F.struct("pos", "far", "near", "anchor", "solo", "rep")).alias("found"))
    # One document for each distinct text that has any; copies are not shuffled.
    first = info.groupBy("k1", "k2").agg(F.min("doc_id").alias("first_id"))
    lists = materialize(lists.join(first, ["k1", "k2"]))
    drop(kept, contexts)
    collect_garbage(spark)
    texts = keyed.join(lists, (keyed.doc_id.eqNullSafe(lists.first_id)) & (keyed.k1 == lists.k1) & (keyed.k2 == lists.k2)).select(keyed.k1, keyed.k2, "text", "found")
    whole = texts = materialize(texts)
    drop(lists)
    collect_garbage(spark)
    pieces = materialize(texts.where(F.exists("found", lambda f: f["rep"])).mapInArrow(_pieces, "anchor long, k1 long, k2 long, pos int, far int, near int, solo boolean, piece binary"))
    big = materialize(pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BIG).select("anchor"))
    crowded = big.limit(1).count() > 0
    done = [whole, pieces, big]
    small = pieces.join(big, "anchor", "left_anti") if crowded else pieces
    hits = small.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_index, "k1 long, k2 long, pos int, far int, near int")
    if crowded:
        windows = materialize(pieces.join(big, "anchor").mapInArrow(_windows, "w1 long, w2 long, k1 long, k2 long, pos int, offset int, solo boolean"))
        twice = materialize(windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w1", "w2"))
        done += [windows, twice]
        more = windows.where("solo").join(twice, ["w1", "w2"]).groupBy("k1", "k2", "pos").agg(F.max("offset").alias("far"), F.min("offset").alias("near"))
        hits = hits.unionByName(more)
    # Whole contexts that occur again, and what the index found of the others.
    spans = hits.select("k1", "k2", (F.col("pos") - F.col("far")).alias("lo"), (F.col("pos") + WINDOW - F.col("near")).alias("hi"))
    spans = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    own = F.transform(F.filter("found", lambda f: ~f["solo"]), lambda f: F.struct((f["pos"] - f["far"]).alias("lo"), (f["pos"] - f["near"] + WINDOW).alias("hi")))
    none = F.array().cast("array<struct<lo:int,hi:int>>")
    texts = texts.join(spans, ["k1", "k2"], "left").select("k1", "k2", "text", F.concat(own, F.coalesce("spans", none)).alias("spans")).where(F.size("spans") > 0)
    cuts = materialize(texts.mapInArrow(_cut, "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string, kept binary").dropDuplicates(["k1", "k2"]))
    drop(*done)
    return info, cuts


def dedup_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    info, cuts = cut_repeats(docs)
    cuts = cuts.drop("kept")
    out = info.join(cuts, ["k1", "k2"], "left")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "sha256").alias("kept_sha256"))
