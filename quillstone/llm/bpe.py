"""Byte-level BPE encoding and decoding with numpy matrices.

Texts are split by the tokenizer's pattern, each match is encoded apart.
Matches that are no token themselves go, once each, into padded matrices of
token ids, one matrix for each length class.  In a round every row merges its
leftmost pair of least rank: ranks come from a hash table of pairs, the merged
row is compacted to the left, and only the two pairs beside the merge are
looked up again.  Rows without a mergeable pair leave the matrix.  A match of
more than ``MATRIX_BYTES`` bytes would need as many rounds as it has merges,
each over its whole row; a heap of pairs gives the same merges there.

Defined results: null text is empty and has no ids; very long texts are
matched piece by piece in bounded memory; repeated rows give equal rows; an
empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import base64
import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import alone, byte_slices, column, flat_bytes, others, ragged

MATRIX_BYTES = 256
SLICE_BYTES = 1 << 20
CACHE_PIECES = 250_000
NONE = np.int32(2**31 - 1)
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class _Opened:
    """A rank file's tables; one of a kind for each Python worker."""

    _open: dict[tuple, "_Opened"] = {}

    @classmethod
    def get(cls, path: str):
        alone(__name__, _Opened._open.clear)
        if (cls, path) not in _Opened._open:
            _Opened._open[cls, path] = cls(path)
        return _Opened._open[cls, path]


class Words(_Opened):
    """The decoder."""

    def __init__(self, path: str):
        ranks = _ranks(path)
        words = [b""] * (max(ranks.values()) + 1)
        for word, i in ranks.items():
            words[i] = word
        self.word_len = np.array([len(w) for w in words], np.int64)
        self.word_at = np.concatenate([[0], np.cumsum(self.word_len)])
        self.word_bytes = np.frombuffer(b"".join(words), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, number of bytes of each id)."""
        n = self.word_len[ids]
        return self.word_bytes[ragged(self.word_at[ids], n)], n


class Bpe(_Opened):
    """The encoder."""

    def __init__(self, path: str):
        self.ranks = ranks = _ranks(path)
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.pair: dict[int, int] = {}
        self._pairs(ranks)
        self._forget()

    def _pairs(self, ranks: dict[bytes, int]) -> None:
        """Open-addressed table: key left << 32 | right, value the merged id."""
        left, right, to = [], [], []
        for word, i in ranks.items():
            for k in range(1, len(word)):
                a, b = ranks.get(word[:k]), ranks.get(word[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), to.append(i)
        keys = np.array(left, np.uint64) << np.uint64(32) | np.array(right, np.uint64)
        to = np.array(to, np.int32)
        bits = max(4, int(len(keys) * 4 - 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, 2**64 - 1, np.uint64)
        self.values = np.full(1 << bits, NONE, np.int32)
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            slot = at[todo]
            free = self.keys[slot] == 2**64 - 1
            # Of several keys for one free slot the first takes it.
            first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)[1]
            first = first[free[first]]
            self.keys[slot[first]], self.values[slot[first]] = keys[todo[first]], to[todo[first]]
            rest = np.ones(len(todo), bool)
            rest[first] = False
            todo = todo[rest]
            at[todo] = (at[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of each pair, NONE where there is none; pads are -1."""
        out = np.full(left.shape, NONE, np.int32)
        real = np.flatnonzero((right.ravel() >= 0) & (left.ravel() >= 0))
        keys = left.ravel()[real].astype(np.uint64) << np.uint64(32) | right.ravel()[real].astype(np.uint64)
        slot, flat = self._slot(keys), out.ravel()
        while len(real):
            there = self.keys[slot]
            hit = there == keys
            flat[real[hit]] = self.values[slot[hit]]
            go = ~hit & (there != np.uint64(2**64 - 1))
            real, keys, slot = real[go], keys[go], (slot[go] + 1) & self.mask
        return flat.reshape(left.shape)

    def _merge_matrix(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of byte ids, padded with -1, to (final rows, their lengths)."""
        out, final = np.full_like(m, -1), np.zeros(len(m), np.int64)
        rows, length = np.arange(len(m)), (m >= 0).sum(1)
        rank = self.rank_of(m[:, :-1], m[:, 1:])
        cols = np.arange(m.shape[1])
        while len(rows):
            j = rank.argmin(1) if rank.shape[1] else np.zeros(len(rows), np.int64)
            best = rank[np.arange(len(rows)), j] if rank.shape[1] else np.full(len(rows), NONE)
            go = best != NONE
            if not go.all():
                stop = ~go
                out[rows[stop], : m.shape[1]], final[rows[stop]] = m[stop], length[stop]
                rows, m, rank, length, j, best = rows[go], m[go], rank[go], length[go], j[go], best[go]
                if not len(rows):
                    break
                wide = int(length.max())
                m, rank, cols = m[:, :wide], rank[:, : wide - 1], cols[:wide]
            k, jj = np.arange(len(rows)), j[:, None]
            # Compaction: what stands right of the merge moves one to the left.
            padded = np.concatenate([m[:, 1:], np.full((len(rows), 1), -1, np.int32)], 1)
            m = np.where(cols > jj, padded, m)
            m[k, j] = best
            moved = np.concatenate([rank[:, 1:], np.full((len(rows), 1), NONE, np.int32)], 1)
            rank = np.where(cols[:-1] > jj, moved, rank)
            length = length - 1
            right = np.where(j + 1 < length, m[k, np.minimum(j + 1, m.shape[1] - 1)], -1)
            at = np.minimum(j, rank.shape[1] - 1)
            rank[k, at] = self.rank_of(m[k, j], right)
            has = np.flatnonzero(j > 0)
            rank[has, j[has] - 1] = self.rank_of(m[has, j[has] - 1], m[has, j[has]])
        return out, final

    def _merge_heap(self, piece: bytes) -> np.ndarray:
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        if not self.pair:
            used = self.values != NONE
            self.pair = dict(zip(self.keys[used].tolist(), self.values[used].tolist()))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := self.pair.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            k = after[i] if alive[i] else n
            if k >= n or ids[i] != a or ids[k] != b:
                continue
            ids[i], alive[k], after[i] = r, False, after[k]
            if after[k] < n:
                before[after[k]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (s := self.pair.get(ids[x] << 32 | ids[y])) is not None:
                    heapq.heappush(heap, (s, x, ids[x], ids[y]))
        return np.array([t for t, ok in zip(ids, alive) if ok], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths) of distinct pieces, in their order."""
        result: list = [None] * len(pieces)
        by_length: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if (whole := self.ranks.get(p)) is not None:
                result[i] = np.array([whole], np.int32)
            elif len(p) > MATRIX_BYTES:
                result[i] = self._merge_heap(p)
            else:
                n = len(p)
                by_length.setdefault(n if n <= 16 else (n + 7) // 8 * 8 if n <= 64 else (n + 63) // 64 * 64, []).append(i)
        for wide, members in by_length.items():
            step = max(1, 2_000_000 // wide)
            for lo in range(0, len(members), step):
                part = members[lo : lo + step]
                lens = np.array([len(pieces[i]) for i in part])
                data = self.byte_ids[np.frombuffer(b"".join([pieces[i] for i in part]), np.uint8)]
                m = np.full((len(part), wide), -1, np.int32)
                m[np.arange(wide) < lens[:, None]] = data
                rows, n = self._merge_matrix(m)
                flat, ends = rows[np.arange(wide) < n[:, None]], np.cumsum(n)
                for i, a, b in zip(part, (ends - n).tolist(), ends.tolist()):
                    result[i] = flat[a:b]
        lengths = np.fromiter(map(len, result), np.int64, len(result))
        return (np.concatenate(result) if result else np.zeros(0, np.int32)), lengths

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.starts, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode_matches(self, matches: list[str]) -> np.ndarray:
        """Ids of consecutive matches.  Pieces are kept for later calls, up to
        CACHE_PIECES of them; then all are forgotten."""
        if len(self.known) > CACHE_PIECES:
            self._forget()
        known = self.known
        new = [p for p in set(matches) if p not in known]
        if new:
            ids, lengths = self.encode_pieces([p.encode("utf-8", "surrogatepass") for p in new])
            base = len(known)
            known.update(zip(new, range(base, base + len(new))))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.ids = np.concatenate([self.ids, ids])
        at = np.fromiter(map(known.__getitem__, matches), np.int64, len(matches))
        return self.ids[ragged(self.starts[at], self.lengths[at])]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each text)."""
        matches: list[str] = []
        parts, counts = [], []
        for text in texts:
            if len(text) > SLICE_BYTES:
                n, found = 0, (m[0] for m in self.pattern.finditer(text))
                parts.append(self.encode_matches(matches))
                matches = []
                while some := list(itertools.islice(found, SLICE_BYTES // 8)):
                    parts.append(self.encode_matches(some))
                    n += len(parts[-1])
                counts.append(("ids", n))
            else:
                found = self.pattern.findall(text)
                matches += found
                counts.append(("matches", found))
        parts.append(self.encode_matches(matches))
        known, lengths = self.known, self.lengths
        n = [c if kind == "ids" else int(lengths[np.fromiter(map(known.__getitem__, c), np.int64, len(c))].sum()) for kind, c in counts]
        return np.concatenate(parts), np.array(n, np.int64)


def _binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _default(path: str | None) -> str:
    return path or public_tokenizers.path(VOCABULARY)


def encode(df: DataFrame, text: str = "text", ids: str = "ids", vocabulary: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all but the text) and ``ids``, a binary column
    of little-endian unsigned 32-bit token ids."""
    keep = others(df, text, ids) if keep is None else keep
    path = _default(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.get(path)
        for batch in batches:
            col = column(batch, "_text")
            _, offsets = flat_bytes(col)
            for i, j in byte_slices(offsets, SLICE_BYTES):
                found, n = bpe.encode([x or "" for x in col.slice(i, j - i).to_pylist()])
                rows = [batch.column(k).slice(i, j - i) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*rows, _binary(found.astype("<u4").view(np.uint8), 4 * n)], names=[*(f"k{k}" for k in range(len(keep))), "ids"])

    given = df.select(*[F.col(c).alias(f"k{k}") for k, c in enumerate(keep)], F.col(text).alias("_text"))
    schema = T.StructType([T.StructField(f"k{k}", df.schema[c].dataType) for k, c in enumerate(keep)] + [T.StructField("ids", T.BinaryType())])
    return given.mapInArrow(run, schema).toDF(*keep, ids)


def decode(df: DataFrame, ids: str = "ids", decoded: str = "decoded", vocabulary: str | None = None) -> DataFrame:
    """All columns and ``decoded``, the bytes that the ids stand for."""
    path, names = _default(vocabulary), others(df, decoded)
    df, at = df.select(*names), names.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words.get(path)
        for batch in batches:
            data, offsets = flat_bytes(batch.column(at))
            for i, j in byte_slices(offsets, SLICE_BYTES):
                own = np.frombuffer(data[offsets[i] : offsets[j]].tobytes(), "<u4").astype(np.int64)
                out, n = words.decode(own)
                ends = np.concatenate([[0], np.cumsum(n)])[(offsets[i : j + 1] - offsets[i]) // 4]
                rows = [batch.column(k).slice(i, j - i) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([*rows, _binary(out, np.diff(ends))], names=[*(f"k{k}" for k in range(len(names))), "decoded"])

    schema = T.StructType([T.StructField(f"k{k}", f.dataType) for k, f in enumerate(df.schema)] + [T.StructField("decoded", T.BinaryType())])
    return df.toDF(*(f"k{k}" for k in range(len(names)))).mapInArrow(run, schema).toDF(*names, decoded)
