"""Chat formatting by columnar byte assembly.

Turns become ``<|im_start|>role\\ntext<|im_end|>\\n``.  A batch of turns is
laid out in numpy: segment lengths, their cumulative offsets and a scatter
index for every byte, then headers and contents are copied into one buffer
that becomes the Arrow column as it is.  Control strings cannot occur in
contents: ``<``, any backslashes and ``|`` get one more backslash after the
``<``; reading takes it out again.

Defined results: null text and null role are empty; turns of a conversation
are ordered by turn (nulls first), then role, then text, so ties and repeated
rows have one order; null conversation ids form one conversation; an empty
table gives an empty result; other columns are not used.  A conversation whose
form is longer than ``PART_BYTES`` comes in several parts, at turn borders, so
no buffer grows with a conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, column, flat_bytes, ragged

START, END = b"<|im_start|>", b"<|im_end|>\n"
PART_BYTES = 8 << 20
SLICE_BYTES = 1 << 22
_ESCAPED = re.compile(rb"<\\(\\*)\|")
_ROLE = {b"\\": b"\\\\", b"\n": b"\\n"}


def escape_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions after each ``<`` that backslashes and a ``|`` of the same
    content follow."""
    lt = np.flatnonzero(data[:-1] == 60) if len(data) else np.zeros(0, np.int64)
    nxt = data[lt + 1]
    direct, slashed = lt[nxt == 124], lt[nxt == 92]
    ends = offsets[np.searchsorted(offsets, direct, side="right")]
    hits = [direct[direct + 1 < ends] + 1]
    for p in slashed.tolist():
        q, end = p + 1, int(offsets[np.searchsorted(offsets, p, side="right")])
        while q < end and data[q] == 92:
            q += 1
        if q < end and data[q] == 124:
            hits.append(np.array([p + 1]))
    return np.sort(np.concatenate(hits))


def escape_role(role: bytes) -> bytes:
    out = re.sub(rb"[\\\n]", lambda m: _ROLE[m[0]], role)
    return re.sub(rb"<(?=\\*\|)", rb"<\\", out)


def unescape_role(role: bytes) -> bytes:
    out = _ESCAPED.sub(rb"<\1|", role)
    return re.sub(rb"\\(.)", lambda m: b"\n" if m[1] == b"n" else m[1], out, flags=re.S)


def unescape(text: bytes) -> bytes:
    return _ESCAPED.sub(rb"<\1|", text)


def assemble(roles: list[bytes], data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with all formatted turns: (bytes, turn offsets, content
    starts, content ends)."""
    n = len(roles)
    heads: dict[bytes, bytes] = {r: START + escape_role(r) + b"\n" for r in set(roles)}
    kinds = {r: k for k, r in enumerate(heads)}
    kind = np.fromiter((kinds[r] for r in roles), np.int64, n)
    head_len = np.array([len(h) for h in heads.values()], np.int64)
    head_at = np.cumsum(head_len) - head_len
    head_bytes = np.frombuffer(b"".join(heads.values()), np.uint8)
    base = offsets[0]
    own, offsets = data[base : offsets[-1]], offsets - base
    extra = escape_points(own, offsets)
    inserted = np.searchsorted(extra, offsets)  # before each content
    text_len = np.diff(offsets) + np.diff(inserted)
    turn_len = head_len[kind] + text_len + len(END)
    turn_at = np.concatenate([[0], np.cumsum(turn_len)])
    start = turn_at[:-1] + head_len[kind]
    out = np.empty(int(turn_at[-1]), np.uint8)
    out[ragged(turn_at[:-1], head_len[kind])] = head_bytes[ragged(head_at[kind], head_len[kind])]
    to = ragged(start - inserted[:-1], np.diff(offsets))
    if len(extra):
        before = np.zeros(len(own) + 1, np.int64)
        np.add.at(before, extra, 1)
        to += np.cumsum(before)[:-1]
        out[to[extra] - 1] = 92
    else:
        to = ragged(start, np.diff(offsets))
    out[to] = own
    out[ragged(turn_at[1:] - len(END), np.full(n, len(END)))] = np.tile(np.frombuffer(END, np.uint8), n)
    return out, turn_at, start, start + text_len


def format_chats(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, part, n_turns, formatted, loss_starts, loss_ends: byte spans of
    the formatted string under the loss mask.  Rows of a conversation are
    consecutive, in order, in one partition."""
    given = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    given = given.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")
    in_loss = {r.encode() for r in loss_roles}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []  # (bytes, starts, ends, turns) of the open part
        size, conv, part, started = 0, None, 0, False

        def emit() -> pa.RecordBatch:
            text = b"".join(h[0] for h in held)
            at = np.cumsum([0, *(len(h[0]) for h in held)])
            starts = np.concatenate([h[1] + a for h, a in zip(held, at)]).astype(np.int64)
            ends = np.concatenate([h[2] + a for h, a in zip(held, at)]).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], pa.int64()), pa.array([part], pa.int64()), pa.array([sum(h[3] for h in held)], pa.int64()), pa.array([text], pa.binary()).cast(pa.string(), safe=False), pa.array([starts], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int64()))],
                names=["conv_id", "part", "n_turns", "formatted", "loss_starts", "loss_ends"])

        for batch in batches:
            data, offsets = flat_bytes(column(batch, "text"))
            ids, all_roles = column(batch, "conv_id").to_pylist(), [r.encode() for r in column(batch, "role").to_pylist()]
            for i, j in byte_slices(offsets, SLICE_BYTES):
                roles, some = all_roles[i:j], ids[i:j]
                out, at, start, end = assemble(roles, data, offsets[i : j + 1])
                loss = np.fromiter((r in in_loss for r in roles), bool, j - i)
                cuts = [0, *(k for k in range(1, len(some)) if some[k] != some[k - 1]), len(some)]
                # Whole conversations inside the slice share the buffer.
                inner, first_done = [], False
                for a, b in zip(cuts, cuts[1:]):
                    if not started or some[a] != conv:
                        if held:
                            yield emit()
                        held, size, conv, part, started = [], 0, some[a], 0, True
                    if size and size + at[b] - at[a] > PART_BYTES:
                        yield emit()
                        held, size, part = [], 0, part + 1
                    if not held and 0 < a and b < len(some) and part == 0:
                        inner.append((a, b))
                        started, conv = False, None
                        continue
                    m = loss[a:b]
                    held.append((out[at[a] : at[b]].tobytes(), start[a:b][m] - at[a], end[a:b][m] - at[a], b - a))
                    size += int(at[b] - at[a])
                    if inner:
                        yield _whole(inner, some, out, at, start, end, loss)
                        inner = []
                if inner:
                    yield _whole(inner, some, out, at, start, end, loss)
        if held:
            yield emit()

    return given.mapInArrow(run, "conv_id long, part long, n_turns long, formatted string, loss_starts array<long>, loss_ends array<long>")


def _whole(inner, some, out, at, start, end, loss) -> pa.RecordBatch:
    """Conversations that lie next to each other in the buffer, without a copy."""
    first, last = inner[0][0], inner[-1][1]
    bounds = np.array([a for a, _ in inner] + [last])
    base = at[first]
    own = out[base : at[last]]
    text = pa.Array.from_buffers(pa.string(), len(inner), [None, pa.py_buffer((at[bounds] - base).astype(np.int32)), pa.py_buffer(own)])
    m = loss[first:last]
    conv_of = np.repeat(np.arange(len(inner)), np.diff(bounds))
    shift = at[bounds[:-1]][conv_of]
    counts = np.concatenate([[0], np.cumsum(np.bincount(conv_of[m], minlength=len(inner)))]).astype(np.int32)
    spans = lambda x: pa.ListArray.from_arrays(pa.array(counts), pa.array((x[first:last] - shift)[m].astype(np.int64)))
    return pa.RecordBatch.from_arrays(
        [pa.array([some[a] for a, _ in inner], pa.int64()), pa.array(np.zeros(len(inner), np.int64)), pa.array(np.diff(bounds).astype(np.int64)), text, spans(start), spans(end)],
        names=["conv_id", "part", "n_turns", "formatted", "loss_starts", "loss_ends"])


def read_turns(formatted: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(role, text) of each turn of a formatted string."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError("turn expected")
        line = formatted.index(b"\n", at)
        end = formatted.index(END, line + 1)
        yield unescape_role(formatted[at + len(START) : line]), unescape(formatted[line + 1 : end])
        at = end + len(END)


def digest_chats(formatted: DataFrame) -> DataFrame:
    """Reads formatted conversations back: turns and masked text of each, with
    digests over its parts in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        done, state, conv = [], None, None
        close = lambda s, c: (c, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4])
        for batch in batches:
            texts = column(batch, "formatted").cast(pa.binary()).to_pylist()
            for c, part, text, starts, ends in zip(column(batch, "conv_id").to_pylist(), column(batch, "part").to_pylist(), texts, column(batch, "loss_starts").to_pylist(), column(batch, "loss_ends").to_pylist()):
                if part == 0:
                    if state:
                        done.append(close(state, conv))
                    state, conv = [0, hashlib.sha256(), 0, hashlib.sha256(), 0], c
                for role, said in read_turns(text):
                    state[0] += 1
                    state[1].update(role + b"\n" + said + b"\n")
                for a, b in zip(starts, ends):
                    said = unescape(text[a:b])
                    state[2] += len(said.decode("utf-8", "replace"))
                    state[3].update(said)
                state[4] += len(text.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done) if done else [[]] * 6, types)], names=names)
            done = []
        if state:
            done = [close(state, conv)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), types)], names=names)

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
