"""Media columns: baseline JPEG as the stored form, DC-only luminance thumbnails.

``pack`` stores bytes losslessly: every byte is the quantised DC coefficient of
one 8x8 block (quantiser 8, so the block's samples equal the byte), 576 blocks
to a row, one restart interval for each row, 1023 rows to a frame; longer
payloads take several frames, which are packed and read one after the other.  ``unpack`` reads any baseline JPEG: it parses
markers, Huffman-decodes the scans in numpy, one lane for each restart
interval, and keeps the DC terms of the luminance, the thumbnail at 1/8 scale.

Defined results: null and empty texts are one row of 255; very long texts take
several frames; equal texts give equal values; media that are not baseline
JPEG get null features and an error text; an empty table an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, column, flat_bytes, others, sha256

ROW = 576
FRAME_ROWS = 1023
#: Bytes that are laid out at once; packing takes some 85 times as many.
SLICE_BYTES = 1 << 20
#: Code lengths of the DC categories that are written: 6 of 3 bits, 3 of 4 bits.
DC_SYMBOLS = (4, 3, 5, 2, 7, 1, 0, 6, 8)
DC_COUNTS = (0, 0, 6, 3) + (0,) * 12
AC_SYMBOLS = (0,)
AC_COUNTS = (1,) + (0,) * 15


class NotBaseline(ValueError):
    pass


def huffman_codes(counts, symbols) -> list[tuple[int, int, int]]:
    """(symbol, code, length) in canonical order."""
    out, code, k = [], 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            out.append((symbols[k], code, length))
            code, k = code + 1, k + 1
        code <<= 1
    return out


def _header(rows: int) -> bytes:
    seg = lambda marker, body: struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body
    return (
        b"\xff\xd8" + seg(0xDB, bytes([0, 8] + [1] * 63)) + seg(0xC0, struct.pack(">BHHB", 8, rows * 8, ROW * 8, 1) + bytes([1, 0x11, 0]))
        + seg(0xC4, bytes([0x00, *DC_COUNTS, *DC_SYMBOLS])) + seg(0xC4, bytes([0x10, *AC_COUNTS, *AC_SYMBOLS]))
        + seg(0xDD, struct.pack(">H", ROW)) + seg(0xDA, bytes([1, 1, 0x00, 0, 63, 0]))
    )


def _dc_table() -> tuple[np.ndarray, np.ndarray]:
    """Code word with the end-of-block bit, and its length, for each difference
    from -255 to 255."""
    codes = {s: (c, n) for s, c, n in huffman_codes(DC_COUNTS, DC_SYMBOLS)}
    value, length = np.zeros(511, np.uint32), np.zeros(511, np.int64)
    for d in range(-255, 256):
        cat = abs(d).bit_length()
        code, n = codes[cat]
        extra = d if d >= 0 else d + (1 << cat) - 1
        value[d + 255], length[d + 255] = (code << cat | extra) << 1, n + cat + 1
    return value, length


_VALUE, _LENGTH = _dc_table()


def pad_rows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(payload rows, rows of each text): texts filled up with 255 to a positive
    multiple of 576 bytes."""
    lens = np.diff(offsets)
    rows = np.maximum(1, -(-lens // ROW))
    starts = (np.cumsum(rows) - rows) * ROW
    out = np.full(int(rows.sum()) * ROW, 255, np.uint8)
    own = data[offsets[0] : offsets[-1]]
    out[np.arange(len(own)) + np.repeat(starts - (offsets[:-1] - offsets[0]), lens)] = own
    return out.reshape(-1, ROW), rows


def pack(payload: np.ndarray, rows: np.ndarray) -> list[bytes]:
    """The JPEG bytes of each text's payload rows."""
    n = len(payload)
    level = payload.astype(np.int64) - 128
    diff = level.copy()
    diff[:, 1:] -= level[:, :-1]
    diff += 255
    length = _LENGTH[diff]
    at = np.cumsum(length, axis=1)
    row_bytes = (at[:, -1] + 7) >> 3
    row_start = np.cumsum(row_bytes) - row_bytes
    spare = row_bytes * 8 - at[:, -1]
    at -= length
    word = (_VALUE[diff].astype(np.int64) << (24 - length - (at & 7))).ravel()
    index = ((at >> 3) + row_start[:, None]).ravel()
    total = int(row_bytes.sum())
    # Bits of different codes never overlap, so sums of their bytes are unions.
    bits = np.zeros(total + 2)
    for k, shift in enumerate((16, 8, 0)):
        part = np.bincount(index, weights=(word >> shift) & 255, minlength=total)
        bits[k : k + total] += part[:total]
    stream = bits[:total].astype(np.uint8)
    stream[row_start + row_bytes - 1] |= ((1 << spare) - 1).astype(np.uint8)
    # Frames: of at most FRAME_ROWS rows each.
    frame_rows, texts = [], []
    for i, r in enumerate(rows.tolist()):
        while r > 0:
            frame_rows.append(min(r, FRAME_ROWS)), texts.append(i)
            r -= frame_rows[-1]
    frame_rows = np.array(frame_rows, np.int64)
    first = np.cumsum(frame_rows) - frame_rows
    full = np.cumsum(np.concatenate([[0], stream == 255]))[:-1]  # stuffing before each byte
    row_full = np.append(full, (stream == 255).sum())[np.append(row_start, total)]
    in_frame = np.arange(n) - np.repeat(first, frame_rows)
    head = len(_header(1))
    ends = np.append(row_start, total)
    scan = ends[first + frame_rows] - ends[first] + row_full[first + frame_rows] - row_full[first] + 2 * (frame_rows - 1)
    size = head + scan + 2
    frame_start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    shift = np.repeat(frame_start + head - row_start[first] - row_full[first], frame_rows) + 2 * in_frame
    out[np.arange(total) + full + np.repeat(shift, row_bytes)] = stream
    marks = np.flatnonzero(in_frame > 0)
    where = row_start[marks] + row_full[marks] + shift[marks] - 2
    out[where], out[where + 1] = 255, 0xD0 + (in_frame[marks] - 1) % 8
    for s, e, r in zip(frame_start.tolist(), (frame_start + size).tolist(), frame_rows.tolist()):
        out[s : s + head] = np.frombuffer(_header(r), np.uint8)
        out[e - 2], out[e - 1] = 255, 0xD9
    raw, text_end = out.tobytes(), np.cumsum(np.bincount(texts, weights=size, minlength=len(rows))).astype(np.int64).tolist()
    return [raw[a:b] for a, b in zip([0, *text_end], text_end)]


def packed(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The JPEG bytes of the texts that ``offsets`` cut out; a text that fills
    several frames is packed frame by frame."""
    if offsets[-1] - offsets[0] <= SLICE_BYTES or len(offsets) > 2:
        return pack(*pad_rows(data, offsets))
    edges = np.append(np.arange(offsets[0], offsets[1], FRAME_ROWS * ROW), offsets[1])
    return [b"".join(pack(*pad_rows(data, edges[k : k + 2]))[0] for k in range(len(edges) - 1))]


class _Tables:
    """Lookups by the next 16 bits: the DC difference with all its bits, and
    with an end of block that follows; the code alone; the AC symbol."""

    def __init__(self, dc: tuple, ac: tuple):
        self.code_len, self.cat = self._expand(dc)
        self.ac_len, self.ac_sym = self._expand(ac)
        w = np.arange(65536, dtype=np.int64)
        cat, n = self.cat.astype(np.int64), self.code_len.astype(np.int64)
        fits = (n > 0) & (n + cat <= 16)
        extra = np.where(fits, (w >> np.maximum(0, 16 - n - cat)) & ((1 << cat) - 1), 0)
        self.diff = self.extend(extra, cat)
        used = np.where(fits, n + cat, 0)
        rest = (w << used) & 0xFFFF
        eob = fits & (self.ac_len[rest] > 0) & (self.ac_sym[rest] == 0) & (used + self.ac_len[rest] <= 16)
        self.used = (used + np.where(eob, self.ac_len[rest], 0)).astype(np.int64)
        self.eob = eob

    @staticmethod
    def extend(extra, cat):
        return np.where((cat > 0) & (extra < (1 << np.maximum(cat - 1, 0))), extra - (1 << cat) + 1, extra)

    @staticmethod
    def _expand(table: tuple) -> tuple[np.ndarray, np.ndarray]:
        length, symbol = np.zeros(65536, np.int64), np.zeros(65536, np.int64)
        for s, code, n in huffman_codes(*table):
            lo = code << (16 - n)
            length[lo : lo + (1 << (16 - n))], symbol[lo : lo + (1 << (16 - n))] = n, s
        return length, symbol


_tables: dict[tuple, _Tables] = {}


def _lookup(dc: tuple, ac: tuple) -> _Tables:
    if (dc, ac) not in _tables:
        if len(_tables) > 32:
            _tables.clear()
        _tables[dc, ac] = _Tables(dc, ac)
    return _tables[dc, ac]


def parse(media: bytes, at: int = 0) -> tuple[dict, int]:
    """The frame that starts at ``at`` up to its scan data, and where these start."""
    if media[at : at + 2] != b"\xff\xd8":
        raise NotBaseline("no start of image")
    at, quant, huff, f = at + 2, {}, {}, {"restart": 0}
    while True:
        if at + 4 > len(media) or media[at] != 0xFF:
            raise NotBaseline("marker expected")
        marker = media[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        size = int.from_bytes(media[at + 2 : at + 4], "big")
        body = media[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                wide = 2 if body[0] >> 4 else 1
                quant[body[0] & 15] = int.from_bytes(body[1 : 1 + wide], "big")
                body = body[1 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                huff[body[0]] = (tuple(body[1:17]), tuple(body[17 : 17 + n]))
                body = body[17 + n :]
        elif marker == 0xDD:
            f["restart"] = int.from_bytes(body[:2], "big")
        elif marker in (0xC0, 0xC1):
            depth, f["height"], f["width"], n = struct.unpack(">BHHB", body[:6])
            if depth != 8 or not f["height"] or not f["width"]:
                raise NotBaseline("8-bit samples expected")
            f["comps"] = {body[6 + 3 * i]: (body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)}
        elif 0xC2 <= marker <= 0xCF and marker != 0xC8:
            raise NotBaseline(f"frame type {marker:02x}")
        elif marker == 0xDA:
            if "comps" not in f or body[0] != len(f["comps"]):
                raise NotBaseline("one scan with all components expected")
            try:
                f["scan"] = tuple((*f["comps"][body[1 + 2 * i]], *huff[body[2 + 2 * i] >> 4], *huff[0x10 | body[2 + 2 * i] & 15]) for i in range(body[0]))
                f["quant"] = quant[f["scan"][0][2]]
            except KeyError as e:
                raise NotBaseline("missing table") from e
            return f, at
        elif marker == 0xD9:
            raise NotBaseline("no scan")


def _blocks(scan: tuple) -> list[tuple[int, int, int]]:
    """(component, row, column) of the blocks of an MCU."""
    if len(scan) == 1:
        return [(0, 0, 0)]
    return [(c, y, x) for c, (h, v, *_) in enumerate(scan) for y in range(v) for x in range(h)]


def _decode_lanes(scan: tuple, bytes3: np.ndarray, starts: np.ndarray, mcus: np.ndarray) -> np.ndarray:
    """Luminance DC terms, lane by MCU and block, of scan data without stuffing;
    bytes3 holds every byte with its next two."""
    blocks = _blocks(scan)
    tables = [_lookup((dc_n, dc_s), (ac_n, ac_s)) for _, _, _, dc_n, dc_s, ac_n, ac_s in scan]
    luma = sum(c == 0 for c, _, _ in blocks)
    pos, last = starts * 8, len(bytes3) - 1
    pred = np.zeros((len(scan), len(starts)), np.int64)
    out = np.zeros((int(mcus.max()) if len(mcus) else 0, luma, len(starts)), np.int32)
    peek = lambda p: (bytes3[np.minimum(p >> 3, last)] >> (8 - (p & 7))) & 0xFFFF
    even = bool((mcus == mcus[0]).all()) if len(mcus) else True
    for m in range(len(out)):
        lanes = slice(None) if even else np.flatnonzero(mcus > m)
        seen = 0
        for c, _, _ in blocks:
            t, p = tables[c], pos[lanes]
            w = peek(p)
            diff, used, done = t.diff[w], t.used[w], t.eob[w]
            if (odd := np.flatnonzero(used == 0)).size:  # a code and its bits exceed the window
                n, cat = t.code_len[w[odd]], t.cat[w[odd]]
                if (n == 0).any():
                    raise NotBaseline("bad code")
                diff[odd] = t.extend(peek(p[odd] + n) >> (16 - cat) if cat.any() else np.zeros(len(odd), np.int64), cat)
                used[odd] = n + cat
            p = p + used
            todo, k = np.flatnonzero(~done), np.ones((~done).sum(), np.int64)
            while todo.size:
                w = peek(p[todo])
                n, s = t.ac_len[w], t.ac_sym[w]
                if (n == 0).any():
                    raise NotBaseline("bad code")
                p[todo] += n + (s & 15)
                k += np.where(s == 0, 64, (s >> 4) + 1)
                todo, k = todo[k < 64], k[k < 64]
            pos[lanes] = p
            pred[c][lanes] += diff
            if c == 0:
                out[m, seen][lanes] = pred[0][lanes]
                seen += 1
    return out


def unpack(media: list[bytes]) -> list[list[np.ndarray] | str]:
    """DC-only luminance thumbnails of the frames of each media value, or why
    there are none."""
    found: list = [[] for _ in media]
    frames: dict[tuple, list] = {}
    joined = b"".join(media)
    data = np.frombuffer(joined + b"\xff\xd9", np.uint8)
    ff = np.flatnonzero(data[:-1] == 255)
    following = data[ff + 1]
    restart = ff[(following >= 0xD0) & (following <= 0xD7)]
    stop = ff[(following != 0) & ((following < 0xD0) | (following > 0xD7)) & (following != 0xFF)]
    stuffed = ff[following == 0] + 1
    base = 0
    for i, m in enumerate(media):
        at = 0
        try:
            if not m:
                raise NotBaseline("empty")
            while at < len(m):
                f, start = parse(m, at)
                end = int(stop[np.searchsorted(stop, base + start)])
                f["from"], f["to"] = base + start, end
                f["slot"] = (i, len(found[i]))
                found[i].append(None)
                frames.setdefault(f["scan"], []).append(f)
                if joined[end : end + 2] != b"\xff\xd9":
                    raise NotBaseline("one scan expected")
                at = end + 2 - base
        except (NotBaseline, struct.error, IndexError) as e:
            found[i] = str(e) or "broken"
        base += len(m)
    # Scan data without stuffing and restart markers.
    keep = np.ones(len(data), bool)
    keep[stuffed] = False
    keep[restart], keep[restart + 1] = False, False
    place = np.cumsum(keep) - keep
    own = np.concatenate([data[keep], np.full(4, 255, np.uint8)]).astype(np.int64)
    bytes3 = own[:-2] << 16 | own[1:-1] << 8 | own[2:]
    for scan, group in frames.items():
        group = [f for f in group if not isinstance(found[f["slot"][0]], str)]
        starts, mcus, shapes = [], [], []
        h, v = (max(s[k] for s in scan) for k in (0, 1)) if len(scan) > 1 else (1, 1)
        for f in group:
            across, down = -(-f["width"] // (8 * h)), -(-f["height"] // (8 * v))
            every = f["restart"] or across * down
            marks = restart[np.searchsorted(restart, f["from"]) : np.searchsorted(restart, f["to"])] + 2
            n = -(-across * down // every)
            begin = np.concatenate([[f["from"]], marks])
            if len(begin) != n:
                found[f["slot"][0]] = "restart intervals missing"
                continue
            starts.append(place[begin])
            each = np.full(n, every)
            each[-1] = across * down - every * (n - 1)
            mcus.append(each), shapes.append((f, across, down, n))
        if not starts:
            continue
        try:
            dc = _decode_lanes(scan, bytes3, np.concatenate(starts), np.concatenate(mcus))
        except NotBaseline as e:
            for f, *_ in shapes:
                found[f["slot"][0]] = str(e)
            continue
        dc, lane = dc.transpose(2, 0, 1), 0
        lh, lv = (scan[0][0], scan[0][1]) if len(scan) > 1 else (1, 1)
        for f, across, down, n in shapes:
            flat = np.concatenate(list(dc[lane : lane + n]))[: across * down] if n > 1 and (across * down) % n else dc[lane : lane + n].reshape(-1, lh * lv)[: across * down]
            if n > 1 and (across * down) % n:  # the last interval is shorter
                every = f["restart"]
                flat = np.concatenate([dc[lane + i][: min(every, across * down - i * every)] for i in range(n)])
            lane += n
            grid = flat.reshape(down, across, lv, lh).transpose(0, 2, 1, 3).reshape(down * lv, across * lh)
            bh, bw = -(-f["height"] * lv // (8 * v)), -(-f["width"] * lh // (8 * h))
            i, k = f["slot"]
            if not isinstance(found[i], str):
                found[i][k] = np.clip((grid[:bh, :bw] * f["quant"] + 4) // 8 + 128, 0, 255).astype(np.uint8)
    return found


def frames_of(media: bytes) -> list[bytes]:
    """A value's frames: no end of image lies inside scan data."""
    out, at = [], 0
    while at < len(media):
        end = media.find(b"\xff\xd9", parse(media, at)[1])
        if end < 0:
            raise NotBaseline("no end of image")
        out.append(media[at : end + 2])
        at = end + 2
    return out


def unpacked(media: list[bytes]) -> list[list[np.ndarray] | str]:
    """As ``unpack``; a long value is read frame by frame."""
    if len(media) != 1 or len(media[0]) <= SLICE_BYTES:
        return unpack(media)
    thumbs: list[np.ndarray] = []
    try:
        frames = frames_of(media[0])
    except (NotBaseline, struct.error, IndexError):
        return unpack(media)  # says what is wrong
    for f in frames:
        (found,) = unpack([f])
        if isinstance(found, str):
            return [found]
        thumbs += found
    return [thumbs]


def thumbnail_hash(thumb: np.ndarray) -> int:
    """64-bit difference hash: signs of the steps between 9 column means in
    each of 8 row bands."""
    rows = np.linspace(0, thumb.shape[0], 9)[:8].astype(int)
    cols = np.linspace(0, thumb.shape[1], 10)[:9].astype(int)
    height = np.maximum(1, np.diff(np.append(rows, thumb.shape[0])))[:, None]
    width = np.maximum(1, np.diff(np.append(cols, thumb.shape[1])))[None, :]
    across = np.add.reduceat(thumb.astype(np.int64), cols, axis=1)
    mean = np.add.reduceat(across, rows, axis=0) / (height * width)
    return int.from_bytes(np.packbits(mean[:, 1:] > mean[:, :-1]).tobytes(), "big")


def store(df: DataFrame, text: str = "text", media: str = "media") -> DataFrame:
    """All other columns, ``n_bytes`` and ``media``, the JPEG form of the text."""
    keep = others(df, text, "n_bytes", media)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_bytes(column(batch, "_text"))
            for i, j in byte_slices(offsets, SLICE_BYTES):
                made = packed(data, offsets[i : j + 1])
                rows = [batch.column(k).slice(i, j - i) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*rows, pa.array(np.diff(offsets[i : j + 1])), pa.array(made, pa.binary())], names=[*(f"k{k}" for k in range(len(keep))), "n_bytes", "media"])

    given = df.select(*[F.col(c).alias(f"k{k}") for k, c in enumerate(keep)], F.col(text).alias("_text"))
    kept = given.drop("_text").schema
    return given.mapInArrow(run, kept.add("n_bytes", "long").add("media", "binary")).toDF(*keep, "n_bytes", media)


_FEATURES = "width long, height long, thumb_hash string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, media_error string"


def features(df: DataFrame, media: str = "media") -> DataFrame:
    """All other columns, and of the media: dimensions, thumbnail hash, digests
    of the stored form and of the thumbnail bytes (all frames, row by row)."""
    keep = others(df, media, *_ARROW.names)

    def row(m: bytes, frames) -> tuple:
        if isinstance(frames, str):
            return (None, None, None, None, None, None, len(m), sha256(m), None, frames)
        digest, size = hashlib.sha256(), sum(t.size for t in frames)
        for t in frames:
            digest.update(np.ascontiguousarray(t))
        tail = b"".join(t.tobytes()[-32:] for t in frames[-2:])[-32:]
        h = "".join(f"{thumbnail_hash(t):016x}" for t in frames)
        width, height = 8 * frames[0].shape[1], 8 * sum(len(t) for t in frames)
        mean = sum(int(t.sum()) for t in frames) / max(1, size)
        return (width, height, h, size, digest.hexdigest(), zlib.crc32(tail), len(m), sha256(m), f"{width}x{height}:{mean:.3f}:{h}", None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = column(batch, "_media")
            _, offsets = flat_bytes(col)
            for i, j in byte_slices(offsets, SLICE_BYTES):
                own = [x or b"" for x in col.slice(i, j - i).to_pylist()]
                made = list(zip(*map(row, own, unpacked(own))))
                rows = [batch.column(k).slice(i, j - i) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*rows, *(pa.array(x, f.type) for x, f in zip(made, _ARROW))], names=[*(f"k{k}" for k in range(len(keep))), *_ARROW.names])

    given = df.select(*[F.col(c).alias(f"k{k}") for k, c in enumerate(keep)], F.col(media).alias("_media"))
    schema = given.drop("_media").schema
    for f in _FEATURES.split(", "):
        schema = schema.add(*f.split())
    return given.mapInArrow(run, schema).toDF(*keep, *_ARROW.names)


_ARROW = pa.schema([(n, {"long": pa.int64(), "string": pa.string()}[t]) for n, t in (f.split() for f in _FEATURES.split(", "))])
