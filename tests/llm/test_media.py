import hashlib
import struct
import zlib

import numpy as np

from quillstone.llm import jpeg, queries


def test_query(spark, sf_dir):
    got = {r.doc_id: r for r in queries.op4_media_columns(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(got)
    by_text = {}
    for d, text in docs:
        raw = (text or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        r = got[d]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert by_text.setdefault(text, (r.media_bytes, r.media_sha256, r.feature)) == (r.media_bytes, r.media_sha256, r.feature)


def _thumbs(texts):
    raw = [t.encode() for t in texts]
    media = jpeg.pack(*jpeg.pad_rows(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])))
    return raw, media, jpeg.unpack(media)


def test_round_trip():
    texts = ["", "a", "x" * 576, "y" * 577, "ÿþ" * 900, "z" * (576 * jpeg.FRAME_ROWS + 5)]
    for raw, media, frames in zip(*_thumbs(texts)):
        payload = b"".join(f.tobytes() for f in frames)
        assert payload.startswith(raw) and len(payload) % 576 == 0 and set(payload[len(raw) :]) <= {255}
    assert len(jpeg.unpack(_thumbs(texts)[1])[-1]) == 2  # frames


def _bits(values):
    s = "".join(f"{v:0{n}b}" for v, n in values)
    s += "1" * (-len(s) % 8)
    return bytes(int(s[i : i + 8], 2) for i in range(0, len(s), 8)).replace(b"\xff", b"\xff\x00")


def test_foreign_jpeg_with_chroma_ac_and_no_restart():
    """4:2:0, 3 components, AC terms that must be skipped, written by hand."""
    rng = np.random.default_rng(3)
    dc_codes = {s: (c, n) for s, c, n in jpeg.huffman_codes((0, 0, 0, 12) + (0,) * 12, tuple(range(12)))}
    ac = ((0, 0, 3, 1) + (0,) * 12, (0x00, 0x21, 0xF0, 0x08))
    ac_codes = {s: (c, n) for s, c, n in jpeg.huffman_codes(*ac)}
    luma = rng.integers(-40, 40, (2, 3, 2, 2))  # MCU rows, MCUs, blocks
    bits, pred = [], [0, 0, 0]
    for y in range(2):
        for x in range(3):
            for comp, value in [(0, v) for v in luma[y, x].ravel()] + [(1, int(rng.integers(-1000, 1000))), (2, 5)]:
                d = int(value) - pred[comp]
                pred[comp] = int(value)
                cat = abs(d).bit_length()
                bits += [dc_codes[cat], (d if d >= 0 else d + (1 << cat) - 1, cat)] if cat else [dc_codes[0]]
                bits += [ac_codes[0xF0], ac_codes[0x21], (1, 1), ac_codes[0x08], (200, 8), ac_codes[0x00]]
    bits = [(v, n) for v, n in bits if n]
    seg = lambda m, b: struct.pack(">BBH", 255, m, len(b) + 2) + b
    media = b"\xff\xd8" + seg(0xE0, b"JFIF\0") + seg(0xDB, bytes([0] + [16] * 64)) + seg(0xC0, struct.pack(">BHHB", 8, 30, 41, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0]))
    media += seg(0xC4, bytes([0, *(0, 0, 0, 12), *([0] * 12), *range(12)])) + seg(0xC4, bytes([0x10, *ac[0], *ac[1]])) + seg(0xDA, bytes([3, 1, 0, 2, 0, 3, 0, 0, 63, 0])) + _bits(bits) + b"\xff\xd9"
    (frames,) = jpeg.unpack([media])
    want = np.clip(luma.transpose(0, 2, 1, 3).reshape(4, 6) * 2 + 128, 0, 255)
    assert (frames[0] == want[:4, :6]).all()


def test_edge_cases(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "é" * 300_000, None), (3, "é" * 300_000, None)], "doc_id long, text string, width int")
    out = jpeg.features(jpeg.store(df.withColumnRenamed("width", "media_width"))).orderBy("doc_id").collect()
    assert [r.payload_bytes for r in out] == [576, 576, 600192, 600192] and out[2].media_sha256 == out[3].media_sha256
    assert jpeg.features(jpeg.store(df.limit(0).select("doc_id", "text"))).count() == 0
    bad = spark.createDataFrame([(1, b"abc"), (2, None), (3, b"\xff\xd8\xff\xc2\x00\x02")], "doc_id long, media binary")
    assert [r.media_error is not None and r.feature is None for r in jpeg.features(bad).collect()] == [True] * 3


def test_long_texts_frame_by_frame(spark):
    import resource

    frame = jpeg.FRAME_ROWS * jpeg.ROW
    texts = ["a\u00e9" * 900_000, "z" * (2 * frame), "z" * (2 * frame + 1), "short"]
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for t in texts:
        raw = t.encode()
        (media,) = jpeg.packed(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        (thumbs,) = jpeg.unpacked([media])
        back = b"".join(x.tobytes() for x in thumbs)
        assert back.rstrip(b"\xff") == raw and len(back) % jpeg.ROW == 0
        assert media == b"".join(jpeg.frames_of(media)) and len(jpeg.frames_of(media)) == len(thumbs) == max(1, -(-len(raw) // frame))
        if len(raw) < 3 * frame:
            assert media == jpeg.pack(*jpeg.pad_rows(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])))[0]
    assert jpeg.unpacked([media + b"\xff" * (jpeg.SLICE_BYTES + 9)])[0] == "no start of image"
    # 64 MB in bounded memory: text, media and thumbnails, and one frame's work.
    big = np.full(64 << 20, 97, np.uint8)
    (media,) = jpeg.packed(big, np.array([0, len(big)]))
    assert sum(x.size for x in jpeg.unpacked([media])[0]) >= len(big)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 700_000
