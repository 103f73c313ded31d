"""Inputs that once killed a job or lost rows without a word."""

import json

import pytest

from quillstone.operators import dedup, matching
from quillstone.sources import catalogues, html, ledger


def _line(k, bank="us"):
    return json.dumps({"bank_code": bank, "doc_id": f"d{k}", "title": "Zinsen für Österreich", "year": 2000})


def test_a_broken_line_stops_the_reader(spark, tmp_path):
    (tmp_path / "us.jsonl").write_text("\n".join([_line(1), '{"bank_code": "us", "doc', _line(3)]) + "\n")
    with pytest.raises(ledger.TornMiddle, match=r"us\.jsonl:2"):
        ledger.read_ledger(spark, str(tmp_path))


def test_a_torn_tail_is_left_out(spark, tmp_path):
    (tmp_path / "us.jsonl").write_bytes((_line(1) + "\n" + _line(2) + "\n").encode() + _line(3).encode()[:50])
    (tmp_path / "ecb.jsonl").write_text(_line(4, "ecb"))
    assert sorted(r.doc_id for r in ledger.read_ledger(spark, str(tmp_path)).collect()) == ["d1", "d2", "d4"]


def test_only_the_banks_files_are_read(spark, tmp_path):
    (tmp_path / "us.jsonl").write_text("\n".join(["{broken", _line(1)]))
    (tmp_path / "ecb.jsonl").write_text(_line(2, "ecb"))
    rows = ledger.read_ledger(spark, str(tmp_path), ["ecb"])
    assert [r.doc_id for r in rows.collect()] == ["d2"] and all(f.endswith("ecb.jsonl") for f in rows.inputFiles())


def test_pages_of_other_encodings_and_bad_links(spark):
    body = '<html><title>Größe</title><a href="http://[x">bad</a><a href="/b.pdf">good</a></html>'
    pages = spark.createDataFrame([("https://h/a", bytearray(body.encode("latin-1"))), ("https://h/c", bytearray(body.encode()))], "url string, body binary")
    got = html.page_links(pages, body="body").collect()
    assert sorted((r.page_url, r.link_url or "") for r in got) == [("https://h/a", ""), ("https://h/a", "https://h/b.pdf"), ("https://h/c", ""), ("https://h/c", "https://h/b.pdf")]
    assert {r.page_title for r in html.page_metas(pages, body="body").collect()} == {"Größe"}
    site = spark.createDataFrame([("u", bytearray("<url><loc>https://h/ö</loc></url>".encode("latin-1")))], "url string, body binary")
    assert [r.loc for r in catalogues.sitemap_entries(site).collect()] == ["https://h/ö"]


def test_every_capture_counts(spark):
    n = 1_000_001
    body = json.dumps([["timestamp"], *([str(k)] for k in range(n))])
    responses = spark.createDataFrame([("u", body), ("v", "[]"), ("w", None)], "url string, body string")
    assert catalogues.archive_captures(responses).count() == n


def test_ties_and_repeated_rows(spark):
    rows = spark.createDataFrame([(1, "x", "b"), (1, "x", "a"), (1, "x", "a"), (2, "x", "c")], "id int, text string, other string")
    assert [(r.id, r.other) for r in dedup.content_dedup(rows, "text", "id").collect()] == [(1, "a")]
    assert [r.other for r in dedup.first_by(rows, ["text"], ["id"]).collect()] == ["a"]


def test_labels_without_broadcast(spark):
    labels = spark.createDataFrame([("e", "one"), ("of", "two"), ("bank of", "three"), ("zz", "four")], "label_norm string, primary_label string")
    texts = spark.createDataFrame([(1, "the bank of russia"), (2, "one"), (2, "one"), (3, "kkk"), (4, ""), (5, None)], "id int, text_norm string")
    out = matching.longest_label(texts, labels)
    assert sorted((r.id, r.primary_label or "") for r in out.collect()) == [(1, "three"), (2, "one"), (2, "one"), (3, ""), (4, ""), (5, "")]
    assert "NestedLoop" not in out._jdf.queryExecution().toString()


def test_propose_equals_all_pairs(spark, monkeypatch):
    import difflib
    import random

    rng = random.Random(2)
    words = "bank rate policy money growth credit risk trade debt wage".split()
    make = lambda n, banks: [(b, k, " ".join(rng.choices(words, k=rng.randrange(0, 6)))) for k in range(n) for b in banks]
    wanted, pool = make(25, "ab"), [*make(40, "a"), *make(3, "c")]
    pool += [("a", 99, None)]
    monkeypatch.setattr(matching, "BLOCK", 7)
    w = spark.createDataFrame(wanted, "bank string, listing_pos int, title_norm string")
    p = spark.createDataFrame([(b, f"d{k}", k, t) for b, k, t in pool], "bank string, doc_id string, seq int, title_norm string")
    got = sorted((r.bank, r.listing_pos, r["rank"], r.doc_id or "", r.score or "") for r in matching.propose(w, p).collect())
    want = []
    for b, k, t in wanted:
        scored = sorted((-round(difflib.SequenceMatcher(None, t, x or "").ratio(), 3), s, f"d{s}") for bank, s, x in pool if bank == b)[:3]
        want += [(b, k, i, d, str(-s or 0.0)) for i, (s, _, d) in enumerate(scored, 1)] or [(b, k, 1, "", "")]
    assert got == sorted(want)
