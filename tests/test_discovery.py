import datetime
import json

import pytest
from pyspark.sql import functions as F

from quillstone import cli, dims
from quillstone.operators import discovery
from quillstone.sources import connectors, html

D = datetime.date


def test_scopes():
    assert discovery.parse_years("2015-2017") == [2015, 2016, 2017] and discovery.parse_years("2020") == [2020]
    assert discovery.parse_scope(None, ["A1", "G1"]) == ["A1"] and discovery.parse_scope("g1", ["A1", "G1"]) == ["G1"]
    with pytest.raises(KeyError):
        discovery.parse_scope("Z9", ["A1"])


def test_new_candidates_use_two_sets(spark):
    held = spark.createDataFrame([("p1", ["p2"], "s1"), ("p3", None, "")], "pdf_url string, alt_urls array<string>, source_url string")
    found = spark.createDataFrame([("p1", "x"), ("p2", "x"), ("p9", "s1"), ("s1", "p3"), ("p8", None), ("p7", "")], "pdf_url string, source_url string")
    assert sorted(r.pdf_url for r in discovery.new_candidates(found, held).collect()) == ["p7", "p8", "s1"]


def test_landing_pages(spark):
    listing = spark.createDataFrame([("u1", D(2020, 3, 1), "list"), ("u2", D(2020, 3, 1), ""), ("https://x/u3.html", None, "")], "link_url string, date date, title string")
    metas = spark.createDataFrame([("u1", "Page", D(2020, 3, 9)), ("u2", "(untitled)", D(2020, 5, 9))], "page_url string, page_title string, published date")
    got = {r.link_url: (r.date, r.date_precision, r.title) for r in discovery.with_landing(listing, metas).collect()}
    assert got == {"u1": (D(2020, 3, 9), "day", "Page"), "u2": (D(2020, 3, 1), "month", "u2"), "https://x/u3.html": (None, None, "u3.html")}


def test_tables_and_paging(spark):
    body = """<table><tr><th>Date</th><th>Title</th></tr><tr><td>Apr. 2002</td><td><a href="wp02e01.pdf">A paper on rates</a></td></tr>
    <tr><td>No. 2</td><td>Another and longer paper</td><td><a href="/data/wp02e02.pdf">PDF</a></td><td>Nov. 13, 2002</td></tr></table><a href="?pageNumString=7">7</a><a href="?pageNumString=12">12</a>"""
    pages = spark.createDataFrame([("https://b/wps/index.htm", body)], "url string, html string")
    got = [(r.date, r.date_precision, r.title, r.link_url) for r in html.table_papers(pages, r"\.pdf$").orderBy("pos").collect()]
    assert got == [(D(2002, 4, 1), "month", "A paper on rates", "https://b/wps/wp02e01.pdf"), (D(2002, 11, 13), "day", "Another and longer paper", "https://b/data/wp02e02.pdf")]
    assert html.page_count(pages).first().last_page == 12


def test_speeches(spark):
    entries = spark.createDataFrame([("p1", "d1", D(2023, 5, 18)), ("p2", "d2", D(2023, 5, 18))], "pdf_url string, detail_url string, date date")
    metas = spark.createDataFrame([("d1", "Jane Doe: on", "Speech by Ms Jane Doe, Governor of the Bank of Latvia, at the Bank of England, London", "t"), ("d2", "x", "Nobody at the Bank of England", "t")], "page_url string, og_title string, og_description string, page_title string")
    got = discovery.attribute_speeches(entries, metas, dims.labels(spark)).collect()
    assert [(r.bank_code, r.pdf_url) for r in got] == [("lv", "p1")]


def test_within_run_and_archive(spark):
    rows = spark.createDataFrame([("k", 2), ("k", 1), (None, 3), (None, 4)], "key string, seq int")
    assert sorted(r.seq for r in discovery.within_run(rows, "key", "seq").collect()) == [1, 3, 4]
    captures = spark.createDataFrame([("http://x/2003/a.pdf", "2004"), ("http://x/2003/a.pdf", "2006"), ("http://x/b.html", "2004")], "original string, stamp string")
    (r,) = discovery.archive_documents(captures, "gb", "E1", r"\.pdf$").collect()
    assert (r.pdf_url, r.date, r.title) == ("https://web.archive.org/web/2006id_/http://x/2003/a.pdf", D(2003, 1, 1), "a.pdf")


def test_routing(spark):
    cols = "doc_type string, pdf_url string"
    own, shared = spark.createDataFrame([("A1", "a"), ("G1", "g")], cols), spark.createDataFrame([("D1", "d")], cols)
    assert discovery.route(own, shared, ["A1", "D1"]).count() == 2
    assert [r.tag for r in discovery.route(own, shared, ["A1", "D1"], native_only=True).collect()] == ["native"]


def test_connector_reads_local_files(spark, tmp_path):
    f = tmp_path / "a.txt"
    f.write_text("hello")
    wanted = spark.createDataFrame([(f.as_uri(),), (f.as_uri(),), ((tmp_path / "none").as_uri(),)], "url string")
    got = {r.url: (bytes(r.body), r.error) for r in connectors.fetch(wanted, delay=0.01).collect()}
    assert got[f.as_uri()] == (b"hello", "") and got[(tmp_path / "none").as_uri()][1].startswith("URLError")


def test_commands(spark, tmp_path, capsys):
    (tmp_path / "l").mkdir()
    rows = [{"bank_code": "us", "doc_type": "A3", "date": "2024-01-31", "year": 2024, "doc_id": "1", "title": "t", "pdf_url": "p", "provenance": "bank_site", "language": "en"}]
    path = tmp_path / "l" / "us.jsonl"
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    assert cli.run(spark, ["report", str(path), "--years", "2024", "--banks", "us", "--csv", str(tmp_path / "r")]) == 0
    assert "partial" in capsys.readouterr().out
    assert cli.run(spark, ["inventory", str(path)]) == 0 and "1 documents, 2024 to 2024" in capsys.readouterr().out
    assert cli.run(spark, ["validate", str(path)]) == 0
    path.write_text(path.read_text() + '{"bank')
    assert cli.run(spark, ["validate", str(path)]) == 1
    with pytest.raises(SystemExit):
        cli.run(spark, ["report", str(path)])
