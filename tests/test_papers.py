import json

import pytest

from quillstone.sources import ledger, papers


def test_tree_of_broken_pages():
    root = papers.Tree("<div class='a b'><p>x<br>y</i></p>z<li>1<li>2</div><span>t").root
    assert [n.text() for n in root.find("div")] == ["x y z 1 2"] and [n.text() for n in root.find(css="b")] == ["x y z 1 2"]
    assert [n.text() for n in root.find("span")] == ["t"] and next(root.find("p")).text() == "x y"
    assert papers.Tree("").root.text() == "" and papers.Tree("<div>" * 50_000).root.text() == ""


def test_buba_paper_dates(spark):
    file = "/resource/blob/1/0af/9CD/{}-data.pdf"
    pages = spark.createDataFrame([
        ("https://d/1", f'<title>T</title>05.04.2012 <a href="{file.format("2011-02-03-dkp-04")}">f</a>'),
        ("https://d/2", f'<meta property="og:title" content=" O "><p>05.04.2012</p>"{file.format("x")}"'),
        ("https://d/3", f"31.02.2012 {file.format('2011-13-03-dkp-04')}"), ("https://d/4", "none"), ("https://d/5", None),
    ], "url string, html string")
    got = {r.page_url[-1]: (str(r.published), r.title) for r in papers.buba_papers(pages).collect()}
    assert got == {"1": ("2011-02-03", "T"), "2": ("2012-04-05", "O"), "3": ("None", "")}


def test_legacy_index(spark):
    pages = spark.createDataFrame([("https://e/a/", '<a href="x20210304.PDF">t</a><a href="/b/20219999.pdf"></a><a href="c.html">u</a>')], "url string, html string")
    got = [(str(r.date), r.title, r.link_url) for r in papers.legacy_index(pages).orderBy("pos").collect()]
    assert got == [("2021-03-04", "t", "https://e/a/x20210304.PDF"), ("None", "/b/20219999.pdf", "https://e/b/20219999.pdf")]
    assert papers.legacy_index(pages, "/b/").count() == 1


def test_split_legacy(spark, tmp_path):
    lines = [json.dumps({"bank_code": b, "doc_id": f"d{k}"}, indent=None) + " " * (k % 2) for k, b in enumerate(["us", "ecb", "us", None, "us"])]
    (tmp_path / "all.jsonl").write_text("\n".join([*lines, ""]))
    root = str(tmp_path / "split")
    assert ledger.split_legacy(spark, str(tmp_path / "all.jsonl"), root) == 3
    got = [r.value for r in spark.read.text(f"{root}/bank_code=us").collect()]
    assert got == [lines[0], lines[2], lines[4]]
    assert sorted(r.doc_id for r in ledger.read_ledger(spark, root, ["us", "ecb"]).collect()) == ["d0", "d1", "d2", "d4"]
    with pytest.raises(Exception, match="already exists"):
        ledger.split_legacy(spark, str(tmp_path / "all.jsonl"), root)
    (tmp_path / "bad.jsonl").write_text('{"a\n{}\n')
    with pytest.raises(ledger.TornMiddle):
        ledger.split_legacy(spark, str(tmp_path / "bad.jsonl"), root + "2")


def test_artefacts_and_audit(spark, tmp_path):
    rows = spark.createDataFrame([("raw/us/C1/2020/a.pdf", bytearray(b"x" * 5)), ("raw/us/C1/2020/b.html", None)], "path string, body binary")
    for _ in range(2):
        assert sorted(tuple(r) for r in ledger.save_artefacts(rows, str(tmp_path)).collect()) == [("raw/us/C1/2020/a.pdf", 5), ("raw/us/C1/2020/b.html", 0)]
    assert (tmp_path / "raw/us/C1/2020/a.pdf").read_bytes() == b"xxxxx"
    assert sorted(p.name for p in (tmp_path / "raw/us/C1/2020").iterdir()) == ["a.pdf", "b.html"]
    audit = spark.createDataFrame([("us", "list", "u", "e")], "bank string, context string, url string, error string")
    for _ in range(2):
        ledger.append_audit(audit, str(tmp_path / "audit"))
    assert spark.read.json(str(tmp_path / "audit")).count() == 2
