"""Operators on small fixtures: order of claims, tiers, guards, convergence."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from quillstone import dims, schema
from quillstone.operators import coverage, dedup, matching, rag, recovery
from quillstone.plans.catalogue import QUERIES
from quillstone.sources import catalogues, html, ledger
from quillstone.streaming import ledger_stream


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_dimensions(spark):
    assert dims.banks(spark).count() == 63 and dims.doc_types(spark).where("in_scope").count() == 16
    assert dims.labels(spark).count() == 86
    assert dims.supported_types(spark).where("bank_code = 'ecb'").orderBy("pos").toPandas().doc_type.tolist() == ["A1", "A2", "A3", "E4", "D1", "D2", "C1"]


def test_save_decisions_claim_in_order(spark):
    new = [("a", "h1", 1), ("a", "h2", 2), ("b", "h2", 3), ("c", "h1", 4), ("d", None, 5), ("k", "h9", 6), ("e", "h0", 7), ("f", None, 8), ("f", "h5", 9)]
    df = spark.createDataFrame(new, "doc_id string, sha256 string, seq int").repartition(3)
    held = spark.createDataFrame([("k", "h0")], "doc_id string, sha256 string")
    got = dict((r.seq, r.status) for r in dedup.save_decisions(df, held).collect())
    assert got == {1: "saved", 2: "exists", 3: "saved", 4: "duplicate_content", 5: "download_failed", 6: "exists", 7: "duplicate_content", 8: "download_failed", 9: "saved"}
    # Saved again, nothing is new.
    saved = df.join(dedup.save_decisions(df, held).where("status = 'saved'"), ["doc_id", "sha256", "seq"], "left_semi")
    assert dedup.save_decisions(saved, saved).where("status = 'saved'").count() == 0


def test_incremental_listing(spark):
    items = [("s", p, k, f"u{p}{k}") for p in range(4) for k in range(2)]
    df = spark.createDataFrame(items, "series string, page int, pos int, url string")
    known = spark.createDataFrame([("u10",), ("u20",), ("u21",)], "url string")
    assert rows(dedup.incremental_listing(df, known), "url") == [("u00",), ("u01",), ("u11",)]
    assert len(rows(dedup.incremental_listing(df, known, stop_on_known=False), "url")) == 5
    assert rows(dedup.incremental_listing(df, known, cap=3), "url") == [("u00",), ("u01",)]


def test_converge():
    results = iter([{"saved": 2, "errors": 1}, {"saved": 0, "errors": 0}, {"saved": 9}])
    assert len(dedup.converge(lambda: next(results))) == 2
    assert len(dedup.converge(lambda: {"saved": 1}, dry_run=True)) == 1


def test_status_rules(spark):
    cases = [(None, 1, "ok"), (None, 0, "unknown"), (8, 8, "ok"), (8, 0, "missing"), (8, 1, "partial"), (0, 0, "unknown"), (0, 2, "partial")]
    df = spark.createDataFrame(cases, "e int, g int, want string")
    assert df.where(coverage.status(F.col("e"), F.col("g")) != F.col("want")).count() == 0


def test_completeness_golden_case(spark):
    held = spark.createDataFrame([("us", "A3", 2024)], "bank_code string, doc_type string, year int")
    grid = coverage.grid(spark, dims.banks(spark).where("bank_code = 'us'"), dims.supported_types(spark), [2024])
    got = {r.doc_type: (r.expected, r.downloaded, r.ratio, r.status) for r in coverage.completeness(held, grid, dims.expected(spark)).collect()}
    assert got["A3"] == (8, 1, 0.12, "partial") and got["F1"][3] == "missing" and got["C1"][3] == "unknown"


def test_apply_guards_are_sequential(spark):
    p = "https://pages/"
    cols = "line int, bank string, page_url string, doc_id string, approve string"
    df = spark.createDataFrame([(1, "ecb", p + "1", "d1", "x"), (2, "ecb", p + "2", "d1", "YES "), (3, "ecb", p + "2", "d2", "oui"), (4, "ecb", p + "2", "d3", "1"), (5, "ecb", "http://x", "d3", "1"), (6, "ecb", p + "9", "gone", "1"), (7, "ecb", p + "9", "d4", "1"), (8, "ecb", p + "9", "d5", "1"), (9, "ecb", p + "9", "d3", None), (10, "ecb", p + "held", "d3", "x")], cols)
    held = spark.createDataFrame([("ecb", "d1", "D1", ""), ("ecb", "d2", "D2", None), ("ecb", "d3", "D1", ""), ("ecb", "d4", "A1", ""), ("ecb", "d5", "D1", p + "held")], "bank string, doc_id string, doc_type string, source_url string")
    got = {r.line: r.skip_reason for r in matching.apply_approved(df, held, p).collect()}
    assert got == {1: None, 2: "duplicate-doc-id", 3: None, 4: "duplicate-ideas-url", 5: "bad-ideas-url", 6: "row-gone", 7: "bad-doc-type", 8: "source-not-empty", 9: "not-approved", 10: "duplicate-ideas-url"}


def test_reconcile_second_pass(spark):
    cols = "bank string, listing_pos int, page_url string, handle string, key string, title_norm string"
    entries = spark.createDataFrame([("b", 1, "p1", "h1", None, ""), ("b", 2, "p2", None, "k2", "t"), ("b", 3, "p3", None, None, "t3"), ("b", 4, "p4", None, None, ""), ("b", 5, "p5", None, "k2", ""), ("b", 6, "seen", None, None, "")], cols)
    held = spark.createDataFrame([("b", "d1", "", "h1", None, "", ["u1"]), ("b", "d2", "", None, "k2", "t", ["u2"]), ("b", "d4", "", None, None, "", ["u4"]), ("b", "d6", "seen", None, None, "", [])], "bank string, doc_id string, source_url string, handle string, key string, title_norm string, urls array<string>")
    pages = spark.createDataFrame([("p4", "u4", ""), ("p3", "none", "nothing")], "page_url string, url_norm string, title_norm string")
    got = {r.listing_pos: (r.action, r.doc_id) for r in matching.reconcile(entries, held, pages).collect()}
    assert got == {1: ("stamp", "d1"), 2: ("stamp", "d2"), 3: ("unmatched", None), 4: ("stamp", "d4"), 5: ("ambiguous", "d2"), 6: ("already", None)}


def test_propose(spark):
    wanted = spark.createDataFrame([("b", 1, "monetary policy and growth"), ("c", 2, "x")], "bank string, listing_pos int, title_norm string")
    pool = spark.createDataFrame([("b", f"d{k}", k, t) for k, t in enumerate(["monetary policy and growth", "monetary policy", "fish", "monetary policy"])], "bank string, doc_id string, seq int, title_norm string")
    got = rows(matching.propose(wanted, pool), "listing_pos", "rank", "doc_id", "score")
    assert [g[2] for g in got] == ["d0", "d1", "d3", None] and got[0][3] == "1.0" and got[3][3] is None


def test_nearest_equals_all_pairs(spark, monkeypatch):
    import random

    def distance(a, b):
        if a is None or b is None:
            return None
        row = list(range(len(b) + 1))
        for x, c in enumerate(a, 1):
            new = [x]
            for y, d in enumerate(b, 1):
                new.append(min(row[y] + 1, new[-1] + 1, row[y - 1] + (c != d)))
            row = new
        return row[-1]

    rng = random.Random(7)
    title = lambda: rng.choice([None, "", "same", *("".join(rng.choice("abdß\U0001f642 ") for _ in range(rng.choice([2, 5, 80]))) for _ in range(4))])
    wanted = [(rng.choice(["b", "c", "few", "none", None]), k // 2, title()) for k in range(90)]
    pool = [(rng.choice(["b", "b", "c", None]), k, title()) for k in range(120)] + [("few", 900, None), ("few", 901, "x")]
    monkeypatch.setattr(matching, "BLOCK", 9)
    got = matching.nearest(spark.createDataFrame(wanted, "bank string, listing_pos int, title_norm string"), spark.createDataFrame(pool, "bank string, doc_id int, title_norm string")).collect()
    want = []
    for pos in {w[1] for w in wanted}:
        pairs = [(distance(w, p), d) for b, k, w in wanted if k == pos for c, d, p in pool if b is not None and b == c]
        want += [(pos, d, x) for x, d in sorted(pairs, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:3]]
    key = lambda r: (r[0], r[1], str(r[2]))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_longest_label(spark):
    labels = spark.createDataFrame([("bank", "A"), ("bank of russia", "B")], "label_norm string, primary_label string")
    texts = spark.createDataFrame([(1, "the bank of russia said"), (2, "nothing")], "id int, text_norm string")
    assert rows(matching.longest_label(texts, labels), "id", "primary_label") == [(1, "B"), (2, None)]


def test_migration(spark):
    left = spark.createDataFrame([("aaa", "k1", "u", "t", "repec"), ("bbb", "k2", "u", "t", "bank_site"), ("ccc", None, "u9", "t9", "repec"), ("fff", None, "u5", "zz", "repec")], "doc_id string, key string, url_norm string, title_norm string, date_source string")
    native = spark.createDataFrame([(1, "k1", "u1", "t1"), (2, "k1", "u1b", "t1"), (3, "k2", "u2", "t2"), (4, "k3", "u5", "t3")], "seq int, key string, url_norm string, title_norm string")
    matched = matching.match_cascade(left, native, "doc_id")
    assert rows(matched.where("match_type is not null"), "doc_id", "match_type", "native_seq") == [("aaa", "key", 1), ("bbb", "key", 3), ("fff", "url", 4)]
    s = matching.migration_summary(matched, native).first()
    assert (s.manifest_total, s.matched_key, s.matched_url, s.already_day, s.unmatched_manifest, s.native_total, s.native_only) == (4, 2, 1, 1, 1, 4, 1)


D = datetime.date


def test_recover_dates(spark):
    cols = "doc_id string, doc_type string, date date, date_precision string, source_url string, repec_handle string, title_norm string, pdf_url string, alt_urls array<string>, seq int"
    r = lambda d, t, when, seq, url="", precision="month": (d, "D1", when, precision, "", "", t, url, None, seq)
    df = spark.createDataFrame([r("idx", "known", D(2002, 1, 1), 1), r("pdf", "a", D(2002, 1, 1), 2), r("arc", "b", D(2002, 1, 1), 3, "http://x/1pap.pdf"), r("old", "c", D(1996, 1, 1), 4, "http://x/2"), r("day", "d", D(2002, 1, 1), 5, precision="day"), r("nokey", "", D(2002, 1, 1), 6), r("same", "a", D(2002, 1, 1), 7), r("before", "s", D(2002, 1, 1), 8), r("null", "e", D(2002, 1, 1), 9, precision=None)], cols)
    index = spark.createDataFrame([("t:known", "2002-01-15", "wayback")], "key string, date string, date_source string")
    captures = spark.createDataFrame([("http://x/1abs.html", "20020129141357"), ("http://x/2", "19960105000000")], "original string, stamp string")
    pdf = lambda d: bytearray(f"/CreationDate(D:{d}".encode())
    bodies = spark.createDataFrame([("pdf", pdf("20020120")), ("arc", pdf("20020201")), ("nokey", pdf("20020120")), ("null", pdf("20020103"))], "doc_id string, body binary")
    got = {x.doc_id: (x.new_date, x.date_source, x.from_index) for x in recovery.recover_dates(df, index, captures, bodies).collect()}
    assert got == {"idx": (D(2002, 1, 15), "wayback", True), "pdf": (D(2002, 1, 20), "pdf_meta", False), "arc": (D(2002, 1, 29), "wayback", False), "same": (D(2002, 1, 20), "pdf_meta", False), "null": (D(2002, 1, 3), "pdf_meta", False)}
    assert rows(recovery.recover_dates(df, index, captures, bodies, apply_only=True), "doc_id") == [("idx",)]


def test_failures(spark):
    f = spark.createDataFrame([("p1", ["a1"], "s1", 1), ("p2", None, "s2", 2), ("p3", ["a3"], "s3", 3), ("p4", None, None, 4), ("p1", ["a1"], "s1b", 5)], "pdf_url string, alt_urls array<string>, source_url string, pos int")
    inv = ledger.inventory(f)
    assert rows(inv, "pdf_url", "pos", "source_url")[0] == ("p1", 1, "s1b")
    held = spark.createDataFrame([("a1", None, "")], "pdf_url string, alt_urls array<string>, source_url string")
    captures = spark.createDataFrame([("c2", "2001"), ("c2", "2003"), ("a3", "2002")], "original string, stamp string")
    fresh = spark.createDataFrame([("p2", ["zz", "c2"])], "pdf_url string, candidates array<string>")
    outcomes = spark.createDataFrame([("p3", "saved")], "pdf_url string, status string")
    got = {r.pdf_url: (r.action, r.snapshot_url) for r in recovery.classify_failures(inv, held, captures, fresh, outcomes).collect()}
    assert got == {"p1": ("converged", None), "p2": ("recoverable", "https://web.archive.org/web/2003id_/c2"), "p3": ("recovered", "https://web.archive.org/web/2002id_/a3"), "p4": ("unrecoverable", None)}


def test_page_metas_decodes_references(spark):
    pages = spark.createDataFrame([("https://a", "<h1>R&amp;D &quot;x&quot; &eacute; &amp</h1>")], "url string, html string")
    assert html.page_metas(pages).first().page_title == 'R&D "x" \u00e9 &'


PAGE = """<html><head><title> A  page </title><meta name="citation_title" content="Paper"><meta name="date" content="2020-02-02">
<meta name="citation_publication_date" content="2019/07"><meta property="og:title" content="first"><meta property="og:title" content="last "></head>
<body><h1>Head <b>line</b></h1><a href="/monetarypolicy/files/fomcminutes20240131.pdf">Minutes</a><a href="/monetarypolicy/files/fomcminutes20240131.pdf">PDF</a>
<a href="https://other.org/x.pdf">other</a><a href="https://www.bis.org/review/r230518a.pdf">Speech 18 May</a><a href=/p/ecb/ecbwps/20253124.html>By citations</a>
<a href="/p/ecb/ecbwps/20253124.html">A long title</a><input name="url" value="https://www.ecb.europa.eu/pub/y.pdf"><table><tr><th>Date</th><td>x <i>y</i></td></tr></table>
<div data-snippets="a.html, b.html,"></div><script>"https:\\/\\/raw.org\\/z.pdf"</script></body>"""


def test_html(spark):
    pages = spark.createDataFrame([("https://www.federalreserve.gov/m/list.htm", PAGE), ("https://e", None)], "url string, html string")
    minutes = html.listing(pages, html.LAYOUT["fomc_minutes"]).collect()
    assert [(m.date, m.title, m.link_url) for m in minutes] == [(D(2024, 1, 31), "Minutes", "https://www.federalreserve.gov/monetarypolicy/files/fomcminutes20240131.pdf")]
    assert [m.date for m in html.listing(pages, html.LAYOUT["speech_pdf"]).collect()] == [D(2023, 5, 18)]
    m = html.page_metas(pages).where("page_title <> '(untitled)'").first()
    assert (m.page_title, m.published, m.og_title) == ("Paper", D(2019, 7, 1), "last")
    c = html.pdf_candidates(pages, F.lit("ecb.europa.eu")).where("size(candidates) > 0").first()
    assert c.candidates[:2] == ["https://www.ecb.europa.eu/pub/y.pdf", "https://www.bis.org/review/r230518a.pdf"] and c.n_own == 1
    assert rows(html.series_listing(pages, "ecb", "ecbwps"), "paper_id", "title") == [("20253124", "A long title")]
    assert html.table_rows(pages).first().cells == ["Date", "x y"]
    assert [r.include_url for r in html.include_snippets(pages).collect()] == ["https://www.federalreserve.gov/m/a.html", "https://www.federalreserve.gov/m/b.html"]
    assert rows(html.raw_links(pages, r"https?://raw[^\"]+"), "match") == [("https://raw.org/z.pdf",)]
    half = pages.limit(1).select(html.speaker_half(F.lit("Jane Doe, Governor, at the conference in X")).alias("x")).first().x
    assert half == "Jane Doe, Governor,"


def test_sitemaps_and_catalogues(spark):
    index = "<sitemapindex><sitemap><loc>https://x/sitemap_documents_2023.xml</loc></sitemap></sitemapindex>"
    year = "<urlset><url><loc>https://x/review/r230518a.pdf</loc><lastmod>2023-05-19T01:00:00Z</lastmod></url><url><loc>https://x/a&amp;b</loc></url></urlset>"
    snaps = spark.createDataFrame([("root", index), ("https://x/sitemap_documents_2023.xml", year)], "url string, body string")
    found = rows(catalogues.walk_sitemaps(snaps.where("url = 'root'"), snaps), "loc", "lastmod")
    assert found == [("https://x/a&b", None), ("https://x/review/r230518a.pdf", D(2023, 5, 19))]
    assert rows(catalogues.yearly_sitemaps(catalogues.sitemap_entries(snaps)), "year") == [(2023,)]
    assert rows(catalogues.speech_entries(catalogues.sitemap_entries(snaps)), "date") == [(D(2023, 5, 18),)]
    r = spark.createDataFrame([('[["original","timestamp"],["http://a","20020129141357"]]',), ('[["timestamp"],["2003"]]',), ("[]",)], "body string")
    assert rows(catalogues.archive_captures(r).where("original is not null"), "original", "date") == [("http://a", D(2002, 1, 29))]
    flat = spark.range(1).select(catalogues.flat_records(F.sequence(F.lit(1), F.lit(7)), F.lit(3)).alias("x")).first().x
    assert flat == [[1, 2, 3], [4, 5, 6]]
    record = ["1", "1577833200", '{"Title": " T "}', '["https://e/pub/pdf/scpwps/ecb.wp2800.de.pdf", "https://e/pub/pdf/scpwps/ecb.wp2800~a1.en.pdf"]']
    papers = catalogues.catalogue_papers(spark.createDataFrame([(record,)], "record array<string>"), ["id", "pub_timestamp", "publicationProperties", "documentTypes"]).first()
    assert (papers.pub_date, papers.title, papers.number, papers.pdf_url[-10:], len(papers.alt_urls)) == (D(2020, 1, 1), "T", 2800, "~a1.en.pdf", 1)
    config = catalogues.source_config(spark, '[ch.sitemap]\nsitemap_url = "https://s"\n[ch.sitemap.patterns]\nE2 = "/stab/.*\\\\.pdf$"\n')
    docs = catalogues.declared_documents(spark.createDataFrame([("ch", "https://s/stab/2020-03-04.pdf", None), ("ch", "https://s/x", None)], "bank_code string, loc string, lastmod date"), config)
    assert rows(docs, "doc_type", "date") == [("E2", D(2020, 3, 4))]


def test_torn_ledger(spark, tmp_path):
    good = json.dumps({"bank_code": "hu", "doc_id": "1", "title": "é"}, ensure_ascii=False)
    f = tmp_path / "hu.jsonl"
    f.write_bytes(f"{good}\n\n{good}\n".encode() + b'{"bank_code": "h')
    problems = ledger.require_whole(spark, str(f)).collect()
    assert [(p.line, p.problem, p.offset) for p in problems] == [(4, "torn", len(f"{good}\n\n{good}\n".encode()))]
    assert ledger.repair_torn_tail(str(f), problems[0].offset) == '{"bank_code": "h'
    assert (tmp_path / "hu.jsonl.torn").exists() and ledger.require_whole(spark, str(f)).count() == 0
    assert ledger.read_ledger(spark, str(f), ["hu"]).count() == 2
    f.write_bytes(b"{broken\n" + good.encode() + b"\n")
    with pytest.raises(ledger.TornMiddle, match=r"hu\.jsonl:1"):
        ledger.require_whole(spark, str(f))
    f.write_bytes(good.encode() + b"\n" + good.encode("latin-1") + b"\n" + good.encode() + b"\n")
    with pytest.raises(ledger.TornMiddle, match=":2"):
        ledger.require_whole(spark, str(f))


def test_rewrite_keeps_documents(spark, tmp_path):
    root = str(tmp_path / "ledger")
    os.makedirs(root)
    rows_ = spark.createDataFrame([{"bank_code": b, "doc_id": str(k), "doc_type": "D1"} for k, b in enumerate("abab")], schema.LEDGER)
    ledger.rewrite(rows_, root)
    now = ledger.current(spark, root)
    ledger.rewrite(now.withColumn("title", F.lit("new")), root, rails=now)
    assert rows(ledger.current(spark, root), "doc_id", "title") == [(str(k), "new") for k in range(4)]
    assert "PartitionFilters: [isnotnull(bank_code" in ledger.current(spark, root).where("bank_code = 'a'")._jdf.queryExecution().toString()
    with pytest.raises(ledger.LostRows):
        ledger.rewrite(now.limit(3), root, rails=now)
    assert ledger.current(spark, root).count() == 4


def test_reports_and_rag(spark, tmp_path):
    path = str(tmp_path / "r")
    ledger.write_report(spark.createDataFrame([("b", 2), ("a", 1)], "k string, v int"), path, ["k"])
    assert [(r.k, r.v) for r in ledger.read_report(spark, path).orderBy("line").collect()] == [("a", "1"), ("b", "2")]
    cite = rag.citation(F.lit("Bank of England"), F.lit("Outlook"), F.lit(D(2023, 5, 18)), F.lit("https://x"))
    assert spark.range(1).select(cite.alias("x")).first().x == "Bank of England, Outlook, 2023-05-18. Source: https://x"
    docs = spark.createDataFrame([("d", "a\nb")], "doc_id string, text string")
    assert rows(rag.chunked(docs), "chunk_id", "chunk") == [("d:0", "a\nb")]


def test_streams(spark, tmp_path):
    src, led, chk = (str(tmp_path / x) for x in ("in", "ledger", "chk"))
    cols = "doc_id string, sha256 string, seq int"
    spark.createDataFrame([("a", "h1", 1), ("b", "h1", 2)], cols).coalesce(1).write.parquet(src)
    run = lambda: ledger_stream.save_stream(spark.readStream.schema(cols).parquet(src), led, chk).awaitTermination()
    run()
    spark.createDataFrame([("a", "h7", 3), ("c", "h2", 4)], cols).coalesce(1).write.mode("append").parquet(src)
    run(), run()
    assert rows(spark.read.parquet(led), "doc_id") == [("a",), ("c",)]
    pages = str(tmp_path / "pages")
    body = bytearray(PAGE.encode())
    spark.createDataFrame([("https://f/l", datetime.datetime(2024, 1, 1), 200, "text/html", body)] * 2, schema.PAGES).write.parquet(pages)
    q = ledger_stream.candidates(ledger_stream.snapshots(spark, pages), html.LAYOUT["fomc_minutes"]).writeStream.format("memory").queryName("found").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("found").count() == 1


@pytest.mark.parametrize("name", ["q21_match_cascade", "q24_ambiguity_class", "q31_stop_on_known", "q42_recovery_class", "q47_save_decisions"])
def test_no_nested_loops(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
