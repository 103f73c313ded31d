"""Scalar functions against stated values."""

import datetime

import pytest
from pyspark.sql import functions as F

from quillstone.functions import dates, text, urls


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def lit(x):
    return F.lit(x)


D = datetime.date


@pytest.mark.parametrize("make, want", [
    (lambda: urls.doc_id(lit("ecb"), lit("D1"), lit("https://x/a.pdf")), __import__("hashlib").sha1(b"ecb|D1|https://x/a.pdf").hexdigest()[:16]),
    (lambda: urls.doc_id(lit("ecb"), F.lit(None).cast("string"), lit("u")), None),
    (lambda: urls.normalize_url(lit(" HTTPS://www.ecb.europa.eu//pub/pdf/scpwps/ecb.wp2800~ab12.en.pdf ")), "www.ecb.europa.eu/pub/pdf/scpwps/ecb.wp2800.en.pdf"),
    (lambda: urls.host(lit("https://user@WWW.Example.com:80/x")), "www.example.com"),
    (lambda: urls.host_matches(lit("https://badexample.com/"), lit("example.com")), False),
    (lambda: urls.host_matches(lit("https://a.example.com/"), lit("example.com")), True),
    (lambda: urls.handle_from_page(lit("https://ideas.repec.org/p/ecb/ecbwps/20253124.html")), "RePEc:ecb:ecbwps:20253124"),
    (lambda: urls.handle_from_page(lit("https://x.org/")), ""),
    (lambda: urls.row_key(lit(""), lit(""), lit("a title")), "t:a title"),
    (lambda: urls.row_key(lit(""), lit(""), lit("")), None),
    (lambda: urls.sibling_url(lit("http://x/1999pap.pdf")), "http://x/1999abs.html"),
    (lambda: urls.url_variants(lit("http://x/1pap.pdf"), F.array(lit("http://x/1abs.html"), lit(""), lit("http://y"))), ["http://x/1pap.pdf", "http://x/1abs.html", "http://y"]),
    (lambda: urls.extension(lit("text/html; charset=utf-8")), "html"),
    (lambda: urls.extension(F.lit(None).cast("string")), "bin"),
    (lambda: urls.target_path(lit("us"), lit("A3"), F.lit(None).cast("int"), lit("ab"), lit(""), lit("http://x/A.PDF")), "raw/us/A3/0/ab.pdf"),
    (lambda: urls.error_text(lit("OSError"), lit("a\nb")), "OSError: a b"),
    (lambda: urls.unescape_slashes(lit("http:\\/\\/x")), "http://x"),
    (lambda: urls.join_url(lit("https://x/a/b.html"), lit("../c.pdf")), "https://x/c.pdf"),
    (lambda: urls.ecb_number(lit("https://e/pub/pdf/scpwps/ecb.wp2800~9f0c.en.pdf"))["number"], 2800),
    (lambda: urls.ecb_number(lit("https://e/pub/other.pdf")), None),
    (lambda: urls.ecb_number_of_handle(lit("RePEc:ecb:ecbops:2025312"))["number"], 312),
    (lambda: urls.fed_key(lit("https://f/econres/feds/files/2020012pap.pdf")), "feds:2020:12"),
    (lambda: urls.fed_key(lit("https://f/econresdata/ifdp/2014/files/ifdp1100.pdf")), "ifdp:1100"),
    (lambda: urls.fed_key(lit("https://f/pubs/feds/2001/200112/200112pap.pdf")), "feds:2001:12"),
    (lambda: urls.fed_key_of_handle(lit("RePEc:fip:fedgfe:98-12")), "feds:1998:12"),
    (lambda: urls.fed_key_of_handle(lit("RePEc:fip:fedgfe:12")), None),
    (lambda: urls.boj_code(lit("https://b/wps_rev/data/wp21e05.pdf")), "21e5"),
    (lambda: urls.buba_key(lit("https://b/2020-01-02-dkp-03-data.pdf")), "3/2020"),
    (lambda: urls.buba_key(lit("zbw:bubdps:032020")), "3/2020"),
    (lambda: dates.slug_date(lit("900101")), D(1990, 1, 1)),
    (lambda: dates.slug_date(lit("890101")), D(2089, 1, 1)),
    (lambda: dates.slug_date(lit("231301")), None),
    (lambda: dates.url_slug_date(lit("https://www.bis.org/review/r230518a.pdf")), D(2023, 5, 18)),
    (lambda: dates.first_date_like(lit("/x/2020-02-31/"), lit("20210101")), None),
    (lambda: dates.first_date_like(lit("/x/"), lit("20210101")), D(2021, 1, 1)),
    (lambda: dates.iso_day(lit("2020-01-01T23:30:00-05:00")), D(2020, 1, 1)),
    (lambda: dates.partial_date(lit("2020/07")), D(2020, 7, 1)),
    (lambda: dates.partial_date(lit("2020-13-01")), None),
    (lambda: dates.month_text_date(lit("Published on 30 May 2025"))["date"], D(2025, 5, 30)),
    (lambda: dates.month_text_date(lit("Nov. 13, 2025"))["date"], D(2025, 11, 13)),
    (lambda: dates.month_text_date(lit("Apr. 2002"))["precision"], "month"),
    (lambda: dates.month_text_date(lit("December 2025"))["date"], D(2025, 12, 1)),
    (lambda: dates.month_text_date(lit("04.10.2010"))["date"], D(2010, 10, 4)),
    (lambda: dates.month_text_date(lit("none")), None),
    (lambda: dates.berlin_day(lit(1577833200)), D(2020, 1, 1)),
    (lambda: dates.stamp_date(lit("20020129141357")), D(2002, 1, 29)),
    (lambda: dates.stamp_date(F.lit(None).cast("string")), None),
    (lambda: dates.month_ok(lit(D(2002, 1, 29)), lit(D(2002, 1, 1))), True),
    (lambda: dates.month_ok(lit(D(2002, 1, 1)), lit(D(2002, 1, 1))), False),
    (lambda: dates.month_ok(lit(D(2002, 2, 3)), lit(D(2002, 1, 1))), False),
    (lambda: dates.month_ok(F.lit(None).cast("date"), lit(D(2002, 1, 1))), False),
    (lambda: dates.year_in_path(lit("https://x/a/2003/b/1999/c")), D(2003, 1, 1)),
    (lambda: dates.url_date(lit("https://x/sp01022003.pdf"), lit(D(2024, 1, 1)), "ddmmyyyy"), D(2003, 2, 1)),
    (lambda: dates.url_date(lit("https://x/sp01022003.pdf"), lit(D(2024, 1, 1))), None),
    (lambda: dates.url_date(lit("https://x/y/fsr200612.en.pdf"), lit(D(2024, 1, 1))), D(2006, 12, 1)),
    (lambda: dates.url_date(lit("https://x/y/in200612.en.html"), lit(D(2024, 1, 1)), "yymmdd"), D(2020, 6, 12)),
    (lambda: dates.url_date(lit("https://x/y/in210331~ab.en.html"), lit(D(2024, 1, 1))), D(2021, 3, 31)),
    (lambda: dates.url_date(lit("https://x/2005/ar2019en.pdf"), lit(D(2024, 1, 1))), D(2019, 1, 1)),
    (lambda: dates.url_date(lit("https://x/y/ecb.sp20240229.pdf"), lit(D(2024, 1, 1))), D(2024, 2, 29)),
    (lambda: dates.url_date(lit("https://x/20240229/none.pdf"), lit(D(2024, 1, 1))), None),
    (lambda: urls.normalize_url(lit("\t\u00a0https://A//b~1f.pdf\n ")), "a/b.pdf"),
    (lambda: urls.boe_slug(lit("https://b/working-paper/2020/")), None),
    (lambda: urls.boe_slug(lit("https://b/working-paper/about-us")), None),
    (lambda: urls.boe_slug(lit("https://b/-/media/boe/files/working-paper/2020/Some-Paper.pdf")), "some-paper"),
    (lambda: urls.boe_slug(lit("https://b/working-paper/2020/some-paper")), "some-paper"),
    (lambda: urls.join_url(lit("https://b/a"), lit("http://[x")), None),
    (lambda: urls.page_text(lit(bytearray("Größe".encode("latin-1")))), "Größe"),
    (lambda: urls.page_text(lit(bytearray("Größe".encode()))), "Größe"),
    (lambda: dates.pdf_creation_date(lit(bytearray(b"%PDF /CreationDate (D:20200131120000)"))), D(2020, 1, 31)),
])
def test_value(spark, make, want):
    assert value(spark, make()) == want


def test_text_keys():
    assert text.title_key("Grüße – Été 2020: «Łódź»") == "gru e ete 2020 odz"
    assert text.institution_key("People's Bank of  CHINA") == "people s bank of china"


def test_chunks(spark):
    def chunks(x):
        return value(spark, text.chunk_text(lit(x) if x is not None else F.lit(None).cast("string")))

    assert chunks("") == [] and chunks(None) == [] and chunks(" \n\u00a0\n") == []
    long = "x" * 4100
    assert chunks(f" {long} ") == ["", f"\n{long}"]
    lines = [f"{k} " + "y" * 900 for k in range(9)]
    got = chunks("\n\n".join(lines))
    assert len(got) == 3 and got[1].startswith(got[0][-480:] + "\n")


def test_similarity(spark):
    a = "monetary policy and the outlook"
    assert value(spark, text.similarity(lit(a), lit(a))) == 1.0
    assert value(spark, text.similarity(lit(a), lit(None).cast("string"))) == 0.0
