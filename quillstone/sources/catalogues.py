"""Sitemaps, JSON catalogues, archive indexes and configuration files."""

from __future__ import annotations

import tomllib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import dates, urls


def sitemap_entries(pages: DataFrame, url: str = "url", body: str = "body") -> DataFrame:
    """page_url, kind ('url' or 'sitemap'), pos, loc, lastmod of XML sitemaps."""
    xml = F.col(body) if dict(pages.dtypes)[body] == "string" else urls.page_text(F.col(body))
    block = F.regexp_extract_all(xml, F.lit(r"(?s)<(?:url|sitemap)>.*?</(?:url|sitemap)>"), F.lit(0))
    cell = lambda tag: F.nullif(F.trim(F.regexp_extract("block", rf"(?s)<{tag}>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</{tag}>", 1)), F.lit(""))
    rows = pages.select(F.col(url).alias("page_url"), F.posexplode(block).alias("pos", "block"))
    loc = F.replace(cell("loc"), F.lit("&amp;"), F.lit("&"))
    return rows.select("page_url", F.when(F.startswith("block", F.lit("<url>")), "url").otherwise("sitemap").alias("kind"), "pos", loc.alias("loc"), dates.iso_day(cell("lastmod")).alias("lastmod")).where("loc is not null")


def walk_sitemaps(roots: DataFrame, snapshots: DataFrame, depth: int = 2) -> DataFrame:
    """loc, lastmod reached from root sitemaps (url) through at most ``depth``
    levels of sitemap indexes, over a table of snapshots (url, body)."""
    level, out = roots.select("url").distinct(), None
    for k in range(depth + 1):
        found = sitemap_entries(snapshots.join(level, "url", "left_semi"))
        pages = found.where("kind = 'url'").select("loc", "lastmod")
        out = pages if out is None else out.unionByName(pages)
        level = found.where("kind = 'sitemap'").select(F.col("loc").alias("url")).distinct()
    return out.groupBy("loc").agg(F.max("lastmod").alias("lastmod"))


def yearly_sitemaps(entries: DataFrame) -> DataFrame:
    """year, loc of the yearly files of a sitemap index."""
    year = F.regexp_extract("loc", r"sitemap_documents_(\d{4})\.xml$", 1)
    return entries.where(year != "").select(year.cast("int").alias("year"), "loc")


def speech_entries(entries: DataFrame) -> DataFrame:
    """pdf_url, detail_url, date of the speeches in a yearly sitemap."""
    d = dates.url_slug_date(F.col("loc"))
    return entries.where(d.isNotNull()).select(F.col("loc").alias("pdf_url"), F.regexp_replace("loc", r"(?i)\.pdf$", ".htm").alias("detail_url"), d.alias("date"))


def flat_records(chunk: Column, width: Column) -> Column:
    """A flat array cut into records of ``width`` values; a last record that is
    not complete goes."""
    n = F.floor(F.size(chunk) / width).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.slice(chunk, (k * width + 1).cast("int"), width.cast("int")))).otherwise(F.slice(F.array(chunk), 1, 0))


def catalogue_papers(records: DataFrame, header: list[str]) -> DataFrame:
    """pub_date, title, doc_type, number, pdf_url, alt_urls of the records
    (arrays of JSON strings, column ``record``) of a JSON catalogue."""
    at = {name: k for k, name in enumerate(header)}
    value = lambda name: F.col("record")[at[name]]
    arrays = [F.from_json(value(n), "array<string>") for n in ("documentTypes", "childrenPublication") if n in at]
    every = F.filter(F.concat(*[F.coalesce(a, F.array().cast("array<string>")) for a in arrays]), lambda u: F.endswith(F.lower(u), F.lit(".pdf")) & urls.ecb_number(u).isNotNull())
    english = F.filter("found", lambda u: F.endswith(F.lower(u), F.lit(".en.pdf")))
    best = F.coalesce(F.get(english, 0), F.get("found", 0))
    out = records.withColumn("found", F.array_distinct(every)).withColumn("pdf_url", best).where("pdf_url is not null")
    number = urls.ecb_number(F.col("pdf_url"))
    return out.select(
        dates.berlin_day(value("pub_timestamp").cast("long")).alias("pub_date"),
        F.trim(F.get_json_object(value("publicationProperties"), "$.Title")).alias("title"),
        number["doc_type"].alias("doc_type"), number["number"].alias("number"), "pdf_url",
        F.filter("found", lambda u: u != F.col("pdf_url")).alias("alt_urls"))


def archive_captures(responses: DataFrame, body: str = "body") -> DataFrame:
    """original, stamp, date of archive index responses: a JSON array of arrays
    whose first row is the header; an index for one URL has no original."""
    rows = F.from_json(F.col(body), "array<array<string>>")
    head = F.get(rows, 0)
    r = responses.select(*[c for c in responses.columns if c != body], head.alias("head"), F.explode(F.slice(rows, F.lit(2), F.greatest(F.size(rows), F.lit(0)))).alias("row"))
    cell = lambda name: F.get("row", F.array_position("head", F.lit(name)).cast("int") - 1)
    original = F.when(F.array_contains("head", "original"), cell("original"))
    out = r.select(*[c for c in responses.columns if c != body], original.alias("original"), cell("timestamp").alias("stamp"))
    return out.withColumn("date", dates.stamp_date(F.col("stamp")))


def capture_bounds(captures: DataFrame) -> DataFrame:
    """url, first_stamp, latest_stamp."""
    return captures.groupBy(F.col("original").alias("url")).agg(F.min("stamp").alias("first_stamp"), F.max("stamp").alias("latest_stamp"))


def source_config(spark: SparkSession, toml: str) -> DataFrame:
    """bank_code, kind, url, doc_type, pattern of declared sources."""
    rows = []
    for bank, kinds in tomllib.loads(toml).items():
        for kind, spec in kinds.items():
            found = spec.get("sitemap_url") or spec.get("urls") or spec.get("url") or ""
            for url in [found] if isinstance(found, str) else found:
                rows += [(bank, kind, url, t, p) for t, p in spec.get("patterns", {}).items()]
    return spark.createDataFrame(rows, "bank_code string, kind string, url string, doc_type string, pattern string")


def declared_documents(entries: DataFrame, config: DataFrame) -> DataFrame:
    """Entries (bank_code, loc, lastmod) that a declared pattern of their
    publisher matches; the date in the URL, else the page's last change."""
    hit = entries.join(config, "bank_code").where("regexp_like(loc, concat('(?i)', pattern))")
    return hit.select("bank_code", "doc_type", F.col("loc").alias("pdf_url"), F.coalesce(dates.first_date_like(F.col("loc")), F.col("lastmod")).alias("date"))
