"""Discovery as plans over page snapshots: scopes, routing, listings with their
landing pages, attribution of speeches."""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions import dates, text, urls
from quillstone.operators import dedup, matching
from quillstone.sources import html

CANDIDATE = ("bank_code", "doc_type", "title", "pdf_url", "source_url", "date", "date_precision", "provenance")


def parse_years(value: str) -> list[int]:
    """'2015-2025' (both ends) or one year."""
    first, _, last = value.partition("-")
    return list(range(int(first), int(last or first) + 1))


def parse_scope(value: str | None, known: Iterable[str]) -> list[str]:
    """'A1,F1', by default the types of groups A to F; unknown ones are an error."""
    known = list(known)
    if not value:
        return [t for t in known if t[0] <= "F"]
    wanted = [t.strip().upper() for t in value.split(",") if t.strip()]
    if wrong := [t for t in wanted if t not in known]:
        raise KeyError(f"unknown document types: {', '.join(wrong)}")
    return wanted


def bank_codes(column: Column) -> Column:
    return column.rlike("^[a-z]{2,4}$")


def year_window(as_of: datetime.date, years_back: int) -> tuple[int, int]:
    return as_of.year - years_back, as_of.year


def route(native: DataFrame, shared: DataFrame, scope: list[str], native_only: bool = False) -> DataFrame:
    """Candidates of the publishers' own sources and of shared catalogues, once
    for each source, tagged, in scope."""
    own = native.withColumn("tag", F.lit("native"))
    out = own if native_only else own.unionByName(shared.withColumn("tag", F.lit("shared")))
    return out.where(F.col("doc_type").isin(scope))


def new_candidates(found: DataFrame, ledger: DataFrame) -> DataFrame:
    """Candidates whose PDF URL and source page the ledger doesn't know yet; two
    sets, two anti joins, both before any page or body is fetched."""
    out = dedup.unknown(found, dedup.known_urls(ledger), "pdf_url", "url")
    return dedup.unknown(out, dedup.known_sources(ledger), "source_url", "source_url")


def with_landing(listing: DataFrame, metas: DataFrame) -> DataFrame:
    """Listing rows (link_url, date: its month, title) with their landing pages'
    metadata (page_url, page_title, published): day or month by landing_choice,
    the title from the landing page, the list, or the URL."""
    m = metas.select(F.col("page_url").alias("_page"), "page_title", "published")
    r = listing.join(m, F.col("link_url") == F.col("_page"), "left")
    choice = dates.landing_choice(F.col("published"), F.col("date"))
    shown = F.nullif(F.nullif("page_title", F.lit("(untitled)")), F.lit(""))
    title = F.coalesce(shown, F.nullif("title", F.lit("")), urls.last_segment(F.col("link_url")))
    return r.select("link_url", choice["date"].alias("date"), choice["precision"].alias("date_precision"), title.alias("title"))


def since_newest_first(rows: DataFrame, since: Column, keep_undated: bool = True) -> DataFrame:
    """What a walk from new to old keeps when it stops at the first older row,
    for any order of the rows: a filter."""
    return dedup.since_until(rows, "date", since, None, keep_undated)


def within_run(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """The first row of each key; rows without a key are all kept."""
    keyed = rows.where(F.col(key).isNotNull())
    return dedup.first_by(keyed, [key], [seq]).unionByName(rows.where(F.col(key).isNull()).select(*rows.columns))


def attribute_speeches(entries: DataFrame, metas: DataFrame, labels: DataFrame) -> DataFrame:
    """Speeches (pdf_url, detail_url, date) with the publisher whose label the
    speaker's half of the page's description has, the longest first; speeches
    without one go."""
    m = metas.select(F.col("page_url").alias("detail_url"), F.coalesce("og_description", "og_title", F.lit("")).alias("said"), F.coalesce("og_title", "page_title").alias("title"))
    r = entries.join(m, "detail_url").withColumn("half", html.speaker_half(F.col("said")))
    r = text.on_distinct(r, "half", text.normalize_institution, "text_norm")
    own = text.on_distinct(labels.select("bank_code", "label", "primary_label"), "label", text.normalize_institution, "label_norm")
    hit = matching.longest_label(r.select("pdf_url", "detail_url", "date", "title", "text_norm"), own)
    banks = own.select("bank_code", "primary_label").distinct()
    return hit.join(F.broadcast(banks), "primary_label").select("bank_code", F.lit("C1").alias("doc_type"), "title", "pdf_url", F.col("detail_url").alias("source_url"), "date", F.lit("day").alias("date_precision"), F.lit("bis_index").alias("provenance"))


def english(urls_: Column) -> Column:
    return F.endswith(F.lower(urls_), F.lit(".en.pdf")) | F.endswith(F.lower(urls_), F.lit(".en.html"))


def archive_documents(captures: DataFrame, bank: str, doc_type: str, pattern: str) -> DataFrame:
    """Candidates from an archive's captures: the raw snapshot as the PDF, the
    original as another URL, dated by the year in its path."""
    hit = captures.where(F.col("original").rlike(pattern))
    latest = hit.groupBy("original").agg(F.max("stamp").alias("stamp"))
    d = dates.year_in_path(F.col("original"))
    return latest.select(F.lit(bank).alias("bank_code"), F.lit(doc_type).alias("doc_type"), urls.last_segment(F.col("original")).alias("title"), urls.archive_url(F.col("stamp"), F.col("original")).alias("pdf_url"), F.array("original").alias("alt_urls"), d.alias("date"), F.lit("year").alias("date_precision"))


def skip_counts(candidates: DataFrame, known: DataFrame, url: str = "pdf_url") -> DataFrame:
    """bank_code, found, skipped: what a publisher's listing held, and how much
    of it was known before."""
    k = known.select(F.col("url").alias("_known")).distinct()
    seen = candidates.join(k, F.col(url) == F.col("_known"), "left")
    return seen.groupBy("bank_code").agg(F.count(F.lit(1)).alias("found"), F.count("_known").alias("skipped"))


def unknown_banks(wanted: DataFrame, banks: DataFrame) -> DataFrame:
    """Codes (bank_code) that no publisher has; a warning, they are left out."""
    return wanted.select("bank_code").where("bank_code is not null").distinct().join(banks.select("bank_code"), "bank_code", "left_anti")
