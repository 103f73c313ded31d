"""HTML pages to rows: one tolerant tag reader, and a table of page layouts.

Pages come as (url, body) rows; parsing is a map over them, so it runs where
the pages are, and an anti join before it (not after) saves the work."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions import dates, urls


class Page(HTMLParser):
    """Links, meta tags, headings, times, inputs and table rows of a page."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.links: list[tuple[str, str]] = []
        self.metas: list[tuple[str, str]] = []
        self.times: list[str] = []
        self.inputs: list[tuple[str, str]] = []
        self.rows: list[list[str]] = []
        self.row_links: list[list[str]] = []
        self.snippets: list[str] = []
        self.title = self.h1 = ""
        self._href: str | None = None
        self._text: dict[str, list[str]] = {}
        self.feed(html)
        self.close()
        self._end_link()

    def _end_link(self) -> None:
        if self._href is not None:
            self.links.append((self._href, " ".join(" ".join(self._text.pop("a", [])).split())))
            self._href = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = {k: v or "" for k, v in attrs}
        if a.get("data-snippets"):
            self.snippets += [x.strip() for x in a["data-snippets"].split(",") if x.strip()]
        if tag == "a" and "href" in a:
            self._end_link()
            self._href, self._text["a"] = a["href"], []
            if self.row_links:
                self.row_links[-1].append(a["href"])
        elif tag == "meta" and a.get("content", "").strip():
            self.metas.append(((a.get("name") or a.get("property") or "").lower(), a["content"].strip()))
        elif tag == "time" and a.get("datetime"):
            self.times.append(a["datetime"])
        elif tag == "input":
            self.inputs.append((a.get("name", ""), a.get("value", "")))
        elif tag == "tr":
            self.rows.append([])
            self.row_links.append([])
        elif tag in ("td", "th") and self.rows:
            self.rows[-1].append("")
            self._text["cell"] = []
        elif tag in ("title", "h1") and tag not in self._text and not getattr(self, tag):
            self._text[tag] = []

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self._end_link()
        elif tag in ("td", "th") and "cell" in self._text and self.rows and self.rows[-1]:
            self.rows[-1][-1] = " ".join(" ".join(self._text.pop("cell")).split())
        elif tag in ("title", "h1") and tag in self._text:
            setattr(self, tag, " ".join(" ".join(self._text.pop(tag)).split()))

    def handle_data(self, data: str) -> None:
        for parts in self._text.values():
            parts.append(data)

    def meta(self, name: str, last: bool = False) -> str:
        found = [c for n, c in self.metas if n == name]
        return found[-1 if last else 0] if found else ""


@dataclass(frozen=True)
class Layout:
    """Links of a kind of page: what their URL must match (searched, any case),
    and where the date is: 'url8' eight digits (group 1 or the whole), 'url6'
    YYMMDD, 'text' the link text, 'either' href then text, 'issue' year and
    month name in the URL, 'year' January 1st of group 1, 'none'."""

    name: str
    pattern: str
    date_from: str
    index_page: str = ""  # what a directory URL is completed with


# The URL shapes of the listing pages that are read.
LAYOUTS = (
    Layout("fomc_minutes", r"(?:fomcminutes(\d{8})\.pdf|/fomc/minutes/(\d{8})\.htm|/fomc/minutes/\d{4}/(\d{8})min\.htm)$", "url8"),
    Layout("fomc_projections", r"(?:fomcprojtabl|FOMC)(\d{8})(?:SEPcompilation)?\.pdf$", "url8"),
    Layout("fomc_statements", r"(?:monetary(?:/)?(\d{8})a\.htm$|boarddocs/press/(?:monetary|general)/\d{4}/(\d{8}))", "url8", "default.htm"),
    Layout("ecb_accounts", r"/press/accounts/\d{4}/html/(?:ecb\.)?mg(\d{6})[~a-z0-9]*\.en\.html$", "url6"),
    Layout("ecb_decisions", r"/press/pr/date/\d{4}/html/(?:ecb\.)?(?:mp|pr)(\d{6})[~a-z0-9]*\.en\.html$", "url6"),
    Layout("ecb_statements", r"/(?:ecb\.)?is(\d{6})[~a-z0-9]*\.en\.html$", "url6"),
    Layout("ecb_bulletin", r"/pub/pdf/ecbu/eb(\d{4})\d{2}\.en\.pdf$", "year"),
    Layout("rba_decisions", r"/media-releases/\d{4}/mr-\d{2}-\d+\.html$", "text"),
    Layout("rba_minutes", r"/rba-board-minutes/\d{4}/(?:(\d{4}-\d{2}-\d{2})|(\d{8}))", "url8"),
    Layout("rba_smp", r"/publications/smp/(\d{4})/(feb|may|aug|nov)/?$", "issue"),
    Layout("speech_pdf", r"^https?://[^/]+/review/r(\d{6})[a-z]?\.pdf$", "url6"),
    Layout("any_pdf", r"\.pdf(?:$|[?#])", "either"),
)
LAYOUT = {x.name: x for x in LAYOUTS}


def _body(pages: DataFrame, body: str) -> Column:
    return F.col(body) if dict(pages.dtypes)[body] == "string" else urls.page_text(F.col(body))


def _parse(pages: DataFrame, url: str, body: str, rows_of, schema: str, kinds: list) -> DataFrame:
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, len(b), 500):
                part = b.slice(i, 500)
                rows = [(u, *r) for u, h in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) for r in rows_of(u or "", h or "")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(names), kinds)], names=names)

    return pages.select(F.col(url).alias("page_url"), _body(pages, body).alias("html")).mapInArrow(run, schema)


def page_links(pages: DataFrame, url: str = "url", body: str = "html") -> DataFrame:
    """page_url, pos, href, link_url (absolute; null where the link is no URL),
    text; links in page order."""
    of = lambda u, h: [(k, href, urls.absolute(u, href), text) for k, (href, text) in enumerate(Page(h).links)]
    return _parse(pages, url, body, of, "page_url string, pos int, href string, link_url string, text string", [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()])


def page_metas(pages: DataFrame, url: str = "url", body: str = "html") -> DataFrame:
    """page_url, page_title, published, og_title, og_description: the citation title, else the
    heading, the title tag or (untitled); the publication date, else the
    citation year.  The bare date tag is an index date and is not read."""

    def of(u: str, h: str) -> list[tuple]:
        p = Page(h)
        year = p.meta("citation_year")
        title = p.meta("citation_title", last=True) or p.h1 or p.title or "(untitled)"
        return [(title, p.meta("citation_publication_date") or None, year if year.isdigit() else None, p.meta("og:title", last=True) or None, p.meta("og:description", last=True) or None)]

    out = _parse(pages, url, body, of, "page_url string, page_title string, published_text string, year_text string, og_title string, og_description string", [pa.string()] * 6)
    return out.select("page_url", "page_title", F.coalesce(dates.partial_date(F.col("published_text")), dates.partial_date(F.col("year_text"))).alias("published"), "og_title", "og_description")


def table_rows(pages: DataFrame, url: str = "url", body: str = "html") -> DataFrame:
    """page_url, pos, cells: table rows of any layout, for content-based reading:
    the date is the first cell with one, the title the longest cell."""
    of = lambda u, h: [(k, r) for k, r in enumerate(Page(h).rows) if r]
    return _parse(pages, url, body, of, "page_url string, pos int, cells array<string>", [pa.string(), pa.int32(), pa.list_(pa.string())])


def table_papers(pages: DataFrame, pattern: str, url: str = "url", body: str = "html") -> DataFrame:
    """page_url, pos, date, date_precision, title, link_url of table rows with a
    link that matches: the date is in the first cell that has one, the title is
    the longest cell, whatever the columns are."""

    def of(u: str, h: str) -> list[tuple]:
        p, seen, out = Page(h), set(), []
        for k, (cells, hrefs) in enumerate(zip(p.rows, p.row_links)):
            link = next((x for x in hrefs if re.search(pattern, x, re.I)), None)
            if link and cells and (full := urls.absolute(u, link)) not in seen:
                seen.add(full)
                out.append((k, cells, full))
        return out

    rows = _parse(pages, url, body, of, "page_url string, pos int, cells array<string>, link_url string", [pa.string(), pa.int32(), pa.list_(pa.string()), pa.string()])
    found = F.filter(F.transform("cells", dates.month_text_date), lambda d: d.isNotNull())
    title = F.element_at(F.array_sort("cells", lambda a, b: F.length(b) - F.length(a)), 1)
    return rows.select("page_url", "pos", F.get(found, 0)["date"].alias("date"), F.get(found, 0)["precision"].alias("date_precision"), title.alias("title"), "link_url")


def page_count(pages: DataFrame, pattern: str = r"pageNumString=(\d+)", most: int = 300, body: str = "html") -> DataFrame:
    """last_page that the pages of a result list link to, ``most`` at most."""
    numbers = F.transform(F.regexp_extract_all(_body(pages, body), F.lit(pattern), F.lit(1)), lambda x: x.cast("int"))
    return pages.agg(F.least(F.max(F.array_max(numbers)), F.lit(most)).alias("last_page"))


def include_snippets(pages: DataFrame, url: str = "url", body: str = "html") -> DataFrame:
    """page_url, pos, include_url: the lazily loaded parts an index page names."""
    of = lambda u, h: [(k, urls.absolute(u, s)) for k, s in enumerate(Page(h).snippets)]
    return _parse(pages, url, body, of, "page_url string, pos int, include_url string", [pa.string(), pa.int32(), pa.string()])


def pdf_candidates(pages: DataFrame, homepage: Column, url: str = "url", body: str = "html") -> DataFrame:
    """page_url, candidates: PDF links, form values and bare PDF URLs in page
    order, each once; those on the publisher's host first, then bis.org."""

    def of(u: str, h: str) -> list[tuple]:
        p = Page(h)
        found = [x for x, _ in p.links if x.startswith("http") and "pdf" in x.lower()]
        found += [v for n, v in p.inputs if n == "url" and v.startswith("http")]
        found += re.findall(r"https?://[^\s\"'<>]+?\.pdf", h, re.I)
        return [(list(dict.fromkeys(found)),)]

    out = _parse(pages, url, body, of, "page_url string, found array<string>", [pa.string(), pa.list_(pa.string())])
    home = F.coalesce(homepage, F.lit("\0"))
    own = F.filter("found", lambda x: urls.host_matches(x, home))
    shared = F.filter("found", lambda x: ~urls.host_matches(x, home) & urls.host_matches(x, F.lit("bis.org")))
    rest = F.filter("found", lambda x: ~urls.host_matches(x, home) & ~urls.host_matches(x, F.lit("bis.org")))
    return out.select("page_url", F.concat(own, shared, rest).alias("candidates"), F.size(own).alias("n_own"), F.size(shared).alias("n_shared"))


def listing(pages: DataFrame, layout: Layout, url: str = "url", body: str = "html") -> DataFrame:
    """page_url, pos, date, date_precision, title, link_url of the links of a
    layout, the first of each URL on a page."""
    hits = page_links(pages, url, body).where(F.col("href").rlike(f"(?i){layout.pattern}"))
    first = hits.groupBy("page_url", "link_url").agg(F.min_by(F.struct("pos", "href", "text"), "pos").alias("r")).select("page_url", "link_url", "r.*")
    groups = re.compile(layout.pattern).groups
    got = F.coalesce(*[F.nullif(F.regexp_extract("href", f"(?i){layout.pattern}", k), F.lit("")) for k in range(1, groups + 1)]) if groups else F.lit(None).cast("string")
    digits = F.regexp_replace(got, "-", "")
    month = F.regexp_extract("href", f"(?i){layout.pattern}", 2) if groups > 1 else F.lit("")
    rules = {
        "url8": F.coalesce(F.try_to_date(digits, "yyyyMMdd"), F.try_to_date(digits, "ddMMyyyy")),
        "url6": dates.slug_date(digits),
        "text": dates.month_text_date(F.col("text"))["date"],
        "either": F.coalesce(dates.first_date_like(F.col("href")), dates.first_date_like(F.col("text"))),
        "issue": dates.month_text_date(F.concat_ws(" ", month, got))["date"],
        "year": F.try_to_date(F.concat(got, F.lit("-01-01")), "yyyy-MM-dd"),
        "none": F.lit(None).cast("date"),
    }
    precision = {"year": "year", "issue": "month"}.get(layout.date_from, "day")
    title = F.coalesce(F.nullif("text", F.lit("")), urls.last_segment(F.col("href")))
    link = F.col("link_url")
    if layout.index_page:
        link = F.when(F.endswith(link, F.lit("/")), F.concat(link, F.lit(layout.index_page))).otherwise(link)
    return first.select("page_url", "pos", rules[layout.date_from].alias("date"), F.lit(precision).alias("date_precision"), title.alias("title"), link.alias("link_url"))


def series_listing(pages: DataFrame, archive: str, series: str, url: str = "url", body: str = "html") -> DataFrame:
    """page_url, pos, paper_id, title: each paper once, with its longest title;
    links that sort the list have none."""
    p = rf"/p/{re.escape(archive)}/{re.escape(series)}/([^/.]+)\.html$"
    hits = page_links(pages, url, body).withColumn("paper_id", F.regexp_extract("href", p, 1)).where("paper_id <> ''")
    title = F.when(F.col("text").rlike("(?i)^(by |sorted)"), "").otherwise(F.col("text"))
    best = F.struct(F.length("t"), -F.col("pos"))
    return hits.withColumn("t", title).groupBy("page_url", "paper_id").agg(F.min("pos").alias("pos"), F.max_by("t", best).alias("title"))


def raw_links(pages: DataFrame, pattern: str, url: str = "url", body: str = "html") -> DataFrame:
    """page_url, pos, match of a pattern anywhere in the markup, JSON escapes
    undone; no parser, the regular expression decides."""
    found = F.regexp_extract_all(urls.unescape_slashes(_body(pages, body)), F.lit(pattern), F.lit(0))
    return pages.select(F.col(url).alias("page_url"), F.posexplode(found).alias("pos", "match"))


# Words that begin an event's name, in the order they are tried.
EVENT_WORDS = ("at", "during", "to", "before", "in", "on", "hosted by", "organised by", "organized by", "sponsored by", "via", "by videoconference", "by video conference")


def speaker_half(text: Column) -> Column:
    """The text before the first word that begins the event's name."""
    return F.split(text, rf"(?i)\s+(?:{'|'.join(EVENT_WORDS)})\s+", 2)[0]
