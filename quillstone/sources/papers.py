"""Paper pages of single publishers: an element tree of each page, and what the
blocks of a layout hold.  Pages are (url, body) rows; a broken page gives what
can be read of it, an empty one nothing."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions import dates, urls
from quillstone.sources import html

# URL shapes and class names of the publishers' pages.
FED_FILE = r"/(?:econres(?:data)?/(?:feds|ifdp)/(?:\d{4}/)?files|pubs/(?:feds|ifdp)/\d{4}/[^/\"']+)/[^\"'\s]+\.(?:pdf|ps)"
FED_NUMBER = r"(\d{4})-(\d{1,4})"
BOE_PAGE = r"/working-paper/(\d{4})/([a-z0-9][a-z0-9\-]+)$"
BOE_FILE = r"/-/media/boe/files/working-paper/\d{4}/[^\"'>\s]+?\.pdf"
BOE_PUBLISHED = r"Published on\s+(\d{1,2}\s+[A-Za-z]+\s+\d{4})"
BOE_MEDIA = "https://www.bankofengland.co.uk/-/media/boe/files/working-paper/"
BUBA_PAGE = r"/en/publications/research/discussion-papers/[a-z0-9][a-z0-9\-]+-\d+"
BUBA_FILE = r"/resource/blob/\d+/[a-f0-9]+/[A-F0-9]+/[^\"'\s]+-data\.pdf"
BUBA_DAY = r"(\d{1,2}\.\d{1,2}\.(?:19|20)\d{2})"
BUBA_ITEM, BUBA_TITLE = "resultlist__item", "teasable__title"
INCLUDE_ENDS = (".en.pdf", ".en.html")

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class Node:
    """An element: its attributes and, in order, its texts and elements."""

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.parts = tag, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo += [p for p in reversed(node.parts) if isinstance(p, Node)]

    def find(self, tag: str = "", css: str = "", attr: str = "") -> Iterator[Node]:
        for n in self.walk():
            if (not tag or n.tag == tag) and (not css or css in n.attrs.get("class", "").split()) and (not attr or attr in n.attrs):
                yield n

    def text(self) -> str:
        out, todo = [], [self]
        while todo:
            part = todo.pop()
            if isinstance(part, str):
                out.append(part)
            else:
                todo += reversed(part.parts)
        return " ".join(" ".join(out).split())


class Tree(HTMLParser):
    """A page as nodes; an end tag closes what is open inside its element, one
    without a start is ignored."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("", {}, None)
        self.feed(page)
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.open)
        self.open.parts.append(node)
        if tag not in _VOID:
            self.open = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.open.parts.append(Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.open))

    def handle_endtag(self, tag: str) -> None:
        node = self.open
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.open = node.parent

    def handle_data(self, data: str) -> None:
        self.open.parts.append(data)


def _links(node: Node, pattern: str) -> list[str]:
    return [a.attrs["href"] for a in node.find("a", attr="href") if re.search(pattern, a.attrs["href"], re.I)]


def _meta(root: Node, key: str, value: str) -> str | None:
    return next((m.attrs.get("content", "").strip() for m in root.find("meta") if m.attrs.get(key, "").lower() == value), None)


def _title(root: Node) -> str:
    heading = next((n.text() for n in root.find("title")), "")
    return _meta(root, "property", "og:title") or heading


_S, _I = pa.string(), pa.int32()


def fed_year_papers(pages: DataFrame, series: str, url: str = "url", body: str = "html") -> DataFrame:
    """page_url, pos, year, seq, month, landing_url, title of the papers of a
    year page: each badge of the series, and the time and heading beside it."""

    def of(u: str, h: str) -> list[tuple]:
        out = []
        for badge in Tree(h).root.find("span", f"badge--{series}"):
            number, block = re.search(FED_NUMBER, badge.text()), badge.parent
            head = next(block.find("h5"), None)
            link = head and next(head.find("a", attr="href"), None)
            if number and link:
                time = next(block.find("time"), None)
                out.append((len(out), int(number[1]), int(number[2]), time.attrs.get("datetime") if time else None, urls.absolute(u, link.attrs["href"]), link.text()))
        return out

    rows = html._parse(pages, url, body, of, "page_url string, pos int, year int, seq int, stamp string, landing_url string, title string", [_S, _I, _I, _I, _S, _S, _S])
    month = F.when(F.trim("stamp").rlike(r"(?i)^[a-z]+\s+\d{4}$"), dates.month_text_date(F.col("stamp"))["date"])
    return rows.select("page_url", "pos", "year", "seq", month.alias("month"), "landing_url", "title")


def fed_landings(pages: DataFrame, url: str = "url", body: str = "html") -> DataFrame:
    """page_url, published, pdf_url: the publication date MM-DD-YYYY, and the
    paper's file, a PDF before a PostScript file."""

    def of(u: str, h: str) -> list[tuple]:
        root = Tree(h).root
        files = sorted(_links(root, FED_FILE), key=lambda x: not x.lower().endswith(".pdf"))
        return [(_meta(root, "name", "citation_publication_date"), urls.absolute(u, files[0]) if files else None)]

    rows = html._parse(pages, url, body, of, "page_url string, stamp string, pdf_url string", [_S] * 3)
    return rows.select("page_url", F.try_to_date(F.nullif(F.regexp_extract(F.coalesce("stamp", F.lit("")), r"^\s*(\d{1,2}-\d{1,2}-\d{4})\s*$", 1), F.lit("")), "M-d-yyyy").alias("published"), "pdf_url")


def boe_site_papers(pages: DataFrame, url: str = "url", body: str = "html") -> DataFrame:
    """year, slug, paper_url, derived_pdf of the papers that site maps link to,
    each once."""
    links = html.page_links(pages, url, body)
    part = lambda k: F.regexp_extract("href", f"(?i){BOE_PAGE}", k)
    hits = links.select("page_url", "pos", "link_url", part(1).alias("year"), F.lower(part(2)).alias("slug")).where("slug <> ''")
    one = hits.groupBy("year", "slug").agg(F.min(F.struct("page_url", "pos", "link_url")).alias("first"))
    derived = F.concat(F.lit(BOE_MEDIA), F.col("year"), F.lit("/"), F.col("slug"), F.lit(".pdf"))
    return one.select(F.col("year").cast("int").alias("year"), "slug", F.col("first.link_url").alias("paper_url"), derived.alias("derived_pdf"))


def boe_papers(pages: DataFrame, url: str = "url", body: str = "html") -> DataFrame:
    """page_url, published, title, pdf_url of paper pages that have a file."""

    def of(u: str, h: str) -> list[tuple]:
        root = Tree(h).root
        files = _links(root, BOE_FILE) or re.findall(BOE_FILE, h, re.I)
        if not files:
            return []
        day = re.search(BOE_PUBLISHED, h, re.I)
        return [(day and day[1], _title(root) or u.rpartition("/")[2], urls.absolute(u, files[0]))]

    rows = html._parse(pages, url, body, of, "page_url string, day string, title string, pdf_url string", [_S] * 4)
    return rows.select("page_url", dates.month_text_date(F.col("day"))["date"].alias("published"), "title", "pdf_url")


def buba_items(pages: DataFrame, url: str = "url", body: str = "html") -> DataFrame:
    """page_url, pos, title, pdf_url, paper_url of a result page's items; an
    item has a file, or a page that has it, or both."""

    def of(u: str, h: str) -> list[tuple]:
        out = []
        for item in Tree(h).root.find(css=BUBA_ITEM):
            files = [x for x in _links(item, BUBA_FILE) if re.search(urls.BUBA_FILE, x, re.I)]
            # The page's pattern is read with its case.
            page = next((x for x in _links(item, BUBA_PAGE) if re.search(BUBA_PAGE, x)), None)
            if files or page:
                title = next(item.find(css=BUBA_TITLE), None)
                out.append((len(out), title.text() if title else "", urls.absolute(u, files[0]) if files else None, urls.absolute(u, page) if page else None))
        return out

    return html._parse(pages, url, body, of, "page_url string, pos int, title string, pdf_url string, paper_url string", [_S, _I, _S, _S, _S])


def buba_papers(pages: DataFrame, url: str = "url", body: str = "html") -> DataFrame:
    """page_url, published, title, pdf_url: the day in the file's name, else the
    first DD.MM.YYYY of the page."""

    def of(u: str, h: str) -> list[tuple]:
        file = re.search(BUBA_FILE, h, re.I)
        if not file:
            return []
        day = re.search(BUBA_DAY, h)
        return [(day and day[1], _title(Tree(h).root), urls.absolute(u, file[0]))]

    rows = html._parse(pages, url, body, of, "page_url string, day string, title string, pdf_url string", [_S] * 4)
    own = F.try_to_date(F.nullif(F.regexp_extract("pdf_url", r"/(\d{4}-\d{2}-\d{2})-dkp", 1), F.lit("")), "yyyy-MM-dd")
    return rows.select("page_url", F.coalesce(own, F.try_to_date("day", "d.M.yyyy")).alias("published"), "title", "pdf_url")


def section_documents(wanted: DataFrame, snapshots: DataFrame, body: str = "html") -> DataFrame:
    """``wanted`` (url of a section's yearly include, ...) with documents, an
    array in page order; null where the include is not served."""
    served = snapshots.join(wanted.select("url").distinct(), "url", "left_semi")
    links = html.page_links(served, "url", body)
    ends = F.lower("href")
    hit = links.where(F.endswith(ends, F.lit(INCLUDE_ENDS[0])) | F.endswith(ends, F.lit(INCLUDE_ENDS[1])))
    found = hit.groupBy(F.col("page_url").alias("url")).agg(F.sort_array(F.collect_list(F.struct("pos", "link_url"))).alias("_f"))
    none = F.array().cast("array<string>")
    known = served.select("url").distinct().join(found, "url", "left").select("url", F.coalesce(F.col("_f.link_url"), none).alias("documents"))
    return wanted.join(known, "url", "left")


def legacy_index(pages: DataFrame, contains: str = "", url: str = "url", body: str = "html") -> DataFrame:
    """page_url, pos, date, title, link_url of the PDF links of an old index."""
    links = html.page_links(pages, url, body).where(F.endswith(F.lower("href"), F.lit(".pdf")) & F.contains("href", F.lit(contains)))
    eight = F.nullif(F.regexp_extract("href", r"\d{8}", 0), F.lit(""))
    return links.select("page_url", "pos", F.try_to_date(eight, "yyyyMMdd").alias("date"), F.coalesce(F.nullif("text", F.lit("")), "href").alias("title"), "link_url")


def enumerate_series(items: DataFrame, max_pages: int = 80) -> DataFrame:
    """series, paper_id, title, page, pos over the pages (series, page from 1,
    pos, paper_id, title) of series listings, up to the first page that is
    missing or has no new paper, ``max_pages`` at most; a paper counts where it
    is seen first."""
    first = items.where(F.col("page") <= max_pages).groupBy("series", "paper_id").agg(F.min(F.struct("page", "pos", "title")).alias("_f"))
    pages = first.select("series", F.col("_f.page").alias("page")).distinct()
    # Pages with something new that follow each other from the first on.
    good = pages.withColumn("_n", F.row_number().over(Window.partitionBy("series").orderBy("page"))).where("page = _n").drop("_n")
    return first.select("series", "paper_id", "_f.*").join(good, ["series", "page"]).select("series", "paper_id", "title", "page", "pos")
