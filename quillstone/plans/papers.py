"""Queries of the publishers' paper pages, over pages that are written from the
supplied tables, with SQL that says what they must give."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.functions import urls
from quillstone.operators import discovery
from quillstone.plans.catalogue import day, query
from quillstone.sources import html, papers


def _page(rows: DataFrame, key: str, item: str, order: str, url: str) -> DataFrame:
    """url, html: the items (SQL text) of each key as one page."""
    made = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, F.expr(item).alias("item")))).alias("items"))
    page = F.concat(F.lit("<html><body><div>"), F.array_join(F.col("items.item"), "\n"), F.lit("</div></body></html>"))
    return made.select(F.expr(url).alias("url"), page.alias("html"))


@query("q86_fed_year_page", """select 'https://f/feds/' || o_custkey || '.htm' as page_url, (row_number() over (partition by o_custkey order by o_orderkey) - 1)::int as pos, year(o_orderdate)::int as year, (o_orderkey % 997)::int as seq,
strftime(o_orderdate, '%Y-%m-01') as month, 'https://f/econres/feds/' || o_orderkey || '.htm' as landing_url, 'On ' || o_orderpriority as title from orders""")
def _(t):
    item = """concat('<div class="row"><time datetime="', date_format(o_orderdate, 'MMMM yyyy'), '">x</time><span class="badge badge--feds">FEDS ', date_format(o_orderdate, 'yyyy'), '-', lpad(o_orderkey % 997, 3, '0'),
      '</span><span class="badge badge--other">no</span><h5><a href="/econres/feds/', o_orderkey, '.htm">On <b>', o_orderpriority, '</b></a></h5></div>')"""
    out = papers.fed_year_papers(_page(t("orders"), "o_custkey", item, "o_orderkey", "concat('https://f/feds/', o_custkey, '.htm')"), "feds")
    return out.withColumn("month", day("month"))


@query("q87_fed_landing", """select 'https://f/' || o_orderkey as page_url, case when o_orderkey % 5 <> 0 then strftime(o_orderdate, '%Y-%m-%d') end as published,
case when o_orderkey % 3 = 0 then 'https://f/pubs/feds/' || year(o_orderdate) || '/' || o_orderkey || '/' || o_orderkey || 'pap.pdf' when o_orderkey % 3 = 1 then 'https://f/econres/feds/files/' || o_orderkey || 'pap.ps' end as pdf_url from orders""")
def _(t):
    page = """concat('<head><meta name="citation_publication_date" content="', if(o_orderkey % 5 = 0, date_format(o_orderdate, 'yyyy'), date_format(o_orderdate, 'MM-dd-yyyy')), '"></head><a href="/other.pdf">o</a>',
      if(o_orderkey % 3 < 2, concat('<a href="/econres/feds/files/', o_orderkey, 'pap.ps">ps</a>'), ''),
      if(o_orderkey % 3 = 0, concat('<a href=/pubs/feds/', year(o_orderdate), '/', o_orderkey, '/', o_orderkey, 'pap.pdf>pdf</a>'), ''))"""
    out = papers.fed_landings(t("orders").select(F.expr("concat('https://f/', o_orderkey)").alias("url"), F.expr(page).alias("html")))
    return out.withColumn("published", day("published"))


@query("q88_boe_papers", """select 'https://b/working-paper/2020/p' || p_partkey as page_url, case when p_size % 4 <> 0 then strftime(date '2001-01-01' + (p_partkey % 7000)::int, '%Y-%m-%d') end as published,
case when p_size % 3 = 0 then 'p' || p_partkey else p_name end as title, 'https://b/-/media/boe/files/working-paper/2020/p' || p_partkey || '.pdf' as pdf_url from part where p_size % 5 <> 0""")
def _(t):
    page = """concat(if(p_size % 3 = 0, '', concat('<meta property="og:title" content="', p_name, '">')), if(p_size % 4 = 0, '', concat('<p>Published on ', date_format(date_add(date'2001-01-01', cast(p_partkey % 7000 as int)), 'd MMMM yyyy'), '</p>')),
      if(p_size % 5 = 0, '<a href="/x.pdf">x</a>', if(p_size % 2 = 0, concat('<a href="/-/media/boe/files/working-paper/2020/p', p_partkey, '.pdf">f</a>'), concat('<script>"/-/media/boe/files/working-paper/2020/p', p_partkey, '.pdf"</script>'))))"""
    out = papers.boe_papers(t("part").select(F.expr("concat('https://b/working-paper/2020/p', p_partkey)").alias("url"), F.expr(page).alias("html")))
    return out.withColumn("published", day("published"))


@query("q89_boe_site_map", "select distinct (2000 + p_size)::int as year, 'paper-' || p_partkey % 300 as slug, 'https://b/working-paper/' || 2000 + p_size || '/paper-' || p_partkey % 300 as paper_url, 'https://www.bankofengland.co.uk/-/media/boe/files/working-paper/' || 2000 + p_size || '/paper-' || p_partkey % 300 || '.pdf' as derived_pdf from part")
def _(t):
    item = "concat('<a href=\"/working-paper/', 2000 + p_size, '/paper-', p_partkey % 300, '\">p</a><a href=\"/working-paper/about-us\">q</a><a href=\"/working-paper/2020/\">r</a>')"
    return papers.boe_site_papers(_page(t("part"), "p_brand", item, "p_partkey", "concat('https://b/sitemap/', replace(p_brand, '#', ''))"))


@query("q90_buba_items", """select 'https://d/list/' || s_nationkey as page_url, (row_number() over (partition by s_nationkey order by s_suppkey) - 1)::int as pos, s_name as title,
case when s_suppkey % 3 < 2 then 'https://d/resource/blob/' || s_suppkey || '/0af/9CD/2012-03-0' || s_suppkey % 9 + 1 || '-dkp-0' || s_suppkey || '-data.pdf' end as pdf_url,
case when s_suppkey % 3 > 0 then 'https://d/en/publications/research/discussion-papers/on-rates-' || s_suppkey end as paper_url from supplier""")
def _(t):
    item = """concat('<li class="x resultlist__item"><div><span class="teasable__title">', s_name, '</span></div>', if(s_suppkey % 3 < 2, concat('<a href="/resource/blob/', s_suppkey, '/0af/9CD/2012-03-0', s_suppkey % 9 + 1, '-dkp-0', s_suppkey, '-data.pdf">f</a>'), ''),
      if(s_suppkey % 3 > 0, concat('<a href="/en/publications/research/discussion-papers/on-rates-', s_suppkey, '">p</a>'), ''), '</li><li class="resultlist__item"><a href="/none.pdf">n</a></li>')"""
    return papers.buba_items(_page(t("supplier"), "s_nationkey", item, "s_suppkey", "concat('https://d/list/', s_nationkey)"))


@query("q91_section_includes", """select 'https://e/' || n_nationkey as url, case when n_nationkey % 3 = 0 then null else coalesce((select string_agg('https://e/' || s_suppkey || '.en.pdf', ',' order by s_suppkey) from supplier where s_nationkey = n_nationkey and s_suppkey % 2 = 0), '') end as documents from nation""")
def _(t):
    item = "concat('<a href=\"', s_suppkey, if(s_suppkey % 2 = 0, '.EN.pdf', '.de.pdf'), '\">d</a>')"
    pages = _page(t("supplier"), "s_nationkey", item, "s_suppkey", "concat('https://e/', s_nationkey)")
    every = t("nation").select(F.concat(F.lit("https://e/"), F.col("n_nationkey").cast("string")).alias("url"), "n_nationkey")
    served = every.where("n_nationkey % 3 <> 0").join(pages, "url", "left").select("url", F.coalesce("html", F.lit("<p></p>")).alias("html"))
    out = papers.section_documents(every.select("url"), served)
    return out.select("url", F.replace(F.array_join("documents", ","), F.lit(".EN."), F.lit(".en.")).alias("documents"))


@query("q92_enumerate_series", """with i as (select o_custkey as series, (row_number() over (partition by o_custkey order by o_orderkey) + 2) // 3 as page, o_orderkey % 50 as paper, o_orderkey as pos from orders),
f as (select series, paper, min(page) as page, min_by(pos, (page, pos)) as pos from i where page <= 80 group by all),
p as (select series, page, row_number() over (partition by series order by page) as n from (select distinct series, page from f))
select f.series as o_custkey, f.paper::varchar as paper_id, f.page::int as page, f.pos as o_orderkey, 't' || f.pos as title from f join p on p.series = f.series and p.page = f.page and p.page = p.n""")
def _(t):
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    items = t("orders").select(F.col("o_custkey").alias("series"), F.floor((nth + 2) / 3).cast("int").alias("page"), (F.col("o_orderkey") % 50).cast("string").alias("paper_id"), F.col("o_orderkey").alias("pos"), F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("title"))
    out = papers.enumerate_series(items)
    return out.select(F.col("series").alias("o_custkey"), "paper_id", "page", F.col("pos").alias("o_orderkey"), "title")


@query("q93_skip_counts", "select o_orderpriority as bank_code, count(*) as found, count(*) filter (o_custkey in (select c_custkey from customer where c_acctbal > 0)) as skipped from orders group by 1")
def _(t):
    known = t("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("url"))
    return discovery.skip_counts(t("orders").select(F.col("o_orderpriority").alias("bank_code"), F.col("o_custkey").alias("pdf_url")), known)


@query("q94_unknown_banks", "select distinct lower(left(n_name, 2)) as bank_code from nation where lower(left(n_name, 2)) not in ('us', 'ca', 'jp', 'fr')")
def _(t):
    wanted = t("nation").select(F.lower(F.left("n_name", F.lit(2))).alias("bank_code"))
    banks = wanted.sparkSession.createDataFrame([("us",), ("ca",), ("jp",), ("fr",)], "bank_code string")
    return discovery.unknown_banks(wanted, banks)


@query("q95_any_encoding", "select page_id, 'Größe ' || page_id as title, 'https://h/' || page_id as link_url from pages union all select page_id, 'Größe ' || page_id, null from pages where page_id % 3 = 0")
def _(t):
    made = F.concat(F.lit("<h1>Größe "), F.col("page_id").cast("string"), F.lit('</h1><a href="/'), F.col("page_id").cast("string"), F.lit('">x</a>'), F.when(F.col("page_id") % 3 == 0, '<a href="http://[x">y</a>').otherwise(""))
    body = F.when(F.col("page_id") % 2 == 0, F.encode(made, "ISO-8859-1")).otherwise(F.encode(made, "UTF-8"))
    pages = t("pages").select("page_id", F.concat(F.lit("https://h/p"), F.col("page_id").cast("string")).alias("url"), body.alias("body"))
    links = html.page_links(pages, body="body").select("page_url", "link_url")
    titles = html.page_metas(pages, body="body").select("page_url", F.col("page_title").alias("title"))
    return pages.select("page_id", F.col("url").alias("page_url")).join(links, "page_url").join(titles, "page_url").select("page_id", "title", "link_url")


@query("q96_url_dates", """select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as full, strftime(o_orderdate, '%Y-%m-01') as month, strftime(o_orderdate, '%Y-01-01') as year, strftime(o_orderdate, '%Y-%m-01') as guessed from orders where year(o_orderdate) >= 1997""")
def _(t):
    from quillstone.functions import dates

    o = t("orders").where(F.year("o_orderdate") >= 1997)
    of = lambda form, fmt: day(dates.url_date(F.concat(F.lit("https://x/20010101/ar"), F.date_format("o_orderdate", form), F.lit("en.pdf")), F.lit("2024-01-01").cast("date"), fmt))
    return o.select("o_orderkey", of("yyyyMMdd", "auto").alias("full"), of("yyyyMM", "yyyymm").alias("month"), of("yyyy", "auto").alias("year"), of("yyyyMM", "auto").alias("guessed"))


@query("q97_boe_slugs", "select p_partkey, case when p_size % 2 = 0 then 'paper-' || p_partkey end as page_slug, 'paper-' || p_partkey as file_slug from part")
def _(t):
    year = F.when(F.col("p_size") % 2 == 0, "2020/").otherwise("")
    page = F.concat(F.lit("https://b/working-paper/"), year, F.lit("Paper-"), F.col("p_partkey").cast("string"))
    file = F.concat(F.lit("https://b/-/media/boe/files/working-paper/2020/paper-"), F.col("p_partkey").cast("string"), F.lit(".PDF"))
    return t("part").select("p_partkey", urls.boe_slug(page).alias("page_slug"), urls.boe_slug(file).alias("file_slug"))


@query("q98_keys_of_handles", """select o_orderkey, case when o_custkey % 2 = 0 then 'D1' else 'D2' end as doc_type, o_orderkey::int as number, 'feds:' || year(o_orderdate) || ':' || o_custkey as fed, 'ifdp:' || o_custkey % 9000 + 100 as ifdp, strftime(o_orderdate, '%y') || 'e' || o_custkey as boj from orders""")
def _(t):
    o = t("orders")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    year, n = F.date_format("o_orderdate", "yyyy"), F.col("o_custkey")
    ecb = urls.ecb_number_of_handle(text("RePEc:ecb:ecb", F.when(n % 2 == 0, "wps").otherwise("ops"), ":", year, F.col("o_orderkey")))
    fed = urls.fed_key_of_handle(text("RePEc:fip:fedgfe:", year, "-", n))
    ifdp = urls.fed_key_of_handle(text("RePEc:fip:fedgif:", n % 9000 + 100))
    boj = urls.boj_code(text("https://j/wps/data/wp", F.date_format("o_orderdate", "yy"), "e", n, ".pdf"))
    return o.select("o_orderkey", ecb["doc_type"].alias("doc_type"), ecb["number"].alias("number"), fed.alias("fed"), ifdp.alias("ifdp"), boj.alias("boj"))
