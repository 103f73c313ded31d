"""More of the ledger's queries: keys and dates of records, saving, recovery,
migration and retrieval on the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone import dims
from quillstone.functions import dates, urls
from quillstone.operators import coverage, dedup, discovery, matching, rag, recovery
from quillstone.plans.catalogue import _NATIVE, _PART, _parts, day, query
from quillstone.sources import catalogues, html, ledger


def text_of(*parts) -> F.Column:
    return F.concat(*[p if isinstance(p, F.Column) else F.col(p).cast("string") if not p.startswith("'") else F.lit(p[1:]) for p in parts])


@query("q54_migration_summary", f"""with l as ({_PART}), n as {_NATIVE}, u as (select url_norm, min(p_partkey) as seq from n group by 1),
ti as (select title_norm, min(p_partkey) as seq from n group by 1 having count(*) = 1),
m as (select l.*, n.p_partkey is not null as k, u.seq is not null as uu, ti.seq is not null as tt, coalesce(n.p_partkey, u.seq, ti.seq) as hit from l left join n on n.key = l.key left join u on u.url_norm = l.url_norm left join ti on ti.title_norm = l.title_norm)
select count(*) as manifest_total, count(*) filter (k) as matched_key, count(*) filter (not k and uu) as matched_url, count(*) filter (not k and not uu and tt) as matched_title,
count(*) filter (hit is not null and title_norm like 'blue%') as already_day, count(*) filter (hit is null) as unmatched_manifest, (select count(distinct url_norm) from n) as native_total,
(select count(distinct url_norm) from n where url_norm not in (select n2.url_norm from n n2 join m on m.hit = n2.p_partkey)) as native_only from m""")  # fmt: skip
def _(t):
    left, native = _parts(t)
    matched = matching.match_cascade(left, native, "p_partkey").withColumn("date_source", F.when(F.startswith("title_norm", F.lit("blue")), "bank_site"))
    return matching.migration_summary(matched, native)


@query("q55_catalogue_coverage", """select source as bank, count(*) as repec_total, count(*) filter (lang in ('en', 'de') or n_chars > 3000) as covered, count(*) filter (lang not in ('en', 'de') and n_chars > 3000) as recovered_pagefetch,
count(*) filter (lang not in ('en', 'de') and n_chars <= 3000 and (1990 + doc_id % 40) between 2024 and 2025) as missing_recent,
count(*) filter (lang not in ('en', 'de') and n_chars <= 3000 and not (1990 + doc_id % 40) between 2024 and 2025) as missing_legacy from documents group by source""")
def _(t):
    entries = t("documents").select(F.col("source").alias("bank"), text_of((1990 + F.col("doc_id") % 40).cast("string"), "'0001").alias("paper_id"), F.when(F.col("lang").isin("en", "de"), "key").alias("tier"), (F.col("n_chars") > 3000).alias("recovered"))
    return coverage.catalogue_coverage(entries, F.lit("2024-06-30").cast("date"))


@query("q56_action_counts", "select user_id, count(*) filter (event_type = 'click') as click, count(*) filter (event_type = 'error') as error, count(*) filter (event_type = 'none') as none from events group by user_id")
def _(t):
    return coverage.action_counts(t("events"), "user_id", "event_type", ["click", "error", "none"])


@query("q57_first_working", """with u as (select o_orderkey, unnest([o_custkey + 1500, o_custkey, o_custkey // 2]) as id, unnest([0, 1, 2]) as pos from orders)
select o_orderkey, min_by(id, pos)::varchar as url from u where id in (select c_custkey from customer where c_mktsegment <> 'MACHINERY') group by o_orderkey""")
def _(t):
    tries = F.array(*[c.cast("string") for c in (F.col("o_custkey") + 1500, F.col("o_custkey"), F.floor(F.col("o_custkey") / 2))])
    working = t("customer").where("c_mktsegment <> 'MACHINERY'").select(F.col("c_custkey").cast("string").alias("url"))
    return dedup.first_working(t("orders"), "o_orderkey", tries, working)


@query("q58_reindex_decisions", """with l as (select distinct 'd' || user_id as doc_id, event_type || floor(value)::int as sha from events where event_type = 'signup'),
r as (select event_id, 'd' || (user_id + 20) as doc_id, value > 3 as file_exists, 'signup' || floor(value)::int as sha from events where event_type = 'view')
select event_id, case when doc_id in (select doc_id from l) then 'exists' when not file_exists then 'missing_file' when sha in (select sha from l) then 'duplicate_content' else 'reindexed' end as status from r""")
def _(t):
    e = t("events")
    sha = text_of("'signup", F.floor("value").cast("string"))
    held = e.where("event_type = 'signup'").select(text_of("'d", "user_id").alias("doc_id"), sha.alias("sha256"))
    rows = e.where("event_type = 'view'").select("event_id", text_of("'d", (F.col("user_id") + 20).cast("string")).alias("doc_id"), (F.col("value") > 3).alias("file_exists"), sha.alias("sha256"))
    return dedup.reindex_decisions(rows, held).select("event_id", "status")


@query("q59_top_by_volume", "select source, n, row_number() over (order by n desc, source) as place from (select source, count(*) as n from documents group by source)")
def _(t):
    n = t("documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "source")).cast("long"))


_STAMPS = "select user_id::varchar as url, strftime(ts, '%Y%m%d%H%M%S') as stamp, value from events"


def _captures(t) -> DataFrame:
    return t("events").select(F.col("user_id").cast("string").alias("original"), F.date_format("ts", "yyyyMMddHHmmss").alias("stamp"), "value")


@query("q60_capture_bounds", f"select url, min(stamp) as first_stamp, max(stamp) as latest_stamp from ({_STAMPS}) group by url")
def _(t):
    return catalogues.capture_bounds(_captures(t))


@query("q61_stamp_date", "select event_id, strftime(ts, '%Y-%m-%d') as day, 'https://web.archive.org/web/' || strftime(ts, '%Y%m%d%H%M%S') || 'id_/http://x/' || user_id as raw_url from events")
def _(t):
    stamp = F.date_format("ts", "yyyyMMddHHmmss")
    return t("events").select("event_id", day(dates.stamp_date(stamp)).alias("day"), urls.archive_url(stamp, text_of("'http://x/", "user_id")).alias("raw_url"))


@query("q62_row_key", "select p_partkey, case when p_size > 25 then 'RePEc:a:' || p_type || ':' || p_partkey else 't:' || p_name end as key from part")
def _(t):
    page = F.when(F.col("p_size") > 25, text_of("'https://x/p/a/", "p_type", "'/", "p_partkey", "'.html"))
    return t("part").select("p_partkey", urls.row_key(page, F.lit(""), F.col("p_name")).alias("key"))


@query("q63_partial_date", "select o_orderkey, case o_orderpriority when '1-URGENT' then strftime(o_orderdate, '%Y-01-01') when '2-HIGH' then strftime(o_orderdate, '%Y-%m-01') else strftime(o_orderdate, '%Y-%m-%d') end as day from orders")
def _(t):
    shape = F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "yyyy")).when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "yyyy/M")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t("orders").select("o_orderkey", day(dates.partial_date(shape)).alias("day"))


@query("q64_first_date_like", "select o_orderkey, case when year(o_orderdate) >= 2000 then strftime(o_orderdate, '%Y-%m-%d') end as day from orders")
def _(t):
    href = text_of("'/x/", F.date_format("o_orderdate", "yyyy_MM_dd"), "'/p.html")
    return t("orders").select("o_orderkey", day(dates.first_date_like(F.lit("/none/"), href)).alias("day"))


@query("q65_year_in_path", "select o_orderkey, strftime(o_orderdate, '%Y-01-01') as day from orders")
def _(t):
    return t("orders").select("o_orderkey", day(dates.year_in_path(text_of("'http://x/a/", F.date_format("o_orderdate", "yyyy"), "'/", "o_orderkey", "'/1999/"))).alias("day"))


@query("q66_paper_keys", """select o_orderkey, 'D1' as doc_type, o_orderkey::int as number, 'feds:' || year(o_orderdate) || ':' || (o_custkey + 1) as fed, 'ifdp:' || (o_custkey + 1) as ifdp, (o_custkey + 1) % 900 + 1 || '/' || year(o_orderdate) as buba from orders""")
def _(t):
    year = F.date_format("o_orderdate", "yyyy")
    ecb = urls.ecb_number(text_of("'https://e/pub/pdf/scpwps/ecb.wp", "o_orderkey", "'~9f.en.pdf"))
    n = (F.col("o_custkey") + 1).cast("string")
    small = ((F.col("o_custkey") + 1) % 900 + 1).cast("string")
    fed = urls.fed_key(text_of("'https://f/econres/feds/files/", year, n, "'pap.pdf"))
    return t("orders").select("o_orderkey", ecb["doc_type"].alias("doc_type"), ecb["number"].alias("number"), fed.alias("fed"), urls.fed_key(text_of("'https://f/econresdata/ifdp/2014/files/ifdp", n, "'.pdf")).alias("ifdp"), urls.buba_key(text_of("'https://b/", year, "'-01-02-dkp-", small)).alias("buba"))


@query("q67_target_path", "select doc_id, 'raw/' || source || '/' || lang || '/' || (case when n_chars > 1000 then 2020 else 0 end) || '/' || doc_id || case when lang = 'en' then '.html' else '.pdf' end as path from documents")
def _(t):
    year = F.when(F.col("n_chars") > 1000, 2020)
    mime = F.when(F.col("lang") == "en", "text/html").otherwise("application/pdf")
    return t("documents").select("doc_id", urls.target_path(F.col("source"), F.col("lang"), year, F.col("doc_id").cast("string"), mime, F.lit("")).alias("path"))


@query("q68_page_handle", "select page_id, 'RePEc:' || split_part(url, '/', 4) || ':s:' || page_id as handle from pages")
def _(t):
    return t("pages").select("page_id", urls.handle_from_page(text_of("'https://x/p/", F.split_part("url", F.lit("/"), F.lit(4)), "'/s/", "page_id", "'.html")).alias("handle"))


@query("q69_citation", "select s_suppkey, n_name || ', ' || s_name || ', ' || strftime(date '2020-01-01' + s_nationkey, '%Y-%m-%d') || '. Source: https://x/' || s_suppkey as citation from supplier join nation on n_nationkey = s_nationkey")
def _(t):
    s = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    d = F.date_add(F.lit("2020-01-01").cast("date"), F.col("s_nationkey").cast("int"))
    return s.select("s_suppkey", rag.citation(F.col("n_name"), F.col("s_name"), d, text_of("'https://x/", "s_suppkey")).alias("citation"))


@query("q70_metadata_join", "select c_custkey, n_name as bank_name, r_name as country from customer left join nation on n_nationkey = c_nationkey left join region on r_regionkey = n_regionkey")
def _(t):
    banks = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").cast("string").alias("bank_code"), F.col("n_name").alias("name"), F.col("r_name").alias("country"))
    none = [F.lit(None).cast(kind).alias(n) for n, kind in (("title", "string"), ("date", "date"), ("year", "int"), ("source_url", "string"), ("pdf_url", "string"))]
    rows = t("customer").select(F.col("c_custkey").alias("doc_id"), F.col("c_nationkey").cast("string").alias("bank_code"), F.col("c_mktsegment").alias("doc_type"), *none)
    types = dims.doc_types(rows.sparkSession)
    return rag.metadata(rows, banks, types).select(F.col("doc_id").alias("c_custkey"), "bank_name", "country")


@query("q71_inventory", "select 'doc_type' as part, lang as name, count(*) as n from documents group by lang union all select 'provenance', source, count(*) from documents group by source union all select 'language', lang, count(*) from documents group by lang")
def _(t):
    return coverage.inventory(t("documents").select(F.col("lang").alias("doc_type"), F.col("source").alias("provenance"), F.col("lang").alias("language")))


@query("q72_disk_matches", """select o_custkey::varchar as doc_id, min(o_orderkey) as seq, 'path/' || o_custkey as path from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0) group by o_custkey""")
def _(t):
    found = t("orders").select(F.col("o_custkey").cast("string").alias("doc_id"), F.col("o_orderkey").alias("seq"))
    held = t("customer").where("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("doc_id"))
    missing = dedup.unknown(found.select("doc_id").distinct(), held, "doc_id", "doc_id").withColumn("path", text_of("'path/", "doc_id"))
    return matching.disk_matches(found, missing)


@query("q73_slug_matches", """select o_orderkey, substr(sha1(o_orderpriority || '|C1|http://x/' || o_orderkey), 1, 16) as doc_id, o_orderpriority as bank_code from orders where o_orderstatus = 'F'""")
def _(t):
    o = t("orders").select("o_orderkey", F.col("o_orderpriority").alias("bank_code"), F.year("o_orderdate").alias("year"), text_of("'http://x/", "o_orderkey").alias("pdf_url"), F.to_date("o_orderdate").alias("date"), "o_orderstatus")
    files = o.where("o_orderstatus = 'F'").select("bank_code", "year", urls.doc_id(F.col("bank_code"), F.lit("C1"), F.col("pdf_url")).alias("doc_id"))
    return matching.slug_matches(files, o.select("year", "pdf_url", "date", "o_orderkey")).select("o_orderkey", "doc_id", "bank_code")


@query("q74_known_urls", "select distinct unnest([o_custkey::varchar, 'a' || o_orderpriority, 'b' || year(o_orderdate)]) as url from orders")
def _(t):
    return dedup.known_urls(t("orders").select(F.col("o_custkey").cast("string").alias("pdf_url"), F.array(text_of("'a", "o_orderpriority"), text_of("'b", F.date_format("o_orderdate", "yyyy")), F.lit("")).alias("alt_urls")))


@query("q75_native_only_routing", "select event_type, user_id, case when value < 10 then 'native' else 'shared' end as tag from events where event_type in ('click', 'view')")
def _(t):
    e = t("events").select(F.col("event_type").alias("doc_type"), "user_id", "value")
    out = discovery.route(e.where("value < 10").drop("value"), e.where("not value < 10").drop("value"), ["click", "view"])
    return out.select(F.col("doc_type").alias("event_type"), "user_id", "tag")


@query("q76_status_counts", "select event_type as status, count(*) as n from events group by 1")
def _(t):
    return dedup.status_counts(t("events").select(text_of("event_type", "': ", "user_id").alias("status")))


@query("q77_last_line", "select 'k' || user_id as key, max_by(event_type, event_id) as event_type, max_by(value, event_id) as value from events group by user_id")
def _(t):
    rows = t("events").select(text_of("'k", "user_id").alias("key"), "event_type", "value", F.col("event_id").alias("pos"))
    return ledger.last_lines(rows, "key", "pos").select("key", "event_type", "value")


@query("q78_failure_inventory", "select 'u' || user_id as pdf_url, min(event_id) as pos, max_by(event_type, event_id) as label from events where event_type <> 'view' group by user_id")
def _(t):
    rows = t("events").where("event_type <> 'view'").select(text_of("'u", "user_id").alias("pdf_url"), F.col("event_id").alias("pos"), F.col("event_type").alias("label"))
    return ledger.inventory(rows).select("pdf_url", "pos", "label")


@query("q79_recover_dates", """with c as (select user_id, min(ts) as ts from events where event_type = 'view' group by 1),
i as (select user_id, max(ts) as ts from events where event_type = 'signup' and value > 20 group by 1),
r as (select o_orderkey, o_custkey, o_orderpriority, i.ts as its, c.ts as cts, case when o_orderstatus = 'F' then timestamp '2024-01-01' else timestamp '2023-12-01' end as month,
  case when o_orderkey % 4 = 0 then make_date(2024, 1, (o_orderkey % 28 + 1)::int) end as pdf from orders left join i on i.user_id = o_custkey left join c on c.user_id = o_custkey where o_orderpriority <> '5-LOW'),
w as (select *, case when date_trunc('month', pdf) = month and day(pdf) <> 1 then pdf end as p, case when date_trunc('month', cts) = month and day(cts) <> 1 then cts end as a from r)
select o_orderkey::varchar as doc_id, strftime(coalesce(its, p, a), '%Y-%m-%d') as day, case when its is not null then 'repec' when p is not null then 'pdf_meta' else 'wayback' end as date_source from w
where coalesce(its, p, a) is not null""")
def _(t):
    o = t("orders").select(F.col("o_orderkey").cast("string").alias("doc_id"), F.when(F.col("o_orderpriority") == "5-LOW", "C1").otherwise("D1").alias("doc_type"), F.when(F.col("o_orderstatus") == "F", F.lit("2024-01-01")).otherwise("2023-12-01").cast("date").alias("date"), F.lit("month").alias("date_precision"), F.lit("").alias("source_url"), F.col("o_custkey").cast("string").alias("repec_handle"), F.lit("").alias("title_norm"), text_of("'v", "o_custkey").alias("pdf_url"), F.lit(None).cast("array<string>").alias("alt_urls"), F.col("o_orderkey").alias("seq"), "o_custkey")
    # A key for each row: the index is looked up by customer.
    e = t("events")
    index = e.where("event_type = 'signup' and value > 20").groupBy(F.col("user_id")).agg(F.max("ts").alias("ts"))
    index = o.join(index, F.col("o_custkey") == F.col("user_id")).select(text_of("'h", "doc_id").alias("key"), day("ts").alias("date"), F.lit("repec").alias("date_source"))
    rows = o.withColumn("repec_handle", text_of("'h", "doc_id")).drop("o_custkey")
    captures = e.where("event_type = 'view'").select(text_of("'v", "user_id").alias("original"), F.date_format("ts", "yyyyMMddHHmmss").alias("stamp"))
    made = F.concat(F.lit("%PDF-1.4 /CreationDate (D:202401"), F.lpad((F.col("seq") % 28 + 1).cast("string"), 2, "0"), F.lit("120000Z)"))
    bodies = rows.where("seq % 4 = 0").select("doc_id", F.encode(made, "UTF-8").alias("body"))
    return recovery.recover_dates(rows, index, captures, bodies).select("doc_id", day("new_date").alias("day"), "date_source")


@query("q80_error_text", "select event_id, left('Error: ' || replace(props, chr(10), ' '), 500) as error from events where event_type = 'error'")
def _(t):
    return t("events").where("event_type = 'error'").select("event_id", urls.error_text(F.lit("Error"), F.col("props")).alias("error"))


@query("q81_title_fallback", "select page_id, case when length(h) > 60 then h else regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '([^/]*)$', 1) end as title from (select page_id, url, regexp_extract(html, '<h1>([^<]*)</h1>', 1) as h from pages)")
def _(t):
    h = F.regexp_extract("html", "<h1>([^<]*)</h1>", 1)
    return t("pages").select("page_id", F.coalesce(F.when(F.length(h) > 60, h), urls.last_segment(F.col("url"))).alias("title"))


@query("q82_within_run", "select min(event_id) as event_id, case when value > 2 then user_id end as key from events group by case when value > 2 then user_id end, case when value > 2 then 0 else event_id end")
def _(t):
    rows = t("events").select("event_id", F.when(F.col("value") > 2, F.col("user_id")).alias("key"))
    return discovery.within_run(rows, "key", "event_id")


@query("q83_sitemap_entries", "select page_id, url as loc, '2024-01-' || lpad((1 + page_id % 28)::varchar, 2, '0') as lastmod from pages")
def _(t):
    p = t("pages")
    stamp = text_of("'2024-01-", F.lpad((1 + F.col("page_id") % 28).cast("string"), 2, "0"), "'T23:59:59+02:00")
    body = text_of("'<urlset><url><loc>", F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), "'</loc><lastmod>", stamp, "'</lastmod></url></urlset>")
    out = catalogues.sitemap_entries(p.select(F.col("page_id").cast("string").alias("url"), body.alias("body")))
    return out.select(F.col("page_url").cast("long").alias("page_id"), "loc", day("lastmod").alias("lastmod"))


@query("q84_speech_slugs", "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders")
def _(t):
    loc = text_of("'https://x/review/r", F.date_format("o_orderdate", "yyMMdd"), "'.pdf")
    out = catalogues.speech_entries(t("orders").select("o_orderkey", loc.alias("loc")))
    both = t("orders").select("o_orderkey", loc.alias("pdf_url")).join(out.select("pdf_url", "date").distinct(), "pdf_url")
    return both.select("o_orderkey", day("date").alias("day"))


@query("q85_speaker_half", "select item_id, regexp_extract(text, '^(.*?)\\s+(?:at|during|to|before|in|on|hosted by|organised by|organized by|sponsored by|via|by videoconference|by video conference)\\s', 1, 'si') as half from benchmark where regexp_matches(text, '\\s(?:at|during|to|before|in|on|hosted by|organised by|organized by|sponsored by|via|by videoconference|by video conference)\\s', 'i')")
def _(t):
    half = html.speaker_half(F.col("text"))
    return t("benchmark").select("item_id", half.alias("half"), "text").where("half <> text").drop("text")
