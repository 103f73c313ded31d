"""URL filters: a temporal list join, in DataFrame functions only.

List entries are dated events: a pattern (a host, with all hosts below it, and
an optional path prefix) is added to or removed from a category.  Events become
validity intervals; each capture is held against the entries that were active
at its fetch time, as of that time.

Hosts are reduced to distinct ones before they meet the list, so a host with a
third of all captures costs one row there.  Its intervals then join the captures
by host, as of their time; Spark's skew join splits the hot host, and no entries
are gathered in one row, however many a domain has.  Nothing is broadcast by a
hint.

Defined results: null, empty or hostless URLs have host '' and are never
blocked; captures without fetch time are never blocked; of events of one
pattern and category on one date the removals come first, so an entry both
removed and added that day is active; repeated events change nothing; repeated
captures give repeated rows; empty tables give empty results, an empty list
blocks nothing; other columns pass by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, others

_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.regexp_replace(F.lower(F.regexp_extract(url, _HOST, 1)), r"\.+$", ""), F.lit(""))


def path_of(url: Column) -> Column:
    path = F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit(""))
    return F.when(path == "", F.lit("/")).otherwise(path)


def intervals(events: DataFrame) -> DataFrame:
    """events (host, prefix, category, action 'add' or 'remove', dated) to
    validity intervals (host, prefix, category, valid_from, valid_to), the end
    excluded and null where the entry is still active."""
    e = events.select(F.lower("host").alias("host"), F.coalesce("prefix", F.lit("/")).alias("prefix"), F.coalesce("category", F.lit("")).alias("category"), F.col("action"), F.col("dated").cast("timestamp").alias("valid_from")).where("host is not null and valid_from is not null and action in ('add', 'remove')")
    order = Window.partitionBy("host", "prefix", "category").orderBy("valid_from", F.desc("action"))
    e = e.withColumn("valid_to", F.lead("valid_from").over(order))
    return e.where("action = 'add' and (valid_to is null or valid_to > valid_from)").drop("action")


def filter_urls(captures: DataFrame, events: DataFrame) -> DataFrame:
    """All columns of ``captures`` (url, fetched_at, ...), and host, blocked,
    n_active (entries), categories (sorted, comma-joined), listed_since."""
    names = others(captures, "host", "blocked", "n_active", "categories", "listed_since")
    given = captures.select(F.struct(*names).alias("_row"), host_of(F.col("url")).alias("_host"), path_of(F.col("url")).alias("_path"), F.col("fetched_at").cast("timestamp").alias("_at"))
    # Captures of one page at one time are asked once.  Tables of their own, so
    # that Spark can split a hot host in the joins.
    asked = materialize(given.where("_host <> '' and _at is not null").select("_host", "_path", "_at").distinct())
    hosts = asked.select("_host").distinct()
    labels = F.split("_host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    above = hosts.select("_host", F.explode(above).alias("_above"))
    listed = above.join(intervals(events), F.col("_above") == F.col("host"))
    listed = materialize(listed.select(F.col("_host").alias("_listed"), "prefix", "category", "valid_from", "valid_to"))
    active = (F.col("valid_from") <= F.col("_at")) & (F.col("valid_to").isNull() | (F.col("_at") < F.col("valid_to")))
    hit = asked.join(listed, (F.col("_host") == F.col("_listed")) & active & F.startswith(F.col("_path"), F.col("prefix")))
    made = [F.count(F.lit(1)).alias("_n"), F.array_join(F.array_sort(F.collect_set("category")), ",").alias("_kinds"), F.min("valid_from").alias("_since")]
    found = materialize(hit.groupBy(F.col("_host").alias("_h"), F.col("_path").alias("_p"), F.col("_at").alias("_a")).agg(*made))
    out = given.join(found, (F.col("_host") == F.col("_h")) & (F.col("_path") == F.col("_p")) & (F.col("_at") == F.col("_a")), "left")
    n = F.coalesce("_n", F.lit(0))
    return out.select(
        *[F.col("_row")[c].alias(c) for c in names],
        F.col("_host").alias("host"),
        (n > 0).alias("blocked"),
        n.cast("long").alias("n_active"),
        F.coalesce("_kinds", F.lit("")).alias("categories"),
        F.col("_since").alias("listed_since"),
    )


def dated_entries(pages: DataFrame) -> DataFrame:
    """The dated list of the op3 query, made by a rule from the hosts at hand:
    every host is listed for a while by the digits of its md5, some twice; a
    third of the hosts have a path entry, and two parent domains an entry."""
    spark = pages.sparkSession
    h = pages.select(host_of(F.col("url")).alias("host")).where("host <> ''").distinct().withColumn("h", F.conv(F.substring(F.md5("host"), 1, 6), 16, 10).cast("long"))
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    added = F.col("h") % 200
    removed = added + 30 + F.col("h") % 61
    kind = F.element_at(F.array(F.lit("spam"), F.lit("malware"), F.lit("adult")), (F.col("h") % 3 + 1).cast("int"))
    event = lambda prefix, category, action, n: F.struct(F.lit(prefix).alias("prefix"), category.alias("category"), F.lit(action).alias("action"), day(n).alias("dated"))
    some = F.array(
        event("/", kind, "add", added),
        F.when(F.col("h") % 2 == 0, event("/", kind, "remove", removed)),
        F.when(F.col("h") % 4 == 0, event("/", kind, "add", removed + 20)),
        F.when(F.col("h") % 3 == 0, event("/fr/", F.lit("geo"), "add", F.col("h") % 97)),
    )
    own = h.select("host", F.explode(some).alias("e")).where("e is not null").select("host", "e.prefix", "e.category", "e.action", "e.dated")
    parents = spark.sql("""select * from values ('example.org', '/', 'parked', 'add', date'2024-03-01'), ('example.org', '/', 'parked', 'remove', date'2024-05-01'),
        ('example.com', '/de/', 'geo', 'add', date'2024-02-10'), ('example.com', '/de/', 'geo', 'remove', date'2024-09-01') as t(host, prefix, category, action, dated)""")
    return own.unionByName(parents)
