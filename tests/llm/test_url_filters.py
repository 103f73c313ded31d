import datetime

from quillstone.llm import queries, url_filters
from tests.oracle import compare, connect


def test_query_equals_sql(spark, sf_dir):
    compare(queries.op3_url_filters(spark, sf_dir), queries.ORACLE_SQL["op3_url_filters"], connect(sf_dir))


def test_no_python_in_the_plan(spark, sf_dir):
    plan = queries.op3_url_filters(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"))


def at(day, hour=0):
    return datetime.datetime(2024, 1, day, hour)


EVENTS = [
    ("bad.com", None, "spam", "add", at(3)),
    ("bad.com", "/", "spam", "remove", at(5)),
    ("bad.com", "/", "spam", "add", at(5)),  # removed and added on a day: active
    ("bad.com", "/", "spam", "remove", at(8)),
    ("bad.com", "/", "spam", "add", at(3)),  # repeated
    ("x.bad.com", "/p/", "malware", "add", at(1)),
    ("gone.org", "/", "spam", "remove", at(1)),
    (None, "/", "spam", "add", at(1)),
]


def test_edge_cases(spark):
    events = spark.createDataFrame(EVENTS, "host string, prefix string, category string, action string, dated timestamp")
    rows = [
        ("http://bad.com/", at(2), False, ""), ("http://bad.com", at(3), True, "spam"), ("https://u:p@X.BAD.com.:80/p/q?x#y", at(6, 1), True, "malware,spam"),
        ("http://x.bad.com/pq", at(9), False, ""), ("http://x.bad.com/p/", at(9), True, "malware"), ("http://notbad.com/", at(4), False, ""), ("http://bad.com/", at(8), False, ""),
        ("http://gone.org", at(4), False, ""), (None, at(4), False, ""), ("", at(4), False, ""), ("mailto:x", at(4), False, ""), ("http://bad.com/", None, False, ""), ("http://bad.com/", at(5), True, "spam"), ("http://bad.com/", at(5), True, "spam"),
    ]
    df = spark.createDataFrame([(u, t, f"{b}{c}") for u, t, b, c in rows], "url string, fetched_at timestamp, entries string")
    got = sorted((r.url or "", str(r.fetched_at), f"{r.blocked}{r.categories}", r.entries) for r in url_filters.filter_urls(df, events).collect())
    assert len(got) == len(rows) and all(g[2] == g[3] for g in got)
    assert url_filters.filter_urls(df.limit(0), events).count() == 0
    assert url_filters.filter_urls(df, events.limit(0)).where("blocked").count() == 0
