import duckdb
import pytest

from check import compare
from dayfold.llm import queries, urls

RULES = ([("net", "/"), ("example.com", "/de/")], [("example.net", "/en/"), ("org", "/fr/")])


def expected(url):
    rest = url.split("://", 1)[1] if url is not None and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fit = [
        (len(h + p), h + p, v) for rules, v in zip(RULES, ("block", "allow")) for h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fit) if fit else (0, None, None)
    return host, path, best[1], best[2]


ODD = [
    None, "", "no scheme", "://", "http://", "http://net", "http://net/", "http://NET/x", "http://a.net?/", "http://internet/",
    "http://example.net/en", "http://example.net/en/", "http://m.Example.NET/en/x#y", "https://xexample.net/en/", "http://a.org/fr/?q=/de/",
    "http://example.com/de/a/b/c", "http://example.com/DE/", "x://y://net/", "http://é.org/fr/ü", "http://example.com//de/", "http://net/\nx",
]


def judge(spark, links, listed=()):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(links)], "page_id long, url string")
    own = spark.createDataFrame([(x,) for x in listed], "canonical string")
    return {r["page_id"]: r for r in urls.filter_urls(pages, own, urls.rules_table(spark, *RULES), ["page_id"]).collect()}


def test_rules_on_odd_urls(spark):
    got = judge(spark, ODD + ODD)
    assert len(got) == 2 * len(ODD)
    for i, url in enumerate(ODD + ODD):
        host, path, rule, verdict = expected(url)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, rule, verdict or "allow"), url


def test_listed_urls_are_blocked_and_false_hits_are_not(spark, monkeypatch):
    links = [f"https://www.s{i}.example.org/p{i}/?utm_source=x" for i in range(400)]
    listed = [f"s{i}.example.org/p{i}" for i in range(0, 400, 3)] + ["s0.example.org/p0", None]
    for bits in (1, 16):  # one bit per key lets many false hits through to the join
        monkeypatch.setattr(urls.bloom_filter, "__defaults__", (bits,))
        got = judge(spark, links, listed)
        assert [got[i]["verdict"] for i in range(400)] == ["block" if i % 3 == 0 else "allow" for i in range(400)]


def test_filter_keeps_every_listed_key_and_drops_most_others(spark):
    keys = spark.range(2000).selectExpr("cast(id as string) AS key")
    bloom = urls.bloom_filter(keys, "key")
    assert urls.possible(keys, "key", bloom).count() == 2000
    others = spark.range(10_000, 60_000).selectExpr("cast(id as string) AS key")
    assert urls.possible(others, "key", bloom).count() < 500


def test_large_lists_are_joined_by_block(spark, monkeypatch):
    monkeypatch.setattr(urls.small_side, "__defaults__", (-1,))
    keys = spark.range(500).selectExpr("cast(id as string) AS key")
    hits = urls.possible(keys, "key", urls.bloom_filter(keys, "key"))
    assert hits.count() == 500 and "BroadcastHashJoin LeftSemi" not in hits._jdf.queryExecution().optimizedPlan().toString()


def test_empty_tables(spark):
    assert judge(spark, []) == {}
    empty = spark.createDataFrame([], "rule string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.net/", "h")], "page_id long, url string, host string")
    out = urls.filter_urls(pages, spark.createDataFrame([], "canonical string"), empty, ["page_id", "host"])
    assert out.count() == 1


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_their_sql(spark, name):
    c = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        c.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.001/{table}.parquet'")
    result, _ = compare(spark, c, name, "/root/testdata/sf0.001")
    assert result.startswith("ok"), result
