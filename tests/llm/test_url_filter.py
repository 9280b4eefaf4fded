import pytest

from clinlake.llm import url_filter as uf


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.key), len(r.host)), default=None)
    return host, path, best.key if best else None, best.verdict if best else default


URLS = [
    None, "", "no scheme", "://", "http://", "http://EXAMPLE.com/en/x", "http://example.com/en", "http://www.example.com/en/?q#f",
    "http://a.b.www.example.com/en/z", "http://notexample.com/en/", "http://example.com?x=/en/", "http://x.net/es/1", "https://x.NET/fr/#a",
    "http://net/es/", "http://.net/es/", "http://x.org/", "http://com", "http://com/", "http://é.com/en/", "http://x.com/" + "p" * 5000,
    "a://b://c.com/x", "http://example.com/en/\nnew", "http://user@example.com:80/en/", "ftp://www.example.com/EN/",
]


@pytest.mark.parametrize("max_bytes", [uf.MAX_FILTER_BYTES, 0])
@pytest.mark.parametrize("rules", [uf.RULES, (uf.Rule("a.com", "/x", "block"), uf.Rule("com", "/x/yy", "allow"), uf.Rule("com", "/p", "block"))])
def test_equals_the_rules_one_by_one(spark, rules, max_bytes):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS + URLS[:3])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in uf.judge_urls(pages, rules, max_filter_bytes=max_bytes).collect()}
    assert got == {i: brute(u, rules) for i, u, *_ in rows}


def test_cascade_is_exact_over_its_universe(spark):
    from pyspark.sql import functions as F

    keys = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    listed = keys.filter("xxhash64(key) % 50 = 0")
    cascade = uf.build_cascade(listed, keys)
    assert len(cascade.levels) >= 2  # the first filter alone is not exact
    found = keys.filter(cascade.contains(F.col("key")))
    assert sorted(r["key"] for r in found.collect()) == sorted(r["key"] for r in listed.collect())


def test_empty_table_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://x.com/")], "page_id long, url string")
    assert uf.judge_urls(pages.limit(0)).collect() == []
    assert [(r["rule"], r["verdict"]) for r in uf.judge_urls(pages, ()).collect()] == [(None, "allow")]


@pytest.mark.parametrize("max_bytes", [uf.MAX_FILTER_BYTES, 0])
def test_many_rules_from_a_table(spark, max_bytes):
    from pyspark.sql import functions as F

    n = 60_000
    table = spark.range(n).select(F.concat(F.lit("h"), F.col("id").cast("string"), F.lit(".net")).alias("host"),
                                  F.when(F.col("id") % 2 == 0, "/").otherwise("/a/").alias("path"),
                                  F.when(F.col("id") % 5 == 0, "allow").otherwise("block").alias("verdict"))
    table = table.unionByName(table.limit(9)).unionByName(spark.createDataFrame([(None, "/", "block"), ("x.net", None, "block")], "host string, path string, verdict string"))
    urls = [f"http://{s}h{i}.net/{p}" for i in (0, 1, 2, 3, 5, 59_999, 60_000, 777) for s in ("", "www.") for p in ("", "a/b", "b")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in uf.judge_urls(pages, table, "other", max_filter_bytes=max_bytes).collect()}
    rules = [uf.Rule(f"h{i}.net", "/a/" if i % 2 else "/", "block" if i % 5 else "allow") for i in (0, 1, 2, 3, 5, 59_999, 777)]
    assert got == {i: brute(u, rules, "other")[2:] for i, u in enumerate(urls)}
