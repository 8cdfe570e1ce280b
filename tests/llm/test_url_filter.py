from pyspark.sql import functions as F

from millrace.llm import url_filter

RULES = [("allow", "org/"), ("block", "a.org/x/"), ("allow", "a.org/x/y")]


def judged(spark, urls, listed=("bad.com",), rules=RULES):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string")
    found = url_filter.filter_urls(pages, "url", url_filter.keys_from_list(spark, list(listed)), rules)
    return [tuple(r) for r in found.orderBy("page_id").select("host", "path", "rule", "verdict").collect()]


def test_host_and_path(spark):
    urls = ["HTTP://WWW.Bad.Com/a/B?q#f", "http://h?x/y", "http://h#/z", "no scheme", None, "", "http://", "a://b://c/d"]
    assert [r[:2] for r in judged(spark, urls)] == [
        ("www.bad.com", "/a/B"), ("h", ""), ("h", ""), ("", ""), ("", ""), ("", ""), ("", ""), ("b:", "//c/d"),
    ]


def test_longest_rule_wins_and_covers_subdomains(spark):
    urls = ["http://a.org/x/yes", "http://www.a.org/x/no", "http://ba.org/x/", "http://a.org", "http://org/"]
    assert [r[2:] for r in judged(spark, urls)] == [
        ("a.org/x/y", "allow"), ("a.org/x/", "block"), ("org/", "allow"), (None, "allow"), ("org/", "allow"),
    ]


def test_listed_domains_block_their_hosts_only(spark):
    urls = ["http://bad.com", "http://x.y.bad.com/z", "http://notbad.com", "http://bad.com.net", "http://com"] * 2
    assert [r[3] for r in judged(spark, urls)] == ["block", "block", "allow", "allow", "allow"] * 2


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(6000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("pmod(xxhash64(key), 3) = 0")
    cascade = url_filter.build_cascade(listed, universe)
    assert len(cascade.levels) > 1
    found = universe.select(cascade.contains(F.col("key")).alias("got"), F.expr("pmod(xxhash64(key), 3) = 0").alias("want"))
    assert found.where("got <> want").isEmpty()


def test_nothing_listed_and_no_pages(spark):
    nothing = spark.createDataFrame([], "key string")
    pages = spark.createDataFrame([(1, "http://a")], "page_id bigint, url string")
    assert url_filter.filter_urls(pages, "url", nothing, []).first()["verdict"] == "allow"
    assert url_filter.filter_urls(pages.where("false"), "url", url_filter.keys_from_list(spark, ["a"]), RULES).count() == 0


def test_a_long_list_is_joined_instead(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_BITS", 10)
    assert [r[3] for r in judged(spark, ["http://bad.com/", "http://x.bad.com", "http://c", None])] == ["block", "block", "allow", "allow"]


def test_clashing_columns_are_replaced(spark, clash):
    pages = clash(spark.createDataFrame([(1, "http://www.bad.com/p"), (1, "http://www.bad.com/p")], "page_id bigint, url string"))
    found = url_filter.filter_urls(pages, "url", url_filter.keys_from_list(spark, ["bad.com"]), RULES)
    assert [(r["host"], r["verdict"], r["score"]) for r in found.collect()] == [("www.bad.com", "block", "x")] * 2


def test_main_path_is_native(spark):
    pages = spark.createDataFrame([(1, "http://a")], "page_id bigint, url string")
    found = url_filter.filter_urls(pages, "url", url_filter.keys_from_list(spark, ["a"]), RULES)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan
