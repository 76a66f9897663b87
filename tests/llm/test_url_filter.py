from compare import canonical, duck_rows, spark_rows
from corpus import SF_DIR, duck

from lotwise.llm import url_filter


def judged(spark, urls, rules=url_filter.RULES, **kinds):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    rows = url_filter.judge_urls(pages, table, **kinds).collect()
    return {r["url"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}


def test_query_equals_sql(spark):
    got = canonical(*spark_rows(url_filter.query(spark, SF_DIR)))
    assert got == canonical(*duck_rows(duck(), url_filter.ORACLE))


def test_longest_rule_wins_and_fits_subdomains(spark):
    got = judged(
        spark,
        [
            "http://WWW.Example.COM/en/x?q#f",
            "http://a.example.com/en/",
            "http://example.com/de/",
            "http://myexample.com/en/x",
            "x://b.net/es/1",
            "x://b.net/e",
            "x://b.org/",
        ],
    )
    assert got["http://WWW.Example.COM/en/x?q#f"] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got["http://a.example.com/en/"][2:] == ("example.com/en/", "block")
    assert got["http://example.com/de/"][2:] == ("com/", "allow")
    assert got["http://myexample.com/en/x"][2:] == ("com/", "allow")
    assert got["x://b.net/es/1"][2:] == ("net/es/", "block")
    assert got["x://b.net/e"] == ("b.net", "/e", None, "allow")
    assert got["x://b.org/"][2:] == (None, "allow")


def test_urls_without_host_or_scheme(spark):
    got = judged(spark, [None, "", "no scheme", "http://", "http://?a", "http:///en/", "a://b://c.com/"])
    assert got[None] == got[""] == got["no scheme"] == ("", "", None, "allow")
    assert got["http://"] == got["http://?a"] == ("", "", None, "allow")
    assert got["http:///en/"] == ("", "/en/", None, "allow")
    assert got["a://b://c.com/"] == ("b:", "//c.com/", None, "allow")


def test_false_positives_of_a_full_filter_are_removed(spark):
    rules = [(f"h{i}.com", "/", "block") for i in range(300)]
    urls = [f"http://h{i}.com/x" for i in range(600)]
    got = judged(spark, urls, rules, max_blocks=1)
    assert [u for u in urls if got[u][3] == "block"] == urls[:300]


def test_contradicting_empty_and_no_rules(spark):
    rules = [("a.com", "/", "allow"), ("A.com", "/", "block"), ("", "/", "block"), (None, "/", "block")]
    assert judged(spark, ["x://a.com/", "x://b.com/"], rules) == {
        "x://a.com/": ("a.com", "/", "a.com/", "block"),
        "x://b.com/": ("b.com", "/", None, "allow"),
    }
    assert judged(spark, ["x://a.com/"], [])["x://a.com/"][2:] == (None, "allow")


def test_repeated_rows_clashing_columns_and_empty_tables(spark):
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "x://a.com/", "mine")] * 3, "page_id long, url string, rule string")
    got = url_filter.judge_urls(pages, rules)
    assert got.columns == ["page_id", "url", "rule", "host", "path", "verdict"]
    assert [r["rule"] for r in got.collect()] == ["com/"] * 3
    assert url_filter.judge_urls(pages.limit(0), rules).collect() == []


def test_a_long_url(spark):
    url = "x://" + "a." * 50 + "com/" + "p" * 20000
    assert judged(spark, [url])[url][2] == "com/"


def test_the_path_to_the_verdict_has_no_python(spark):
    plan = url_filter.query(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_hosts_of_very_many_labels(spark):
    """A megabyte of labels ends in seconds, as only as many suffixes as lists have lengths count."""
    long = "a." * 500_000
    got = judged(spark, [f"http://{long}net/es/x", f"http://{long}www.example.com/en/", f"http://{long}", "x://.com/"])
    assert got[f"http://{long}net/es/x"][2:] == ("net/es/", "block")
    assert got[f"http://{long}www.example.com/en/"][2:] == ("www.example.com/en/", "allow")
    assert got[f"http://{long}"] == (long, "", None, "allow")
    assert got["x://.com/"] == (".com", "/", "com/", "allow")


def test_no_python_in_the_plan(spark):
    df = url_filter.query(spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Arrow", "ExistingRDD"):
        assert word not in plan
