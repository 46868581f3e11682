import pytest

from ringledger.llm import url_filter as urls

PAGES = "page_id long, url string, host string, verdict string, n int, row string"
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"))


def _judged(spark, addresses, rules=RULES):
    rows = [(k, url, "mine", "mine", 1, "mine") for k, url in enumerate(addresses)]
    found = urls.url_filter(spark.createDataFrame(rows, PAGES), rules)
    return {r["page_id"]: r for r in found.select("row.page_id", "host", "path", "rule", "verdict").collect()}


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    ("http://WWW.Example.com/en/a?b#c", "www.example.com", "/en/a", "www.example.com/en/", "allow"),
    ("http://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
    ("x://notexample.com/en/x", "notexample.com", "/en/x", "com/", "allow"),
    ("x://a.com", "a.com", "", None, None), ("x://a.com?q=/en/", "a.com", "", None, None),
    ("x://com/", "com", "/", "com/", "allow"), ("no scheme", "", "", None, None),
    (None, "", "", None, None), ("", "", "", None, None), ("://", "", "", None, None),
    ("a://b://c/d", "b:", "//c/d", None, None),
])
def test_parts_and_longest_rule(spark, url, host, path, rule, verdict):
    row = _judged(spark, [url])[0]
    assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
    assert verdict is None or row["verdict"] == verdict


def test_reputation_flows_from_suffix_to_domain_to_host(spark):
    rules = (("good.net/ok/", "allow"), ("bad.net/no/", "block"), ("org/ok/", "allow"))
    pages = ([f"x://a.good.net/ok/{k}" for k in range(60)] + [f"x://b.bad.net/no/{k}" for k in range(60)]
             + [f"x://h{k}.o{k}.org/ok/" for k in range(40)])
    asked = ["x://a.good.net/else", "x://new.good.net/else", "x://b.bad.net/else",
             "x://new.bad.net/else", "x://new.one.org/else"]
    found = _judged(spark, pages + asked, rules)
    verdicts = [found[len(pages) + k]["verdict"] for k in range(len(asked))]
    assert verdicts == ["allow", "allow", "block", "block", "allow"]


def test_without_outcomes_all_is_allowed(spark):
    found = _judged(spark, ["x://a.net/1", "x://b.net/2", None], rules=())
    assert {r["verdict"] for r in found.values()} == {"allow"}


def test_outcomes_may_be_given(spark):
    pages = spark.createDataFrame([(k, f"x://bad.net/{k}", k < 1) for k in range(50)],
                                  "page_id long, url string, ok boolean")
    found = urls.url_filter(pages, (), outcome=urls.F.col("ok"))
    assert {r["verdict"] for r in found.collect()} == {"block"}


def test_double_suffixes(spark):
    hosts = spark.createDataFrame([("a.b.co.uk",), ("b.co.uk",), ("x.y.com",), ("local",)], "host string")
    names = hosts.select("host", *urls._names(urls.F.col("host"))).collect()
    assert [tuple(r)[1:] for r in names] == [
        ("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("y.com", "com"), ("local", "local")]


def test_empty_table(spark):
    assert _judged(spark, []) == {}
