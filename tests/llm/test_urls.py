import pytest

from mentionlake.llm import urls

SCHEMA = "page_id long, url string, verdict string, n int"


def judged(spark, found, rules=urls.RULES):
    rows = urls.judge(spark.createDataFrame([(i, u, "old", 1) for i, u in enumerate(found)], SCHEMA), rules).collect()
    return [r for _, r in sorted((r.page_id, r) for r in rows)]


@pytest.mark.parametrize(("url", "host", "path", "rule"), [
    ("http://A.Example.COM/en/1?x=/de/#y", "a.example.com", "/en/1", "example.com/en/"),
    ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/"),
    ("https://m.www.example.com/en/x", "m.www.example.com", "/en/x", "www.example.com/en/"),
    ("https://www.example.com/EN/", "www.example.com", "/EN/", "com/"),
    ("x://notexample.com/en/9", "notexample.com", "/en/9", "com/"),
    ("http://h.net/es/1", "h.net", "/es/1", "net/es/"),
    ("http://h.net/es", "h.net", "/es", None),
    ("http://net/fr/1://b/c", "net", "/fr/1://b/c", "net/fr/"),
    ("http://a.com", "a.com", "", None),
    ("http://a.com?/b", "a.com", "", None),
    ("http://ÄB.org#/x", "Äb.org", "", None),
    ("mailto:someone", "", "", None),
    ("a\nb://c.org/d\ne", "c.org", "/d\ne", None),
    ("://", "", "", None),
    ("", "", "", None),
    (None, "", "", None),
])
def test_parts_and_rules(spark, url, host, path, rule):
    (row,) = judged(spark, [url])
    assert (row.host, row.path, row.rule) == (host, path, rule)
    allowed = {r.name: r.allow for r in urls.RULES}
    assert row.verdict == ("allow" if allowed.get(rule, True) else "block")


def test_templates(spark):
    found = [f"http://h.org/en/{i}" for i in range(30)] + [f"http://h.org/en/{'%032x' % i}.html" for i in range(9)]
    found += [f"http://h.org/shop/{w}/{i}/a/b/c" for i in range(20) for w in ("red", "blue")] + ["http://h.org/rare", "http://other.org/en/1"]
    got = {r.path: r.template for r in judged(spark, found)}
    assert got["/en/7"] == got["/en/" + "%032x" % 3 + ".html"]
    assert got["/shop/red/3/a/b/c"] == got["/shop/blue/4/a/b/c"] == "/*/*/*/a/**" or got["/shop/red/3/a/b/c"].endswith("/**")
    assert got["/rare"] == "/*"


def test_a_branch_that_is_blocked_takes_its_unlabelled_pages_along(spark):
    rules = [urls.Rule(False, "h.org", "/x/spam/"), urls.Rule(True, "h.org", "/x/good/"), urls.Rule(False, "h.org", "/ads/0")]
    found = [f"http://h.org/x/good/{i}" for i in range(60)] + [f"http://h.org/ads/0{i}" for i in range(40)] + [f"http://h.org/ads/{i}" for i in range(1, 10)]
    found += [f"http://h.org/news/{i}" for i in range(30)]
    rows = judged(spark, found, rules)
    by = lambda start: {r.verdict for r in rows if r.path.startswith(start) and r.rule is None}
    assert by("/ads/") == {"block"} and by("/news/") == {"allow"}
    assert all(0 <= r.purity <= 1 for r in rows)


def test_nulls_repeats_and_empty_tables(spark):
    rows = judged(spark, [None, "", "http://h.net/fr/1", "http://h.net/fr/1"])
    assert [r.verdict for r in rows] == ["allow", "allow", "block", "block"] or [r.rule for r in rows][2:] == ["net/fr/"] * 2
    empty = spark.createDataFrame([], SCHEMA)
    assert urls.judge(empty).count() == 0
    twins = spark.createDataFrame([(None, "http://a.org/b", "", 1)] * 2, SCHEMA)
    assert [r.host for r in urls.judge(twins).collect()] == ["a.org"] * 2


def test_a_very_long_url(spark):
    (row,) = judged(spark, ["http://h.org/" + "/".join(map(str, range(50_000)))])
    assert row.template.endswith("/**") and len(row.path) > 200_000
