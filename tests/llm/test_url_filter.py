import re

from pyspark.sql import functions as F

from driftwood.llm import url_filter as U

from .helpers import by_id

URLS = ["http://Shop.Example.COM/en/x", "https://www.example.com/en/1?utm_source=a", "https://a.net/es/3", "https://net/fr/", "http://net/de/1",
        "http://example.org", None, "", "no scheme/x", "http://x.org/a/?b=2&a=1&utm_id=7#f", "https://www.x.org/a?a=1&b=2&ref=q",
        "http://x.org:80/a/index.html?a=1&b=2", "http://x.org/A?a=1&b=2", "http://x.org/a?a=1&b=3", "ftp://y.org?q", "http://y.org#f://z",
        "https://evilnet/es/3", "http://example.com.org/en/", "http://É.net/es/x", "http://xcom/"]


def pages_of(spark, urls):
    df = spark.createDataFrame([(i, u, "<p>idiot</p>" if i % 2 else None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    return df.withColumn("host", F.lit("clash")).withColumn("id", F.lit("clash")).withColumn("block", F.lit(1))


def parts(u):
    if not u or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    m = re.match(r"([^/?#]*)(/[^?#]*)?", rest)
    return "".join(c.lower() if c.isascii() else c for c in m[1]), m[2] or ""


def rule(u):
    host, path = parts(u)
    fit = [(v, r) for v, r in U.RULES if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0]))
           and path.startswith("/" + r.split("/", 1)[1])]
    return max(fit, key=lambda x: len(x[1])) if fit else (None, None)


def run(spark, urls, listed):
    lists = spark.createDataFrame([(u,) for u in listed], "url string")
    return {r.id: r for r in U.filter_urls(pages_of(spark, urls), lists, U.RULES).collect()}


def test_parts_and_rules(spark):
    got = run(spark, URLS, [])
    for i, u in enumerate(URLS):
        v, r = rule(u)
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (*parts(u), r, v or "allow"), u


def test_listed_urls_are_blocked_whatever_their_dress(spark):
    got = run(spark, URLS, ["http://x.org/a?a=1&b=2", None, "nothing"])
    assert [got[i].verdict for i in (9, 10, 11)] == ["block"] * 3
    assert [got[i].verdict for i in (12, 13, 5, 6)] == ["allow"] * 4


def test_no_false_positive_and_no_miss(spark):
    urls = [f"http://h{i % 13}.org/p{i}" for i in range(5000)]
    got = run(spark, urls, urls[::7])
    assert {i for i, r in got.items() if r.verdict == "block"} == set(range(0, 5000, 7))


def test_bloom_passes_all_members_and_few_others(spark):
    members = spark.range(20000).select(F.concat(F.lit("m"), "id").alias("url"))
    others = spark.range(20000).select(F.concat(F.lit("o"), "id").alias("url"))
    n = 20000 * U.BITS_PER_URL // 256
    bloom = U.blocked_bloom(members, n)
    assert U.possible_hits(members, bloom, n).count() == 20000
    assert U.possible_hits(others, bloom, n).count() < 400


def test_empty_tables(spark):
    assert run(spark, [], ["http://a.b/c"]) == {}
    df = U.query(pages_of(spark, URLS))
    assert by_id((r.page_id,) for r in df.collect()) == by_id((i,) for i in range(len(URLS)))


def test_no_python_in_the_plan(spark):
    plan = U.query(pages_of(spark, URLS))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
