import random
import re

from tallymark.llm import url_filters

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return host.translate(LOWER), re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]


def brute(url, rules):
    host, path = parts(url)
    fits = [
        (len(h + p), len(h), h + p, v) for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *max(fits)[2:]) if fits else (host, path, None, "allow")


def judged(spark, rows, rules):
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, path string")
    result = url_filters.judge(pages, url_filters.rule_table(spark, rules))
    assert result.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    return result.collect()


def test_registered_rules_and_odd_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "http://org", "http://org/", "HTTP://A.ORG/x?y#z", "https://example.org/es",
        "https://example.org/es/", "https://www.Example.org/en/12#top", "https://badexample.org/es/x",
        "http://x.com/fr/1", "http://x.com/de/1", "http://com/fr/", "http://a.b?x=://c.org/", "x://y://z.org/a",
        "http://a..org/x", "http://é.org/ü", "http://x.com:80/fr/", "line\nhttp://x.org/a",
    ] + [f"http://h{i}.example.org/en/{i}" for i in range(40)]
    rows = [(i % 7, u, "own", "own") for i, u in enumerate(urls)] + [(None, urls[5], "own", "own")] * 3
    got = judged(spark, rows, url_filters.RULES)
    expected = [(u, *brute(u, url_filters.RULES)) for _, u, *_ in rows]
    key = lambda r: tuple("" if x is None else "=" + x for x in r)
    assert sorted(((r.url, r.host, r.path, r.rule, r.verdict) for r in got), key=key) == sorted(expected, key=key)


def test_nested_rules_by_brute_force(spark):
    rng = random.Random(5)
    hosts = ["org", "a.org", "b.a.org", "a-b.org", "com", "x.com", "a.x.com"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/ab", "/b"]
    rules = sorted({(rng.choice(hosts), rng.choice(paths)) for _ in range(25)})
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p in rules]
    rows = [
        (i, f"http://{rng.choice(['', 'w.', 'b.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'b', '/b', '?q'])}", "", "")
        for i in range(600)
    ]
    for r in judged(spark, rows, rules):
        host, path = parts(r.url)
        best = brute(r.url, rules)
        assert (r.host, r.path) == (host, path)
        assert (r.rule and len(r.rule), r.rule is None) == (best[2] and len(best[2]), best[2] is None), r
        if r.rule:
            assert r.verdict == dict((h + p, v) for h, p, v in rules)[r.rule]


def test_no_rules_and_no_pages(spark):
    assert {r.verdict for r in judged(spark, [(1, "http://a.org/", "", "")], [("org", "/zzz", "block")])} == {"allow"}
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filters.judge(pages, url_filters.rule_table(spark)).count() == 0
    none = url_filters.rule_table(spark).limit(0)
    one = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert url_filters.judge(one, none).first().verdict == "allow"
