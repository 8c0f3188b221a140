import random

from rarelens.llm import url_filter
from rarelens.llm.catalog import QUERIES, SQL, URL_RULES
from tests.compare import connect, difference

URLS = [None, "", "no scheme", "http://", "https://EXAMPLE.com/en/x", "http://www.example.com/en/", "http://a.www.example.com/en/1?x#y", "http://example.com",
        "http://example.com?q=/en/", "http://x.net/es/", "http://x.net/es", "ftp://net/fr/a/b", "http://com/", "http://.com/", "http://examplexcom/en/", "a://b://c.com/"]


def plain(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut].lower(), rest[cut:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h), len(p), a == "block", a, h + p) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[3:] if fits else ("allow", None)))


def check(spark, urls, rules, **options):
    pages = spark.createDataFrame([(i, u, "host", "rule") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["verdict"], r["rule"]) for r in url_filter.filter_urls(pages, rules, **options).collect()}
    assert got == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_trie_and_join_equal_the_plain_version(spark):
    check(spark, URLS, URL_RULES)
    check(spark, URLS, URL_RULES, trie_chars=0)
    rng = random.Random(2)
    hosts = ["com", "a.com", "b.a.com", "net", "c.net"]
    rules = list({(h, p): (rng.choice(["allow", "block"]), h, p) for h in hosts for p in ("", "/", "/x", "/x/", "/x/y", "/xy/") if rng.random() < .7}.values())
    urls = [f"http://{rng.choice(['', 'w.', 'b.'])}{rng.choice(hosts)}{rng.choice(['', '/', '/x', '/x/', '/xy/z', '/x/y/z', '/q'])}" for _ in range(60)]
    check(spark, urls, rules)
    check(spark, urls, rules, trie_chars=0)
    check(spark, urls[:3], [])


def test_query_equals_sql_and_empty_table(spark, small):
    assert difference(spark, QUERIES["op2_url_filters"], SQL["op2_url_filters"], connect(small), small)[0] is None
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0
