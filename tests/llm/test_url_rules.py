import pytest

from cohortspark.llm.url_rules import RULES, judge_urls

URLS = [
    None, "", "no scheme", "http://", "http://a.net", "http://a.net/", "http://net/x",
    "https://EXAMPLE.net/en/1?q#f", "http://www.example.net/en/", "http://example.net/en",
    "http://notexample.net/en/1", "http://a.example.com/de/x", "http://example.com/DE/x",
    "http://org/fr/", "http://x.y.org/fr/z", "http://x.orgy/fr/", "http://a..net/x",
    "http://net./x", "ftp://u@h.net:80/p", "http://éa.net/é", "x://y.net?z://b.org/fr/",
    "http://example.net.net/en/", "http://" + "s." * 3000 + "org/fr/" + "p" * 20000,
]


def by_hand(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    fits = [
        (len(h + p), len(h), h + p, v)
        for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return host, path, *(max(fits)[2:] if fits else (None, default))


MORE = (*RULES, ("block", "example.net", "/en/p"), ("allow", "a.example.com", "/"), ("block", "y.org", "/"))


@pytest.mark.parametrize("rules", [RULES, MORE, ()], ids=["fixed", "nested", "none"])
def test_every_url_gets_the_longest_rule(spark, scratch, rules):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS * 3)] + [(None, URLS[5], "x", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, key string, stack string")
    got = judge_urls(pages, scratch, rules)
    order = [(str(r[0]), r[1:]) for r in [(i, *by_hand(u, rules)) for i, u, *_ in rows]]
    assert sorted((str(r[0]), tuple(r)[1:]) for r in got.collect()) == sorted(order)


def test_no_pages(spark, scratch):
    assert judge_urls(spark.createDataFrame([], "page_id long, url string"), scratch).count() == 0


def test_no_python_and_no_product_in_the_plan(spark, scratch):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    text = judge_urls(pages, scratch)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("Python", "Arrow", "Cartesian", "NestedLoop"))
