"""URL parts and rules against Python; the model on hosts it has not seen."""

import re

from tidemark.llm import urls
from tidemark.llm.queries import URL_RULES, op8_url_filter, table

CASES = [
    None, "", "no scheme", "http://", "HTTP://Example.COM/EN/x", "https://www.example.com/en/1?q#f", "https://a.example.com/en",
    "https://example.com/en/", "https://notexample.com/en/", "x://net/es/1", "x://a.net/fr/", "x://ÀÉ.net/fr/", "x://h?://other/en/",
    "x://h#y/z", "http://u@h.com:80/p", "x://" + "a" * 50_000 + ".com/" + "b" * 50_000,
]


def parts(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", ""
    return re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]


def rule(host, path):
    fits = [(h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda f: len(f[0]), default=(None, None))


def test_parts_and_rules(spark, small):
    cases = spark.createDataFrame([(i, u, "s") for i, u in enumerate(CASES)], "page_id long, url string, _key string")
    out = {r.page_id: r for r in urls.filter_urls(cases, URL_RULES).collect()}
    pages = {r.page_id: r.url for r in table(spark, small, "pages").collect()}
    given = {r.page_id: r for r in op8_url_filter(spark, small).collect()}
    for rows, asked in ((out, dict(enumerate(CASES))), (given, pages)):
        assert rows.keys() == asked.keys()
        for i, url in asked.items():
            host, path = parts(url)
            assert (rows[i].host, rows[i].path) == (host, path)
            name, verdict = rule(host, path)
            assert rows[i].rule == name
            assert rows[i].verdict == (verdict or ("block" if rows[i].score >= 0.5 else "allow"))


def test_model_on_unseen_hosts(spark):
    bad = ["http://spam-farms.example.org/x/1", "https://casino-wins.info/", "https://my-cheap-pills.biz/a", "x://free-bets24.de/"]
    good = ["http://therin.example.org/x/1", "https://daily-weather.info/", "https://blog.tionble.biz/a", "x://stadt-museum.de/"]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(bad + good)], "page_id long, url string")
    out = {r.page_id: r.verdict for r in urls.filter_urls(rows, ()).collect()}
    assert [out[i] for i in range(8)] == ["block"] * 4 + ["allow"] * 4


def test_empty_table_and_repeated_rows(spark):
    rows = spark.createDataFrame([(1, "x://a.net/fr/"), (1, "x://a.net/fr/"), (None, None)], "page_id long, url string")
    assert urls.filter_urls(rows.where("false"), URL_RULES).count() == 0
    assert sorted(r.rule or "" for r in urls.filter_urls(rows, URL_RULES).collect()) == ["", "net/fr/", "net/fr/"]
