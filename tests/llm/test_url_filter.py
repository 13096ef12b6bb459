"""Verdicts against every rule tried on every url."""

import random

from tripmart.llm import url_filter

LABELS = ["com", "net", "example", "www", "en", "a"]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = rest
    for sign in "/?#":
        host = host.split(sign)[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def judged(url, rules):
    host, path = split(url)
    fit = [
        (len(h + p), h + p, v)
        for v, h, p in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fit:
        return host, path, None, "allow"
    _, rule, verdict = max(fit)
    return host, path, rule, verdict


def test_all_rules_on_all_urls(spark):
    rng = random.Random(3)

    def host():
        return ".".join(rng.choice(LABELS) for _ in range(rng.randrange(1, 5)))

    def path():
        return rng.choice(["", "/", "/en/", "/en/x", "/fr/y/", "/EN/", "/é"])

    urls = [None, "", "nothing", "http://", "://a.com/en/", "HTTP://WWW.Example.COM/en/?q#f"]
    urls += [f"https://{host()}{path()}{rng.choice(['', '?a=/en/', '#/en/'])}" for _ in range(400)]
    urls += [urls[5]] * 30 + ["x://example.com.evil/en/", "x://notexample.com/en/"]
    pages = spark.createDataFrame(
        [(i % 300 if i % 7 else None, u, "h", "r") for i, u in enumerate(urls)],
        "page_id long, url string, html string, rule string",
    )
    rules = [(rng.choice(["allow", "block"]), host(), path()) for _ in range(60)]
    rules = list({(h, p): (v, h, p) for v, h, p in rules}.values()) + list(url_filter.RULES)
    rules = list({(h, p): (v, h, p) for v, h, p in rules}.values())
    got = url_filter.judge_urls(pages, url_filter.rule_table(spark, rules)).collect()
    want = [(r[0], *judged(r[1], rules)) for r in pages.select("page_id", "url").collect()]
    key = lambda row: tuple(map(str, row))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = url_filter.rule_table(spark)
    assert url_filter.judge_urls(pages, rules).collect() == []
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge_urls(pages, rules.limit(0)).collect()] == ["allow"]
