import random

from lexiloom.llm import url_filter


def plain(url, rules, default):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    cut = lambda s, marks: s[: min([s.index(m) for m in marks if m in s], default=len(s))]
    host = cut(rest, "/?#")
    path = cut(rest[len(host) :], "?#")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fitting = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fitting:
        return host, path, None, default
    best = max(fitting)
    return host, path, best[2], best[3]


def test_random_urls(spark):
    rng = random.Random(1)
    rules = [*url_filter.RULES, ("b.example.org", "", "block"), ("net", "/a", "block"), ("example.net", "/a/b", "allow")]
    part = lambda: rng.choice(["a", "b", "example", "org", "com", "net", "A", "é"])
    urls = [None, "", "://", "x", "http://", "http://org", "HTTP://ORG/", "http://a\n.org/x\ny", "u:p@http://example.org/es/?://"]
    for _ in range(600):
        host = ".".join(part() for _ in range(rng.randrange(1, 5))) + rng.choice(["", ".org", ".com", ".example.org", ".org:80"])
        urls.append(f"http://{host}" + rng.choice(["", "/", "/es/", "/en/1", "/en/12/x", "/fr/", "/de", "/a/b"]) + rng.choice(["", "?q=/es/", "#/x"]))
    rows = list(enumerate(urls)) + [(3, "x"), (None, "http://org/")]
    pages = spark.createDataFrame([(i, u, "extra", u) for i, u in rows], "page_id long, url string, rule string, host string")
    table = spark.createDataFrame([*rules, rules[0], (None, "/", "allow"), ("x", None, "block")], "host string, path string, verdict string")
    got = sorted((tuple(r) for r in url_filter.judge(pages, table, "block").collect()), key=repr)
    assert got == sorted(((i, *plain(u, rules, "block")) for i, u in rows), key=repr)
    assert url_filter.judge(pages.limit(0), table).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, table.limit(0)).collect()} == {"allow"}


def test_conflicting_rules_block(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    rules = spark.createDataFrame([("a.b", "/", "allow"), ("A.b", "/", "block")], "host string, path string, verdict string")
    assert url_filter.judge(pages, rules).first().verdict == "block"
