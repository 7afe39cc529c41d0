from ledgerlens.llm import url_filter as u


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
        rest = rest[n:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0]) + len(r[1]), r[2] == "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else default


URLS = [
    "http://a.Example.ORG/es/1?x=/#y", "https://example.org/en/123", "https://badexample.org/en/1", "http://x.com/fr/", "http://x.com/de/1", "http://x.net/de/", "ftp://org", "ftp://org/",
    "no scheme", "", None, "http://", "http://?q", "http://host#f", "http://ÄÖ.com/fr/ü", "a://b://c/d", "http://x.com/fr/" + "y" * 100_000, "http://" + "a." * 2000 + "com/de/",
]


def test_against_brute_force(spark):
    rows = [(i, x, "clash") for i, x in enumerate(URLS)] + [(0, URLS[0], "clash"), (None, URLS[3], "clash")]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    rules = spark.createDataFrame([*u.RULES, u.RULES[0], (None, "/", "block"), ("", "/", "block")], "host string, path string, verdict string")
    got = sorted((-1 if r.page_id is None else r.page_id, r.host, r.path, r.rule or "", r.verdict) for r in u.judge(pages, rules).collect())
    want = []
    for i, x, _ in rows:
        host, path, rule, verdict = brute(x, u.RULES)
        want.append((-1 if i is None else i, host, path, rule or "", verdict))
    assert got == sorted(want)
    assert u.judge(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in u.judge(pages, rules.limit(0), default="block").collect()} == {"block"}


def test_longest_wins_then_block(spark):
    rules = [("com", "/a/b", "allow"), ("x.com", "/a", "block"), ("x.com", "/a/", "allow"), ("com", "/a/bb", "block")]
    pages = spark.createDataFrame([(1, "http://x.com/a/bb"), (2, "http://y.com/a/b"), (3, "http://x.com/ab")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in u.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    assert got == {i: brute(x, rules)[2:] for i, x in ((1, "http://x.com/a/bb"), (2, "http://y.com/a/b"), (3, "http://x.com/ab"))}
