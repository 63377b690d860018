from branchwise.llm import urlfilter as u


def brute(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [(len(h + p), h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, default))
    return host, path, best[1], best[2]


URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://A.NET/x", "http://example.net/en/x", "http://www.example.net/en", "ftp://example.com/de/?q#f", "http://notexample.com/de/",
    "http://a.org/fr/é", "http://org/fr/", "http://x://net/", "http://a.net?x=/", "http://.net/", "http://a..net/", "http://a.org/fr/" + "y" * 20_000, "http://ÄÖ.org/fr/\nz", "a\nb://org/fr/",
]


def result(spark, rows, rules):
    frame = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS host", "'x' AS rule", "'x' AS lengths")
    return sorted(map(tuple, u.judge(frame, u.rules_frame(spark, rules)).collect()), key=str)


def test_odd_urls_and_ties(spark):
    rows = [(k, url) for k, url in enumerate(URLS)] + [(None, URLS[6]), (None, URLS[6]), (1, URLS[7])]
    for rules in (u.RULES, [*u.RULES, ("net", "/", "allow"), ("a.net", "/x", "allow"), ("net", "/x", "block")]):
        plain = {}
        for h, p, a in rules:
            plain[h, p] = max(a, plain.get((h, p), a))
        assert result(spark, rows, rules) == sorted(((i, *brute(url, [(*k, a) for k, a in plain.items()])) for i, url in rows), key=str)


def test_empty(spark):
    assert result(spark, [], u.RULES) == []
    assert {r[4] for r in result(spark, [(1, URLS[6])], [])} == {"allow"}
