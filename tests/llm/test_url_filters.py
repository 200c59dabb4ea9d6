import random

from pyspark.sql import functions as F

from hexloom.llm.url_filters import match_urls


def brute(url, rules, default="allow"):
    at = url.find("://") if url is not None else -1
    rest = url[at + 3 :] if at >= 0 else ""
    cut = min([k for c in "/?#" if (k := rest.find(c)) >= 0] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else default


def test_against_brute_force(spark):
    r = random.Random(4)
    part = lambda: r.choice(["a", "b", "aa", "org", "com"])
    rules = sorted({(".".join(part() for _ in range(r.randint(1, 3))), r.choice(["", "/"]) + r.choice(["", "x", "x/y", "xy/", "\xff"]), r.choice(["allow", "block"])) for _ in range(60)})
    urls = [f"http://{'.'.join(part() for _ in range(r.randint(1, 5)))}{r.choice(['', '/', '/x', '/x/y/z', '/xy/é', '/\U0010ffff'])}{r.choice(['', '?q=/x', '#/x', '?'])}" for _ in range(3000)]
    urls += [None, "", "no scheme/x", "://", "http://", "HTTP://A.ORG/x", "http://org", "http://a..org/", "http://ÄA.com/x"] + ["http://hot.a.org/x/y"] * 1500
    pages = spark.createDataFrame([(k, u, "mine") for k, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in match_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    assert len(got) == len(urls)
    assert {k: brute(u, rules) for k, u in enumerate(urls)} == got


def test_edges(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", 5), (1, "http://a.org/x", 5)], "page_id long, url string, path int")
    rules = spark.createDataFrame([(None, "/", "block"), ("org", None, "allow"), ("org", "", "block")], "host string, path string, verdict string")
    assert [(r.rule, r.verdict) for r in match_urls(pages, rules).collect()] == [("org", "block")] * 2
    none = match_urls(pages, rules.where(F.lit(False)), default="block").collect()
    assert [(r.rule, r.verdict) for r in none] == [(None, "block")] * 2
    assert match_urls(pages.where(F.lit(False)), rules).count() == 0
