import itertools
import random
import re

from reelscope.llm.url_rules import judge_urls
from tests.llm.cases import table

RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("WWW.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("a.net", "/e", "block"),
    ("a.net", "", "allow"),
    ("tie.org", "/x/", "allow"),
    ("tie.org", "/x/", "block"),
    ("org", "/x/yyyy/", "allow"),
    (None, "/", "block"),
    ("", "/", "block"),
    ("bare.org", None, "block"),
]


def low(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return low(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def brute(url, rules=RULES):
    host, path = parts(url)
    fits = [
        (len(low(h)) + len(p or ""), len(h), low(h) + (p or ""), v)
        for h, p, v in rules
        if h and (host == low(h) or host.endswith("." + low(h))) and path.startswith(p or "")
    ]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def judged(spark, urls, rules=RULES):
    pages = table(spark, [(i, u, "mine", 1) for i, u in enumerate(urls)], "page_id bigint, url string, host string, prefix int")
    got = judge_urls(pages, table(spark, rules, "host string, path string, verdict string")).collect()
    assert len(got) == len(urls)
    return {urls[r.page_id]: tuple(r)[1:] for r in got}


def test_urls_against_brute_force(spark):
    hosts = ["com", "example.com", "www.example.com", "WWW.Example.COM", "xexample.com", "a.net", "b.a.net", "ba.net",
             "tie.org", "q.bare.org", "x.com:80", "u@x.com", "example.com.", "", "." , "é.com"]
    tails = ["", "/", "/en/", "/en", "/en/1?x=/es/", "/es/#a", "?/en/", "#", "/x/yyyy/z", "/x/", "//en/", "/e", "/eé"]
    urls = [f"http://{h}{t}" for h, t in itertools.product(hosts, tails)]
    urls += [None, "", "no scheme", "://", "a://b://c.com/en/", "http:/example.com/en/", "x://example.com/en/\n?"]
    got = judged(spark, urls)
    assert got == {u: brute(u) for u in urls}
    assert {v[3] for v in got.values()} == {"allow", "block"}


def test_random_rules(spark):
    rng = random.Random(8)
    names = ["a", "b", "c.a", "b.c.a", "a.b"]
    paths = ["", "/", "/p", "/p/", "/p/q", "/p/q/"]
    rules = [(rng.choice(names), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(12)]
    urls = [f"s://{h}{p}" for h in [*names, "x.b.c.a", "aa"] for p in [*paths, "/pp", "/p/q/r"]]
    assert judged(spark, urls, rules) == {u: brute(u, rules) for u in urls}


def test_long_urls_repeats_and_empty_tables(spark):
    urls = ["http://" + "a." * 20_000 + "example.com/" + "en/" * 20_000, "http://x.com/", "http://x.com/"]
    got = judged(spark, urls)
    assert got == {u: brute(u) for u in urls}
    assert judged(spark, []) == {}
    assert judged(spark, urls, []) == {u: (*parts(u), None, "allow") for u in urls}
