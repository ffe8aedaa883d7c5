"""URL filter: rules against plain Python, the model against a direct computation."""

import math
from collections import Counter

import pytest

from salesloom.llm import urls as U
from tests.conftest import SF_SMALL

EDGE = [None, "", "no scheme", "http://", "HTTP://ORG/", "https://a.org", "https://a.ORG/x?y#z",
        "ftp://example.org/es/1", "http://x.example.org/en/1", "http://notexample.org/en/1",
        "http://b.com/fr/", "http://b.com/de/x", "http://b.com/fr", "x://y?://z.org/", "http://é.net/ü\u0130K",
        "http://b.com/de/x", "http://c.net/" + "long/" * 3000]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = rest
    for i, ch in enumerate(rest):
        if ch in "/?#":
            host = rest[:i]
            break
    path = rest[len(host):]
    for i, ch in enumerate(path):
        if ch in "?#":
            path = path[:i]
            break
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in U.RULES:
        domain, prefix = rule[:rule.index("/")], rule[rule.index("/"):]
        if (host == domain or host.endswith("." + domain)) and path.startswith(prefix):
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    return host, path, best


def codes(text):
    out = [U.START] * 3
    for ch in text:
        ch = ch.lower() if "A" <= ch <= "Z" else ch
        out.append(U.ALPHABET.find("#" if ch in "0123456789" else ch) + 1)
    return out


def plain_probability(counts, gram):
    p = 1.0 / U.SYMBOLS
    for order in range(4):
        context = gram[3 - order:3]
        follow = Counter()
        for g, n in counts.items():
            if g[3 - order:3] == context:
                follow[g[3]] += n
        n, t = sum(follow.values()), sum(v > 0 for v in follow.values())
        if n:
            p = (follow[gram[3]] + t * p) / (n + t)
    return p


def test_rules_and_parts_on_edge_cases(spark):
    df = spark.createDataFrame([(i, u, "clash", 0.5) for i, u in enumerate(EDGE)],
                               "page_id long, url string, host string, score double")
    got = {r["page_id"]: r for r in U.judge_urls(df).collect()}
    assert len(got) == len(EDGE)
    for i, url in enumerate(EDGE):
        host, path, best = plain_parts(url)
        assert (got[i]["host"], got[i]["path"]) == (host, path), url
        assert got[i]["rule"] == (best[1] if best else None)
        assert got[i]["verdict"] in ("allow", "block")
        if best:
            assert got[i]["verdict"] == best[0]
    assert got[0]["verdict"] == "allow" and got[0]["score"] is None


def test_ratios_equal_direct_witten_bell(spark):
    good, bad = ["ab/ab", "abc"], ["ba-ba1", "abd"]
    df = spark.createDataFrame([(t, 1, label) for t, label in
                                [*((g, 1) for g in good), *((b, 0) for b in bad), ("zab?", None)]],
                               "text string, weight long, label int")
    got = {r["gram"]: r["ratio"] for r in U.gram_ratios(U._counts(df)).collect()}

    def grams(t):
        c = codes(t)
        return [tuple(c[i - 3:i + 1]) for i in range(3, len(c))]

    g = Counter(x for t in good for x in grams(t))
    b = Counter(x for t in bad for x in grams(t))
    every = set(g) | set(b) | set(grams("zab?"))
    assert len(got) == len(every)
    for gram in every:
        code = 0
        for c in gram:
            code = code * U.SYMBOLS + c
        assert got[code] == pytest.approx(math.log(plain_probability(g, gram)) - math.log(plain_probability(b, gram)))


def test_model_tells_rejected_hosts_apart_and_empty_input(spark):
    rows = [(i, f"http://good{i % 7}.org/{i}") for i in range(80)]
    rows += [(100 + i, f"http://spam-pills{i % 7}.com/de/{i}") for i in range(80)]
    rows += [(200, "http://spam-pills9.com/x"), (201, "http://good9.net/x"), (201, "http://good9.net/x")]
    got = [(r["page_id"], r["verdict"]) for r in U.judge_urls(
        spark.createDataFrame(rows, "page_id long, url string")).collect()]
    assert (200, "block") in got and got.count((201, "allow")) == 2
    assert U.judge_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []


def test_whole_table_without_python(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    out = U.judge_urls(pages)
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert out.count() == pages.count()
