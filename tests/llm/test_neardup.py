"""Near duplicates against all pairs on full sets."""

import random
import re

import numpy as np
import pytest

from salesloom.llm import neardup as N
from salesloom.llm.graph import components
from tests.conftest import SF_SMALL


def plain_sets(texts, k):
    out = []
    for t in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        out.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    return out


def plain(rows, rule):
    sets = plain_sets([t for _, t in rows], rule.words)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= rule.percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        low[r] = min((x for x in (low.get(r), d) if x is not None), default=None)
    return sorted(((d, len(sets[i]), low[find(i)] if sets[i] else d,
                    d is not None and d == (low[find(i)] if sets[i] else d))
                   for i, (d, _) in enumerate(rows)), key=repr)


def family(rng, words, n, edits):
    base = [rng.choice(words) for _ in range(120)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randrange(edits + 1)):
            t[rng.randrange(len(t))] = rng.choice(words)
        out.append(" ".join(t))
    return out


def made(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", " \t\n", "one", "One", "two words", "two  WORDS", "a b c", "a b c a b c", "É b c d", "é b c d",
             "x y z", "long " * 30000]
    for n, edits in ((40, 3), (40, 8), (30, 14), (5, 1)):
        texts += family(rng, words, n, edits)
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    texts += texts[13:40]
    rows = list(zip(rng.sample(range(10_000), len(texts)), texts))
    return rows + [(None, texts[20]), (None, "alone in null"), (rows[30][0], texts[60])]


@pytest.mark.parametrize("rule", [N.Rule(3, 85), N.Rule(5, 80)])
def test_equals_all_pairs(spark, rule, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 8)
    rows = made(rule.words)
    df = spark.createDataFrame([(d, t, -1, "x") for d, t in rows], "doc_id long, text string, n int, node string")
    got = sorted((tuple(r) for r in N.near_duplicates(df, rule).collect()), key=repr)
    assert got == plain(rows, rule)


def test_table_and_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted((tuple(r) for r in N.near_duplicates(docs).collect()), key=repr)
    assert got == plain(rows, N.Rule(3, 85))
    empty = docs.limit(0)
    assert N.near_duplicates(empty).collect() == []


def test_estimate_and_mergeable_registers():
    rng = np.random.default_rng(5)
    rule = N.Rule(3, 85)
    pool = N.mix64(rng.integers(1, 2 ** 62, 4000).astype(np.uint64))
    for j in (0.3, 0.85, 0.97):
        both = int(2000 * j)
        x = np.unique(pool[:both + (2000 - both) // 2])
        y = np.unique(np.r_[pool[:both], pool[2000:2000 + (2000 - both) // 2]])
        rx, ry = N.registers([x, y], 400)
        ok, best = N.may_link(np.array([(rx > ry).sum()]), np.array([(rx < ry).sum()]), 400, np.array([len(x)]),
                              np.array([len(y)]), rule)
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        assert abs(best[0] - true) < 0.09 or true < 0.5
        assert ok[0] or true < 0.85
        assert np.array_equal(np.maximum(rx, ry), N.registers([np.union1d(x, y)], 400)[0])


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 230)] + [(229, 3), (5, 5)]
    got = {r["u"]: r["v"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(101, 141)}, **{i: 3 for i in [7, *range(200, 230)]}}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_sift_keeps_every_wanted_row_and_few_others(spark):
    rows = [(i if i % 50 else None, f"text {i}") for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").unionByName(
        spark.createDataFrame(rows[:100], "doc_id bigint, text string"))
    ids = docs.where("doc_id % 8 = 1").select("doc_id").distinct()
    got = N.sifted(docs, ids, "doc_id", ids.count())
    want = sorted(r.text for r in docs.join(ids, "doc_id", "left_semi").collect())
    assert got.columns == docs.columns
    assert sorted(r.text for r in got.join(ids, "doc_id", "left_semi").collect()) == want
    assert len(want) <= got.count() < len(want) + 0.15 * docs.count()
    assert N.sifted(docs, ids.where("false"), "doc_id", 0).count() == 0


def test_texts_are_sifted_before_they_are_joined_with_the_wanted(spark):
    docs = spark.createDataFrame([(i, f"a b c {i}") for i in range(40)], "doc_id bigint, text string")
    wanted = docs.where("doc_id < 4").selectExpr("cast(doc_id as string) as n", "doc_id").selectExpr("encode(n, 'utf-8') as node", "doc_id")
    plan = N.node_sets(docs, wanted, N.Rule(3, 85))._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.find("(doc_id#") < plan.find("(_word#")
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert "_word#" in joins[-1] and "doc_id#" in joins[-2]
