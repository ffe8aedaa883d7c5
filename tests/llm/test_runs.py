"""Periodic runs against a direct search, extensions against letter-by-letter comparison."""

import hashlib
import random
import re
import time
import zlib

import numpy as np

from salesloom.llm import runs as R
from tests.conftest import SF_SMALL


def plain_runs(w):
    """(start, period, length) of all runs: every stretch that matches itself shifted by q."""
    best = {}
    for q in range(1, len(w) // 4 + 1):
        t = 0
        while t < len(w) - q:
            s = t
            while t < len(w) - q and w[t] == w[t + q]:
                t += 1
            if t > s and t + q - s >= max(6, 4 * q):
                best.setdefault((s, t + q), q)
            t += t == s
    return sorted((s, q, e - s) for (s, e), q in best.items())


def plain_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    gone = {i for s, q, size in found for i in range(s + q, s + size)}
    best = max(found, key=lambda r: (r[2], -r[0], -r[1]), default=None)
    listed = "".join(f"{s},{size},{q}\n" for s, q, size in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(found), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4),
            *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)))


def spread(rng, n, letters):
    d = [b"%d" % rng.randrange(letters) for _ in range(n)]
    if n > 8 and rng.random() < 0.6:
        a, p = rng.randrange(n), 1 + rng.randrange(6)
        d = d[:a] + [d[a + (i - a) % p] if a + (i - a) % p < n else b"x" for i in range(a, n)]
    return d


def test_all_runs_of_many_short_texts():
    rng = random.Random(1)
    for _ in range(600):
        docs = [spread(rng, rng.choice([0, 1, 5, 6, 7, 10, 30, 60]), rng.choice([1, 2, 2, 3, 5])) for _ in range(rng.randint(1, 4))]
        got = [[] for _ in docs]
        for text, start, length, period in zip(*(x.tolist() for x in R.runs_of_texts(docs)), strict=True):
            got[text].append((start, period, length))
        assert got == [plain_runs(d) for d in docs]


def test_extensions_in_the_grammar():
    rng = np.random.default_rng(2)
    for letters in (1, 2, 3, 50):
        text = rng.integers(0, letters, 400)
        text[200:300] = text[:100]
        symbols = np.r_[-1, text, -2].astype(np.int64)
        grammar = R.Grammar(symbols)
        i, j = rng.integers(1, 401, (2, 2000))
        i, j = i[i != j], j[i != j]

        def plain(a, b, step, symbols=symbols):
            n = 0
            while symbols[a + n * step] == symbols[b + n * step]:
                n += 1
            return n

        assert grammar.extension(i, j).tolist() == [plain(a, b, 1) for a, b in zip(i, j, strict=True)]
        back = grammar.mirrored().extension(len(symbols) - i, len(symbols) - j)
        assert back.tolist() == [plain(a - 1, b - 1, -1) for a, b in zip(i, j, strict=True)]
        for h, blocks in enumerate(grammar.blocks):       # every level holds the one below: blocks of one symbol, or at most two
            cuts = grammar.down[h]
            assert cuts[0] == 0 and cuts[-1] == len(grammar.symbols[h]) and (np.diff(cuts) > 0).all()
            if not blocks:
                assert np.diff(cuts).max() <= 2


def test_one_very_long_text_in_linear_memory():
    began = time.time()
    for w, period in (([b"a"] * 300_000, 1), ([b"%d" % (i % 777) for i in range(300_000)], 777)):
        text, start, length, found = R.runs_of_texts([[], w, [b"a"]])
        assert (text.tolist(), start.tolist(), length.tolist(), found.tolist()) == ([1], [0], [300_000], [period])
    assert time.time() - began < 60


def test_digests_with_odd_rows(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(x.decode() for x in spread(rng, rng.choice([0, 3, 9, 40, 200]), rng.choice([1, 2, 4])))) for i in range(150)]
    rows += [(None, None), (None, "a a a a a a a"), (3, ""), (7, "  \t\n"), (5, "é é \x0bé é\x1cx é é é é é"), (9, "b " * 30_000)]
    rows += rows[:5]
    docs = spark.createDataFrame([(a, b, -1, "x") for a, b in rows], "doc_id bigint, text string, n_runs int, words string")
    assert sorted(map(tuple, R.run_digests(docs).collect()), key=str) == sorted((plain_row(*r) for r in rows), key=str)
    assert R.run_digests(docs.limit(0)).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = sorted(map(tuple, R.run_digests(docs).collect()))
    assert got == sorted(plain_row(r["doc_id"], r["text"]) for r in docs.collect())


def test_texts_and_runs_of_the_operator(spark):
    docs = spark.createDataFrame([(1, "x a b a b a b a b a y y"), (2, "p q")], "id bigint, body string")
    rows = {r["doc_id"]: r for r in R.periodic_runs(docs, "body", "id").collect()}
    assert [tuple(r) for r in rows[1]["runs"]] == [(1, 9, 2)]
    assert rows[1]["collapsed"] == "x a b y y" and rows[2]["collapsed"] == "p q" and rows[2]["runs"] == []
