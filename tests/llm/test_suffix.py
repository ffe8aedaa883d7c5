"""Repeated strings against direct counting of all substrings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from salesloom.llm import suffix as S
from tests.conftest import SF_SMALL


def plain(rows, minimum):
    raw = [(t or "").encode() for _, t in rows]
    count = Counter(r[i:i + minimum] for r in raw for i in range(len(r) - minimum + 1))
    out = []
    for (d, _), r in zip(rows, raw, strict=True):
        gone = np.zeros(len(r) + 2, dtype=bool)
        for i in range(len(r) - minimum + 1):
            if count[r[i:i + minimum]] > 1:
                gone[i + 1:i + 1 + minimum] = True
        kept = bytes(b for b, g in zip(r, gone[1:-1], strict=True) if not g)
        out.append((d, len(r), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def made(seed, minimum):
    rng = random.Random(seed)

    def words(n):
        return " ".join(rng.choice(["alpha", "bêta", "c", "delta", "ε", "zeta" + str(rng.randrange(50))]) for _ in range(n))

    passage, line = words(40), words(14)
    texts = [None, "", "short", "a" * (minimum - 1), "b" * minimum, "c" * (minimum + 1), "xy" * minimum, words(300),
             "q" * 3 * minimum + words(50)]
    texts += [f"{words(rng.randrange(30))} {passage} {words(rng.randrange(30))}" for _ in range(30)]
    texts += [f"{words(5)} {line} {words(8)} {line}" for _ in range(10)]
    base = words(120)
    for _ in range(12):
        t = base.split()
        t[rng.randrange(len(t))] = "edit" + str(rng.randrange(9))
        texts.append(" ".join(t))
    texts += [texts[7], base, base, passage, passage[:minimum], texts[20] + texts[21]]
    return list(zip(rng.sample(range(10_000), len(texts)), texts)) + [(None, words(90)), (None, base), (5, passage), (5, words(3))]


@pytest.mark.parametrize("seed", range(3))
def test_runs_equal_sorting(seed):
    rng = np.random.default_rng(seed)
    segments = [bytes(rng.integers(97, 99 + seed, rng.integers(0, 60)).astype(np.uint8)) for _ in range(30)] + [b"ab" * 20, b"ab" * 20]
    for minimum in (1, 3, 8):
        order, first = S.repeat_runs(segments, minimum)
        at, starts = 0, {}
        for seg in segments:
            starts |= {at + i: seg[i:i + minimum] for i in range(len(seg) - minimum + 1)}
            at += len(seg) + 1
        runs = np.split(order, first[1:])
        got = sorted(sorted(r.tolist()) for r in runs if len(r) > 1)
        groups = {}
        for p, x in starts.items():
            groups.setdefault(x, []).append(p)
        assert got == sorted(sorted(g) for g in groups.values() if len(g) > 1)


@pytest.mark.parametrize("hot", [256, 3])
def test_equals_counting_all_substrings(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "BUNDLE", 2000)
    monkeypatch.setattr(S, "GRAM", 8)
    monkeypatch.setattr(S, "STEP", 8)
    rows = made(hot, 60)
    df = spark.createDataFrame([(d, t, "x", 7) for d, t in rows], "doc_id long, text string, key string, n_bytes int")
    rows_out = S.removal_digests(df, 60).collect()
    assert all(r["repeated"] == (r["n_removed"] > 0) for r in rows_out)
    got = sorted((tuple(r)[:5] for r in rows_out), key=repr)
    assert got == plain(rows, 60)
    cut = {(r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in S.without_repeats(df, 60).collect()}
    exact = {(d, k) for d, _, n, _, k in got if n == 0}
    assert exact <= cut and S.without_repeats(df, 60).columns == df.columns


def test_table_and_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = sorted((tuple(r)[:5] for r in S.removal_digests(docs).collect()), key=repr)
    assert got == plain([(r["doc_id"], r["text"]) for r in docs.collect()], 400)
    assert S.removal_digests(docs.limit(0)).collect() == []
