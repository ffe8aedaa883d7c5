"""Decontamination: retrieval equals full scoring; planted items are found, decoys are not."""

import random

import pytest

from salesloom.llm import decontam as D
from tests.conftest import SF_SMALL


def texts(seed, n, size):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7)) % 3000}" for _ in range(20_000)]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(1, size))) for _ in range(n)]


@pytest.mark.parametrize("threshold", [0.2, 0.5])
def test_block_max_pruning_loses_nothing(monkeypatch, threshold):
    monkeypatch.setattr(D, "BLOCK", 4)
    monkeypatch.setattr(D, "THRESHOLD", threshold)
    index = D.Index(list(enumerate([*texts(1, 60, 40), "", "!!", None])))
    docs = [D.words_of(t) for t in [*texts(2, 40, 300), "", *texts(1, 60, 40)[:5]]]
    got = {(d, f, i): s for d, f, i, s in index.retrieve(docs)}
    inverse = {v: k for k, v in index.term.items()}
    want = {}
    entry_term = [None] * len(index.item)
    for t in range(len(inverse)):
        for e in range(index.term_start[t], index.term_end[t]):
            for p in range(index.entry_start[e], index.entry_end[e]):
                entry_term[p] = inverse[t]
    for d, words in enumerate(docs):
        for first in range(0, len(words) + 1, index.longest):
            there = set(words[first:first + 2 * index.longest])
            score = {}
            for p, t in enumerate(entry_term):
                if t in there:
                    score[index.item[p]] = score.get(index.item[p], 0) + index.impact[p]
            want |= {(d, first, i): s for i, s in score.items() if s >= threshold - 1e-9}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in got)


def test_planted_edited_and_clean(spark):
    items = [(1, "What is the capital of the small country of Freedonia today?\nThe capital is Fredville by the river."),
             (2, "One short item here. It has an answer right there."), (2, "One short item here. It has an answer right there."),
             (3, None), (4, ""), (None, "Another one with a null id and enough words to be found again.")]
    filler = " ".join(f"f{i}" for i in range(500))
    rows = [(10, f"{filler} {items[0][1].upper()} {filler}"), (11, filler), (12, f"{filler} {items[1][1]}"),
            (13, items[5][1]), (14, None), (15, ""), (None, items[1][1]), (12, f"{filler} {items[1][1]}"),
            (16, "What is the capital of the small country? " + filler),
            (17, f"{filler} " * 40 + items[0][1].replace("by the river", "on the river") + f" {filler}")]
    schema = "doc_id long, text string, item_id string, score int"
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], schema)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r["doc_id"], r["item_id"]) for r in D.contaminated(docs, bench).collect()), key=repr)
    assert got == sorted([(10, 1), (12, 2), (12, 2), (12, 2), (12, 2), (13, None), (None, 2), (None, 2), (17, 1)], key=repr)
    left = D.decontaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [11, 14, 15, 16]
    assert D.contaminated(docs.limit(0), bench).collect() == []
    assert D.contaminated(docs, bench.limit(0)).collect() == [] and D.decontaminated(docs, bench.limit(0)).count() == 10


def test_shards_do_not_lose_items(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, bench).collect()}
    texts_, items = ({r[0]: r["text"] for r in t.select(c, "text").collect()} for t, c in ((docs, "doc_id"), (bench, "item_id")))
    exact = {(d, i) for d, t in texts_.items() for i, s in items.items() if s in t}
    assert exact <= whole
    assert all(D.share(D.shingles(D.words_of(items[i])), D.shingles(D.words_of(texts_[d]))) >= 0.7 for d, i in whole)
    monkeypatch.setattr(D, "SHARD", 7)
    assert {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, bench).collect()} >= exact


@pytest.mark.parametrize("limit", [("SHARD", 7), ("SHARD_BYTES", 500)])
def test_shards_share_their_statistics(spark, monkeypatch, limit):
    items = [(i, t) for i, t in enumerate([*texts(5, 18, 30), "", None, *texts(6, 2, 80)])]
    docs = spark.createDataFrame([(i, f"{a} {t} {b}") for i, (a, (_, t), b) in enumerate(zip(texts(7, 22, 99), items, texts(8, 22, 99), strict=True))],
                                 "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string").coalesce(1)

    def found():
        return sorted(tuple(r) for r in D.contaminated(docs, bench).collect())

    whole = found()
    assert len(whole) >= 20
    monkeypatch.setattr(D, *limit, raising=False)
    assert len(list(D.shards(bench))) > 2
    got = found()
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in whole]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in whole])
