"""Toxicity: the automaton against edit distances, context, held-out ranking."""

import random

import numpy as np

from salesloom.llm import toxicity as T

SF = "/root/testdata/sf0.01"


def distance(a, b):
    """Edits with swaps of neighbours."""
    d = {(i, j): max(i, j) for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_automaton_equals_edit_distance(monkeypatch):
    monkeypatch.setattr(T, "STATES", 300)
    rng = random.Random(4)
    terms = ["abcde", "abcdefghi", "aabba", "cab", "bcbcbcbcbc"]
    lexicon = T.Lexicon({t: (1.0, False) for t in terms})
    for _ in range(3000):
        base = list(rng.choice(terms))
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(base) + 1)
            base[i:i + rng.randrange(3)] = [rng.choice("abcdexi") for _ in range(rng.randrange(3))]
        word = "".join(base)
        best = min((distance(word, t) for t in terms if distance(word, t) <= T.edits_allowed(len(t))), default=None)
        assert (lexicon.hit(word)[1] > 0) == (best is not None), word
        if best is not None:
            assert lexicon.hit(word)[1] == 1.0 - 0.15 * best


def test_stems_folding_exceptions_and_context():
    lexicon = T.Lexicon({"idiot": (3.0, False), "vequ": (2.0, True)}, frozenset(["idiom"]))
    assert lexicon.hit("vequation") == (2.0, 1.0) and lexicon.hit("ve")[0] == 0
    assert lexicon.hit(T.folded("1d10t")) == (3.0, 1.0) and lexicon.hit("idoit")[0] > 0 and lexicon.hit("idiom")[0] == 0
    plain, quoted, direct = (T.features_of(t, lexicon, {})[0] for t in
                             ("what an idiot this is", 'the word "idiot" is rude', "you idiot go away"))
    assert quoted < plain < direct
    assert T.features_of("", lexicon, {}) == [0.0] * 4


def test_edges_and_held_out_ranking(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = T.score_documents(docs, labels).persist()
    assert scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    toxic, clean = ([r["score"] for r in rows if r["toxic"] == k] for k in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean])
    assert auc > 0.7, auc          # two in five toxic texts of this table hold no learnable term
    odd = spark.createDataFrame([(None, None, "x"), (1, "", "x"), (1, "", "x")], "doc_id long, text string, score string")
    none = labels.limit(0)
    assert [r["score"] for r in T.score_documents(odd, none).collect()] == [0.5] * 3
    assert T.score_documents(odd.limit(0), labels).collect() == []


def test_rare_clean_variants_are_exceptions(spark, monkeypatch):
    monkeypatch.setattr(T, "MAX_TERMS", 1)
    common = [f"{a}{b}{a}{b}" for a in "acdefhj" for b in "klmpqrs"]      # more than 20 commoner clean words
    texts = [("grobnik", True)] * 5 + [(" ".join(common), False)] * 30 + [("grobnek", False), ("grubnik", False)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id long, toxic boolean")
    (entries, exceptions), *_ = T.train(docs, labels, folds=5, held_fold=5)
    assert set(entries) == {"grobnik"} and exceptions == {"grobnek", "grubnik"}
    assert T.Lexicon(entries, exceptions).hit("grobnek") == (0.0, 0.0)
