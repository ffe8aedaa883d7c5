"""Quality classifier: a sparse ensemble of rules over document statistics.

``with_statistics`` computes every statistic as a Spark column over the whole text.
Small randomised trees are grown on labelled rows; each path from a root is a
conjunctive rule; a lasso logistic fit keeps few rules; the fitted model is one
Spark column expression (``score_column``), so scoring is a narrow JVM-side
projection without Python.

The fit reads at most ``MAX_TRAIN`` labelled rows (the smallest hashes of
doc_id), which bounds what reaches the driver: MAX_TRAIN rows of a dozen doubles.

Defined cases: null text is empty; an empty text has all statistics 0 and gets
the score of such a row; a doc_id with several label rows trains with each of
them; null labels are ignored; without both classes among the training labels
every score is the smoothed share of label 1, (ones + 1) / (rows + 2).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import fold_of, fresh
from salesloom.llm.trees import fit_logistic, fit_tree, paths

MAX_TRAIN = 20_000
TREES, DEPTH = 30, 3
L1 = 0.002
STATS = ["n_words", "word_chars", "distinct_words", "repeat_next", "upper", "symbols", "bars",
         "digits", "marked_words", "lines", "distinct_lines", "caps_words"]


def with_statistics(docs: DataFrame, into: str = "s") -> DataFrame:
    """``docs`` with a struct of the statistics ``STATS`` of its ``text``.  The word
    and line lists are columns of a projection below, so each is built once."""
    names = [fresh(docs, f"{into}_{c}") for c in ("text", "words", "lines")]
    t, words, lines = map(F.col, names)
    n, n_words = F.greatest(F.length(t), F.lit(1)), F.greatest(F.size(words), F.lit(1))

    def share(pattern: str) -> Column:
        return (F.length(t) - F.length(F.regexp_replace(t, pattern, ""))) / n

    def count(which: Column) -> Column:
        return F.size(F.filter(which, lambda yes: yes))

    same_as_next = F.zip_with(words, F.slice(words, 2, n_words), lambda a, b: F.coalesce(a == b, F.lit(False)))
    marked = F.transform(words, lambda w: w.rlike(r"[^\p{L}\p{N}\s.,;:?'\")]{2,}$"))
    caps = F.transform(words, lambda w: (w == F.upper(w)) & (w != F.lower(w)) & (F.length(w) > 1))
    values = [F.size(words), F.length(F.array_join(words, "")) / n_words,
              F.size(F.array_distinct(words)) / n_words, count(same_as_next) / n_words, share(r"\p{Lu}+"),
              share(r"[^\p{L}\p{N}\s]+"), share(r"\|+"), share(r"\p{N}+"), count(marked) / n_words,
              F.size(lines), F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
              count(caps) / n_words]
    text = F.coalesce(F.col("text"), F.lit(""))
    lists = [text, *[F.filter(F.split(text, p), lambda w: w != "") for p in (r"\s+", r"[\r\n]+")]]
    return (docs.withColumns(dict(zip(names, lists, strict=True)))
            .withColumn(into, F.struct(*[v.cast("double").alias(k) for k, v in zip(STATS, values, strict=True)]))
            .drop(*names))


def fit(rows: list[tuple[float, list[float]]], seed: int = 7) -> tuple[float, list]:
    """(intercept, [(weight, conditions)]) from (label, statistics) rows."""
    y = np.array([r[0] for r in rows], dtype=float)
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return float(np.log(share / (1 - share))), []
    x = np.array([r[1] for r in rows], dtype=float)
    rng = np.random.default_rng(seed)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    found: dict[tuple, None] = {}
    for _ in range(TREES):
        pick = rng.choice(len(y), size=min(len(y), 4000), p=weight / weight.sum())
        tree = fit_tree(x[pick], y[pick], DEPTH, max(2, len(pick) // 200), features=5, rng=rng)
        for path in paths(tree):
            found.setdefault(tuple(sorted(path)))
    if not found:
        return float(np.log(y.mean() / (1 - y.mean()))), []
    rules = np.array([np.all([(x[:, f] > c) == high for f, high, c in rule], axis=0) for rule in found]).T
    intercept, w = fit_logistic(rules.astype(float), y, l1=L1)
    return intercept, [(float(a), rule) for a, rule in zip(w, found, strict=True) if abs(a) > 1e-6]


def score_column(stats: Column, model: tuple[float, list]) -> Column:
    """The model compiled to one column expression over the statistics struct."""
    intercept, rules = model
    total = F.lit(intercept)
    for weight, rule in rules:
        holds = F.lit(True)
        for f, high, cut in rule:
            v = stats[STATS[f]]
            holds = holds & ((v > cut) if high else (v <= cut))
        total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def train(stats: DataFrame, labels: DataFrame, folds: int = 3, held_fold: int = 1,
          label_col: str = "quality") -> tuple[float, list]:
    """Fit on labels outside ``held_fold``.  ``stats``: doc_id and the struct ``s``."""
    known = (labels.where(F.col(label_col).isNotNull() & (fold_of(F.col("doc_id"), folds) != held_fold))
             .select("doc_id", F.col(label_col).cast("double").alias("y"))
             .orderBy(F.xxhash64(F.col("doc_id")), "doc_id", "y").limit(MAX_TRAIN))
    rows = stats.join(F.broadcast(known), "doc_id").select("doc_id", "y", "s").collect()  # <= MAX_TRAIN per repeated id
    rows.sort(key=lambda r: (r["doc_id"], r["y"]))
    return fit([(r["y"], list(r["s"])) for r in rows])


def sampled_model(docs: DataFrame, labels: DataFrame, folds: int, held_fold: int) -> tuple[float, list]:
    """:func:`train` with statistics of the rows that it can sample only."""
    known = labels.where(F.col("quality").isNotNull()).select("doc_id")
    sample = (known.where(fold_of(F.col("doc_id"), folds) != held_fold).distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRAIN))
    sampled = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id", "left_semi")
    return train(with_statistics(sampled).select("doc_id", "s"), labels, folds, held_fold)


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 3, held_fold: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``, scored in one narrow pass."""
    model = sampled_model(docs, labels, folds, held_fold)
    return (with_statistics(docs.select("doc_id", "text"))
            .select("doc_id", (fold_of(F.col("doc_id"), folds) == held_fold).alias("held_out"),
                    score_column(F.col("s"), model).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame, folds: int = 3, held_fold: int = 1) -> DataFrame:
    """The rows of ``docs`` (all columns) that the classifier predicts as good."""
    model = sampled_model(docs, labels, folds, held_fold)
    into = fresh(docs, "stats")
    return with_statistics(docs, into).where(score_column(F.col(into), model) >= 0.5).drop(into)
