"""Quality classifier: statistics, compiled rules, held-out accuracy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesloom.llm import quality as Q

SF = "/root/testdata/sf0.01"


def test_statistics_of_edge_texts(spark):
    texts = [None, "", "   ", "one", "A a a a\nA a a a\n", "X!! Y!! z", "a | b | c", "\u0000é\ud7ff", "w " * 20000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = [r["s"].asDict() for r in Q.with_statistics(df).orderBy("doc_id").collect()]
    assert set(got[0]) == set(Q.STATS) and all(v == 0 for v in got[0].values())
    assert got[1] == got[0]
    assert got[4]["n_words"] == 8 and got[4]["lines"] == 2 and got[4]["distinct_lines"] == 0.5
    assert got[4]["repeat_next"] == pytest.approx(4 / 8)
    assert got[5]["marked_words"] == pytest.approx(2 / 3)
    assert got[6]["bars"] == pytest.approx(2 / 9)
    assert got[8]["distinct_words"] == pytest.approx(1 / 20000)


def test_compiled_expression_equals_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.random((400, len(Q.STATS)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] <= 0.7)).astype(float)
    model = Q.fit([(a, b.tolist()) for a, b in zip(y, x, strict=True)])
    want = np.full(len(x), model[0])
    for w, rule in model[1]:
        want += w * np.all([(x[:, f] > c) == high for f, high, c in rule], axis=0)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)],
                               "i int, " + ", ".join(f"{s} double" for s in Q.STATS))
    got = [r[0] for r in df.orderBy("i").select(Q.score_column(F.struct(*Q.STATS), model)).collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-want)))
    assert ((want > 0) == (y == 1)).mean() > 0.97
    assert 0 < len(model[1]) < 200


def test_no_labels_one_class_and_empty_documents(spark):
    docs = spark.createDataFrame([(1, "a b", "q"), (1, "a b", "q"), (None, None, "q")], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in Q.score_documents(docs, none).collect()] == [0.5] * 3
    one = spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(2, None, 0)], "doc_id long, quality int, toxic int")
    scores = {r["score"] for r in Q.score_documents(docs, one).collect()}
    assert len(scores) == 1 and math.isfinite(scores.pop())
    assert Q.score_documents(docs.limit(0), one).count() == 0


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.score_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert docs.count() == Q.score_documents(docs, labels).count()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc > 0.85, auc


def test_scores_are_one_pass_over_the_documents_without_a_stored_copy(spark, tmp_path):
    spark.createDataFrame([(i, f"Some words {i}.") for i in range(8)], "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    got = Q.score_documents(spark.read.parquet(f"{tmp_path}/docs"), labels)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and plan.count("parquet") == 1 and got.count() == 8
