"""The pipeline, each stage against a plain computation on its own input."""

import json

import corpus_pipeline as C
from salesloom.llm import bpe, decontam, neardup
from tests.conftest import SF_SMALL
from tests.llm.test_neardup import plain as plain_groups
from tests.llm.test_suffix import plain as plain_cuts


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    more = spark.createDataFrame([(900_001, None), (900_002, ""), (900_003, "One row."), (900_003, "One row.")], "doc_id long, text string")
    docs = docs.unionByName(more, allowMissingColumns=True).withColumn("_ranges", docs.doc_id * 0 + 1).withColumn("key", docs.doc_id)
    kept = C.quality_filter(spark, docs, SF_SMALL).persist()
    assert kept.columns == docs.columns and 0.5 * docs.count() < kept.count() <= docs.count()
    single = C.near_duplicates(spark, kept, SF_SMALL).persist()
    ids = {d for d, _, _, k in plain_groups([(r["doc_id"], r["text"]) for r in kept.collect()], neardup.Rule(5, 80)) if k}
    assert single.columns == docs.columns and {r["doc_id"] for r in single.collect()} == ids
    cut = C.repeated_strings(spark, single, SF_SMALL).persist()
    want = plain_cuts([(r["doc_id"], r["text"]) for r in single.collect()], C.REPEAT_BYTES)
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    after = {r["doc_id"]: r for r in cut.collect()}
    assert cut.columns == docs.columns and cut.count() == single.count()
    for doc_id, n, gone, _, _ in want:
        text = after[doc_id]["text"]
        assert (text == before[doc_id]) if not gone else 0 <= n - gone - len(text.encode()) <= 8 * 3
        assert text is None or doc_id >= 900_000 or after[doc_id]["n_chars"] == len(text)
    clean = C.decontamination(spark, cut, SF_SMALL).persist()
    items = [t["text"] for t in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    left = {r["doc_id"] for r in clean.collect()}
    index = decontam.Index(list(enumerate(items)))
    for doc_id, r in after.items():
        words = decontam.words_of(r["text"] or "")
        held = any(index.verify(words, a, i) for i in range(len(items)) for a in range(0, len(words) + 1, index.longest))
        assert (doc_id in left) != held
    coded = C.tokens(spark, clean, SF_SMALL)
    own = bpe.Bpe(json.loads(bpe.load_spec(bpe.default_path())))
    texts = {r["doc_id"]: r["text"] or "" for r in clean.collect()}
    for r in coded.collect():
        assert r["decoded"] == texts[r["doc_id"]] and r["ids"] == own.encode(r["decoded"]) and r["n_tokens"] == len(r["ids"])


def test_run_and_empty_input(spark, tmp_path):
    assert [name for name, _ in C.STAGES] == ["quality", "near_duplicates", "repeated_strings", "decontamination", "bpe"]
    full = C.run(spark, SF_SMALL)
    assert 0 < full.count() < 200
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert C.run(spark, str(tmp_path)).collect() == []
