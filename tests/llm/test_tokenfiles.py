"""Token files: the scan against a plain loop, counts against the tokenizer."""

import json
import random

import numpy as np

from salesloom.llm import bpe
from salesloom.llm import tokenfiles as K
from tests.conftest import SF_SMALL


def test_scan_equals_a_loop(spark, monkeypatch):
    monkeypatch.setattr(K, "GROUP", 3)
    rng = random.Random(2)
    rows, want = [], []
    for file in range(6):
        ids = [K.END if rng.random() < (0.02 if file % 2 else 0.4) else rng.randrange(500) for _ in range(rng.choice([0, 1, 40, 700]))]
        start = doc = 0
        for i, x in enumerate(ids):
            if x == K.END:
                want.append((file, doc, start, i - start, True))
                start, doc = i + 1, doc + 1
        if start < len(ids):
            want.append((file, doc, start, len(ids) - start, False))
        rows += [(file, b, np.array(ids[a:a + 7], K.WIDTH).tobytes()) for b, a in enumerate(range(0, len(ids), 7))]
    rows.append((9, 0, None))
    blocks = spark.createDataFrame(rows, "file long, block long, ids binary").repartition(5)
    got = sorted(tuple(r)[:5] for r in K.scan(blocks).collect())
    assert got == sorted(want)
    assert K.scan(blocks.limit(0)).collect() == []


def test_counts_of_documents(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK_IDS", 100)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(-1, None), (-1, ""), (-2, "a<|endoftext|>b"), (None, "x y")], "doc_id long, text string")
    docs = docs.unionByName(more).withColumn("doc", docs.doc_id).repartition(3)
    own = bpe.Bpe(json.loads(bpe.load_spec(bpe.default_path())), plain_specials=True)
    want = sorted(((r["doc_id"], len(own.encode(r["text"] or ""))) for r in docs.collect()), key=repr)
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in K.document_counts(docs).collect()), key=repr) == want
    assert K.document_counts(docs.limit(0)).collect() == []
