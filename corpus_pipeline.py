"""The training-data pipeline over the ``documents`` table.

Stages, each a function of (spark, docs, sf_dir) that works on all rows the one
before it kept:

1. quality: rows that the quality classifier predicts as bad go.
2. near_duplicates: of documents linked by five-word shingles with a Jaccard
   similarity of 0.8 or more, directly or through others, the one with the smallest
   doc_id stays.
3. repeated_strings: every string of ``REPEAT_BYTES`` bytes that also stands anywhere
   else is cut out of the texts, all occurrences; rows stay, n_chars is kept right.
4. decontamination: rows that hold a benchmark item go.
5. bpe: the texts left as token ids, with their decoding.

``run`` writes each stage's result under the shared folder and reads it back, as
a cluster run would, so a lost executor never repeats earlier stages.  Null and
empty texts, repeated rows, empty tables and further columns pass through every
stage as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm import bpe, decontam, neardup, quality, suffix
from salesloom.llm.common import table, written

#: More than 50 words of prose, and longer than license lines or short repeated lines.
REPEAT_BYTES = 200


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs, neardup.Rule(words=5, percent=80))


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix.without_repeats(docs, REPEAT_BYTES)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return (bpe.encode_documents(docs)
            .select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded"))


STAGES = [("quality", quality_filter), ("near_duplicates", near_duplicates), ("repeated_strings", repeated_strings),
          ("decontamination", decontamination), ("bpe", tokens)]

ORACLE_SQL = None       # learned and Unicode-dependent stages; tests/llm/test_pipeline.py is brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
