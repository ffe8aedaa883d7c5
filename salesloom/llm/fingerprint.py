"""Document fingerprints by consistent weighted sampling.

A text is a weighted set: its white-space separated words with their counts; a
word of more than ``LONG_WORD`` code points gives its overlapping pieces of
``PIECE`` code points instead, so an edit inside an unbroken text changes few
terms.  For each of ``SAMPLES`` positions a term draws r, c ~ Gamma(2, 1) and
b ~ U(0, 1) from a hash of (term, position); with weight w its level is
t = floor(ln w / r + b) and its key ln c - r (t - b) - r.  The term with the
smallest key and its level are the sample: two texts agree at a position with
probability equal to the generalised Jaccard similarity of their weights.  A
sample is stored as 16 bits of its hash, the fingerprint as hex.

Likeness is the share of equal samples, corrected for chance agreement of 16-bit
hashes being negligible.  Equal texts have equal fingerprints; a text without
terms has the constant fingerprint '' (likeness 1 to '', 0 to any other).

``fingerprint_neighbours`` also needs each row's successor by doc_id.  Rows go to
range buckets cut at approximate quantiles of doc_id; each bucket's first rows
are sent to the bucket before it as guests (the first bucket's to the last); a
task streams its sorted bucket and holds two rows.  Rows with equal doc_id follow
each other in order of text; a null id sorts first; the last row's successor is
the first row (in a table of one row: itself).
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import CHUNK_BYTES, hash_bytes, map_chunks, mix64, shuffle_partitions, texts_of

SAMPLES = 64
LONG_WORD, PIECE = 24, 8
BLOCK = 20_000        # (term, weight) pairs whose samples are drawn at once


def terms_of(text: str) -> Counter:
    words = text.split()
    out = Counter(w for w in words if len(w) <= LONG_WORD)
    for w in words:
        if len(w) > LONG_WORD:
            out.update(w[i:i + PIECE] for i in range(len(w) - PIECE + 1))
    return out


def _uniforms(terms: np.ndarray, stream: int) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers in (0, 1) per term (row) and position (column)."""
    at = mix64(np.arange(SAMPLES, dtype=np.uint64) + np.uint64(1 + stream * SAMPLES))
    bits = mix64(terms[:, None] ^ at[None, :])
    pair = (bits >> np.uint64(40), (bits >> np.uint64(8)) & np.uint64(0xFFFFFF))
    return tuple((x.astype(np.float32) + np.float32(0.5)) * np.float32(2.0 ** -24) for x in pair)


def draw(terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys (to be minimised) and 16-bit sample hashes of (term hash, weight) rows."""
    u, v = _uniforms(terms, 0)
    r = -np.log(u * v)
    u, v = _uniforms(terms, 1)
    key = np.log(-np.log(u * v))
    b, _ = _uniforms(terms, 2)
    level = np.floor(np.log(weights).astype(np.float32)[:, None] / r + b)
    key -= r * (level - b) + r
    sample = mix64(mix64(terms)[:, None] ^ level.astype(np.int64).view(np.uint64))
    return key, sample.astype(np.uint16)


def fingerprints(texts: list[str]) -> list[str]:
    """The fingerprint of each text."""
    bags = [terms_of(t) for t in texts]
    words: dict[tuple[str, int], int] = {}
    flat = np.fromiter((words.setdefault(x, len(words)) for bag in bags for x in bag.items()), dtype=np.int64)
    sizes = np.array([len(b) for b in bags], dtype=np.int64)
    out = [""] * len(texts)
    if not len(flat):
        return out
    hashes = hash_bytes([w.encode("utf-8", "surrogatepass") for w, _ in words])
    weights = np.array([n for _, n in words], dtype=np.float64)
    drawn = [draw(hashes[i:i + BLOCK], weights[i:i + BLOCK]) for i in range(0, len(weights), BLOCK)]
    keys = np.concatenate([k for k, _ in drawn])
    samples = np.concatenate([s for _, s in drawn])
    ends = np.cumsum(sizes)
    across = np.arange(SAMPLES)
    for i, (end, n) in enumerate(zip(ends, sizes, strict=True)):
        if n:
            own = flat[end - n:end]
            best = np.full(SAMPLES, np.inf, dtype=np.float32)
            chosen = np.zeros(SAMPLES, dtype=np.int64)
            for a in range(0, n, BLOCK):       # a very long text has many terms
                part = keys[own[a:a + BLOCK]]
                low = part.argmin(axis=0)
                value = part[low, across]
                better = value < best
                best[better], chosen[better] = value[better], own[a:a + BLOCK][low][better]
            out[i] = samples[chosen, across].astype(">u2").tobytes().hex()
    return out


def likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    x, y = (np.frombuffer(bytes.fromhex(s), dtype=">u2") for s in (a, b))
    return float((x == y).mean())


def fingerprint_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row of ``docs``."""

    def start():
        return lambda batch: {"doc_id": batch.column("doc_id"), "fingerprint": fingerprints(texts_of(batch, "text"))}

    kind = dict(docs.dtypes)["doc_id"]
    return map_chunks(docs.select("doc_id", "text"), "text", f"doc_id {kind}, fingerprint string", start)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the start of ``following``."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def below(cuts: list, kind: str) -> Column:
    """How many of the sorted ``cuts`` are below doc_id, by binary search in one literal array."""
    if not cuts:
        return F.lit(0)
    held = F.split(F.lit(",".join(map(str, cuts))), ",").cast(f"array<{kind}>")
    steps = F.array(*[F.lit(1 << k) for k in range(len(cuts).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(cuts)) & (F.get(held, at + step - 1) < F.col("doc_id")), at + step).otherwise(at))


def with_successors(docs: DataFrame) -> DataFrame:
    """Every row in a partition that also holds its successor: (doc_id, text, guest),
    sorted by guest, doc_id and text within each partition."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    n = shuffle_partitions(spark)
    shares = F.split(F.lit(",".join(str(i / n) for i in range(1, n)) or "0.5"), ",").cast("array<double>")
    cuts = rows.agg(F.percentile_approx("doc_id", shares, 10_000).alias("c")).first()["c"] if n > 1 else []
    cuts = sorted(set(cuts or []))                 # fewer than n numbers
    bucket = below(cuts, dict(rows.dtypes)["doc_id"])
    bucket = F.when(F.col("doc_id").isNull(), 0).otherwise(bucket).cast("int")
    firsts = (rows.select("doc_id", bucket.alias("bucket"))
              .groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"),
                                                    F.col("doc_id").alias("id"))).alias("first"))
              .orderBy("bucket").collect())        # one row per bucket
    # a bucket's first id and the bucket before it: at most one row per partition
    hosts = spark.createDataFrame([(b["bucket"], b["first"]["id"], firsts[i - 1]["bucket"]) for i, b in enumerate(firsts)],
                                  f"of int, first {dict(rows.dtypes)['doc_id']}, host int")
    rows = rows.withColumn("bucket", bucket)
    rows = rows.join(F.broadcast(hosts), (F.col("bucket") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first")), "left")
    host = F.col("host")
    own = F.struct(F.col("bucket").alias("at"), F.lit(False).alias("guest"))
    guest = F.struct(host.alias("at"), F.lit(True).alias("guest"))
    both = F.filter(F.array(own, guest), lambda p: p["at"].isNotNull())
    return (rows.withColumn("p", F.explode(both))
            .select("doc_id", "text", F.col("p.at").alias("at"), F.col("p.guest").alias("guest"))
            .repartitionById(len(cuts) + 1, F.col("at"))
            .sortWithinPartitions("guest", F.asc_nulls_first("doc_id"), "text")
            .select("doc_id", "text", "guest"))


def fingerprint_neighbours(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next) of every row of ``docs``."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []      # (doc_id, text) whose successors are at hand, but for the last
        size, over = 0, False

        def flush(schema: pa.Schema) -> pa.RecordBatch:
            """Rows for all that wait but the last, which stays."""
            texts = [t for _, t in waiting]
            rows = []
            changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
            both = fingerprints(texts + changed)       # they share most terms
            prints, others = both[:len(texts)], both[len(texts):]
            for i, (other, print_other) in enumerate(zip(changed, others, strict=True)):
                rows.append((waiting[i][0], len(texts[i]), hashlib.sha256(other.encode()).hexdigest(), prints[i],
                             print_other, likeness(prints[i], print_other), likeness(prints[i], prints[i + 1])))
            del waiting[:-1]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
                zip(*rows, strict=True) if rows else [[]] * len(names), schema, strict=True)], schema=schema)

        schema = None
        for batch in batches:
            schema = schema or pa.schema([pa.field("doc_id", batch.schema.field("doc_id").type), *[
                pa.field(k, t) for k, t in zip(names[1:], [pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2],
                                               strict=True)]])
            for doc_id, text, guest in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "guest")),
                                           strict=True):
                if guest and (over or not waiting):
                    continue           # of the guests only the first is a successor
                over = over or guest
                waiting.append((doc_id, text))
                size += len(text)
                if size > CHUNK_BYTES and len(waiting) > 1:
                    yield flush(schema)
                    size = 0
        if len(waiting) > 1:
            yield flush(schema)

    kind = dict(docs.dtypes)["doc_id"]
    return with_successors(docs).mapInArrow(
        run, f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")
