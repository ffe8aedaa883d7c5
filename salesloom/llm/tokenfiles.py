"""Token counts of documents in flat token files without an index.

A flat token file is a run of fixed-width token ids in which every document ends
with the end-of-document id.  It is kept as blocks (file, block number, bytes) cut
at a fixed number of ids, wherever documents end.  ``scan`` finds the separators of
each block with one vectorised comparison and needs no order or index; documents
that run over block ends are stitched by a prefix scan over the blocks' summaries
(separators so far, position of the last separator): first within groups of
``GROUP`` blocks, then over the groups' totals, so no task holds a whole file.

``write_blocks`` makes such blocks from documents: a text is encoded with special
tokens as plain text, so the separator id never stands inside a document.

Defined cases: a file of no ids has no documents; ids after the last separator are
an unfinished document, reported with ``complete`` false; two separators in a row
enclose an empty document; null and empty texts are empty documents; repeated
rows and ids are documents of their own.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesloom.llm.bpe import Bpe, default_path, load_spec
from salesloom.llm.common import checkpointed, chunks, texts_of, written

END = 50256              # the end-of-document id of the byte-level BPE file
WIDTH = "<u2"            # ids of that file fit in two bytes
BLOCK_IDS = 1 << 15
GROUP = 1024             # blocks per group of the first prefix scan


def write_blocks(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """(file, block, ids binary, doc_ids): one flat file per input partition.  The
    list of doc_ids of the documents that end in a block is a side record for the
    reader of the counts; ``scan`` does not look at it."""
    spec = docs.sparkSession.sparkContext.broadcast(load_spec(tokenizer_path or default_path()))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bpe, file = Bpe(json.loads(spec.value), plain_specials=True), TaskContext.get().partitionId()
        rest, names, block, schema = np.empty(0, WIDTH), [], 0, None

        def row(ids: np.ndarray, ended: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([ids.tobytes()], pa.binary()),
                 pa.array([ended], pa.list_(schema))], names=["file", "block", "ids", "doc_ids"])

        for batch in batches:
            schema = batch.schema.field("doc_id").type
            for part in chunks(batch, "text"):
                flat = [rest]
                for doc_id, words in zip(part.column("doc_id").to_pylist(), bpe.encode_words(texts_of(part, "text")),
                                         strict=True):
                    flat += [np.frombuffer(bpe.raw_ids(words), "<i4").astype(WIDTH), np.array([END], dtype=WIDTH)]
                    names.append(doc_id)
                rest = np.concatenate(flat)
                while len(rest) >= BLOCK_IDS:
                    ended = int((rest[:BLOCK_IDS] == END).sum())
                    yield row(rest[:BLOCK_IDS], names[:ended])
                    rest, names, block = rest[BLOCK_IDS:], names[ended:], block + 1
        if len(rest):
            yield row(rest, names)

    return docs.select("doc_id", "text").mapInArrow(
        run, f"file bigint, block bigint, ids binary, doc_ids array<{kind}>")


def separators(blocks: DataFrame, end: int = END, width: str = WIDTH) -> DataFrame:
    """(file, block, n_ids, at): the positions of the separators within each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends, flat = [], [0], []
            for raw in batch.column("ids"):
                ids = np.frombuffer(raw.as_buffer() or b"", dtype=width)
                found = np.flatnonzero(ids == end)
                sizes.append(len(ids))
                flat.append(found)
                ends.append(ends[-1] + len(found))
            at = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                          pa.array(np.concatenate(flat) if flat else [], pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), pa.array(sizes, pa.int64()), at],
                                             names=["file", "block", "n_ids", "at"])

    return blocks.select("file", "block", F.coalesce("ids", F.lit(b"")).alias("ids")).mapInArrow(
        run, "file bigint, block bigint, n_ids bigint, at array<bigint>")


def scan(blocks: DataFrame, end: int = END, width: str = WIDTH) -> DataFrame:
    """(file, doc, start, n_tokens, complete, block): every document of every file,
    its number and first position in the file, its ids without the separator, and
    the block in which it ends."""
    found = checkpointed(separators(blocks, end, width))
    n = F.size("at").cast("bigint")
    summary = found.select("file", "block", F.expr(f"block div {GROUP}").alias("group"), "n_ids", n.alias("n"),
                           F.when(n > 0, F.element_at("at", -1)).alias("last"))
    # first scan: within groups of at most GROUP blocks
    inner = Window.partitionBy("file", "group").orderBy("block")
    before = inner.rowsBetween(Window.unboundedPreceding, -1)
    local = summary.select(
        "file", "group", "block", "n_ids", "n", "last",
        F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("ids_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"))
    local = local.withColumn("last_before", F.max(F.col("ids_before") + F.col("last")).over(before))
    # second scan: over one row per group
    totals = local.groupBy("file", "group").agg(
        F.sum("n_ids").alias("ids"), F.sum("n").alias("docs"), F.max(F.col("ids_before") + F.col("last")).alias("end"))
    outer = Window.partitionBy("file").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("base", F.coalesce(F.sum("ids").over(outer), F.lit(0)))
    totals = totals.select("file", "group", "base",
                           F.coalesce(F.sum("docs").over(outer), F.lit(0)).alias("docs_base"),
                           F.max(F.col("base") + F.col("end")).over(outer).alias("end_base"))
    placed = local.join(totals, ["file", "group"]).select(
        "file", "block", (F.col("base") + F.col("ids_before")).alias("base"),
        (F.col("docs_base") + F.col("n_before")).alias("first_doc"),
        F.coalesce(F.col("base") + F.col("last_before"), F.col("end_base"), F.lit(-1)).alias("last_end"))
    each = (found.join(placed, ["file", "block"])
            .select("file", "block", "base", "first_doc", "last_end", "at", F.posexplode("at").alias("i", "here")))
    ended = F.col("base") + F.col("here")
    previous = F.when(F.col("i") > 0, F.col("base") + F.get(F.col("at"), F.col("i") - 1)).otherwise(F.col("last_end"))
    documents = each.select("file", (F.col("first_doc") + F.col("i")).alias("doc"), (previous + 1).alias("start"),
                            (ended - previous - 1).alias("n_tokens"), F.lit(True).alias("complete"), "block")
    tail = (local.join(totals, ["file", "group"]).groupBy("file").agg(
        F.max(F.col("base") + F.col("ids_before") + F.col("n_ids")).alias("length"),
        F.max(F.coalesce(F.col("base") + F.col("ids_before") + F.col("last"), F.lit(-1))).alias("end"),
        F.max(F.col("docs_base") + F.col("n_before") + F.col("n")).alias("docs"), F.max("block").alias("block"))
        .where(F.col("length") > F.col("end") + 1)
        .select("file", F.col("docs").alias("doc"), (F.col("end") + 1).alias("start"),
                (F.col("length") - F.col("end") - 1).alias("n_tokens"), F.lit(False).alias("complete"), "block"))
    return documents.unionByName(tail)


def document_counts(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """(doc_id, file, doc, start, n_tokens) of every row of ``docs``, by writing flat
    token blocks to the shared folder and scanning them."""
    blocks = written(write_blocks(docs, tokenizer_path))
    counted = scan(blocks).withColumn("i", F.row_number().over(Window.partitionBy("file", "block").orderBy("doc")) - 1)
    named = blocks.select("file", "block", F.posexplode("doc_ids").alias("i", "doc_id"))
    return counted.join(named, ["file", "block", "i"]).select("doc_id", "file", "doc", "start", "n_tokens")
