"""Exact top-k search by the three-phase uniform threshold.

Vectors are rounded to whole numbers and cut into ``LISTS`` lists: list j holds the components
j, j + LISTS, ... of all vectors.  Each list scores every vector for a query by its part
of the inner product; a vector's score is the sum over the lists.  Lists are kept as packed
blocks of vectors, queries as groups of some blocks' queries, and every phase is a
join of blocks with query groups, spread over (list, shard of blocks).

1. Each list gives the ``heads`` best of its local scores per query.  What the other lists
   hold of these vectors is looked up, and the k-th best total is a lower bound of the
   k-th best score.
2. The bound over the number of lists is a safe cutoff: a vector below it in every list
   stays below the bound.  It goes to all lists, and each gives all entries that reach
   it, ties included.  Entries are added up by vector; the bound rises to the k-th best of
   the totals that are complete, and vectors that cannot reach it with their missing lists
   at the cutoff are dropped.
3. What is missing of the others is looked up, and the totals are exact.

No entry is capped: a query for which fewer than k vectors are known has no cutoff and gets all.

A vector that is null, or holds null, NaN or an infinite component, takes no part.  Vectors of
different length are compared as if zeros followed the shorter; an empty vector
scores 0.  Rows are told apart by where they are stored, so repeated ids or vectors are
rows of their own and only the query's own row is left out.  Scaled components beyond
``LARGEST`` count as that, so sums over up to 2,048 components stay whole 64-bit numbers.  Equal
scores are in order of vec_id (null last), then of storage.  A row without vec_id is no query.
An empty table gives no rows.  Only the id and vector columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.llm.common import checkpointed, written

LISTS = 2
BLOCK_ROWS, BLOCK_VALUES = 4096, 1 << 20     # a block holds at most so many vectors and about so many components
GROUP_QUERIES = 1024                         # queries of a group, about
SHARD_BLOCKS = 4                             # blocks of a list that a task meets with all query groups
AT_ONCE = 1 << 21                            # scores computed at once
LARGEST = 1 << 26
KINDS = ("<i2", "<i4")

BLOCKS = pa.schema([("list", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()), ("known", pa.binary()), ("queries", pa.binary()),
                    ("kind", pa.string()), ("width", pa.int32()), ("scores", pa.binary()), ("n_queries", pa.int64())])
ENTRY = ("list int, grp int, q_block bigint, q_at int, query_id bigint, r_block bigint, r_at int, vec_id bigint, score bigint")
QUERY, ROW = ("grp", "q_block", "q_at"), ("r_block", "r_at")


def whole_parts(vectors: pa.Array, scale: float) -> np.ndarray:
    """The vectors as rows of whole numbers, with zeros after the shorter ones."""
    ends = vectors.offsets.to_numpy()
    sizes = np.diff(ends)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=np.int64)
    flat = vectors.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]].astype(np.float64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.clip(np.floor(flat * scale), -LARGEST, LARGEST).astype(np.int64)
    return out


def pack(scale: float, every: int, lists: int):
    """Blocks of (vec_id, vector) rows; every ``every``-th id is a query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                size = np.diff(batch.column("vector").slice(at, BLOCK_ROWS).offsets.to_numpy())
                n = max(1, min(len(size), int(BLOCK_VALUES // max(1, size.max()))))
                part = batch.slice(at, n)
                ids = part.column("vec_id")
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy()
                queries = np.flatnonzero(known & (ids % every == 0)).astype("<i4")
                values = whole_parts(part.column("vector").take(pa.array(np.arange(n))), scale)
                rows = []
                for j in range(lists):
                    own = values[:, j::lists]
                    kind = KINDS[int(np.abs(own).max(initial=0)) >= 1 << 15]
                    rows.append((j, block, ids.astype("<i8").tobytes(), known.tobytes(), queries.tobytes(), kind, own.shape[1],
                                 own.astype(kind).tobytes(), len(queries)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), BLOCKS, strict=True)],
                                                 schema=BLOCKS)
                at, block = at + n, block + 1

    return run


def _matrix(kind: str, width: int, scores: bytes, n: int) -> np.ndarray:
    return np.frombuffer(scores, kind).reshape(n, width)


class Queries:
    """A group's queries in one list: number of the block, place in it, id and components."""

    def __init__(self, parts: list[dict]):
        parts = [p for p in parts if p["queries"]]
        width = max(p["width"] for p in parts)
        at = [np.frombuffer(p["queries"], "<i4") for p in parts]
        self.block = np.concatenate([np.full(len(a), p["block"], dtype=np.int64) for a, p in zip(at, parts, strict=True)])
        self.at = np.concatenate(at).astype(np.int64)
        self.ids = np.concatenate([np.frombuffer(p["ids"], "<i8")[a] for a, p in zip(at, parts, strict=True)])
        self.values = np.zeros((len(self.at), width), dtype=np.int64)
        low = 0
        for a, p in zip(at, parts, strict=True):
            self.values[low:low + len(a), :p["width"]] = _matrix(p["kind"], p["width"], p["scores"], len(p["known"]))[a]
            low += len(a)

    def places(self, block: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The rows here of queries given by block and place."""
        order = np.lexsort((self.at, self.block))
        names = {k: i for i, k in zip(order.tolist(), zip(self.block[order].tolist(), self.at[order].tolist(), strict=True), strict=True)}
        return np.array([names[k] for k in zip(block.tolist(), at.tolist(), strict=True)], dtype=np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with those of ``b``, over the columns both have."""
    w = min(a.shape[1], b.shape[1])
    a, b = a[:, :w], b[:, :w]
    if int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * w < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a.astype(np.int64) @ b.T.astype(np.int64)


def _entries(columns: list) -> pa.RecordBatch:
    names = ["list", "grp", "q_block", "q_at", "query_id", "r_block", "r_at", "vec_id", "score"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c).cast(t) for c, t in zip(columns, types, strict=True)], names=names)


def scan(heads: int | None):
    """Entries of (query group, block) rows: the ``heads`` best per query, or those not below
    the cutoffs that come with the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.to_pylist():
                queries = Queries(cell["parts"])
                n = len(cell["known"])
                values = _matrix(cell["kind"], cell["width"], cell["scores"], n)
                ids = np.frombuffer(cell["ids"], "<i8")
                known = np.frombuffer(cell["known"], bool)
                if heads is None:
                    least = np.full(len(queries.at), np.iinfo(np.int64).min)
                    cut = cell["cutoffs"] or []
                    if cut:
                        at = queries.places(np.array([c["q_block"] for c in cut]), np.array([c["q_at"] for c in cut]))
                        least[at] = [c["cutoff"] for c in cut]
                step = max(1, AT_ONCE // max(1, n))
                for low in range(0, len(queries.at), step):
                    some = slice(low, low + step)
                    scores = products(queries.values[some], values)
                    wanted = np.ones(scores.shape, dtype=bool)
                    own = np.flatnonzero(queries.block[some] == cell["block"])
                    wanted[own, queries.at[some][own]] = False
                    if heads is None:
                        wanted &= scores >= least[some][:, None]
                    elif heads < n:
                        ranked = np.where(wanted, scores, np.iinfo(np.int64).min)
                        best = np.argpartition(-ranked, heads - 1, axis=1)[:, :heads]
                        chosen = np.zeros(scores.shape, dtype=bool)
                        np.put_along_axis(chosen, best, True, axis=1)
                        wanted &= chosen
                    q, r = np.nonzero(wanted)
                    if not len(q):
                        continue
                    q_all = q + low
                    yield _entries([np.full(len(q), cell["list"]), np.full(len(q), cell["grp"]), queries.block[q_all], queries.at[q_all],
                                    queries.ids[q_all], np.full(len(q), cell["block"]), r, pa.array(ids[r], mask=~known[r]), scores[q, r]])

    return run


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Local scores of the (query, vector) pairs that come with a query group and a block."""
    for batch in batches:
        for cell in batch.to_pylist():
            queries = Queries(cell["parts"])
            values = _matrix(cell["kind"], cell["width"], cell["scores"], len(cell["known"]))
            wanted = cell["wanted"]
            block, at, r = (np.array([w[c] for w in wanted], dtype=np.int64) for c in ("q_block", "q_at", "r_at"))
            q = queries.places(block, at)
            width = min(values.shape[1], queries.values.shape[1])
            step = max(1, AT_ONCE // max(1, width))
            score = np.concatenate([np.einsum("ij,ij->i", queries.values[q[i:i + step], :width],
                                              values[r[i:i + step], :width].astype(np.int64)) for i in range(0, len(q), step)])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), cell["grp"], np.int32)), pa.array(block), pa.array(at.astype(np.int32)),
                                              pa.array(np.full(len(q), cell["block"], np.int64)), pa.array(r.astype(np.int32)),
                                              pa.array(score)], names=["grp", "q_block", "q_at", "r_block", "r_at", "score"])


def _kth(df: DataFrame, k: int, name: str) -> DataFrame:
    """Per query the k-th best score, where there are k."""
    ranked = Window.partitionBy(*QUERY).orderBy(F.desc("score"), *ROW)
    return (df.select(*QUERY, *ROW, "score").withColumn("nth", F.row_number().over(ranked))
            .where(F.col("nth") <= k).where(F.col("nth") == k).select(*QUERY, F.col("score").alias(name)))


class Search:
    """The packed lists of one table and its queries."""

    def __init__(self, vectors: DataFrame, every: int, scale: float, lists: int):
        self.lists = lists
        finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))      # NaN is above all numbers
        rows = vectors.where(F.col("vector").isNotNull() & finite)
        blocks = written(rows.mapInArrow(pack(scale, every, lists), _ddl()))
        sizes = blocks.where("list = 0").agg(F.count("*").alias("blocks"), F.sum("n_queries").alias("queries")).first()
        shards = -(-max(1, sizes["blocks"]) // SHARD_BLOCKS)
        groups = -(-max(1, sizes["queries"] or 0) // GROUP_QUERIES)
        number = F.xxhash64("block")
        self.blocks = blocks.withColumn("shard", F.pmod(number, F.lit(shards)).cast("int"))
        part = F.struct("block", "ids", "known", "queries", "kind", "width", "scores")
        self.groups = (blocks.where("n_queries > 0").withColumn("grp", F.pmod(number, F.lit(groups)).cast("int"))
                       .groupBy("list", "grp").agg(F.collect_list(part).alias("parts")))
        self.shards = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))

    def entries(self, heads: int | None = None, cutoffs: DataFrame | None = None) -> DataFrame:
        groups = self.groups
        if cutoffs is not None:
            own = cutoffs.groupBy("grp").agg(F.collect_list(F.struct("q_block", "q_at", "cutoff")).alias("cutoffs"))
            groups = groups.join(own, "grp", "left")
        return groups.withColumn("shard", self.shards).join(self.blocks, ["list", "shard"]).mapInArrow(scan(heads), ENTRY)

    def looked_up(self, pairs: DataFrame) -> DataFrame:
        """``score``: what the lists in ``missing`` (bits) hold of each pair, in sum."""
        each = F.explode(F.filter(F.array(*map(F.lit, range(self.lists))), lambda j: F.getbit(F.col("missing"), j) == 1))
        cells = (pairs.withColumn("list", each).groupBy("list", "grp", F.col("r_block").alias("block"))
                 .agg(F.collect_list(F.struct("q_block", "q_at", "r_at")).alias("wanted")))
        local = cells.join(self.blocks, ["list", "block"]).join(self.groups, ["list", "grp"]).mapInArrow(
            _look_up, "grp int, q_block bigint, q_at int, r_block bigint, r_at int, score bigint")
        return local.groupBy(*QUERY, *ROW).agg(F.sum("score").alias("more"))


def _ddl() -> str:
    kinds = {pa.int32(): "int", pa.int64(): "bigint", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in BLOCKS)


def _added(entries: DataFrame, lists: int) -> DataFrame:
    """One row per query and vector: sum of its entries and which lists are missing, as bits."""
    seen = F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("list")))
    return entries.groupBy(*QUERY, *ROW).agg(F.first("query_id").alias("query_id"), F.first("vec_id").alias("vec_id"),
                                             F.sum("score").alias("score"),
                                             F.lit((1 << lists) - 1).bitwiseXOR(seen).alias("missing"))


def _totals(search: Search, added: DataFrame) -> DataFrame:
    """``added`` with exact scores."""
    part = added.where("missing != 0")
    more = search.looked_up(part)
    return added.where("missing = 0").unionByName(
        part.join(more, [*QUERY, *ROW]).withColumn("score", F.col("score") + F.col("more")).drop("more"))


def nearest(vectors: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0, lists: int = LISTS, heads: int | None = None,
            vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` the
    ``k`` other rows with the highest inner product of floor(scale * component)."""
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("vector"))
    search = Search(rows, every, scale, lists)
    heads = max(k, heads or 4 * k)

    first = search.entries(heads)
    in_list = Window.partitionBy(*QUERY, "list").orderBy(F.desc("score"), *ROW)
    first = first.withColumn("nth", F.row_number().over(in_list)).where(F.col("nth") <= heads).drop("nth")
    bound = checkpointed(_kth(_totals(search, checkpointed(_added(first, lists))), k, "bound"))
    # an entry reaches the cutoff if lists * score >= bound
    second = written(search.entries(cutoffs=bound.withColumn("cutoff", _ceil_div(F.col("bound"), lists))))

    added = checkpointed(_added(second, lists))
    higher = _kth(added.where("missing = 0"), k, "higher")
    open_lists = F.bit_count("missing")
    reach = F.col("score") * lists + open_lists * F.col("bound")       # above lists * score, if a list is missing
    safe = (added.join(bound, list(QUERY), "left").join(higher, list(QUERY), "left")
            .where(F.col("bound").isNull() | (open_lists == 0) | (reach > lists * F.greatest("bound", F.coalesce("higher", "bound"))))
            .select(*added.columns))
    best: Column = F.row_number().over(Window.partitionBy(*QUERY).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), *ROW))
    return (_totals(search, checkpointed(safe)).withColumn("rank", best).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _ceil_div(x: Column, n: int) -> Column:
    """x / n rounded up, in whole numbers."""
    return -((-x - F.pmod(-x, F.lit(n))) / n).cast("bigint")


#: The same rows from all pairs of queries and vectors, for small tables.
ALL_PAIRS = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.v, r.v)::BIGINT AS score
  FROM whole q JOIN whole r ON q.vec_id <> r.vec_id
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
