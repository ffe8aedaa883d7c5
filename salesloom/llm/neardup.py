"""Near-duplicate documents by SetSketch registers.

A document's set holds the hashes (64 bits) of its distinct word shingles.  Equal
sets are folded first: a class is one node, whatever its number of copies.  Each
node gets a SetSketch: per register the smallest of the elements' exponential
variates, on an exponential scale of base ``BASE`` and truncated to
[0, ``TOP``].  Registers of a union are the maximum of the registers.  Bands of
``ROWS`` registers are the candidate buckets; their number is chosen so that a
pair at the threshold shares no band with a probability below ``MISS``.

Pairs of a bucket are judged in three steps: the sizes must allow the threshold;
the joint likelihood of the two sketches must not rule it out (``SIGMAS``); then the
full sets decide.  Only connectivity is wanted, so a bucket is never expanded into
pairs: in ``ROUNDS`` rounds every member is compared with one pivot of its bucket
that is not yet known to be in its component; the pair of a bucket of two is judged for
good in the first.  At last the buckets that still hold several
components are bundled by pivot, a node standing once in a bundle whatever its
number of bands there, and the rows of a bundle are compared in blocks of about
``BLOCK`` rows or ``BLOCK_SHINGLES`` set elements, by sketches first; the sets of rows that
these leave in doubt then meet, and only links between components come out.  A bucket of copies of one text collapses in
the first round; members that no link joins cost comparisons that are quadratic
within their bundle, split over tasks by blocks.

Defined cases: words are ASCII-lower-cased runs of non-white-space; a text with
fewer words than a shingle is one shingle; null, empty and blank texts have an
empty set and are their own component; a row with null doc_id takes part in its
class but is never kept (a set known under null ids only links with nothing, and
its component is null); rows that repeat a doc_id are documents that share that id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import forget, hash_bytes, map_chunks, mix64, texts_of, written
from salesloom.llm.graph import components

BASE, RATE, TOP = 1.02, 20.0, 4095
ROWS = 5
MISS = 1e-9
SIGMAS = 6.0
ROUNDS = 2
BLOCK, BLOCK_SHINGLES = 2048, 1 << 21    # rows, and elements of their sets, of a block on average
SIFT_WORDS = 1 << 20     # 64 bits each
SLICE = 1 << 16          # shingles hashed at once


@dataclass(frozen=True)
class Rule:
    """Link when ``100 * intersection >= percent * union``."""

    words: int
    percent: int

    @property
    def bands(self) -> int:
        return math.ceil(math.log(MISS) / math.log(1 - (self.percent / 100) ** ROWS))


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    split = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    known: dict[bytes, int] = {}
    flat = np.fromiter((known.setdefault(w, len(known)) for s in split for w in s), dtype=np.int64)
    hashes = mix64(hash_bytes(list(known)))[flat] if len(flat) else np.empty(0, np.uint64)
    out, at = [], 0
    for s in split:
        own = hashes[at:at + len(s)]
        at += len(s)
        n = min(words, len(own))
        x = np.zeros(len(own) - n + 1 if n else 0, dtype=np.uint64)
        for i in range(n):
            x = x * np.uint64(0x9E3779B97F4A7C15) + own[i:i + len(x)]
        out.append(np.unique(mix64(x + np.uint64(n))))
    return out


def registers(sets: list[np.ndarray], m: int) -> np.ndarray:
    """One row of ``m`` registers per (non-empty) set."""
    seeds = mix64(np.arange(1, m + 1, dtype=np.uint64))
    factors = mix64(seeds) | np.uint64(1)
    low = np.empty((len(sets), m), dtype=np.uint64)
    i = 0
    while i < len(sets):
        j, total = i, 0
        while j < len(sets) and (j == i or total + len(sets[j]) <= SLICE):
            total += len(sets[j])
            j += 1
        x = np.concatenate(sets[i:j])
        starts = np.cumsum([0, *[len(s) for s in sets[i:j - 1]]])
        for k in range(m):
            h = (x ^ seeds[k]) * factors[k]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            low[i:j, k] = np.minimum.reduceat(h, starts)
        i = j
    smallest = -np.log1p(-(low.astype(np.float64) + 0.5) * 2.0 ** -64) / RATE
    return np.clip(np.floor(1 - np.log(smallest) / math.log(BASE)), 0, TOP).astype(np.uint16)


def sketch_table(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, n, node, regs, bands) per row; node, regs and bands null for empty sets."""

    def start():
        def work(batch: pa.RecordBatch) -> dict:
            import xxhash

            sets = shingle_sets(texts_of(batch, "text"), rule.words)
            full = [i for i, s in enumerate(sets) if len(s)]
            m = rule.bands * ROWS
            regs = registers([sets[i] for i in full], m)
            bands = np.zeros((len(full), rule.bands), dtype=np.uint64)
            for k in range(rule.bands):
                key = np.full(len(full), k + 1, dtype=np.uint64)
                for r in range(ROWS):
                    key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + regs[:, k * ROWS + r])
                bands[:, k] = key
            out = {"doc_id": batch.column("doc_id"), "n": [len(s) for s in sets]}
            out |= {c: [None] * len(sets) for c in ("node", "regs", "bands")}
            for row, i in enumerate(full):
                out["node"][i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                out["regs"][i] = regs[row].tobytes()
                out["bands"][i] = bands[row].view(np.int64)
            return out

        return work

    kind = dict(docs.dtypes)["doc_id"]
    return map_chunks(docs.select("doc_id", "text"), "text",
                      f"doc_id {kind}, n bigint, node binary, regs binary, bands array<bigint>", start)


def may_link(above: np.ndarray, below: np.ndarray, m: int, nx: np.ndarray, ny: np.ndarray,
             rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """(whether the pair may reach the threshold, estimated similarity) of pairs of sets
    of nx and ny elements, of whose ``m`` registers so many are above and below.

    The three counts are multinomial with probabilities that depend on the similarity;
    the score of their joint log-likelihood at the threshold, in standard deviations,
    says whether the threshold is ruled out, and one Newton step gives the estimate."""
    t, scale = rule.percent / 100, (BASE - 1) / BASE
    u, v = nx / (nx + ny), ny / (nx + ny)

    def p(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rest = 1 - np.clip(x, 0, 1) * scale
        return np.maximum(-np.log(rest) / math.log(BASE), 1e-9), scale / (math.log(BASE) * rest)

    (a, slope_a), (b, slope_b) = p(u - v * t), p(v - u * t)
    da, db = -v * slope_a, -u * slope_b
    e = np.maximum(1 - a - b, 1e-9)
    score = above * da / a + below * db / b - (m - above - below) * (da + db) / e
    information = m * (da ** 2 / a + db ** 2 / b + (da + db) ** 2 / e)
    sized = 100 * np.minimum(nx, ny) >= rule.percent * np.maximum(nx, ny)
    return sized & (score >= -SIGMAS * np.sqrt(information)), t + score / information


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(len(column), -1)


def sketch_test(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """(a, b, only, likeness) of the pairs (a, b, only) whose sketches do not rule out a link."""
    side = {k: nodes.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("regs").alias(f"r{k}"))
            for k in "ab"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                na, nb = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("na", "nb"))
                x, y = _matrix(batch.column("ra")), _matrix(batch.column("rb"))
                ok, best = may_link((x > y).sum(axis=1), (x < y).sum(axis=1), x.shape[1], na, nb, rule)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).filter(pa.array(ok)) for c in ("a", "b", "only")), pa.array(best[ok])],
                    names=["a", "b", "only", "likeness"])

    return (pairs.join(side["a"], "a").join(side["b"], "b")
            .mapInArrow(run, "a binary, b binary, only boolean, likeness double"))


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """(u, v) of the pairs (a, b) that link by their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("xa"), batch.column("xb"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= rule.percent * (len(x) + len(y) - both))
            ok = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], names=["u", "v"])

    joined = pairs.select("a", "b")
    for k in "ab":
        joined = joined.join(sets.select(F.col("node").alias(k), F.col("x").alias(f"x{k}")), k)
    return joined.mapInArrow(run, "u binary, v binary")


def sifted(df: DataFrame, ids: DataFrame, key: str, n: int) -> DataFrame:
    """``df`` without most of the rows whose ``key`` is not among the about ``n`` ``ids``: a join that
    follows decides, but wide rows that it would drop need not be shuffled first.

    The ids' hashes are set as bits of ``n / 4`` words (``SIFT_WORDS`` at most, so the broadcast is
    bounded): of other keys one in sixteen passes, more beyond that bound."""
    words = max(1, min(SIFT_WORDS, n // 4))
    word = F.pmod(F.xxhash64(key, F.lit(1)), F.lit(words)).alias("_word")
    bit = F.expr(f"shiftleft(1L, CAST(pmod(xxhash64(`{key}`, 2), 64L) AS INT))").alias("_bit")
    held = ids.select(word, bit).groupBy("_word").agg(F.bit_or("_bit").alias("_held"))
    return (df.select("*", word, bit).join(F.broadcast(held), "_word")
            .where(F.col("_held").bitwiseAND(F.col("_bit")) != 0).select(*df.columns))


def node_sets(docs: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """(node, x): the shingle hashes of the nodes ``wanted`` (node, doc_id), read again
    from the texts of those documents."""

    def start():
        def work(batch: pa.RecordBatch) -> dict:
            import xxhash

            raw = [s.tobytes() for s in shingle_sets(texts_of(batch, "text"), rule.words)]
            return {"node": [xxhash.xxh3_128_digest(r) for r in raw], "x": raw}

        return work

    ids = wanted.select("doc_id").distinct()
    near = sifted(docs.select("doc_id", "text"), ids, "doc_id", wanted.count())
    # the ids are distinct; a semi join would be pushed below the sift, onto all texts
    found = map_chunks(near.join(ids, "doc_id").select("doc_id", "text"), "text",
                       "node binary, x binary", start)
    # rows that repeat a doc_id may give a node twice
    return found.join(wanted.select("node"), "node", "left_semi").groupBy("node").agg(F.first("x").alias("x"))


def intersections(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the pairwise intersections, by products of 0/1 matrices."""
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    often = count[column] > 1
    rank = np.cumsum(count > 1) - 1
    row, column = row[often], rank[column[often]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        a, b = np.searchsorted(column, [first, first + columns])
        held = np.zeros((len(sets), columns), dtype=np.float32)
        held[row[a:b], column[a:b] - first] = 1
        total += held @ held.T
    return total.astype(np.int64)


def doubtful(regs: np.ndarray, n: np.ndarray, roots: np.ndarray, left: np.ndarray, right: np.ndarray,
             rule: Rule) -> np.ndarray:
    """The rows that stand in a pair of a ``left`` and a ``right`` row (the same rows, or
    apart) of different components whose sketches do not rule out a link."""
    same = left is right
    held = np.zeros(len(n), dtype=bool)
    for a in left:
        others = right[right > a] if same else right
        others = others[(roots[others] != roots[a])
                        & (100 * np.minimum(n[others], n[a]) >= rule.percent * np.maximum(n[others], n[a]))]
        if len(others):
            x, y = regs[a], regs[others]
            ok, _ = may_link((x > y).sum(axis=1), (x < y).sum(axis=1), len(x), np.full(len(others), n[a]), n[others], rule)
            held[others[ok]] = True
            held[a] |= ok.any()
    return np.flatnonzero(held)


def exact_links(sets: list[np.ndarray], roots: np.ndarray, rule: Rule) -> list[tuple[int, int]]:
    """Links between rows of different components, one for each pair of components."""
    both = intersections(sets)
    n = np.array([len(s) for s in sets])
    out: dict[tuple[int, int], tuple[int, int]] = {}
    for a in range(len(n)):
        k = both[a, a + 1:]
        linked = (100 * k >= rule.percent * (n[a] + n[a + 1:] - k)) & (roots[a + 1:] != roots[a])
        for b in np.flatnonzero(linked) + a + 1:
            out.setdefault((min(roots[a], roots[b]), max(roots[a], roots[b])), (a, int(b)))
    return list(out.values())


def pivot(turn: int, root: str = "root") -> Column:
    """The smallest member (node, root) of a bucket, by an order of the nodes that is the
    same in every bucket, so that buckets which overlap mostly have the same one."""
    return F.min(F.struct(F.xxhash64("node", F.lit(turn)), F.col("node"), F.col(root).alias("root"))).alias("p")


def climbed(found: DataFrame, jumps: int = 2) -> DataFrame:
    """(u, v): for nodes v of ``found`` (u, v), as u, one that some links lead to.  Every
    link leads to a smaller node by the pivots' order, so there are no cycles; nodes with the
    same v are connected, those further apart than the jumps reach keep different ones."""
    up = written(found.groupBy(F.col("v").alias("u")).agg(F.min("u").alias("v")))
    for _ in range(jumps):
        up = (up.join(up.select(F.col("u").alias("v"), F.col("v").alias("top")), "v", "left")
              .select("u", F.coalesce("top", "v").alias("v")))
    return up


def cross_links(members: DataFrame, nodes: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """(u, v): links between different components within one bucket.  ``members``:
    (node, root, a), a the bucket's pivot.  Buckets with the same pivot are one bundle, which
    holds each node once, however many of its bands fall there; blocks of a bundle meet pairwise."""
    bundles = written(members.select("a", "node", "root").distinct().join(nodes.select("node", "n"), "node"))
    blocks = F.ceil(F.greatest(F.lit(1), F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    mixed = (bundles.groupBy("a").agg(blocks.alias("blocks"), F.min("root").alias("low"), F.max("root").alias("high"))
             .where("low != high").select("a", "blocks"))
    placed = (bundles.join(mixed, "a").withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("a", "node", "root", "n", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
              .join(nodes.select("node", "regs"), "node"))

    def numbered(group: pa.Table) -> np.ndarray:
        number: dict[bytes, int] = {}
        return np.array([number.setdefault(r, len(number)) for r in group.column("root").to_pylist()])

    def sift(cell: pa.Table) -> pa.Table:
        n, own = (cell.column(c).to_numpy() for c in ("n", "own"))
        left = right = np.arange(len(n))
        if cell.column("i")[0].as_py() != cell.column("j")[0].as_py():
            left, right = np.flatnonzero(own == own.min()), np.flatnonzero(own != own.min())
        rows = doubtful(_matrix(cell.column("regs").combine_chunks()), n, numbered(cell), left, right, rule)
        return cell.select(["a", "i", "j", "node", "root"]).take(pa.array(rows))

    def compare(cell: pa.Table) -> pa.Table:
        links = exact_links([np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in cell.column("x")], numbered(cell), rule)
        node = cell.column("node").combine_chunks()
        return pa.table({k: node.take(pa.array([p[i] for p in links], pa.int64())) for i, k in enumerate("uv")})

    left_over = placed.groupBy("a", "i", "j").applyInArrow(sift, "a binary, i int, j int, node binary, root binary")
    return left_over.join(sets, "node").groupBy("a", "i", "j").applyInArrow(compare, "u binary, v binary")


def near_duplicates(docs: DataFrame, rule: Rule = Rule(3, 85)) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``."""
    sketched = written(sketch_table(docs, rule))
    rows = written(sketched.select("doc_id", "n", "node"))
    full = sketched.where(F.col("node").isNotNull())
    banded = full.groupBy("node").agg(F.first("bands").alias("bands")).select("node", F.explode("bands").alias("band"))
    # band and count alone go through the shuffle of all bands; pivots are looked for among the shared ones
    shared = banded.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    met = written(banded.join(shared, "band").select("band", "node", "size"))
    pivots = met.groupBy("band").agg(pivot(0, "node")).select("band", F.col("p.node").alias("a"))
    buckets = written(met.join(pivots, "band").select("band", "node", "size", "a"))
    forget(met)
    nodes = written(full.join(buckets.select("node").distinct(), "node", "left_semi").groupBy("node")
                         .agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("regs").alias("regs")))
    forget(sketched)
    steps = [buckets, nodes]                  # tables that go when the components are known
    sets = written(node_sets(docs, nodes.where(F.col("doc_id").isNotNull()).select("node", "doc_id"), rule))
    steps.append(sets)
    links = None
    members = buckets.select("node", F.col("node").alias("root"), "a", F.col("a").alias("pivot_root"),
                             (F.col("size") == 2).alias("only"))
    for turn in range(ROUNDS):
        pairs = (members.where("root != pivot_root").groupBy("a", F.col("node").alias("b"))
                 .agg(F.max("only").alias("only")))
        # of each node the likeliest pair, and the pairs that were the whole of a bucket
        likely = (sketch_test(pairs, nodes, rule).groupBy("b")
                  .agg(F.max(F.struct("likeness", "a")).alias("p"), F.collect_set(F.when(F.col("only"), F.col("a"))).alias("only"))
                  .select("b", F.explode(F.array_union(F.array("p.a"), "only")).alias("a")))
        found = written(verified(likely, sets, rule))
        steps += [members, found]
        links = found if links is None else links.unionByName(found)
        last = turn == ROUNDS - 1
        stars = components(links) if last else climbed(found)
        # buckets that still hold several components; those of two have had their pair judged
        labelled = (buckets.where("size > 2").select("band", "node")
                    .join(stars.withColumnsRenamed({"u": "node", "v": "root"}), "node", "left")
                    .withColumn("root", F.coalesce("root", "node")))
        mixed = (labelled.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), pivot(turn + 1))
                 .where("low != high").select("band", F.col("p.node").alias("a"), F.col("p.root").alias("pivot_root")))
        members = written(labelled.join(mixed, "band").select("node", "root", "a", "pivot_root", F.lit(False).alias("only")))
    stars = written(components(stars.unionByName(cross_links(members, nodes, sets, rule))))
    forget(members, *steps)
    owners = rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("low"))
    rooted = (owners.join(stars.withColumnsRenamed({"u": "node", "v": "root"}), "node", "left")
              .withColumn("root", F.coalesce("root", "node")))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("node", "component_id")
    return (rows.select("doc_id", "n", "node").join(named, "node", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))


def keep_one(docs: DataFrame, rule: Rule = Rule(5, 80)) -> DataFrame:
    """``docs`` without the documents whose component has a smaller doc_id.  Rows with
    null doc_id stay; of rows that repeat one doc_id all stay or go."""
    gone = near_duplicates(docs, rule).where(~F.col("kept") & F.col("doc_id").isNotNull())
    return docs.join(gone.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
