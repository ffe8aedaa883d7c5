"""Periodic runs of words, found by recompression.

The words of a slice of texts lie in one array of symbols, a separator of its own
after each text.  Recompression makes levels of it, by turns: block compression
replaces every maximal block of one symbol by a symbol for (symbol, length), pair
compression gives each symbol a side and replaces every left symbol that a right one
follows by a symbol for the pair.  Equal blocks and pairs get equal symbols, so the
levels are a run-length grammar of the texts, in which equal stretches are cut alike
except at their ends.  A longest-common-extension query compares two places level by
level upwards, at most two symbols on each, and comes down again where they first
differ; no suffix array is made.

Run candidates lie on a harmonic grid: a run with period q matches itself shifted by
q on a stretch of ``least(q) - q`` words or more, which holds a multiple of that number.
So sum(n / (3 q)) = O(n log n) places are compared, and grammar queries to both sides of
those where two neighbouring words agree give the exact run.  A run found with a
multiple of its period is the same stretch; the smallest period is kept.

``periodic_runs`` has one row per row of its table, repeated rows and ids included.
Null and empty texts have no words and no runs; a text of one word neither.  Runs are in
order of start, then period; ties do not arise, as no two runs share start and end.  A
very long text is a slice of its own: memory is about 100 bytes for each of its words.
Only the id and text columns are read, so further columns cannot clash.  An empty
table gives an empty result; ids may be null.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import map_chunks, mix64

SLICE_BYTES = 2 << 20     # text worked on at once inside a task
QUERIES = 1 << 19         # grid places compared at once
MIN_WORDS, MIN_TURNS = 6, 4    # a run has at least this many words, and this many periods
WORD_BREAK = r"[\x20\x09-\x0D]+"


class Grammar:
    """The levels of a sequence.  Negative symbols are separators: each occurs once, they
    stay as they are, and the sequence begins and ends with one."""

    def __init__(self, symbols: np.ndarray):
        self.symbols = [symbols]              # of each level
        self.up: list[np.ndarray] = []        # level h: place, one level up, of the symbol holding it
        self.down: list[np.ndarray] = []      # level h + 1: place, one level down, of its first symbol; then the end
        self.blocks: list[bool] = []          # whether level h + 1 has blocks of level h, or pairs
        name, seed = int(symbols.max(initial=0)) + 1, 0
        while True:
            now = self.symbols[-1]
            joined = (now[1:] == now[:-1])
            if joined.any():
                first = np.flatnonzero(np.r_[True, ~joined])
                size = np.diff(np.r_[first, len(now)])
                many = size > 1
                name = self._add(now, first, many, now[first[many]], size[many], name, blocks=True)
                now = self.symbols[-1]
            if not ((now[1:] >= 0) & (now[:-1] >= 0)).any():
                return
            seed += 1
            side = (mix64(now.view(np.uint64) + np.uint64(seed << 40)) & np.uint64(1)).astype(bool)
            plain = now >= 0
            left, right = side & plain, ~side & plain
            pairs, others = left[:-1] & right[1:], right[:-1] & left[1:]
            if others.sum() > pairs.sum():
                pairs = others
            at = np.flatnonzero(pairs)
            if len(at):
                keep = np.ones(len(now), dtype=bool)
                keep[at + 1] = False
                first = np.flatnonzero(keep)
                name = self._add(now, first, np.r_[pairs, False][first], now[at], now[at + 1], name, blocks=False)

    def _add(self, now: np.ndarray, first: np.ndarray, new: np.ndarray, a: np.ndarray, b: np.ndarray, name: int,
             blocks: bool) -> int:
        """One more level: symbols begin at ``first``; those marked ``new`` stand for (a, b)."""
        made = now[first]
        both = a * (int(b.max()) + 1) + b if int(a.max()) < (1 << 62) // (int(b.max()) + 1) else None
        if both is None:                      # keys beyond 64 bits: number the first parts anew
            both = pd.factorize(a)[0] * (int(b.max()) + 1) + b
        codes, rules = pd.factorize(both)
        made[new] = name + codes
        self.symbols.append(made)
        part = np.zeros(len(now), dtype=np.int32)
        part[first[1:]] = 1
        self.up.append(np.cumsum(part, dtype=np.int32))
        self.down.append(np.r_[first, len(now)].astype(np.int32))
        self.blocks.append(blocks)
        return name + len(rules)

    def mirrored(self) -> Grammar:
        """The same levels read backwards."""
        out = Grammar.__new__(Grammar)
        out.symbols = [s[::-1] for s in self.symbols]
        out.up = [np.int32(len(s) - 1) - u[::-1] for s, u in zip(self.symbols[1:], self.up, strict=True)]
        out.down = [np.int32(len(s)) - d[::-1] for s, d in zip(self.symbols, self.down, strict=False)]
        out.blocks = self.blocks
        return out

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For each pair of different places between the same two separators: the
        number of equal symbols from there on."""
        x, y = i.astype(np.int64), j.astype(np.int64)
        top = len(self.up)
        ended = np.full(len(x), top)          # the level on which the places were found to differ
        live = np.arange(len(x))
        for h in range(top):
            a, b, go, stepped = self._compare(h, x[live], y[live])
            x[live], y[live] = a, b
            ended[live[~go]] = h
            live = live[go]
            x[live], y[live] = self.up[h][stepped[0]] + 1, self.up[h][stepped[1]] + 1
            if not len(live):
                break
        order = np.argsort(-ended, kind="stable")
        upto = np.searchsorted(-ended[order], -np.arange(top + 1), side="right")
        for h in range(int(ended.max(initial=0)) - 1, -1, -1):
            down = order[:upto[h + 1]]        # those that differ on a level above h
            a, b = self.down[h][x[down]].astype(np.int64), self.down[h][y[down]].astype(np.int64)
            x[down], y[down] = self._compare(h, a, b)[:2]
        return x - i

    def _compare(self, h: int, a: np.ndarray, b: np.ndarray):
        """Moves both places of level ``h`` over what is equal, at most to the end of the
        symbols above; whether both got there; and for those that did, the last places
        that were equal."""
        symbols, up, down = self.symbols[h], self.up[h], self.down[h]
        same = symbols[a] == symbols[b]
        if self.blocks[h]:
            more_a, more_b = down[up[a] + 1] - a, down[up[b] + 1] - b
            go = same & (more_a == more_b)
            move = np.where(same, np.minimum(more_a, more_b), 0)
            return np.where(go, a, a + move), np.where(go, b, b + move), go, (a[go], b[go])
        last_a, last_b = down[up[a] + 1] == a + 1, down[up[b] + 1] == b + 1
        two = same & ~last_a & ~last_b        # both begin a pair
        second = np.zeros(len(a), dtype=bool)
        second[two] = symbols[a[two] + 1] == symbols[b[two] + 1]
        go = (same & last_a & last_b) | second
        move = (same & ~go).astype(np.int64)
        return a + move, b + move, go, (a[go], b[go])


def least(q: np.ndarray | int) -> np.ndarray:
    """The smallest length of a run with period ``q``."""
    return np.maximum(MIN_WORDS, MIN_TURNS * q)


def grid(n: int, longest: int):
    """(places, periods) of the harmonic grid over ``n`` symbols, some at a time, for
    periods of runs of at most ``longest`` words."""
    q = np.arange(1, longest // MIN_TURNS + 1, dtype=np.int64)
    q = q[least(q) <= longest]
    step = least(q) - q
    places = -(-np.maximum(n - q, 0) // step)
    ends = np.cumsum(places)
    a = 0
    while a < len(q):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + QUERIES, side="right")))
        sizes = places[a:b]
        nth = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        yield nth * np.repeat(step[a:b], sizes), np.repeat(q[a:b], sizes)
        a = b


def runs_of(symbols: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of a sequence like ``Grammar``'s, whose longest
    part between separators has ``longest`` symbols; by start, then period."""
    found = np.empty((0, 3), dtype=np.int64)
    forwards = backwards = None
    for t, q in grid(len(symbols), longest):
        inside = t + q < len(symbols)
        t, q = t[inside], q[inside]
        hit = np.flatnonzero(symbols[t] == symbols[t + q])
        t, q = t[hit], q[hit]                 # no separator, as these occur once: neighbours exist
        near = (symbols[t + 1] == symbols[t + q + 1]) | (symbols[t - 1] == symbols[t + q - 1])
        t, q = t[near], q[near]
        if not len(t):
            continue
        if forwards is None:
            forwards = Grammar(symbols)
            backwards = forwards.mirrored()
        end = t + q + forwards.extension(t, t + q)
        start = t - backwards.extension(len(symbols) - t, len(symbols) - t - q)
        ok = end - start >= least(q)
        found = np.concatenate([found, np.stack([start[ok], end[ok], q[ok]], axis=1)])
        found = found[np.lexsort(found.T[::-1])]
        new = np.r_[True, (found[1:, :2] != found[:-1, :2]).any(axis=1)] if len(found) else np.empty(0, dtype=bool)
        found = found[new]                    # of one stretch the smallest period stays
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    return found[:, 0], found[:, 1], found[:, 2]


def runs_of_texts(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs of the texts' words, in order."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(w) for w in texts], dtype=np.int64)
    first = np.cumsum(sizes + 1) - sizes      # of each text's words; a separator stands before
    symbols = np.empty(int(sizes.sum()) + len(texts) + 1, dtype=np.int64)
    symbols[np.r_[0, first + sizes]] = -1 - np.arange(len(texts) + 1)
    for at, words in zip(first.tolist(), texts, strict=True):
        symbols[at:at + len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    start, end, period = runs_of(symbols, int(sizes.max(initial=0)))
    text = np.searchsorted(first, start, side="right") - 1
    return text, start - first[text] if len(start) else start, end - start, period


def collapsed(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """The words joined by one space, without those that a run repeats."""
    if len(start):
        change = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, start + length, -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, runs array<struct<start, length, period>>, collapsed) of every row."""

    def start():
        def work(batch: pa.RecordBatch) -> dict:
            words = [(t or b"").split() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            owner, begin, length, period = runs_of_texts(words)
            cut = np.searchsorted(owner, np.arange(len(words) + 1))
            kept = [collapsed(w, begin[a:b], length[a:b], period[a:b])
                    for w, a, b in zip(words, cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
            found = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (begin, length, period)],
                                               ["start", "length", "period"])
            return {"doc_id": batch.column("doc_id"), "n_words": [len(w) for w in words],
                    "runs": pa.ListArray.from_arrays(pa.array(cut, pa.int32()), found),
                    "collapsed": pa.array(kept, pa.binary())}

        return work

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_chunks(rows, "text", f"doc_id {kind}, n_words bigint, "
                      "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string", start, SLICE_BYTES)


def looped(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the texts, but those whose id has a crc32 h divisible by ten (null id:
    crc32 of '') repeat from word g % n on, g = h // 10, their next 1 + (n - g % n) // (3 + g % 8) words."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", WORD_BREAK), lambda w: w != "")
    n = F.size("words")
    tail = F.transform(F.sequence(F.col("a"), n - 1), lambda i: F.get("words", F.col("a") + (i - F.col("a")) % F.col("p")))
    some = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words).alias("words"))
    some = some.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    some = some.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    return some.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(
        F.concat(F.slice("words", 1, F.col("a")), tail), " ")).otherwise(F.col("text")).alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of
    every row of ``docs``, whose texts are looped first."""
    runs = F.col("runs")

    def longer(best: Column, r: Column) -> Column:
        return F.when(best.isNull() | (r["length"] > best["length"]), r).otherwise(best)   # in order, so ties keep the first

    listed = F.array_join(F.transform(runs, lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    best = F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), longer)
    return (periodic_runs(looped(docs))
            .select("doc_id", F.size(runs).cast("bigint").alias("n_runs"), best.alias("best"),
                    F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
            .select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                    F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("bigint").alias("exponent_milli"),
                    "runs_sha256", "collapsed_sha256"))
