"""Repeated byte strings across a corpus, found on Burrows-Wheeler transforms.

A byte is repeated when a string of ``minimum`` bytes that covers it also starts
anywhere else.  Work is divided by anchors: in every stretch of ``minimum`` bytes
the ``GRAM``-byte string of lowest hash is the anchor, so equal stretches have equal
anchors at equal places.  A stretch can only be repeated if its anchor is; an
anchor's segment is the text of all stretches that have it as theirs.

1. Equal texts are folded (their copies repeat each other whole), and anchors that
   stand in one place only are dropped.
2. Occurrences of an anchor whose segments are equal repeat each other over the
   whole segment; equal segments are folded and take part once.
3. The differing segments of an anchor meet in one task.  Segments of several
   anchors are joined, with separators, to texts of about ``BUNDLE`` bytes, and
   ``repeat_runs`` finds the runs of suffixes with common prefixes of ``minimum``
   bytes: a breadth-first backward extension of intervals on the transform sets
   the bounds between suffixes by increasing common prefix and stops at
   ``minimum``; what no bound divides by then is repeated.
4. An anchor with more than ``HOT`` differing segments (a passage in very many
   texts, at its edges) is split: groups of ``STEP`` neighbouring stretches are
   counted by the bytes that all of the group hold and by the bytes that any holds;
   the first unique: no repeat; the second not unique: all repeated; else its
   stretches are counted one by one.  All of it combines before shuffling.

Equality of texts, segments and stretches is that of 64 to 128 bits of hashes; in
step 3 of the bytes.  Nothing is sampled or capped.

Defined cases: null text is empty; texts shorter than ``minimum`` bytes lose
nothing; a string that overlaps its own copy counts; repeated rows are copies of
each other; null and repeated doc_ids are allowed (texts are told apart by hash).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from salesloom.llm.common import forget, fresh, map_chunks, mix64, texts_of, written

MINIMUM = 400
GRAM = 128
BUNDLE = 1 << 18
HOT = 256
STEP = 32
SLICE = 1 << 23
ANCHOR = ["place", "gram", "segment", "lo", "hi"]
FACTOR = 0x9E3779B97F4A7C15           # odd, so it has an inverse modulo 2**64
BYTE = mix64(np.arange(1, 257, dtype=np.uint64))


class Rolling:
    """Hashes of any substrings of ``data`` by differences of prefix sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power = np.full(n, FACTOR, dtype=np.uint64)
        back = np.full(n + 1, pow(FACTOR, -1, 1 << 64), dtype=np.uint64)
        if n:
            power[0] = 1
        back[0] = 1
        np.multiply.accumulate(power, out=power)
        self.back = np.multiply.accumulate(back)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(BYTE[data] * power)])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.back[start])


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(x)
    pad = np.concatenate([x, np.full(-n % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(pad, axis=1).ravel()
    behind = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def anchors(data: np.ndarray, minimum: int) -> list[np.ndarray]:
    """Of the text's anchors: place, hash, hash of the segment, first and last start of
    the stretches that have it."""
    n, width = len(data), minimum - GRAM + 1
    if n < minimum:
        return [np.empty(0, np.int64)] * 5
    rolling = Rolling(data)
    start = np.arange(n - GRAM + 1)
    grams = rolling.hash(start, start + GRAM)
    low = np.uint64(0xFFFFFF)
    of_stretch = np.empty(n - minimum + 1, dtype=np.int64)
    for a in range(0, len(of_stretch), SLICE):            # places within a slice fit 24 bits
        part = grams[a:a + SLICE + width - 1]
        place = np.arange(len(part), dtype=np.uint64)
        lowest = sliding_minimum((part & ~low) | (low - place), width)   # of equal ones the last
        of_stretch[a:a + len(lowest)] = (low - (lowest & low)).astype(np.int64) + a
    lo = np.flatnonzero(np.r_[True, of_stretch[1:] != of_stretch[:-1]])
    hi, at = np.r_[lo[1:], len(of_stretch)] - 1, of_stretch[lo]
    shape = ((at - lo) << 32) + (hi - lo)
    segment = mix64(rolling.hash(lo, hi + minimum) + mix64(shape))
    return [at, grams[at].view(np.int64), segment.view(np.int64), lo, hi]


def suffix_array(s: np.ndarray) -> np.ndarray:
    """By prefix doubling; ``s`` holds unique separators, so all suffixes differ."""
    n = len(s)
    bits = int(s.max()).bit_length()
    k = max(1, 62 // bits)                               # symbols that fit one number
    rank = np.zeros(n, dtype=np.int64)
    for i in range(k):
        rank <<= bits
        rank[:n - i] |= s[i:]
    rank = np.unique(rank, return_inverse=True)[1]
    while True:
        key = rank * (int(rank.max()) + 2)
        key[:n - k] += rank[k:] + 1
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.r_[False, key[order[1:]] != key[order[:-1]]])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        if new[-1] == n - 1 or k >= n:
            return order
        k *= 2


def repeat_runs(segments: list[bytes], minimum: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix places in sorted order, first of each run): suffixes of one run share
    their first ``minimum`` bytes.  Places count through the segments, each followed by
    one separator."""
    count = len(segments)
    sizes = np.array([len(x) + 1 for x in segments])
    s = np.empty(int(sizes.sum()), dtype=np.int64)
    ends = np.cumsum(sizes) - 1
    inner = np.ones(len(s), dtype=bool)
    inner[ends] = False
    s[inner] = np.frombuffer(b"".join(segments), dtype=np.uint8).astype(np.int64) + count
    s[ends] = np.arange(count)
    n = len(s)
    order = suffix_array(s)
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    before = order - 1                                   # of the first place: the last
    transform = s[before]
    back = place[before]                                 # where the suffix one longer stands
    usable = transform >= count                          # separators are not extended over
    by_symbol = np.argsort(transform, kind="stable")
    same = transform[by_symbol[1:]] == transform[by_symbol[:-1]]
    following, previous = np.full(n, n), np.full(n, -1)
    following[by_symbol[:-1][same]] = by_symbol[1:][same]
    previous[by_symbol[1:][same]] = by_symbol[:-1][same]
    bound = np.zeros(n + 1, dtype=bool)
    bound[:count + 1] = True                             # suffixes that start with a separator
    bound[n] = True
    lo, hi = np.array([0]), np.array([n])
    for shared in range(minimum):                        # the common prefix found in this step
        size = hi - lo
        owner = np.repeat(np.arange(len(lo)), size)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + lo[owner]
        ok = usable[at]
        owner, at = owner[ok], at[ok]
        first = previous[at] < lo[owner]                 # of its symbol in its interval
        last = following[at] >= hi[owner]
        a = np.lexsort((transform[at[first]], owner[first]))
        b = np.lexsort((transform[at[last]], owner[last]))
        lo, hi = back[at[first]][a], back[at[last]][b] + 1
        new = ~bound[hi]
        lo, hi = lo[new], hi[new]
        if shared and not len(hi):
            break
        bound[hi] = True
        if not shared:                                   # suffixes of separators are extended, too
            lo, hi = np.r_[np.arange(count), lo], np.r_[np.arange(count) + 1, hi]
    return order, np.flatnonzero(bound[:n])


def ranges_of(starts: np.ndarray) -> list[tuple[int, int]]:
    """Sorted distinct numbers as closed ranges."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.r_[0, cut + 1]].tolist(), starts[np.r_[cut, len(starts) - 1]].tolist(), strict=True))


def repeated_starts(segments: list[tuple[bytes, int, bytes]], minimum: int) -> list[tuple[bytes, int, int]]:
    """(text, first, last): starts of repeated strings.  ``segments``: (text, place of the
    segment in it, bytes); the same place of a text may stand in several segments."""
    order, first = repeat_runs([x for _, _, x in segments], minimum)
    names: dict[bytes, int] = {}
    text = np.array([names.setdefault(t, len(names)) for t, _, _ in segments])
    sizes = np.array([len(x) + 1 for _, _, x in segments])
    shift = np.array([p for _, p, _ in segments]) - (np.cumsum(sizes) - sizes)
    owner = np.repeat(np.arange(len(segments)), sizes)[order]
    where = (text[owner] << 44) + order + shift[owner]   # text and place in it
    runs = np.diff(np.r_[first, len(order)])
    many = np.minimum.reduceat(where, first) != np.maximum.reduceat(where, first)
    found = np.unique(where[np.repeat(many, runs)])
    keys = list(names)
    return [(keys[a >> 44], a & ((1 << 44) - 1), b & ((1 << 44) - 1)) for a, b in ranges_of(found)]


def text_table(docs: DataFrame, minimum: int) -> DataFrame:
    """(doc_id, n_bytes, key, sha, and the arrays of ``anchors``) per row; key is 128 bits
    of hash of the text."""

    def start():
        def work(batch: pa.RecordBatch) -> dict:
            import xxhash

            raw = [t.encode() for t in texts_of(batch, "text")]
            found = [anchors(np.frombuffer(r, dtype=np.uint8), minimum) for r in raw]
            arrays = {k: [f[i] for f in found] for i, k in enumerate(ANCHOR)}
            return {"doc_id": batch.column("doc_id"), "n_bytes": [len(r) for r in raw],
                    "key": [xxhash.xxh3_128_digest(r) for r in raw], "sha": [hashlib.sha256(r).hexdigest() for r in raw], **arrays}

        return work

    kind = dict(docs.dtypes)["doc_id"]
    return map_chunks(docs.select("doc_id", "text"), "text",
                      f"doc_id {kind}, n_bytes bigint, key binary, sha string, "
                      + ", ".join(f"{k} array<bigint>" for k in ANCHOR), start)


def fetched(docs: DataFrame, owners: DataFrame) -> DataFrame:
    """``owners`` (key, owner, ...) with the ``text`` of each key, read from its owner."""
    text = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    kind = dict(docs.dtypes)["doc_id"]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            keys = [xxhash.xxh3_128_digest(t.encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=["owned", "text", "of"])

    text = text.mapInArrow(keyed, f"owned {kind}, text string, of binary")
    return (owners.join(text, (F.col("key") == F.col("of")) & F.col("owner").eqNullSafe(F.col("owned")))
            .drop("owner", "owned", "of"))


def segment_rows(docs: DataFrame, needed: DataFrame, minimum: int) -> DataFrame:
    """(gram, key, place, at, hot, bytes): the segments of ``needed`` (key, owner, each:
    array of (gram, place, lo, hi, hot)); ``at`` is the segment's start in its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            done: set[bytes] = set()
            for key, text, each in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "each")), strict=True):
                raw = text.encode()
                if key in done or xxhash.xxh3_128_digest(raw) != key:      # a row that repeats a doc_id
                    continue
                done.add(key)
                lo, hi = ([e[k] for e in each] for k in ("lo", "hi"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([e["gram"] for e in each], pa.int64()), pa.array([key] * len(each), pa.binary()),
                     pa.array([e["place"] for e in each], pa.int64()), pa.array(lo, pa.int64()),
                     pa.array([e["hot"] for e in each], pa.bool_()),
                     pa.array([raw[a:b + minimum] for a, b in zip(lo, hi, strict=True)], pa.binary())],
                    names=["gram", "key", "place", "at", "hot", "bytes"])

    return fetched(docs, needed).mapInArrow(
        run, "gram bigint, key binary, place bigint, at bigint, hot boolean, bytes binary")


def differing(rows: DataFrame, minimum: int) -> DataFrame:
    """(key, lo, hi) of repeats among the differing segments of each anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, int, bytes]] = []
        size, gram = 0, None

        def found() -> pa.RecordBatch:
            out = repeated_starts(held, minimum)
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in
                                               enumerate((pa.binary(), pa.int64(), pa.int64()))], names=["key", "lo", "hi"])

        for batch in batches:
            for g, key, at, raw in zip(*(batch.column(c).to_pylist() for c in ("gram", "key", "at", "bytes")), strict=True):
                if g != gram and size >= BUNDLE:
                    yield found()
                    held, size = [], 0
                gram = g
                held.append((key, at, raw))
                size += len(raw) + 1
        if held:
            yield found()

    return (rows.where(~F.col("hot")).select("gram", "key", "at", "bytes").repartition("gram")
            .sortWithinPartitions("gram").mapInArrow(run, "key binary, lo bigint, hi bigint"))


def stretch_hashes(rows: DataFrame, minimum: int, single: bool) -> DataFrame:
    """Of segments (key, place, at, bytes): for every group of STEP stretches (key, lo, hi,
    here, core, whole), ``here`` being where the core stands; or with ``single`` the
    stretches low..high one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = zip(*(batch.column(c).to_pylist() for c in ("low", "high")), strict=True) if single else None
            for key, place, at, raw in zip(*(batch.column(c).to_pylist() for c in ("key", "place", "at", "bytes")), strict=True):
                rolling = Rolling(np.frombuffer(raw, dtype=np.uint8))
                last = len(raw) - minimum                       # stretches 0..last
                if single:
                    low, high = next(wanted)
                    lo = hi = np.arange(low - at, high - at + 1)
                else:
                    # groups lie on multiples of STEP bytes before the anchor
                    group = np.arange((place - at - last) // STEP, (place - at) // STEP + 1)
                    lo, hi = place - at - group * STEP - STEP + 1, place - at - group * STEP
                # what all stretches of the group hold, as if the text's ends did not cut the group
                core, here = rolling.hash(hi, lo + minimum), hi + at
                lo, hi = np.clip(lo, 0, None), np.clip(hi, None, last)
                whole = rolling.hash(lo, hi + minimum)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(lo), pa.binary()), pa.array(lo + at), pa.array(hi + at),
                     pa.array(here), pa.array(core.view(np.int64)), pa.array(whole.view(np.int64))], names=["key", "lo", "hi", "here", "core", "whole"])

    return rows.mapInArrow(run, "key binary, lo bigint, hi bigint, here bigint, core bigint, whole bigint")


def _twice(rows: DataFrame, name: str) -> DataFrame:
    """The values of ``name`` that stand in two different places."""
    place = F.struct("key", "here")
    return (rows.groupBy(name).agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a != b").select(name))


def hot_repeats(rows: DataFrame, minimum: int) -> tuple[DataFrame, list[DataFrame]]:
    """(key, lo, hi) of repeats of anchors with very many differing segments, and the
    tables that it is made from."""
    segments = rows.where("hot").select("key", "place", "at", "bytes")
    groups = written(stretch_hashes(segments, minimum, False))
    shared = groups.join(_twice(groups, "core"), "core", "left_semi")
    shared = written(shared.join(_twice(shared, "whole").withColumn("same", F.lit(True)), "whole", "left"))
    open_ = shared.where("same is null").select("key", F.col("lo").alias("low"), F.col("hi").alias("high")).distinct()
    ranged = segments.join(open_, "key").where("low >= at and high + {} <= at + length(bytes)".format(minimum))
    each = written(stretch_hashes(ranged.dropDuplicates(["key", "low", "high"]), minimum, True).drop("core"))
    # a stretch may equal one inside a group that was settled as a whole: those count as well
    settled = segments.join(shared.where("same").select("key", F.col("lo").alias("low"), F.col("hi").alias("high"), "whole")
                            .groupBy("whole").agg(F.min(F.struct("key", "low", "high")).alias("one"))
                            .select("one.*"), "key").where("low >= at and high + {} <= at + length(bytes)".format(minimum))
    partners = stretch_hashes(settled.dropDuplicates(["key", "low", "high"]), minimum, True).drop("core")
    every = each.unionByName(partners)
    return (shared.where("same").select("key", "lo", "hi").unionByName(
        each.join(_twice(every, "whole"), "whole", "left_semi").select("key", "lo", "hi")), [groups, shared, each])


def repeats(docs: DataFrame, minimum: int = MINIMUM) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): rows (doc_id, n_bytes, key, sha) of ``docs``; spans (key, owner,
    ranges) of the texts with repeats, ranges being pairs (lo, hi) of first bytes."""
    table = written(text_table(docs, minimum))
    rows = written(table.select("doc_id", "n_bytes", "key", "sha"))
    texts = rows.groupBy("key").agg(F.min("doc_id").alias("owner"), F.count("*").alias("copies"), F.first("n_bytes").alias("n_bytes"))
    once = table.where("n_bytes >= {}".format(minimum)).groupBy("key").agg(F.first(F.struct(*ANCHOR)).alias("a"))
    places = once.select("key", F.inline(F.arrays_zip(*[F.col(f"a.{k}").alias(k) for k in ANCHOR])))
    shared = (places.groupBy("gram").agg(F.count("*").alias("n"), F.min("segment").alias("a"), F.max("segment").alias("b"))
              .where("n > 1").select("gram", (F.col("a") == F.col("b")).alias("same")))
    found = placed = written(places.join(shared, "gram"))
    forget(table)
    # classes of equal segments of the anchors that have several
    classes = (found.where(~F.col("same")).groupBy("gram", "segment")
               .agg(F.count("*").alias("n"), F.min(F.struct("key", "place", "lo", "hi")).alias("one")))
    sized = classes.groupBy("gram").agg(F.count("*").alias("differing"), F.min("n").alias("least")).where("least = 1")
    classes = written(classes.join(sized, "gram", "left"))
    found = found.join(classes.where("n > 1").select("gram", "segment", F.lit(True).alias("equal")), ["gram", "segment"], "left")
    whole = found.where(F.col("same") | F.col("equal")).select("key", "lo", "hi")
    one = classes.where(F.col("differing").isNotNull()).select(
        "one.key", F.struct("gram", "one.place", "one.lo", "one.hi", (F.col("differing") > HOT).alias("hot")).alias("e"))
    needed = one.groupBy("key").agg(F.collect_list("e").alias("each")).join(texts.select("key", "owner"), "key")
    segments = written(segment_rows(docs, needed, minimum))
    copies = texts.where(f"copies > 1 and n_bytes >= {minimum}").select("key", F.lit(0).cast("bigint").alias("lo"),
                                                                        (F.col("n_bytes") - minimum).alias("hi"))
    hot, steps = hot_repeats(segments, minimum)
    ranges = whole.unionByName(differing(segments, minimum)).unionByName(hot).unionByName(copies)
    spans = written(ranges.groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
                    .join(texts.select("key", "owner", "copies"), "key"))
    forget(placed, classes, segments, *steps)
    return rows, spans


def merged(ranges: list, minimum: int) -> list[tuple[int, int]]:
    """Half-open byte spans that the ranges of starts cover, apart from each other."""
    out: list[list[int]] = []
    for lo, hi in sorted((r["lo"], r["hi"]) for r in ranges):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi + minimum)
        else:
            out.append([lo, hi + minimum])
    return [tuple(x) for x in out]


def cut(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    ends = [0, *[b for _, b in spans]]
    starts = [*[a for a, _ in spans], len(raw)]
    return b"".join([raw[a:b] for a, b in zip(ends, starts, strict=True)])


def removal_digests(docs: DataFrame, minimum: int = MINIMUM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, repeated) of every row of ``docs``;
    ``repeated`` says whether anything was removed."""
    rows, spans = repeats(docs, minimum)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            out: dict[bytes, tuple] = {}
            for key, text, ranges in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "ranges")), strict=True):
                raw = text.encode()
                if xxhash.xxh3_128_digest(raw) == key:
                    gone = merged(ranges, minimum)
                    out[key] = (key, sum(b - a for a, b in gone), len(gone), hashlib.sha256(cut(raw, gone)).hexdigest())
            columns = list(zip(*out.values(), strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                columns, (pa.binary(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["key", "r", "s", "k"])

    partly = (fetched(docs, spans.where("copies = 1").select("key", "owner", "ranges"))
              .mapInArrow(run, "key binary, r bigint, s bigint, k string").dropDuplicates(["key"]))
    done = partly.unionByName(spans.where("copies > 1").join(rows.groupBy("key").agg(F.first("n_bytes").alias("r")), "key")
                              .select("key", "r", F.lit(1).cast("bigint").alias("s"), F.sha2(F.lit(b""), 256).alias("k")))
    return rows.join(done, "key", "left").select(
        "doc_id", "n_bytes", F.coalesce("r", F.lit(0)).alias("n_removed"), F.coalesce("s", F.lit(0)).alias("n_spans"),
        F.coalesce("k", "sha").alias("kept_sha256"), (F.coalesce("r", F.lit(0)) > 0).alias("repeated"))


def without_repeats(docs: DataFrame, minimum: int) -> DataFrame:
    """``docs`` (all columns) with every repeated string of ``minimum`` bytes cut out of
    ``text`` (bytes of a cut code point go with the cut) and ``n_chars`` brought up to
    date.  Texts without repeats stay as they are."""
    _, spans = repeats(docs, minimum)
    schema = docs.schema
    key_name, ranges_name = fresh(docs, "key"), fresh(docs, "ranges")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            keys = [xxhash.xxh3_128_digest(t.encode()) for t in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())],
                                             names=[*batch.schema.names, key_name])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, ranges in enumerate(batch.column(ranges_name).to_pylist()):
                if ranges:
                    texts[i] = cut(texts[i].encode(), merged(ranges, minimum)).decode("utf-8", errors="ignore")
            columns = {c: batch.column(c) for c in schema.names}
            columns["text"] = pa.array(texts, pa.string())
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([None if t is None else len(t) for t in texts], columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    with_key = StructType([*schema.fields, StructField(key_name, BinaryType())])
    joined = docs.mapInArrow(keyed, with_key).join(
        spans.select(F.col("key").alias(key_name), F.col("ranges").alias(ranges_name)), key_name, "left")
    return joined.select(*schema.names, ranges_name).mapInArrow(run, schema)
