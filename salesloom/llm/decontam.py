"""Benchmark decontamination: a BM25 index of test items, block-max WAND, verification.

Test items are indexed in shards of at most ``SHARD`` items and ``SHARD_BYTES`` letters
of text, or one longer item (the driver reads and indexes them one shard at a time and
broadcasts the shard's index).  Document frequencies, the mean length and the longest
item are those of all items, so results do not depend on the shards.  Term weights are BM25 impacts divided by the item's own full score, so a
passage's score is the share of an item's weight that it holds and one threshold
suits all items.  Every document is cut into passages of twice the longest item's
words, overlapping by half, so any stretch as long as an item lies in one passage.

Every passage is a query.  Block-max WAND is done for a whole batch of passages at
once: a passage is dropped if its terms' largest impacts cannot reach the threshold
together; then blocks of ``BLOCK`` items are dropped by the terms' largest impacts
in the block; the blocks left are scored in full.  Passages are taken in slices of about
``EXPANDED`` postings, which bounds a task's memory.  No passage or item that reaches
the threshold is lost.  Each retrieved item is verified against the passage's words:
either ``VERIFY`` of its ``WORDS``-word shingles are there, or that share of the
question's shingles and of the answer's words.  The answer is an item's last line, or
its last sentence if it has one line (an item of one sentence is both).

Defined cases: null and empty texts have no passages; items without words are
never found; repeated items are found under each of their ids; repeated rows and
null ids of documents give rows of their own; without items nothing is found.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import checkpointed, chunks, map_chunks, texts_of

SHARD = 20_000
SHARD_BYTES = 64 << 20
BLOCK = 64
SLICE_BYTES = 1 << 20     # text cut into passages at once
EXPANDED = 1 << 18        # postings of some passages looked at at once
THRESHOLD = 0.5
VERIFY = 0.8
WORDS = 5
K1, B = 1.2, 0.75
WORD = re.compile(r"\w+")
SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[str, str]:
    lines = [x for x in text.strip().splitlines() if WORD.search(x)]
    parts = lines if len(lines) > 1 else [x for x in SENTENCE_END.split(text.strip()) if WORD.search(x)]
    return ("\n".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, text)


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    n = min(WORDS, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


def share(part: set, whole: set) -> float:
    return len(part & whole) / len(part) if part else 0.0


def expand(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, position) for every position of the ranges [starts, ends)."""
    n = ends - starts
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + starts[row]


def sums(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and the sums of their values."""
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    return key[first], (np.add.reduceat(value, first) if len(key) else value)


def slices(passage: np.ndarray, sizes: np.ndarray) -> Iterator[slice]:
    """Cuts rows, sorted by passage, between passages, so that the ranges of a slice have about
    ``EXPANDED`` positions, or are those of one passage."""
    if not len(passage):
        return
    first = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
    total = np.add.reduceat(sizes, first)
    part = (np.cumsum(total) - total) // EXPANDED
    cut = first[np.flatnonzero(np.r_[True, part[1:] != part[:-1]])]
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(passage)], strict=True):
        yield slice(a, b)


class Common:
    """What a shard's index takes from all items: their number, mean length, longest
    length, and in how many of them a word stands (asked for a shard's words at once)."""

    def __init__(self, items: DataFrame):
        def sizes():
            return lambda batch: {"size": [len(words_of(t)) for t in texts_of(batch, "text")]}

        def words():
            return lambda batch: {"word": [w for t in texts_of(batch, "text") for w in set(words_of(t))]}

        texts = items.select("text")
        size = map_chunks(texts, "text", "size bigint", sizes)
        self.n, self.mean, self.longest = size.agg(F.count("*"), F.avg("size"), F.max("size")).first()
        self.counted = checkpointed(map_chunks(texts, "text", "word string", words).groupBy("word").agg(F.count("*").alias("n")))

    def frequencies(self, words: list[str]) -> np.ndarray:
        asked = self.counted.sparkSession.createDataFrame(pa.table({"word": pa.array(words, pa.string())}))
        found = {r["word"]: r["n"] for r in self.counted.join(asked, "word", "left_semi").collect()}
        return np.array([found[w] for w in words], dtype=np.int64)


class Index:
    """BM25 impacts of one shard of items, with their maxima by term and block.  Without
    ``common`` the shard holds all items."""

    def __init__(self, items: list[tuple[object, str]], common: Common | None = None):
        self.ids = [i for i, _ in items]
        words = [words_of(t or "") for _, t in items]
        self.words = words
        parts = [question_and_answer(t or "") for _, t in items]
        self.question = [words_of(q) for q, _ in parts]
        self.answer = [words_of(a) for _, a in parts]
        self.longest = max([1, *map(len, words), common.longest if common else 0])
        bags = [Counter(w) for w in words]
        self.term: dict[str, int] = {}
        rows = [(self.term.setdefault(w, len(self.term)), i, n) for i, bag in enumerate(bags) for w, n in bag.items()]
        term, item, count = (np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)) if rows else [np.empty(0, np.int64)] * 3
        df = common.frequencies(list(self.term)) if common else np.bincount(term, minlength=len(self.term))
        n_items = common.n if common else len(items)
        size = np.array([len(w) for w in words], dtype=float)
        mean = common.mean if common else size.mean() if len(size) else 1.0
        norm = K1 * (1 - B + B * size / max(mean, 1.0))
        impact = np.log(1 + (n_items - df[term] + 0.5) / (df[term] + 0.5)) * count * (K1 + 1) / (count + norm[item])
        own = np.bincount(item, impact, minlength=len(items))
        order = np.lexsort((item, term))
        self.item, term = item[order], term[order]
        self.impact = (impact / own[item] if len(item) else impact)[order]
        entry = np.flatnonzero(np.r_[True, (np.diff(term) != 0) | (np.diff(self.item // BLOCK) != 0)]) \
            if len(term) else np.empty(0, np.int64)
        self.entry_start, self.entry_end = entry, np.r_[entry[1:], len(term)]
        self.entry_block = self.item[entry] // BLOCK
        self.entry_max = np.maximum.reduceat(self.impact, entry) if len(entry) else np.empty(0)
        n_terms = len(self.term)
        self.term_start = np.searchsorted(term[entry], np.arange(n_terms))
        self.term_end = np.searchsorted(term[entry], np.arange(n_terms), side="right")
        self.term_max = np.maximum.reduceat(self.impact, np.searchsorted(term, np.arange(n_terms))) if n_terms else np.empty(0)

    def passages(self, words: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(passage of each pair, term of each pair, document and first word of each
        passage): the distinct known terms of every passage."""
        get, step = self.term.get, self.longest
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        term = np.fromiter((get(x, -1) for w in words for x in w), dtype=np.int64, count=int(sizes.sum()))
        place = np.arange(len(term)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        spans = sizes // step + 1                       # passages of each document
        base = np.cumsum(spans) - spans
        known = term >= 0
        at = place[known] // step
        late = (np.repeat(base, sizes)[known] + at, term[known])
        early = tuple(x[at > 0] for x in (late[0] - 1, late[1]))
        n = max(1, len(self.term))
        key = np.unique(np.r_[late[0] * n + late[1], early[0] * n + early[1]])
        doc = np.repeat(np.arange(len(words)), spans)
        first = (np.arange(len(doc)) - np.repeat(base, spans)) * step
        return key // n, key % n, doc, first

    def retrieve(self, words: list[list[str]]) -> list[tuple[int, int, int, float]]:
        """(document, first word of the passage, item, score) of all that reach the threshold."""
        passage, term, doc, first = self.passages(words)
        least = THRESHOLD - 1e-9
        n = int(passage[-1]) + 1 if len(passage) else 0
        bound = np.bincount(passage, self.term_max[term], minlength=n)
        alive = bound[passage] >= least                 # by the terms' maxima
        passage, term = passage[alive], term[alive]
        n_blocks = len(self.ids) // BLOCK + 1
        out = []
        for some in slices(passage, self.term_end[term] - self.term_start[term]):
            row, entry = expand(self.term_start[term[some]], self.term_end[term[some]])
            own = passage[some][row]
            key = own * n_blocks + self.entry_block[entry]
            found, bound = sums(key, self.entry_max[entry])
            alive = np.isin(key, found[bound >= least])     # by the blocks' maxima
            own, entry = own[alive], entry[alive]
            for part in slices(own, self.entry_end[entry] - self.entry_start[entry]):
                each, at = expand(self.entry_start[entry[part]], self.entry_end[entry[part]])
                key, score = sums(own[part][each] * len(self.ids) + self.item[at], self.impact[at])
                ok = score >= least
                where, item = key[ok] // len(self.ids), key[ok] % len(self.ids)
                out += zip(doc[where].tolist(), first[where].tolist(), item.tolist(), score[ok].tolist(), strict=True)
        return out

    def verify(self, words: list[str], first: int, item: int) -> tuple[float, float, float] | None:
        """(overlap, question overlap, answer overlap) if the passage holds the item."""
        passage = words[first:first + 2 * self.longest]
        there = shingles(passage) | ({tuple(passage[i:i + n]) for n in {len(self.words[item]), len(self.question[item])}
                                      if n < WORDS for i in range(len(passage) - n + 1)})
        overlap = share(shingles(self.words[item]), there)
        question = share(shingles(self.question[item]), there)
        answer = share(set(self.answer[item]), set(passage))
        return (overlap, question, answer) if overlap >= VERIFY or min(question, answer) >= VERIFY else None

    def search(self, texts: list[str]) -> dict[tuple[int, int], tuple]:
        """Per (document, item) the best verified (first word, score, overlaps)."""
        words = [words_of(t) for t in texts]
        best: dict[tuple[int, int], tuple] = {}
        for doc, first, item, score in self.retrieve(words):
            checked = self.verify(words[doc], first, item)
            if checked:
                value = (checked[0], score, -first, checked[1], checked[2])
                best[(doc, item)] = max(best.get((doc, item), value), value)
        return best


def parts_of(items: DataFrame) -> Iterator[list[tuple[object, str]]]:
    held: list[tuple[object, str]] = []
    letters = 0
    for r in items.select("item_id", "text").toLocalIterator():
        size = len(r["text"] or "")
        if held and (len(held) >= SHARD or letters + size > SHARD_BYTES):
            yield held
            held, letters = [], 0
        held.append((r["item_id"], r["text"]))
        letters += size
    if held:
        yield held


def shards(items: DataFrame) -> Iterator[Index]:
    parts = parts_of(items)
    first = [p for p in (next(parts, None), next(parts, None)) if p]
    common = Common(items) if len(first) > 1 else None
    for part in chain(first, parts):
        yield Index(part, common)


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, score, overlap, question_overlap, answer_overlap):
    a row for every document and test item that it holds, with its best passage."""
    kinds = [dict(d.dtypes)[c] for d, c in ((docs, "doc_id"), (items, "item_id"))]
    schema = (f"doc_id {kinds[0]}, item_id {kinds[1]}, first_word bigint, score double, overlap double, "
              "question_overlap double, answer_overlap double")
    out = None
    for index in shards(items):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        item_type = pa.array(index.ids).type

        def run(batches: Iterator[pa.RecordBatch], shared=shared, item_type=item_type) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in chunks(batch, "text", SLICE_BYTES):
                    found = sorted(shared.value.search(texts_of(part, "text")).items())
                    if found:
                        values = [v for _, v in found]
                        yield pa.RecordBatch.from_arrays(
                            [part.column("doc_id").take(pa.array([k[0] for k, _ in found])),
                             pa.array([shared.value.ids[k[1]] for k, _ in found], item_type),
                             pa.array([-v[2] for v in values], pa.int64()),
                             *[pa.array([v[i] for v in values], pa.float64()) for i in (1, 0, 3, 4)]],
                            names=["doc_id", "item_id", "first_word", "score", "overlap", "question_overlap", "answer_overlap"])

        rows = docs.select("doc_id", "text").mapInArrow(run, schema)
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return docs.sparkSession.createDataFrame([], schema)
    return out


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that hold no test item; no shuffle."""
    for index in shards(items):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in chunks(batch, "text", SLICE_BYTES):
                    held = {doc for doc, _ in shared.value.search(texts_of(part, "text"))}
                    yield part.filter(pa.array([i not in held for i in range(part.num_rows)]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
