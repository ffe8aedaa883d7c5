"""Toxicity: Levenshtein automata intersected with a lexicon trie, scored in context.

The lexicon (terms, and stems that many toxic words share) is learned from a
bounded sample of labelled texts: entries whose document frequency is far higher
among toxic texts.  It is put in a trie.  A word is run through the product of the
trie with Levenshtein automata: the states are sets of (trie node, edits so far),
determinised lazily and kept, so a known prefix costs one table look-up a letter
and most words die after a few letters.  Allowed edits are insertion, deletion,
substitution and swap of neighbours: 0 for entries under 5 letters, 1 from 5, 2
from 9.  Digits and signs used for letters are folded first.  Misspelled variants
that clean labelled texts use are exceptions, not hits.

A hit's weight is scaled by its window of ``WINDOW`` words on either side: quoted
or reported mentions count less, address of a person more.  A logistic fit over
the sums of weights gives the score.

At most ``MAX_TRAIN`` labelled rows (the smallest hashes of doc_id) and
``MAX_TERMS`` entries are used; every word of these rows' clean texts is tested as
an exception.  Defined cases: null and empty texts have no hits
and get the score of that; without both classes among the training labels the
score is the smoothed share of toxic ones for every text; repeated rows and null
ids are scored like any other.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import checkpointed, fold_of, map_chunks, texts_of
from salesloom.llm.trees import fit_logistic

MAX_TRAIN = 20_000
MAX_TERMS = 5_000
MIN_TOXIC = 4            # labelled toxic texts that an entry must stand in
MIN_LOG_ODDS = 2.5
STEM = (4, 8)            # letters of a stem
WINDOW = 6
STATES = 200_000         # determinised states kept at once
FOLD = str.maketrans("013457@$", "oieastas")
WORD = re.compile(r"[^\W_]+(?:[@$'’*][^\W_]+)*|[\"“”«»„]")
# Fixed word lists (English, French, German, Spanish).
QUOTE_MARKS = frozenset("\"“”«»„")
REPORTS = frozenset("""said says quoted quote quotes called word words term reported wrote writes
dit cité mot terme appelé sagte schrieb wort begriff zitat genannt dijo citó palabra término llamado""".split())
PERSONS = frozenset("""you your youre yourself u ur tu toi vous te ton ta du dich dir dein deine ihr euch
usted ustedes eres tú ti""".split())


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def folded(word: str) -> str:
    """Letters for the digits and signs that stand for them (plain numbers stay)."""
    return word.translate(FOLD) if not word.isalpha() and any(c.isalpha() for c in word) else word


def edits_allowed(length: int) -> int:
    return 0 if length < 5 else 1 if length < 9 else 2


class Lexicon:
    """Trie of entries {text: (weight, is_stem)} with the lazily built automaton."""

    def __init__(self, entries: dict[str, tuple[float, bool]], exceptions: frozenset[str] = frozenset()):
        self.entries, self.exceptions = entries, exceptions
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[tuple[float, bool, int] | None] = [None]   # weight, stem, length
        self.most = [0]                                            # edits of the longest entry below
        for text, (weight, stem) in sorted(entries.items()):
            node, allowed = 0, 0 if stem else edits_allowed(len(text))
            self.most[0] = max(self.most[0], allowed)
            for c in text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], allowed)
            self.ends[node] = (weight, stem, len(text))
        self.reset()

    def reset(self) -> None:
        self.sets: list[tuple] = []
        self.moves: list[dict[str, int]] = []
        self.found: list[tuple[float, float]] = []                 # best (weight, similarity) on ending here
        self.stem: list[float] = []                                # best stem weight on passing here
        self.number: dict[tuple, int] = {}
        self.start = self.state(self.close({(0, 0, ""): None}))

    def close(self, items: dict) -> tuple:
        """Adds the letters of the trie that the word left out.  An item is (node,
        edits, letter owed by a swap); of one node and letter the fewest edits stay."""
        best: dict[tuple[int, str], int] = {}
        todo = [(n, e, s) for n, e, s in items]
        while todo:
            node, edits, owed = todo.pop()
            if best.get((node, owed), 9) <= edits:
                continue
            best[(node, owed)] = edits
            if not owed:
                todo += [(child, edits + 1, "") for child in self.children[node].values() if edits < self.most[child]]
        return tuple(sorted((n, e, s) for (n, s), e in best.items()))

    def state(self, items: tuple) -> int:
        if items in self.number:
            return self.number[items]
        self.number[items] = len(self.sets)
        self.sets.append(items)
        self.moves.append({})
        best, stem = (0.0, 0.0), 0.0
        for node, edits, owed in items:
            end = self.ends[node]
            if owed or end is None:
                continue
            if end[1]:
                stem = max(stem, end[0] if edits == 0 else 0.0)
            elif edits <= edits_allowed(end[2]):
                best = max(best, (end[0] * (1.0 - 0.15 * edits), 1.0 - 0.15 * edits))
        self.found.append(best)
        self.stem.append(stem)
        return self.number[items]

    def move(self, at: int, letter: str) -> int:
        items: dict[tuple[int, int, str], None] = {}
        for node, edits, owed in self.sets[at]:
            children = self.children[node]
            if owed:                                              # second letter of a swap
                if letter == owed[0]:
                    items[(int(owed[1:]), edits, "")] = None
                continue
            if letter in children:
                items[(children[letter], edits, "")] = None
            if edits < self.most[node]:
                items[(node, edits + 1, "")] = None               # a letter too many
                for c, child in children.items():
                    if edits < self.most[child] and c != letter:
                        items[(child, edits + 1, "")] = None      # another letter
                        if letter in self.children[child]:        # swapped with the next
                            items[(child, edits + 1, c + str(self.children[child][letter]))] = None
        new = self.state(self.close(items)) if items else -1
        self.moves[at][letter] = new
        return new

    def hit(self, word: str) -> tuple[float, float]:
        """(weight, similarity) of the best entry that ``word`` matches, else (0, 0)."""
        if len(self.sets) > STATES:
            self.reset()
        exact = self.entries.get(word)
        if exact:
            return exact[0], 1.0
        at, stem = self.start, 0.0
        for i, letter in enumerate(word):
            new = self.moves[at].get(letter)
            at = self.move(at, letter) if new is None else new
            if at < 0:
                break
            stem = max(stem, self.stem[at])
            if i > 60:
                at = -1
                break
        if stem:
            return stem, 1.0
        best = self.found[at] if at >= 0 else (0.0, 0.0)
        return best if best[0] and word not in self.exceptions else (0.0, 0.0)


FEATURES = ["mass", "density", "quoted", "fuzzy"]


def features_of(text: str, lexicon: Lexicon, seen: dict[str, tuple[float, float]]) -> list[float]:
    """Weights of hits: in context, in context per hundred words, of mentions, of
    misspelled ones (the first and last two as logarithms)."""
    words = words_of(text)
    hits = []
    for i, w in enumerate(words):
        known = seen.get(w)
        if known is None:
            if len(seen) > 500_000:
                seen.clear()
            known = seen[w] = lexicon.hit(folded(w))
        if known[0]:
            hits.append((i, *known))
    mass = quoted = fuzzy = 0.0
    for i, weight, similarity in hits:
        before, after = words[max(0, i - WINDOW):i], words[i + 1:i + 1 + WINDOW]
        mention = (QUOTE_MARKS.intersection(before) and QUOTE_MARKS.intersection(after)) \
            or REPORTS.intersection(before) or REPORTS.intersection(after)
        scale = 0.25 if mention else 1.5 if PERSONS.intersection(before + after) else 1.0
        mass += weight * scale
        quoted += weight * (1.0 if mention else 0.0)
        fuzzy += weight * (similarity < 1.0)
    return [math.log1p(mass), min(3.0, 100.0 * mass / (len(words) + 50)), math.log1p(quoted), math.log1p(fuzzy)]


def clean_variants(counted: DataFrame, entries: dict[str, tuple[float, bool]]) -> frozenset[str]:
    """Of the words that clean texts use, those that match an entry with edits: all are
    tested, in tasks, and only the matches are collected."""

    def start():
        draft = Lexicon(entries)

        def work(batch: pa.RecordBatch) -> dict:
            return {"word": [w for w in texts_of(batch, "word")
                             if w not in entries and draft.hit(w)[1] not in (0.0, 1.0)]}

        return work

    # edits are for entries of 5 letters or more, so a match has 4 or more
    used = counted.where(~F.col("stem") & (F.col("k") < F.col("n")) & (F.length("word") >= 4)).select("word")
    return frozenset(r["word"] for r in map_chunks(used, "word", "word string", start).collect())


def learn_entries(sample: DataFrame) -> tuple[dict[str, tuple[float, bool]], frozenset[str]]:
    """Entries and exceptions, from (y, text) rows.  Words and stems are counted by
    Spark, once per text."""

    def start():
        def work(batch: pa.RecordBatch) -> dict:
            out = []
            for y, text in zip(batch.column("y").to_pylist(), texts_of(batch, "text"), strict=True):
                words = {folded(w) for w in words_of(text) if len(w) >= 3 and w[0].isalpha()}
                stems = {w[:n] for w in words for n in range(STEM[0], min(STEM[1], len(w) - 1) + 1)}
                out += [(w, False, y) for w in words] + [(s, True, y) for s in stems]
            columns = list(zip(*out, strict=True)) if out else [[], [], []]
            return dict(zip(("word", "stem", "y"), columns, strict=True))

        return work

    rows = map_chunks(sample, "text", "word string, stem boolean, y int", start)
    totals = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    counted = checkpointed(rows.groupBy("word", "stem").agg(F.sum("y").cast("int").alias("k"),
                                                            F.count("*").cast("int").alias("n")))
    odds = (F.log((F.col("k") + 0.5) / (toxic + 1)) - F.log((F.col("n") - F.col("k") + 0.5) / (clean + 1)))
    strong = (counted.where(F.col("k") >= MIN_TOXIC).withColumn("odds", odds).where(F.col("odds") >= MIN_LOG_ODDS)
              .orderBy(F.desc("odds"), "stem", "word").limit(MAX_TERMS).collect())
    words = {r["word"]: float(r["odds"]) for r in strong if not r["stem"]}
    # a stem adds something if few of its texts are clean and it is more than one word's start
    stems = {r["word"]: float(r["odds"]) for r in strong
             if r["stem"] and r["k"] >= 4 * MIN_TOXIC and r["n"] - r["k"] <= 0.01 * r["k"]
             and sum(w.startswith(r["word"]) for w in words) >= 3}
    entries = {w: (o, False) for w, o in words.items()} | {s: (o, True) for s, o in stems.items()}
    return entries, clean_variants(counted, entries)


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0):
    """(lexicon, intercept, weights) from labels outside ``held_fold``."""
    known = (labels.where(F.col("toxic").isNotNull() & (fold_of(F.col("doc_id"), folds) != held_fold))
             .select("doc_id", F.col("toxic").cast("int").alias("y"))
             .orderBy(F.xxhash64(F.col("doc_id")), "doc_id", "y").limit(MAX_TRAIN))
    sample = checkpointed(docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
                          .join(F.broadcast(known), "doc_id").select("y", "text"))
    lexicon = learn_entries(sample)
    rows = _features(sample, lexicon, "y int").collect()         # MAX_TRAIN rows of five numbers
    rows.sort(key=tuple)
    y = np.array([r["y"] for r in rows], dtype=float)
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return lexicon, float(np.log(share / (1 - share))), np.zeros(len(FEATURES))
    x = np.array([[r[f] for f in FEATURES] for r in rows])
    return (lexicon, *fit_logistic(x, y, l2=1e-4, steps=3000))


def _features(docs: DataFrame, lexicon: tuple, carry: str) -> DataFrame:
    """The column named in ``carry`` with the features of ``text``."""
    name = carry.split()[0]

    def start():
        matcher, seen = Lexicon(*lexicon), {}

        def work(batch: pa.RecordBatch) -> dict:
            rows = [features_of(t, matcher, seen) for t in texts_of(batch, "text")]
            return {name: batch.column(name)} | {f: [r[i] for r in rows] for i, f in enumerate(FEATURES)}

        return work

    return map_chunks(docs.select(name, "text"), "text",
                      ", ".join([carry, *[f"{f} double" for f in FEATURES]]), start)


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted, and the features) of every row of ``docs``."""
    lexicon, intercept, weights = train(docs, labels, folds, held_fold)
    rows = _features(docs.select("doc_id", "text"), lexicon, f"doc_id {dict(docs.dtypes)['doc_id']}")
    total = F.lit(float(intercept))
    for f, w in zip(FEATURES, weights, strict=True):
        total = total + F.col(f) * F.lit(float(w))
    return (rows.withColumn("score", 1 / (1 + F.exp(-total)))
            .select("doc_id", (fold_of(F.col("doc_id"), folds) == held_fold).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"), *FEATURES))
