"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

The tokenizer file (JSON of the public ``tokenizers`` format; its path is a
parameter) gives vocabulary and merges.  A task collects the words of many texts
that it has not met yet, lays their byte symbols out in one flat array and merges
in rounds: the pairs of neighbouring symbols are looked up by binary search in
the sorted pair keys, each word's lowest-ranked pair is merged wherever it stands
in the word (left to right), and words without a known pair leave the array.
Added special tokens found in a text become their own ids, as the library does;
``plain_specials`` treats them as ordinary text instead.

Memory is bounded by the slice of texts at hand and ``CACHE_WORDS`` cached words.
Null texts are empty; an empty text has no ids, and decodes to the empty text.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salesloom.llm.common import map_chunks, texts_of

CACHE_WORDS = 500_000
# Fixed value: the public split pattern of byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NO_RANK = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


class Bpe:
    """Encoder and decoder of one tokenizer file's content (parsed JSON)."""

    def __init__(self, spec: dict, plain_specials: bool = False):
        import regex

        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        symbols = byte_symbols()
        self.byte_id = np.array([vocab[s] for s in symbols], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = (left << 32) | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made[order]
        back = {s: b for b, s in enumerate(symbols)}
        specials = [t for t in spec.get("added_tokens", []) if t.get("special")]
        self.special = {} if plain_specials else {t["content"]: t["id"] for t in specials}
        self.bytes_of = {i: bytes(back[c] for c in s) for s, i in vocab.items()}
        for t in specials:
            self.bytes_of[t["id"]] = t["content"].encode()
        self.split_words = regex.compile(PATTERN).findall
        self.split_special = regex.compile(
            "(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")"
        ).split if self.special else None
        # per word: ids as text, number of ids, decoded bytes, ids as little-endian int32
        self.cache: dict[str, tuple[str, int, bytes, bytes]] = {}

    def words(self, text: str) -> list[str]:
        if self.split_special is None or not any(s in text for s in self.special):
            return self.split_words(text)
        out: list[str] = []
        for part in self.split_special(text):
            out += [part] if part in self.special else self.split_words(part)
        return out

    def merge(self, words: list[str]) -> list[np.ndarray]:
        """The ids of every word (non-empty, not special)."""
        raw = [w.encode() for w in words]
        lengths = np.array([len(r) for r in raw], dtype=np.int64)
        ids = self.byte_id[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        done: list[np.ndarray | None] = [None] * len(words)
        while len(ids):
            key = (ids[:-1] << 32) | ids[1:]
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            known = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank = np.where(known, self.rank[at], NO_RANK)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(np.r_[rank, NO_RANK], starts)
            sizes = np.diff(np.r_[starts, len(ids)])
            # the last position of each word pairs across words and holds NO_RANK
            finished = lowest == NO_RANK
            for s, n in zip(starts[finished], sizes[finished], strict=True):
                done[word[s]] = ids[s:s + n]
            hit = np.flatnonzero(known & (rank == np.repeat(lowest, sizes)[:-1]))
            # of overlapping equal pairs (x x x), take every second from the left
            if len(hit):
                run = np.flatnonzero(np.r_[True, (np.diff(hit) > 1) | (word[hit[1:]] != word[hit[:-1]])])
                nth = np.arange(len(hit)) - np.repeat(run, np.diff(np.r_[run, len(hit)]))
                hit = hit[nth % 2 == 0]
            ids = ids.copy()
            ids[hit] = self.made[at[hit]]
            keep = ~np.repeat(finished, sizes)
            keep[hit + 1] = False
            ids, word = ids[keep], word[keep]
        return done

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.cache]
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache.clear()
            new = list(words)
        plain = [w for w in new if w not in self.special]
        for w, ids in zip(plain, self.merge(plain), strict=True):
            each = ids.tolist()
            self.cache[w] = (",".join(map(str, each)), len(each), b"".join([self.bytes_of[i] for i in each]),
                             ids.astype("<i4").tobytes())
        for w in new:
            if w in self.special:
                i = self.special[w]
                self.cache[w] = (str(i), 1, self.bytes_of[i], np.array([i], "<i4").tobytes())

    def encode_words(self, texts: list[str]) -> list[list[tuple[str, int, bytes, bytes]]]:
        """Per text and word what the cache holds of it."""
        words = [self.words(t) for t in texts]
        self.learn(set().union(*words) if words else set())
        get = self.cache.__getitem__
        return [[*map(get, w)] for w in words]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.raw_ids(self.encode_words([text])[0]), "<i4").tolist()

    @staticmethod
    def raw_ids(words: list[tuple[str, int, bytes, bytes]]) -> bytes:
        return b"".join([w[3] for w in words])

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.bytes_of[i] for i in ids).decode("utf-8", errors="replace")


def load_spec(path: str) -> str:
    """The tokenizer file's text, read once on the driver."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_digests(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of ``docs``."""
    spec = docs.sparkSession.sparkContext.broadcast(load_spec(tokenizer_path or default_path()))

    def start():
        bpe = Bpe(json.loads(spec.value))

        def work(batch: pa.RecordBatch) -> dict:
            sha, rows = hashlib.sha256, []
            for words in bpe.encode_words(texts_of(batch, "text")):
                ids, counts, raw, _ = zip(*words, strict=True) if words else ((), (), (), ())
                decoded = b"".join(raw).decode("utf-8", errors="replace")
                rows.append((sum(counts), sha(",".join(ids).encode()).hexdigest(), sha(decoded.encode()).hexdigest()))
            columns = zip(*rows, strict=True)
            return {"doc_id": batch.column("doc_id"),
                    **dict(zip(("n_tokens", "ids_sha256", "decoded_sha256"), columns, strict=True))}

        return work

    kind = dict(docs.dtypes)["doc_id"]
    return map_chunks(docs.select("doc_id", "text"), "text",
                      f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", start)


def encode_documents(docs: DataFrame, tokenizer_path: str | None = None,
                     plain_specials: bool = False) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of every row of ``docs``."""
    spec = docs.sparkSession.sparkContext.broadcast(load_spec(tokenizer_path or default_path()))

    def start():
        bpe = Bpe(json.loads(spec.value), plain_specials)

        def work(batch: pa.RecordBatch) -> dict:
            encoded = bpe.encode_words(texts_of(batch, "text"))
            flat = [np.frombuffer(bpe.raw_ids(words), "<i4") for words in encoded]
            ends = np.cumsum([0, *map(len, flat)])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                           pa.array(np.concatenate(flat) if flat else [], pa.int32()))
            return {"doc_id": batch.column("doc_id"), "ids": ids,
                    "decoded": [b"".join([w[2] for w in words]).decode("utf-8", errors="replace")
                                for words in encoded]}

        return work

    kind = dict(docs.dtypes)["doc_id"]
    return map_chunks(docs.select("doc_id", "text"), "text",
                      f"doc_id {kind}, ids array<int>, decoded string", start)
