"""BPE against the tokenizers library."""

import hashlib
import json
import random

import pytest

from salesloom.llm import bpe
from tests.conftest import SF_SMALL

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(bpe.default_path())


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(json.loads(bpe.load_spec(bpe.default_path())))


EDGE = ["", " ", "\n\n \t x", "aaaaaaaaaaaaaaaa", "a" * 5000, "don't we'll I'M", "<|endoftext|>", "x<|endoftext|><|endoftext|> y",
        "<|endoftext", "日本語テキスト", "👩‍👩‍👧 e\u0301 ñ", "\u00a0\u2003x\u200b", "1234567890 ½ Ⅷ ४५", "!!! *** &&&", "\x00\x01",
        "\ufffd\ufeff", "ab" * 3000, "  lead", "trail  ", "\r\n\r\n", "'s's'll"]


def test_edge_texts(library, own):
    for t in EDGE:
        ids = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids, t[:40]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_random_unicode(library, own):
    rng = random.Random(3)
    pools = ["abcdefgh thing ", "éüßñçà ", "0123456789.,;:!? ", "\n\t\r  ", "漢字かなカナ한글", "\U0001f600\U0001f468\u200d", "аяюжд "]
    texts = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(1, 200))) for _ in range(400)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for t, ids, words in zip(texts, want, own.encode_words(texts), strict=True):
        assert [int(i) for w in words for i in w[0].split(",")] == ids
        assert b"".join(w[2] for w in words).decode() == t


def test_partial_ids_decode_like_the_library(library, own):
    ids = library.encode("日本語 👩 ñ é", add_special_tokens=False).ids
    for cut in range(1, len(ids)):
        assert own.decode(ids[cut:]) == library.decode(ids[cut:], skip_special_tokens=False)


def test_special_as_plain_text(library):
    plain = bpe.Bpe(json.loads(bpe.load_spec(bpe.default_path())), plain_specials=True)
    ids = plain.encode("a<|endoftext|>b")
    assert 50256 not in ids and plain.decode(ids) == "a<|endoftext|>b"


def test_small_cache_gives_the_same(own, monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    t = "several different words pass through a tiny cache, several times"
    assert own.encode(t) == library.encode(t, add_special_tokens=False).ids


def test_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    more = spark.createDataFrame([(-1, None, "x"), (-1, "", "x"), (-1, "", "x")], "doc_id long, text string, ids string")
    got = bpe.token_digests(docs.select("doc_id", "text").unionByName(more, allowMissingColumns=True)).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()} | {-1: ""}
    assert len(got) == docs.count() + 3
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
    assert bpe.token_digests(docs.limit(0)).collect() == []
    e = {r["doc_id"]: r for r in bpe.encode_documents(docs).collect()}
    assert all(e[i]["ids"] == library.encode(t, add_special_tokens=False).ids and e[i]["decoded"] == t
               for i, t in texts.items() if i >= 0)
