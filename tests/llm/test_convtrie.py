"""The conversation trie against a table of all prefixes."""

import hashlib
import math
import random
import zlib

import duckdb
import pytest

from salesloom.llm import convtrie as C
from tests.conftest import SF_SMALL


def plain(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            convs.setdefault(c, []).append(((t is not None, t or 0), hashlib.sha256(f"{len(r)}:{r}{x}".encode()).digest()[:16], r, x))
    own = {c: [v[2:] for v in sorted(turns, key=lambda z: z[:2])] for c, turns in convs.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:])
    nodes, kids, below = {}, {}, {}
    for c, s in whole.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    for s in nodes:
        if s:
            kids.setdefault(s[:-1], []).append(s)
    for s in sorted(nodes, key=len, reverse=True):
        mine = [below[k] for k in kids.get(s, [])]
        below[s] = (sum(x for x, _ in mine) or 1, sum(x for _, x in mine) + ((len(nodes[s]) - 1) * len(s[-1][1]) if s else 0))
    return sorted(((min(m), len(s), min(nodes[s[:-1]]) if s else None, len(m), len(kids.get(s, [])), *below[s],
                    hashlib.sha256(",".join(map(str, sorted(c for c in m if len(whole[c]) == len(s)))).encode()).hexdigest())
                   for s, m in nodes.items()), key=str)


def trie(spark, rows):
    table = spark.createDataFrame([(*r, 1, "z") for r in rows],
                                  "conv_id bigint, turn bigint, role string, text string, depth int, ids string")
    return sorted(map(tuple, C.rebuilt_trie(table).collect()), key=str)


def test_radix_tree_keeps_all_keys_and_grows_its_layouts():
    rng = random.Random(1)
    for alphabet in (b"\x00\x01", bytes(range(20)), bytes(range(60)), bytes(range(256))):
        keys = [bytes(rng.choice(alphabet) for _ in range(2 * rng.randrange(5))) for _ in range(2000)]
        tree = C.RadixTree()
        for i, k in enumerate(keys):
            tree.insert(k, i)
        depths, parents, ends = tree.aligned(2)
        names = [b""] * len(depths)
        for v in range(1, len(depths)):
            some = next(iter(ends[v]), None)
            names[v] = keys[some] if some is not None else None
        prefixes = {k[:d] for k in keys for d in range(0, len(k) + 1, 2)}
        assert len(depths) == len(prefixes)
        assert sorted(m for e in ends for m in e) == list(range(len(keys)))
        assert all(depths[v] == depths[parents[v]] + 1 for v in range(1, len(depths)))
        assert {len(keys[m]) // 2 for v, e in enumerate(ends) for m in e if depths[v] != len(keys[m]) // 2} == set()
        wanted = 4 if len(alphabet) <= 4 else 48 if len(alphabet) <= 48 else 256
        assert tree.root.layout == wanted


@pytest.mark.parametrize("slice_bytes", [60, 400, 4 << 20])
def test_all_prefixes(spark, monkeypatch, slice_bytes):
    """Slices of one or few conversations make nearly all nodes merged ones."""
    monkeypatch.setattr(C, "SLICE_BYTES", slice_bytes)
    rng = random.Random(slice_bytes)
    ids = [0, 1, 2, 3, 4, 100, 101, 102, 103, 200, 250, -5, -100, None, 305]
    rows = [(rng.choice(ids), rng.choice([None, *range(8)]), rng.choice(["u", "a", None]), rng.choice(["x", "yy", "zé\U0001d11e", None, ""]))
            for _ in range(150)]
    rows += [(c, i, "u", f"m{i % 3}") for c in range(400, 500) for i in range(c % 7)]
    rows += rows[:10]
    assert trie(spark, rows) == plain(rows)


def test_no_conversation(spark):
    assert trie(spark, []) == [] and trie(spark, [(None, 1, "u", "x")]) == []


def test_long_conversation_and_long_turn(spark):
    rows = [(c, i, "u", str(i)) for c in (7, 8, 9) for i in range(1500)] + [(10, 0, "u", "w" * 300_000)]
    assert trie(spark, rows) == plain(rows)


def test_conversations_as_they_are(spark):
    rows = [(1, 0, "u", "hi"), (1, 1, "a", "yo"), (2, 0, "u", "hi"), (3, 5, "u", "hi"), (3, 6, "a", "no!")]
    got = C.conversation_trie(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    assert sorted((r["depth"], r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"]) for r in got) == [
        (0, 1, 3, 1, 2, 4), (1, 1, 3, 2, 2, 4), (2, 1, 1, 0, 1, 0), (2, 3, 1, 0, 1, 0)]


def test_whole_table_against_sql(spark):
    path = f"{SF_SMALL}/conversations.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}')")
    got = sorted(map(tuple, C.rebuilt_trie(spark.read.parquet(path)).collect()), key=str)
    assert got == sorted(con.execute(C.ALL_PREFIXES).fetchall(), key=str)
    assert got == plain([tuple(r) for r in spark.read.parquet(path).select("conv_id", "turn", "role", "text").collect()])
