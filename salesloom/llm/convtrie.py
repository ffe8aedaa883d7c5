"""Prefix trie of conversations, from adaptive radix trees.

A conversation is the string of its turns' ids, ``WIDTH`` bytes each, big-endian: the first
16 bytes of the sha256 of role and text (texts are not carried on).  Conversations
are dealt out by ranges of these strings, so prefixes that many share, or one
conversation repeated by the million, spread over tasks.  A task takes its sorted range in
slices of ``SLICE_BYTES`` of ids and puts each slice into an adaptive radix tree: inner
nodes grow from 4 to 16, 48 and 256 children and change their layout as they do, and
a chain without branches is one compressed path.  The tree is walked once; only byte
depths that are multiples of ``WIDTH`` are nodes of the trie.

A trie node with members in several slices lies on the path of the first or last
conversation of each of them.  The nodes on these two paths are given as parts and merged
by node; all others are whole.  Merged nodes are few: at most two paths a slice.  What they sum
over their subtrees is summed along paths: each node counts on one path that runs through
it, and a node's sum is that of what its paths hold from it downwards.  The digest of a merged
node's members streams over its sorted ids, so the members of a hot node need no memory.

Rows without conv_id belong to no conversation.  Null role or text is empty; equal turn
numbers are in order of the turn's id; repeated rows are turns of their own.  An empty
table has no nodes, not even a root.  A long text counts as a digest, and a conversation of many
turns is one record of 20 bytes a turn.  Only the four columns named are read, so
further columns cannot clash.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from salesloom.llm.common import written

WIDTH = 16
SLICE_BYTES = 4 << 20     # ids in one tree
SALTS = 32                # a merged node's children are dealt over so many keys when they look up their parent
SHARED_TURNS, BLOCK = 6, 100


def common(a: bytes, b: bytes) -> int:
    """The length of the longest common prefix."""
    n = min(len(a), len(b))
    return n - ((int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")).bit_length() + 7) // 8


class Node:
    """An inner node or leaf: compressed path, children by next byte, members that end here.

    Layouts: up to 4 and up to 16 children are two parallel lists sorted by byte; up to 48
    are slots found through 256 one-byte numbers; beyond, 256 children direct."""

    __slots__ = ("path", "layout", "index", "kids", "ends")

    def __init__(self, path: bytes):
        self.path, self.layout, self.ends = path, 4, []
        self.index, self.kids = bytearray(), []

    def find(self, byte: int) -> Node | None:
        if self.layout <= 16:
            at = self.index.find(byte)
            return self.kids[at] if at >= 0 else None
        if self.layout == 48:
            slot = self.index[byte]
            return self.kids[slot - 1] if slot else None
        return self.kids[byte]

    def put(self, byte: int, kid: Node) -> None:
        """Adds or replaces the child at ``byte``."""
        if self.layout <= 16:
            at = bisect_left(self.index, byte)
            if at < len(self.index) and self.index[at] == byte:
                self.kids[at] = kid
                return
            if len(self.kids) == self.layout:
                self._grow()
                self.put(byte, kid)
                return
            self.index.insert(at, byte)
            self.kids.insert(at, kid)
        elif self.layout == 48:
            if self.index[byte]:
                self.kids[self.index[byte] - 1] = kid
            elif len(self.kids) == 48:
                self._grow()
                self.put(byte, kid)
            else:
                self.kids.append(kid)
                self.index[byte] = len(self.kids)
        else:
            self.kids[byte] = kid

    def _grow(self) -> None:
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            slots = bytearray(256)
            for slot, byte in enumerate(self.index):
                slots[byte] = slot + 1
            self.layout, self.index = 48, slots
        else:
            self.layout, self.kids = 256, [self.kids[s - 1] if s else None for s in self.index]
            self.index = bytearray()

    def children(self) -> list[Node]:
        """In order of their bytes."""
        if self.layout <= 16:
            return self.kids
        if self.layout == 48:
            return [self.kids[s - 1] for s in self.index if s]
        return [k for k in self.kids if k is not None]


class RadixTree:
    """Byte strings with the members that have them; the root's path stays empty."""

    def __init__(self) -> None:
        self.root = Node(b"")

    def insert(self, key: bytes, member: int) -> None:
        node, parent, byte, at = self.root, None, 0, 0
        while True:
            if not key.startswith(node.path, at):
                same = common(node.path, key[at:at + len(node.path)])
                upper = Node(node.path[:same])        # the path is cut where the key leaves it
                upper.put(node.path[same], node)
                node.path = node.path[same + 1:]
                parent.put(byte, upper)
                node = upper
            at += len(node.path)
            if at == len(key):
                node.ends.append(member)
                return
            parent, byte = node, key[at]
            node = parent.find(byte)
            at += 1
            if node is None:
                leaf = Node(key[at:])
                leaf.ends.append(member)
                parent.put(byte, leaf)
                return

    def aligned(self, width: int) -> tuple[list[int], list[int], list[list[int]]]:
        """Depth (in units of ``width`` bytes), parent and ending members of every node at an
        aligned depth, parents first; the root is number 0 and its own parent."""
        depths, parents, ends = [0], [0], [self.root.ends]
        stack = [(k, 1, 0) for k in self.root.children()]      # node, bytes down to the one it hangs on, number above
        while stack:
            node, low, above = stack.pop()
            high = low + len(node.path)
            for depth in range((low - 1) // width + 1, high // width + 1):
                depths.append(depth)
                parents.append(above)
                ends.append([])
                above = len(depths) - 1
            if node.ends:
                ends[above] = node.ends
            stack += [(k, high + 1, above) for k in node.children()]
        return depths, parents, ends


def digest(ids: Iterator[int]) -> str:
    """sha256 of the decimal ids joined by commas."""
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


NO_MEMBER = digest(iter(()))
# kind 0: whole node; 1: part of a node, once for each path (slice, side); 2: a member that ends at a node of kind 1
PARTS = pa.schema([("kind", pa.int32()), *[(c, pa.int64()) for c in (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")], ("ends_sha256", pa.string()),
    ("node", pa.binary()), ("parent_node", pa.binary()), ("slice", pa.int64()), ("side", pa.int32()), ("chars", pa.int64())])


def slice_rows(ids: list[int], keys: list[bytes], chars: list[list[int]], number: int) -> list[tuple]:
    """Rows of ``PARTS`` of one slice of sorted conversations."""
    tree = RadixTree()
    for member, key in enumerate(keys):
        tree.insert(key, member)
    depths, parents, ends = tree.aligned(WIDTH)
    n = len(depths)
    edge: dict[int, bytes] = {}               # nodes on the first and the last path, with their ids
    paths = []
    at_end = {m: v for v, e in enumerate(ends) if e for m in (e[0], e[-1])}
    for member in (0, len(keys) - 1):
        v, path = at_end[member], []
        while True:
            path.append(v)
            edge[v] = hashlib.sha256(keys[member][:depths[v] * WIDTH]).digest()[:WIDTH]
            if v == 0:
                break
            v = parents[v]
        paths.append(path)
    convs, least, some = [len(e) for e in ends], [min((ids[m] for m in e), default=None) for e in ends], [e[0] if e else -1 for e in ends]
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    for v in range(n - 1, -1, -1):            # children come after their parents
        up = parents[v]
        if v not in edge:
            saved[v] += (convs[v] - 1) * chars[some[v]][depths[v] - 1]
            leaves[v] += children[v] == 0
        if v:
            convs[up] += convs[v]
            least[up] = least[v] if least[up] is None else min(least[up], least[v])
            some[up] = some[v]
            if v not in edge:                 # the sums of merged nodes leave other merged nodes out
                children[up] += 1
                leaves[up] += leaves[v]
                saved[up] += saved[v]
    rows = []
    for v in range(n):
        if v not in edge:
            up = parents[v]
            rows.append((0, least[v], depths[v], None if up in edge else least[up], convs[v], children[v], leaves[v], saved[v],
                         digest(sorted(ids[m] for m in ends[v])) if ends[v] else NO_MEMBER,
                         None, edge.get(up), None, None, None))
    counted = set()
    for side, path in enumerate(paths):
        for v in path:
            stats = (convs[v], children[v], leaves[v], saved[v]) if v not in counted else (0, 0, 0, 0)
            rows.append((1, least[v], depths[v], None, *stats, None, edge[v], edge[parents[v]] if v else None, number, side,
                         chars[some[v]][depths[v] - 1] if v else 0))
            if v not in counted:
                rows += [(2, ids[m], None, None, None, None, None, None, None, edge[v], None, None, None, None) for m in ends[v]]
            counted.add(v)
    return rows


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    ids: list[int] = []
    keys: list[bytes] = []
    chars: list[list[int]] = []
    held = 0

    def flush() -> pa.RecordBatch:
        rows = slice_rows(ids, keys, chars, number)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PARTS, strict=True)],
                                          schema=PARTS)

    for batch in batches:
        for conv, key, size in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "ids", "chars")), strict=True):
            ids.append(conv)
            keys.append(key)
            chars.append(size)
            held += len(key) + WIDTH
            if held > SLICE_BYTES:
                yield flush()
                number, held = number + 1, 0
                ids, keys, chars = [], [], []
    if ids:
        yield flush()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ends_sha256) from (node, conv_id) sorted by both."""
    node, state = None, None
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], schema=schema)

    for batch in batches:
        for here, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if here != node:
                if node is not None:
                    yield row()
                node, state = here, hashlib.sha256(str(conv).encode())
            else:
                state.update(b",%d" % conv)
    if node is not None:
        yield row()


def trie_nodes(sequences: DataFrame) -> DataFrame:
    """One row per trie node of ``sequences`` (conv_id bigint, ids binary of ``WIDTH`` bytes a
    turn, chars array<int> of the turns' lengths), a written table; see ``conversation_trie``."""
    ranged = sequences.repartitionByRange("ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    parts = written(ranged.select("conv_id", "ids", "chars").mapInArrow(_parts, from_arrow_schema(PARTS)))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    whole, edge = parts.where("kind = 0"), parts.where("kind = 1")

    merged = edge.groupBy("node").agg(
        F.first("parent_node").alias("parent_node"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved"), F.first("chars").alias("chars"), F.min(F.struct("slice", "side")).alias("home"))
    kids = merged.groupBy(F.col("parent_node").alias("node")).agg(F.count("*").alias("more"))
    merged = written(merged.join(kids, "node", "left").select(
        "node", "parent_node", "depth", "conv_id", "n_convs", "home",
        (F.col("n_children") + F.coalesce("more", F.lit(0))).alias("n_children"),
        (F.col("saved") + F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("chars")).otherwise(0)).alias("saved"),
        (F.col("leaves") + (F.col("n_children") + F.coalesce("more", F.lit(0)) == 0).cast("bigint")).alias("leaves")))
    here = F.struct("slice", "side") == F.col("home")
    below = Window.partitionBy("slice", "side").orderBy(F.desc("depth"))
    sums = (edge.select("node", "slice", "side", "depth").join(merged.select("node", "home", "saved", "leaves"), "node")
            .select("node", *[F.sum(F.when(here, F.col(c)).otherwise(0)).over(below).alias(c) for c in ("saved", "leaves")])
            .groupBy("node").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves")))
    ends = (parts.where("kind = 2").select("node", "conv_id").repartition("node").sortWithinPartitions("node", "conv_id")
            .mapInArrow(_digests, "node binary, ends_sha256 string"))
    above = merged.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("above"))
    top = (merged.select("node", "parent_node", "depth", "conv_id", "n_convs", "n_children").join(sums, "node")
           .join(ends, "node", "left").join(above, "parent_node", "left")
           .select("conv_id", "depth", F.col("above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
                   F.coalesce("ends_sha256", F.lit(NO_MEMBER)).alias("ends_sha256")))
    salted = above.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hanging = (whole.where("parent_node IS NOT NULL").withColumn("salt", F.pmod(F.hash("conv_id", "depth"), F.lit(SALTS)))
               .join(salted, ["parent_node", "salt"]).withColumn("parent_conv_id", F.col("above")))
    return top.unionByName(whole.where("parent_node IS NULL").select(names)).unionByName(hanging.select(names))


def turn_id(role: str = "role", text: str = "text"):
    """The turn's ``WIDTH`` bytes: sha256 of the role's length, the role and the text."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    both = F.concat(F.char_length(who).cast("string"), F.lit(":"), who, said).cast("binary")
    return F.unhex(F.substring(F.sha2(both, 256), 1, 2 * WIDTH))


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<known, turn, id, chars>>) with the turns in order."""
    chars = F.char_length(F.coalesce("text", F.lit(""))).cast("int")
    one = F.struct(F.col("turn").isNotNull().alias("known"), "turn", turn_id().alias("id"), chars.alias("chars"))
    return (conversations.where("conv_id IS NOT NULL").select("conv_id", one.alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))


def sequences_of(lists: DataFrame, turns) -> DataFrame:
    """(conv_id, ids, chars) for ``trie_nodes`` of the turns that the column ``turns`` holds."""
    joined = F.unhex(F.array_join(F.transform(turns, lambda t: F.hex(t["id"])), ""))
    return lists.select("conv_id", joined.alias("ids"), F.transform(turns, lambda t: t["chars"]).alias("chars"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256) of every node of the trie of conversations as they are."""
    lists = turn_lists(conversations)
    return trie_nodes(written(sequences_of(lists, F.col("turns"))))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """As ``conversation_trie``, of rebuilt conversations: the first h turns of
    conversation c - c % ``BLOCK``, then c's own turns after its first h; h is the crc32 of c's
    decimal digits modulo ``SHARED_TURNS``."""
    lists = written(turn_lists(conversations))
    firsts = lists.where(F.col("conv_id") % BLOCK == 0).select(
        F.col("conv_id").alias("block"), F.slice("turns", 1, SHARED_TURNS - 1).alias("firsts"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED_TURNS).cast("int")
    none = F.slice("turns", 1, 0)
    both = lists.withColumn("block", F.col("conv_id") - F.col("conv_id") % BLOCK).join(firsts, "block", "left")
    turns = F.concat(F.slice(F.coalesce("firsts", none), F.lit(1), h), F.slice("turns", h + 1, F.size("turns")))
    return trie_nodes(written(sequences_of(both, turns)))


#: The rows of ``rebuilt_trie`` from all prefixes and all their ancestors, for small tables.
ALL_PREFIXES = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(text, '') AS said,
         sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[1:32] AS id
  FROM conversations WHERE conv_id IS NOT NULL),
lists AS (
  SELECT conv_id, list({'id': id, 'chars': length(said)} ORDER BY turn NULLS FIRST, id) AS turns,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END))) % 6 AS h
  FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS turns
  FROM lists a LEFT JOIN lists b ON b.conv_id = a.conv_id - a.conv_id % 100),
paths AS (
  SELECT conv_id, list_transform(turns, lambda t: t.id) AS ids, list_transform(turns, lambda t: t.chars) AS chars FROM rebuilt),
nodes AS (
  SELECT ids[1:d] AS path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars[d]) AS chars,
         sha256(coalesce(string_agg(CASE WHEN len(ids) = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM paths, unnest(range(0, len(ids) + 1)) AS u(d) GROUP BY path, depth),
kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
marked AS (
  SELECT nodes.*, coalesce(kids.n, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * chars ELSE 0 END AS own
  FROM nodes LEFT JOIN kids USING (path)),
sums AS (
  SELECT path[1:a] AS path, sum((n_children = 0)::INT) AS n_leaves, sum(own) AS saved_tokens
  FROM marked, unnest(range(0, depth + 1)) AS u(a) GROUP BY 1)
SELECT m.conv_id, m.depth, p.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, m.ends_sha256
FROM marked m JOIN sums s ON s.path = m.path LEFT JOIN nodes p ON m.depth > 0 AND p.path = m.path[1:m.depth - 1]
"""
