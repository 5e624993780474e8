"""Prefix trie of conversations in balanced parentheses, shard by shard.

A prefix of a conversation is known by a key, running over its turns.  Keys that one
conversation alone has make unary tails, whose nodes need no tree.  The shared parts of the
conversations are sorted as sequences of keys and dealt out by range, conversations of equal
sequence by id, so a sequence that a third of the conversations have is spread as well.  A
shard writes its trie as balanced parentheses over which blocks of least excess form a tree:
``findclose`` delimits a subtree, ranks count the pairs ``()`` in it, which are leaves, and
sums over nodes in their order give what a subtree holds by two look-ups.

Only nodes on a shard's first and last sequence, its spine, can stand in other shards too.
They are passed on with what hangs off them beside the spine, and a second tree over the
spines of all shards, in their order, merges them.  That one task reads two sequences a
shard, however many conversations there are, and the ids of conversations that end on them,
joined to a text by shard, since the digest of a list of ids can only be taken in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import stored

BLOCK = 256
#: Characters of a key in a path.
KEY = 32
#: Rows of an Arrow batch.
BATCH = 20_000
NOTHING = hashlib.sha256(b"").hexdigest()


class Parentheses:
    """A tree as +1 (open) and -1 (close), nodes numbered as they open."""

    def __init__(self, bits: np.ndarray) -> None:
        self.excess = np.cumsum(bits, dtype=np.int64)
        self.opens = np.flatnonzero(bits > 0)
        #: Leaf pairs that begin before a place.
        self.pairs = np.concatenate([[0], np.cumsum((bits[:-1] > 0) & (bits[1:] < 0)), [0]])
        self.pairs[-1] = self.pairs[-2]
        lows = [np.minimum.reduceat(self.excess, np.arange(0, len(bits), BLOCK))]
        while len(lows[-1]) > 1:
            lows.append(np.minimum.reduceat(lows[-1], np.arange(0, len(lows[-1]), 2)))
        self.lows = lows

    def _block(self, block: int, most: int) -> int:
        """The first block from ``block`` on that goes down to ``most``."""
        level = 0
        while block >= len(self.lows[level]) or self.lows[level][block] > most:
            block += 1
            if block % 2 == 0:
                block, level = block // 2, level + 1
        while level:
            block, level = block * 2, level - 1
            if self.lows[level][block] > most:
                block += 1
        return block

    def findclose(self, place: int) -> int:
        """The place that closes what opens at ``place``."""
        most = self.excess[place] - 1
        begin, end = place + 1, (place // BLOCK + 1) * BLOCK
        inside = np.flatnonzero(self.excess[begin:end] <= most)
        if not len(inside):
            begin = self._block(place // BLOCK + 1, most) * BLOCK
            inside = np.flatnonzero(self.excess[begin:begin + BLOCK] <= most)
        return begin + int(inside[0])

    def subtrees(self) -> tuple[np.ndarray, np.ndarray]:
        """By node, the number behind its last descendant, and the leaves of its subtree."""
        close = np.array([self.findclose(int(i)) for i in self.opens], np.int64)
        behind = np.arange(len(self.opens)) + (close - self.opens + 1) // 2
        return behind, self.pairs[close] - self.pairs[self.opens]


def totals(values: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Sums over subtrees, from values by node."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[behind] - sums[np.arange(len(behind))]


def _least_below(own: list[int | None], parent: list[int]) -> list[int | None]:
    """The least id in each subtree."""
    least = list(own)
    for v in range(len(least) - 1, 0, -1):
        if least[v] is not None and (least[parent[v]] is None or least[v] < least[parent[v]]):
            least[parent[v]] = least[v]
    return least


class Shard:
    """The trie of sorted conversations: nodes in order, and their parentheses."""

    def __init__(self) -> None:
        self.bits, self.path, self.stack = [1], "", [0]
        self.key, self.depth, self.size, self.parent = [""], [0], [0], [-1]
        self.least, self.count, self.ids, self.tail = [None], [0], [[]], [False]
        self.first: list[int] = []

    def _open(self, key: str, size: int, depth: int, parent: int) -> int:
        self.bits.append(1)
        for column, value in ((self.key, key), (self.depth, depth), (self.size, size), (self.parent, parent),
                              (self.least, None), (self.count, 0), (self.ids, []), (self.tail, False)):
            column.append(value)
        return len(self.key) - 1

    def add(self, path: str, sizes: list[int], conv: int, length: int) -> None:
        """A conversation of ``length`` turns whose shared part is ``path``."""
        begun, own, common = bool(self.first), len(sizes), 0
        if path == self.path:
            common = own
        else:
            while common < min(own, len(self.stack) - 1) and path.startswith(self.path[common * KEY:common * KEY + KEY], common * KEY):
                common += 1
        while len(self.stack) - 1 > common:
            self.stack.pop()
            self.bits.append(-1)
        for d in range(common, own):
            self.stack.append(self._open(path[d * KEY:d * KEY + KEY], sizes[d], d + 1, self.stack[-1]))
        self.path = path
        if not begun:
            self.first = list(self.stack)
        node = self.stack[-1]
        if length > own:
            node = self._open("", 0, own + 1, node)
            self.bits.append(-1)
            self.tail[node] = length > own + 1
        if length <= own + 1:
            self.ids[node].append(conv)
        self.count[node] += 1
        self.least[node] = conv if self.least[node] is None else min(self.least[node], conv)

    def rows(self, shard: int) -> Iterator[tuple]:
        """Finished nodes (kind 0) and spine nodes (kind 1), as ``PARTS``."""
        bits = np.array(self.bits + [-1] * len(self.stack), np.int8)
        behind, leaves = Parentheses(bits).subtrees()
        n = len(self.key)
        convs = totals(np.array(self.count), behind)
        saved = totals((convs - 1) * np.array(self.size, np.int64), behind)
        least = _least_below(self.least, self.parent)
        spine = np.zeros(n, bool)
        spine[self.first] = spine[self.stack] = True
        parent = np.array(self.parent)
        inner = np.flatnonzero(~spine)  # never the root
        children = np.bincount(parent[inner], minlength=n)
        beside = [np.zeros(n, np.int64) for _ in range(2)]
        for out, values in zip(beside, (leaves, saved), strict=True):
            np.add.at(out, parent[inner], values[inner])
        for v in range(n):
            ids = ",".join(map(str, self.ids[v]))
            if spine[v]:
                yield (1, shard, v, self.key[v], least[v], self.depth[v], None, None, int(convs[v]), int(children[v]),
                       int(beside[0][v]), int(beside[1][v]), self.size[v], ids)
            else:
                up = self.parent[v]
                yield (0, shard, v, None, least[v], self.depth[v], None if spine[up] else least[up],
                       self.key[up] if spine[up] else None, int(convs[v]), int(children[v]) + self.tail[v], int(leaves[v]),
                       int(saved[v]), self.size[v], hashlib.sha256(ids.encode()).hexdigest() if ids else NOTHING)


LONG = pa.int64()
PARTS = pa.schema([
    ("kind", pa.int32()), ("shard", pa.int32()), ("seq", LONG), ("key", pa.string()), ("conv_id", LONG), ("depth", LONG),
    ("parent_conv_id", LONG), ("parent_key", pa.string()), ("n_convs", LONG), ("n_children", LONG), ("n_leaves", LONG),
    ("saved_tokens", LONG), ("size", LONG), ("ends", pa.string()),
])
PARTS_DDL = (
    "kind int, shard int, seq long, key string, conv_id long, depth long, parent_conv_id long, parent_key string, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, size long, ends string"
)
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
MERGED = pa.schema([("key", pa.string()), *[(c, pa.string() if c == "ends_sha256" else LONG) for c in NODE]])
MERGED_DDL = "key string, " + ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in NODE)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = zip(*waiting, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for row in rows:
        waiting.append(row)
        if len(waiting) == BATCH:
            yield batch()
            waiting = []
    if waiting:
        yield batch()


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted partition (path, sizes, conv_id, length) as rows of ``PARTS``."""
    from pyspark import TaskContext

    trie = None
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            trie = trie or Shard()
            trie.add(*row)
    if trie:
        yield from _batches(trie.rows(TaskContext.get().partitionId()), PARTS)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spines of all shards, in order, as rows of ``MERGED``."""
    names = ["key", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "size", "ends"]
    key, depth, size, parent, least = [], [], [], [], []
    convs, children, leaves, saved = [], [], [], []
    ends: list = []
    bits, stack = [], []
    for batch in batches:
        for k, conv, d, n, c, lv, s, z, ids in zip(*(batch.column(x).to_pylist() for x in names), strict=True):
            if not (len(stack) > d and key[stack[d]] == k):
                while len(stack) > d:
                    stack.pop()
                    bits.append(-1)
                for column, value in ((key, k), (depth, d), (size, z), (parent, stack[-1] if stack else -1), (least, conv),
                                      (convs, 0), (children, 0), (leaves, 0), (saved, 0), (ends, None)):
                    column.append(value)
                stack.append(len(key) - 1)
                bits.append(1)
            v = stack[d]
            convs[v] += n
            children[v] += c
            leaves[v] += lv
            saved[v] += s
            least[v] = min(least[v], conv)
            if ids:
                if ends[v]:
                    ends[v].update(b",")
                else:
                    ends[v] = hashlib.sha256()
                ends[v].update(ids.encode())
    if not key:
        return
    tree = Parentheses(np.array(bits + [-1] * len(stack), np.int8))
    behind, _ = tree.subtrees()
    n = len(key)
    below = np.bincount(np.array(parent[1:], np.int64), minlength=n) if n > 1 else np.zeros(n, np.int64)
    all_children = np.array(children) + below
    all_leaves = totals(np.array(leaves) + (all_children == 0), behind)
    all_saved = totals(np.array(saved) + (np.array(convs) - 1) * np.array(size), behind)
    yield from _batches(
        ((key[v], least[v], depth[v], least[parent[v]] if v else None, convs[v], int(all_children[v]), int(all_leaves[v]),
          int(all_saved[v]), ends[v].hexdigest() if ends[v] else NOTHING) for v in range(n)), MERGED)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, n_turns) and their turns (conv_id, pos, m1, m2, size).

    Turns of a conversation are ordered by turn, null first, then role, then the text's
    digest; ``pos`` counts from 0.  Conversation c consists of the first h turns of
    c - c % 5, as many as there are, and of its own turns after its first h, where h is
    crc32 of c modulo 9.  ``m1`` and ``m2`` are 60 bits each of a digest of role and text.
    """
    given = turns.where("conv_id is not null").selectExpr(
        "cast(conv_id as bigint) as conv_id", "turn", "coalesce(cast(role as string), '') as role",
        "coalesce(cast(text as string), '') as text",
    ).selectExpr(
        "conv_id", "turn", "role", "cast(octet_length(text) as bigint) as size",
        "md5(cast(concat(octet_length(role), ':', role, text) as binary)) as digest",
    )
    own = given.selectExpr(
        "conv_id", "size", "row_number() over (partition by conv_id order by turn nulls first, role, digest) - 1 as pos",
        "cast(conv(substr(digest, 1, 15), 16, 10) as bigint) as m1", "cast(conv(substr(digest, 16, 15), 16, 10) as bigint) as m2",
    )
    own = stored(own)
    heads = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).selectExpr(
        "conv_id", "own", "conv_id - conv_id % 5 as base",
        "cast(crc32(cast(cast(conv_id as string) as binary)) % 9 as int) as head",
    )
    bases = heads.selectExpr("conv_id as base", "own as there")
    convs = heads.join(bases, "base", "left").selectExpr(
        "conv_id", "base", "head", "least(head, coalesce(there, 0)) as taken",
        "least(head, coalesce(there, 0)) + greatest(own - head, 0) as n_turns",
    )
    begun = own.where("pos < 8 and conv_id % 5 = 0").withColumnRenamed("conv_id", "base").join(
        convs.select("conv_id", "base", "head"), "base").where("pos < head")
    gone_on = own.join(convs.select("conv_id", "head", "taken"), "conv_id").where("pos >= head")
    columns = ["m1", "m2", "size"]
    rows = begun.selectExpr("conv_id", "cast(pos as bigint) as pos", *columns).unionByName(
        gone_on.selectExpr("conv_id", "cast(taken + pos - head as bigint) as pos", *columns))
    return convs.select("conv_id", "n_turns"), rows


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the prefix trie, as ``NODE``; one row per distinct prefix, root included.

    ``convs`` lists (conv_id, n_turns), ``turns`` (conv_id, pos from 0 without holes, m1, m2:
    digest of the turn, size: bytes of its text).  The key of a prefix joins position-bound
    hashes of its turns, 128 bits.  A conversation's turns are numbered, and the shared part
    of its keys gathered, in one task; keys of unshared turns never are.
    """
    keyed = stored(turns.selectExpr(
        "conv_id", "pos", "size",
        *[f"bit_xor({h}) over (partition by conv_id order by pos rows between unbounded preceding and current row) as {p}"
          for p, h in (("p1", "xxhash64(pos, m1, m2)"), ("p2", "xxhash64(m2, m1, pos)"))],
    ).selectExpr("conv_id", "pos", "size", "concat(lpad(hex(p1), 16, '0'), lpad(hex(p2), 16, '0')) as key"))
    shared = keyed.groupBy("pos", "key").count().where("count > 1")
    paths = keyed.join(shared.select("pos", "key"), ["pos", "key"], "left_semi").groupBy("conv_id").agg(
        F.expr("array_sort(collect_list(struct(pos, key, size)))").alias("path"))
    known = stored(convs.join(paths, "conv_id", "left").selectExpr(
        "coalesce(array_join(transform(path, x -> x.key), ''), '') as path",
        "coalesce(transform(path, x -> x.size), array()) as sizes", "conv_id", "n_turns",
    ))
    parts = stored(known.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").mapInArrow(_shard, PARTS_DDL))
    spine = stored(parts.where("kind = 1").repartition(1).sortWithinPartitions("shard", "seq").mapInArrow(_merge, MERGED_DDL))
    inner = parts.where("kind = 0").selectExpr(
        "conv_id", "depth", "parent_conv_id", "parent_key", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends as ends_sha256")
    above = spine.selectExpr("key as parent_key", "depth + 1 as depth", "conv_id as above")
    hung = inner.where("parent_key is not null").join(above, ["parent_key", "depth"]).drop("parent_conv_id").withColumnRenamed("above", "parent_conv_id")
    tails = keyed.join(known.selectExpr("conv_id", "size(sizes) as own", "n_turns"), "conv_id").where("pos > own").selectExpr(
        "conv_id", "pos + 1 as depth", "conv_id as parent_conv_id", "1L as n_convs", "if(pos + 1 < n_turns, 1L, 0L) as n_children",
        "1L as n_leaves", "0L as saved_tokens",
        f"if(pos + 1 < n_turns, '{NOTHING}', sha2(cast(conv_id as string), 256)) as ends_sha256",
    )
    out = inner.where("parent_key is null")
    for more in (hung, tails, spine):
        out = out.select(NODE).unionByName(more.select(NODE))
    return out


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The prefix trie of the rebuilt conversations of ``turns`` (conv_id, turn, role, text).

    Null role and text are empty; turns without conv_id belong to no conversation.  Repeated
    rows are turns of their own; ties in turn go by role, then by the text's digest.  Texts of
    any length count with all their bytes.  An empty table gives no node, not even a root.
    Other columns are ignored.
    """
    return trie(*rebuilt(turns.select("conv_id", "turn", "role", "text")))
