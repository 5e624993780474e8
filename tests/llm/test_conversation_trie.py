"""Prefix trie of conversations against brute force and reference SQL."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from compare import reference, spark_rows, sql_rows
from pyspark.sql import functions as F

from assayer.llm import conversation_trie as ct
from assayer.llm.oracle import ORACLE
from assayer.llm.queries import QUERIES


def brute(rows):
    """Nodes of the trie of rebuilt conversations, from (conv_id, turn, role, text)."""
    own: dict[int, list] = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, role, digest), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members: dict[tuple, list] = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, ids in members.items():
        below = [x for x in members if x[:len(node)] == node]
        children = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(y[:-1] == x and y for y in members)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        ends = ",".join(str(c) for c in sorted(ids) if len(built[c]) == len(node))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def nodes(df):
    return sorted((tuple(r) for r in df.select(ct.NODE).collect()), key=str)


def random_rows(seed, convs):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(convs * 2), convs):
        for k in range(rng.choice([1, 1, 2, 3, 9, 14])):
            rows.append((c, k, rng.choice(["user", "assistant"]) if rng.random() < 0.2 else "user", rng.choice(["a", "b", "éé", ""]) * (k < 6) + "z" * (k % 3)))
    return rows


def test_parentheses():
    rng = random.Random(4)
    for n in (1, 2, 40, 900):
        bits, open_now, opened = [1], 1, 1
        while opened < n or open_now > 1:
            up = opened < n and (open_now == 1 or rng.random() < 0.5 + 0.4 * (n == 900))
            bits.append(1 if up else -1)
            opened, open_now = opened + up, open_now + (1 if up else -1)
        bits.append(-1)
        tree = ct.Parentheses(np.array(bits, np.int8))
        stack, close = [], {}
        for i, b in enumerate(bits):
            if b > 0:
                stack.append(i)
            else:
                close[stack.pop()] = i
        assert {int(i): tree.findclose(int(i)) for i in tree.opens} == close
        behind, leaves = tree.subtrees()
        for v, i in enumerate(tree.opens):
            part = bits[i:close[i] + 1]
            assert behind[v] - v == part.count(1)
            assert leaves[v] == sum(a > 0 > b for a, b in zip(part, part[1:]))


@pytest.mark.parametrize("shards", ["1", "3", "40"])
def test_trie_equals_brute_force(spark, shards):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for seed in range(2):
            rows = random_rows(seed, 60)
            assert nodes(ct.prefix_trie(frame(spark, rows))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_sequence_over_many_shards(spark):
    """Conversations of one shared sequence lie in many shards and are one node each depth."""
    convs = spark.range(500).selectExpr("id as conv_id", "if(id % 50 = 0, 4L, 3L) as n_turns")
    turns = convs.selectExpr("conv_id", "explode(sequence(0L, n_turns - 1)) as pos").selectExpr(
        "conv_id", "pos", "if(pos = 3, conv_id, pos) as m1", "pos as m2", "10L as size")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.conv_id, r.depth): r for r in ct.trie(convs, turns).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 4 + 10 and got[0, 3].n_convs == 500
    assert (got[0, 0].n_children, got[0, 3].n_children, got[0, 0].n_leaves, got[0, 1].saved_tokens) == (1, 10, 10, 3 * 499 * 10)
    ids = ",".join(str(c) for c in range(500) if c % 50)
    assert got[0, 3].ends_sha256 == hashlib.sha256(ids.encode()).hexdigest() and got[50, 4].parent_conv_id == 0


def test_odd_rows(spark):
    rows = [(None, 0, "user", "x"), (1, None, None, None), (1, None, None, None), (1, 2, "user", None), (2, 0, "user", "long " * 50_000),
            (2, 0, "user", "long " * 50_000), (3, 1, "a", "t"), (3, 1, "b", "t"), (0, 0, "user", "q"), (5, None, "user", "")]
    df = frame(spark, rows).withColumn("depth", F.lit("clash")).withColumn("key", F.lit(None).cast("string"))
    assert nodes(ct.prefix_trie(df)) == brute(rows)
    assert ct.prefix_trie(df.limit(0)).count() == 0


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_reference_sql(spark, size):
    root = f"/root/testdata/{size}"
    assert spark_rows(QUERIES["op12_conversation_trie"](spark, root)) == sql_rows(reference(root), ORACLE["op12_conversation_trie"])


def test_query_equals_brute_force(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert nodes(QUERIES["op12_conversation_trie"](spark, data)) == brute(rows)
