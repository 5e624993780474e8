"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
from pyspark.sql import functions as F

from assayer.llm import periodic_runs
from assayer.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if all(a == b for a, b in zip(words, words[q:])))


def brute(words):
    """Every maximal stretch of every lag, kept when the lag is its smallest period."""
    out, n = [], len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q) and smallest_period(words[i:j + q]) == q:
                out.append((i, j - i + q, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n and text is not None:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def odd_sequences():
    rng = random.Random(5)
    yield []
    yield [1] * 23
    yield [1] * 24
    yield [1, 2] * 40 + [1]
    yield ([1] * 30 + [2]) * 4                      # runs inside a run
    yield [1, 1, 2] * 9 + [3] + [1, 2, 1] * 9
    for _ in range(150):
        out = []
        for _ in range(rng.randint(1, 5)):
            block = [rng.randint(0, rng.choice([1, 2, 5, 40])) for _ in range(rng.randint(1, 30))]
            out += (block * rng.randint(1, 12))[: rng.randint(1, 140)]
        yield out


def test_runs_equal_brute_force():
    for ids in odd_sequences():
        got = periodic_runs.runs_of(np.array(ids, np.int32))
        assert got == brute(ids), ids
        keep = periodic_runs.collapsed_words(len(ids), got)
        assert keep.tolist() == [not any(s + q <= i < s + m for s, m, q in got) for i in range(len(ids))]


def test_splitting_loses_no_run_and_keeps_only_frequent_words():
    for ids in odd_sequences():
        parts = periodic_runs.surviving(np.array(ids, np.int32))
        for s, m, _ in brute(ids):
            assert any(lo <= s and s + m <= hi for lo, hi in parts)
        for lo, hi in parts:
            assert hi - lo >= 24 and all(ids[lo:hi].count(w) >= 3 for w in ids[lo:hi])


def test_long_texts_take_seconds():
    rng = np.random.default_rng(1)
    same = np.zeros(300_000, np.int32)
    few = rng.integers(0, 50, 300_000).astype(np.int32)
    tail = np.concatenate([np.arange(200_000), np.tile(np.arange(25_000), 4)]).astype(np.int32)
    onion = np.concatenate([np.repeat(np.arange(50_000), 2), np.repeat(np.arange(50_000)[::-1], 1)]).astype(np.int32)
    began = time.time()
    assert periodic_runs.runs_of(same) == [(0, 300_000, 1)]
    assert periodic_runs.runs_of(few) == []
    assert (200_000, 100_000, 25_000) in periodic_runs.runs_of(tail)
    assert periodic_runs.runs_of(onion) == []
    assert time.time() - began < 60


def test_words_are_not_cut_between_pieces():
    text = "ab  cde\tf " * 50
    assert [w for p in periodic_runs.pieces(text, WORD, 7) for w in p] == WORD.findall(text)


def test_odd_rows(spark):
    long = " ".join(f"w{k}" for k in range(5000)) + " x y z" * 3000
    rows = [(1, None, 5, "a"), (2, "", 5, "a"), (3, " \n", 5, "a"), (4, "a b " * 12, 5, None), (4, "a b " * 12, 5, None),
            (None, "é " * 30, None, "q"), (6, long, 1, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int, collapsed string")
    got = periodic_runs.periodic_runs(df.withColumn("Extra", F.lit(1)))
    assert got.columns == ["doc_id", "text", "Extra", "n_words", "runs", "collapsed"]
    by_id = {r.doc_id: r for r in got.collect()}
    assert [by_id[i].n_words for i in (1, 2, 3, 4, None)] == [0, 0, 0, 24, 30]
    assert by_id[1].runs == [] and by_id[1].collapsed == ""
    assert [tuple(r) for r in by_id[4].runs] == [(0, 24, 2)] and by_id[4].collapsed == "a b"
    assert [tuple(r) for r in by_id[6].runs] == [(5000, 9000, 3)]
    assert got.count() == len(rows) and periodic_runs.periodic_runs(df.limit(0)).count() == 0


def test_query_equals_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in QUERIES["op11_periodic_runs"](spark, data).collect())
    small = {r.doc_id: r.text for r in docs if len(r.text or "") < 12_000}
    assert len(got) == len(docs) and len(small) > len(docs) * 0.9
    for row in got:
        if row[0] in small:
            assert row == expected(row[0], small[row[0]])
