"""Near duplicates, byte pairs and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from assayer.llm import byte_bpe, embeddings, minhash
from assayer.llm.components import components

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _roots(ids, linked):
    root = {i: i for i in ids}

    def of(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = of(a), of(b)
        root[max(a, b)] = min(a, b)
    return {i: of(i) for i in ids}


def test_components(spark):
    pairs = [(k, k + 1) for k in range(60)] + [(100, 100), (201, 200), (200, 201), (None, 3), (300, 301), (300, 302)]
    got = {r.id: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, 200: 200, 201: 200, 300: 300, 301: 300, 302: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = minhash.mix(rng.integers(1, 1 << 60, 900).astype(np.uint64))
    for shared in (0, 300, 500):
        same = np.mean([
            np.mean(minhash.signature(minhash.mix(pool[:600] + np.uint64(s)), 200) == minhash.signature(minhash.mix(pool[600 - shared : 1200 - shared] + np.uint64(s)), 200))
            if len(pool[600 - shared : 1200 - shared]) else 0.0 for s in range(4)
        ])
        b = len(pool[600 - shared : 1200 - shared])
        assert abs(same - shared / (600 + b - shared)) < 0.08
    assert len(minhash.signature(pool[:1], 100)) == 100


def test_near_copies(spark):
    random.seed(3)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = []
    for k in range(60):
        words = random.choices(vocabulary, k=random.randint(3, 150))
        texts.append(" ".join(words))
        for _ in range(k % 4):
            words = list(words)
            words[random.randrange(len(words))] = "new"
            texts.append(" ".join(words))
    rows = list(enumerate(texts)) + [(900, texts[0]), (900, texts[0]), (901, None), (902, ""), (903, " "), (904, "x"), (905, "x")]
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, class_id int")
    sets = {}
    for k, t in rows:
        w = (t or "").split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(sets)
    linked = [(a, b) for a in ids for b in ids if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    got = minhash.classes(df).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.class_id for r in got} == _roots(ids, linked)
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)
    kept = minhash.without_copies(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(_roots(ids, linked).values()))
    assert minhash.classes(df.limit(0)).count() == 0
    null = spark.createDataFrame([(None, "q r s"), (3, "q r s"), (None, "other")], "doc_id long, text string")
    assert sorted(r.class_id for r in minhash.classes(null).collect())[:2] == [3, 3]


def test_crowded_family_of_unlike_texts(spark):
    """A shared passage puts all texts near 0.79 of each other; every third pair is at 0.82."""
    passage = [f"p{k}" for k in range(92)]
    rows = []
    for k in range(0, 160, 2):
        own = 88 + 4 + (2 if k % 3 == 0 else 0)
        start = passage[:92] + [f"s{k}" for _ in range(own - 92)]
        for doc in (k, k + 1):
            words = start + [f"d{doc}x{j}" for j in range(104 - own)]
            rows.append((doc, " ".join(words)))
    sets = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for d, t in rows for w in [t.split()]}
    like = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b}
    linked = [p for p, s in like.items() if s >= 0.8]
    assert len(linked) == 27 and 0.78 < min(like.values())
    got = minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == _roots(sorted(sets), linked)


def test_embeddings(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    v = np.concatenate([base, base + 0.05 * rng.normal(size=base.shape), base[:20] + 0.02 * rng.normal(size=(20, 16)), base[:5], base[:3] * 2])
    rows = [(k, [float(x) for x in w], k % 2) for k, w in enumerate(v)]
    bad = [(500, None, 0), (501, [0.0] * 16, 0), (502, [float("nan")] * 16, 0), (503, [None] * 16, 0), (504, rows[0][1], None), (505, [], 0), (506, [1.0, 0.0], 0), (507, [1.0, 0.0], 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame([(*r, 1) for r in rows + bad], "vec_id long, embedding array<double>, label int, links int")
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    near = unit @ unit.T >= 0.98
    linked = [(a, b) for a in range(len(v)) for b in range(a) if near[a, b] and a % 2 == b % 2] + [(506, 507)]
    ids = [r[0] for r in rows] + [r[0] for r in bad if r[0] is not None]
    got = embeddings.near_duplicates(df).collect()
    assert len(got) == len(rows) + len(bad)
    roots = _roots(ids, linked)
    for r in got:
        if r.vec_id is not None:
            assert r.component_id == roots[r.vec_id] and r.n_links == sum(r.vec_id in p for p in linked)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks_of(PATH), special_tokens={})


def test_byte_pairs(spark, tokenizer):
    texts = [
        None, "", " ", "\n\n \t x", "don't we'll", "a\u00a0b\u2003\u3000 c\x85d\x1ce", "日本語 ñandú 😀👩‍👩‍👧", "${x} \\' \" % _ `", "\x00\x01\x7f",
        "aaaa" * 30, "x" * 700, " " * 400 + "y", "<|endoftext|>", "١٢٣ ½²", "e\u0301", "The quick brown fox. " * 40,
        "".join(random.Random(4).choices("漢字語文章本日月火水木金土", k=34_000)), "ab" * 129, "abc" * 40_000,
    ]
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)] + [(1, "", 1)], "doc_id long, text string, ids int")
    for clashing in ("block", "words", "k", "rows"):
        df = df.withColumn(clashing, F.lit(1))
    assert byte_bpe.encoded(df, PATH, public_tokenizers.PATTERN).columns == [c for c in df.columns if c != "ids"] + ["ids"]
    again = byte_bpe.digests(df.coalesce(1), PATH, public_tokenizers.PATTERN, most=3, table=2).collect()
    got = byte_bpe.digests(df, PATH, public_tokenizers.PATTERN).collect()
    assert sorted(again) == sorted(got)
    assert len(got) == len(texts) + 1
    for r in got:
        ids = tokenizer.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids), texts[r.doc_id]
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    both = byte_bpe.encoded(df, PATH, public_tokenizers.PATTERN, also=("decoded", "text"))
    assert both.columns == [c for c in df.columns if c not in ("ids", "text")] + ["ids", "decoded", "text"]
    for r in byte_bpe.decoded(both, PATH, to="again", packed="block").collect():
        assert r.again == r.decoded == (texts[r.doc_id] or "").encode() and r.block == r.text
    assert byte_bpe.digests(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_pipeline(spark, data, tokenizer):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, data)
        assert out.columns == docs.columns, name
    done = corpus_pipeline.run(spark, data)
    rows = done.where(F.col("doc_id") % 7 == 0).collect()
    assert done.where("not round_trip").count() == 0 and rows
    for r in rows[:20]:
        assert r.ids == tokenizer.encode_ordinary(tokenizer.decode(r.ids))


def test_unlike_texts_of_a_family_hardly_meet(spark):
    """Texts just under 0.8 to each other share bands; their own words keep them from meeting."""
    rows = []
    for k in range(300):
        own = 12 if k % 100 else 10
        words = [f"p{j}" for j in range(104 - own)] + [f"d{k}x{j}" for j in range(own)]
        rows.append((k, " ".join(words)))
    df = spark.createDataFrame(rows, "id long, text string")
    ids = df.select("id")
    sets = minhash.shingled(df, ids)
    first = minhash.prefixes(sets).withColumn("root", F.col("id"))
    met = {(r.a, r.b) for r in minhash.meetings(first, first).collect()}
    words = {d: t.split() for d, t in rows}
    each = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for d, w in words.items()}
    linked = [(b, a) for a in each for b in each if a < b and len(each[a] & each[b]) >= 0.8 * len(each[a] | each[b])]
    assert set(linked) <= met and len(linked) == 3 and len(met) < 300
    got = minhash.classes(df.withColumnRenamed("id", "doc_id")).collect()
    assert {r.doc_id: r.class_id for r in got} == _roots(sorted(each), linked)


def test_byte_pair_plans_hold_no_ranks(spark):
    """Spark keeps the text of each plan, in the driver and in its log: megabytes of literals add up there."""
    df = spark.createDataFrame([(1, "unseen wordings " * 3)], "doc_id long, text string")
    words = df.selectExpr("array(array(113, 117, 117, 120)) as word")
    folded = byte_bpe.folded(words, "word", PATH)
    for made in (folded, byte_bpe.digests(df, PATH, public_tokenizers.PATTERN)):
        assert len(made._jdf.queryExecution().toString()) < 100_000
    ranks = byte_bpe.ranks_of(PATH)
    assert folded.columns == ["word"] and folded.collect() == [([byte_bpe.merged(b"quux", ranks)],)]
