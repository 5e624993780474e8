"""URL filter, mixing and personal data against plain Python and reference SQL."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from compare import reference, spark_rows, sql_rows
from pyspark.sql import functions as F

from assayer.llm import mixing, pii, url_filter
from assayer.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_reference_sql(spark, data, name):
    assert spark_rows(QUERIES[name](spark, data)) == sql_rows(reference(data), ORACLE[name])


def test_urls_odd_rows(spark):
    rows = [
        (1, None, "x"), (2, "no scheme", "x"), (3, "HTTP://WWW.Example.COM/en/a?b#c", "x"), (3, "a://x.net/es/", "x"),
        (4, "a://x.com", "x"), (5, "a://net/fr/q", "x"), (6, "a://É.org", None),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(df).collect()}
    assert got == {
        (1, "", "", None, "allow"), (2, "", "", None, "allow"),
        (3, "www.example.com", "/en/a", "www.example.com/en/", "allow"), (3, "x.net", "/es/", "net/es/", "block"),
        (4, "x.com", "", None, "allow"), (5, "net", "/fr/q", "net/fr/", "block"), (6, "É.org", "", None, "allow"),
    }
    assert url_filter.filter_urls(df.limit(0)).count() == 0


def test_reputation_blocks_bad_hosts_only(spark):
    outcomes = [("bad.org", 1)] * 30 + [("good.org", 0)] * 30 + [("mixed.net", 0), ("mixed.net", 1)]
    known = url_filter.reputations(spark.createDataFrame(outcomes, "host string, bad int"))
    bound = {r.host: r.bound for r in known.collect()}
    assert bound["bad.org"] > 0.5 > max(bound["good.org"], bound["mixed.net"])


def _words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def _targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    stopped, total = set(), sum(sizes.values())
    while True:
        free = sum(weight[s] for s in names if s not in stopped)
        level = (total - sum(3 * sizes[s] for s in stopped)) / free if free else 0
        goal = {s: 3 * sizes[s] if s in stopped else level * weight[s] for s in names}
        more = {s for s in names if goal[s] > 3 * sizes[s] + 1e-9}
        if not more:
            return goal
        stopped |= more


def test_mixture(spark):
    rows = [(k, "w " * (k % 50), f"s{k % 7}" if k % 7 else None, 0) for k in range(1500)]
    rows += [(9999, "a b\u00a0c\td", "rare", 0)] * 2 + [(8888, None, "rare", 0), (None, "x y z", "s1", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.mixture(df, block=8, shard=256)
    out = [tuple(r) for r in got.collect()]
    assert sorted(map(str, out)) == sorted(map(str, (tuple(r) for r in mixing.mixture(df, block=8, shard=256).collect())))
    assert Counter((r[0], r[1]) for r in out) == Counter((k, _words(t)) for k, t, _, _ in rows)
    sizes = Counter()
    for _, text, source, _ in rows:
        sizes[source] += _words(text)
    goal = _targets(sizes)
    assert all(taken <= 3 * size for _, size, _, _, taken in out)
    source_of = {k: s for k, _, s, _ in rows}
    taken = Counter()
    for doc, _, source_size, target, words in out:
        source = source_of[doc]
        assert source_size == sizes[source] and target == pytest.approx(goal[source])
        taken[source] += words
    for source, words in goal.items():
        assert abs(taken[source] - words) <= max(0.03 * words, 16)
    assert mixing.mixture(df.limit(0)).count() == 0
    mixed = mixing.mixed_documents(df.withColumn("start", F.lit("s")), block=8, shard=256)
    assert mixed.columns == ["doc_id", "text", "source", "size", "start"]
    found = mixed.collect()
    assert sum(_words(r.text) for r in found) == sum(r[4] for r in out) and {(r["size"], r.start) for r in found} == {(0, "s")}


def test_words_are_taken_as_the_slots_say(spark):
    rows = [(k, "w " * (k % 31), f"s{k % 3}") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = df.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    goal, here = mixing.targets(sizes, (5, 2, 1), 3), mixing.placed(sizes.where("size > 0"))
    dealt = mixing.slots(goal, block=8, shard=64, most=3, seed=7).collect()
    by_source: dict[str, Counter] = {}
    for s in dealt:
        by_source.setdefault(s.source, Counter())[s.block] += 1
    total = {r.source: r.source_size for r in goal.collect()}
    for source, blocks in by_source.items():  # every epoch goes through all blocks before the next begins
        assert max(blocks.values()) - min(blocks.get(k, 0) for k in range(-(-total[source] // 8))) <= 1
        first = [s.block for s in sorted(dealt, key=lambda s: (s.shard, s.slot)) if s.source == source and s.epoch == 0]
        assert len(set(first)) == len(first)
    expected = {r.doc_id: sum(n * max(0, min(8 * b + 8, r.start + r.size) - max(8 * b, r.start)) for b, n in by_source[r.source].items())
                for r in here.collect()}
    got = {r.doc_id: r.taken for r in mixing.mixture(df, block=8, shard=64).collect()}
    assert got == {k: expected.get(k, 0) for k, _, _ in rows}


def test_block_permutations(spark):
    small = spark.range(1, 60).selectExpr("id as n", "explode(sequence(0L, id - 1)) as x").crossJoin(spark.range(2).withColumnRenamed("id", "e"))
    got: dict = {}
    for r in small.selectExpr("n", "e", "x", f"{mixing.permuted('x', 'n', 'e', '7')} as y").orderBy("n", "e", "x").collect():
        got.setdefault((r.n, r.e), []).append(r.y)
    assert all(sorted(ys) == list(range(n)) for (n, _), ys in got.items())
    assert all(got[n, 0] != got[n, 1] for n in range(20, 60))
    steps = Counter(b - a for a, b in zip(got[59, 0], got[59, 0][1:]))
    assert max(steps.values()) < 12
    for n in (10**10, 10**12, 2**62):
        big = spark.range(300).selectExpr(f"{n}L as n", f"id * {n // 301}L as x")
        ys = [r.y for r in big.selectExpr(f"{mixing.permuted('x', 'n', 'n', '7')} as y").collect()]
        assert len(set(ys)) == 300 and 0 <= min(ys) and max(ys) < n and 0.35 * n < sum(ys) / 300 < 0.65 * n


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and _luhn(re.sub("[^0-9]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def _luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


ODD = [
    None, "", "é a@b.com@c.de x", "a@b.com_x@y.org", "1.2.3.4.5.6.7.8 300.1.1.1 00001.2.3.4", "4111 1111 1111 1111",
    "4111-1111-1111-1111 5", "+1 (743) 555-3824 +49 30 1234567, +5", "\U0001F600 me@x.io", "7" * 3000, "x" * 50_000,
    "a." * 3000 + "@", "1 " * 4000, "IBAN GB82 WEST 1234 5698 7654 32.", "ssn 078-05-1120", "+1234567890123452 x",
]


def test_personal_data(spark, data):
    rows = [(k, t, "s") for k, t in enumerate(ODD)] + [(2, ODD[2], "s")]
    texts = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").limit(150).collect()
    rows += [(1000 + r.doc_id, r.text, "s") for r in texts]
    got = {r.doc_id: r for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()}
    for doc, text, _ in rows:
        found = [(k, m.start(), m.end()) for k, p, ok in BASE for m in re.finditer(p, text or "") if ok(m[0])]
        row = got[doc]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(f[0] == k for f in found) for k, _, _ in BASE]
        joined = ",".join("%s:%d:%d" % f for f in found)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert row.spans.startswith(joined)
    assert got[13].spans.endswith("iban:5:32") and got[14].spans.endswith("ssn:4:15")


def test_ibans_before_capitals(spark):
    texts = {
        "IBAN GB82 WEST 1234 5698 7654 32 BIC WESTGB2L": ["GB82 WEST 1234 5698 7654 32"],
        "IBAN DE89370400440532013000 BIC COBADEFFXXX": ["DE89370400440532013000"],
        "NO9386011117947 NO9386011117947 X": ["NO9386011117947"] * 2,
        "IBAN DE89370400440532013001 BIC COBADEFFXXX": [],
    }
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in pii.report(df).collect():
        text = rows[r.doc_id][1]
        spans = [s.split(":") for s in r.spans.split(",") if s.startswith("iban")]
        assert [text[int(a) : int(b)] for _, a, b in spans] == texts[text], text


def test_redaction(spark):
    df = spark.createDataFrame([(1, "é me@x.io, 1.2.3.4!", 9, "k"), (2, None, None, "k"), (3, "", 0, "k")], "doc_id long, text string, n_chars long, spans string")
    got = pii.redacted(df)
    assert got.columns == df.columns
    assert {tuple(r) for r in got.collect()} == {(1, "é [EMAIL], [IP]!", 16, "k"), (2, None, None, "k"), (3, "", 0, "k")}


def test_unlabelled_hosts_are_judged_by_their_relatives(spark):
    hosts = [f"h{k}.bad.org" for k in range(40)] + [f"h{k}.fine.org" for k in range(40)]
    outcomes = spark.createDataFrame(
        [(h, int(".bad." in h)) for h in hosts for _ in range(5)], "host string, bad int"
    )
    rows = [(1, "http://new.bad.org/a"), (2, "http://new.fine.org/a"), (3, "http://h3.bad.org/"), (4, "http://other.xyz/"), (5, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(pages, rules=(), outcomes=outcomes).collect()}
    assert got == {1: "block", 2: "allow", 3: "block", 4: "allow", 5: "allow"}
