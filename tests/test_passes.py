"""Shared passes, radix selection, sketches, units and deaths against plain Python."""

from __future__ import annotations

import datetime
import random
import re
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayer.operators import age, grains, keys, links, percentiles, profile, replication, sketches, units
from assayer.operators.grains import Member, Use
from assayer.operators.keystate import LANES, Pass
from suite.projections import UNITS, frame

D = datetime.date


def found(df):
    return {r["check_id"]: (r["numerator"], r["denominator"]) for r in df.collect()}


# ---- key states --------------------------------------------------------------------

def key_tables(spark, seed):
    rng = random.Random(seed)
    rows = {t: [(rng.choice([None, *map(str, range(12))]), rng.choice([None, "p", "q", "r"]), rng.randint(0, 2)) for _ in range(n)]
            for t, n in (("A", 40), ("B", 25), ("C", 8), ("EMPTY", 0))}
    return rows, {t: spark.createDataFrame(r, "K string, U string, N int") for t, r in rows.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_key_states_against_plain_python(spark, seed):
    rows, tables = key_tables(spark, seed)
    one = Pass(tables)
    one.orphans(0, "A", "K", [("B", "K")])
    one.orphans(1, "A", "K", [("B", "K"), ("C", "K")])
    one.share(2, "C", "A", "K")
    one.primary_key(3, "B", ["K"])
    one.primary_key(4, "A", ["K", "N"])
    one.duplicated(5, "A", "K", "U")
    one.duplicated(6, "B", "K", "N")
    one.orphans(7, "EMPTY", "K", [("A", "K")])
    one.primary_key(8, "EMPTY", ["K"])
    held = {t: {k for k, *_ in r if k is not None} for t, r in rows.items()}

    def groups(t, key, value=lambda r: 1):
        out = {}
        for r in rows[t]:
            out.setdefault(key(r), []).append(value(r))
        return out

    def several(t, unit):
        return sum(len(set(v) - {None}) > 1 for v in groups(t, lambda r: r[0], unit).values())

    assert found(one.evidence()) == {
        0: (len(held["A"] - held["B"]), len(held["A"])), 1: (len(held["A"] - held["B"] - held["C"]), len(held["A"])),
        2: (len(held["C"]), len(held["A"])),
        3: (sum(len(v) > 1 for v in groups("B", lambda r: r[0]).values()), len(groups("B", lambda r: r[0]))),
        4: (sum(len(v) > 1 for v in groups("A", lambda r: (r[0], r[2])).values()), len(groups("A", lambda r: (r[0], r[2])))),
        5: (several("A", lambda r: r[1]), len(held["A"])), 6: (several("B", lambda r: r[2]), len(held["B"])),
        7: (0, 0), 8: (0, 0),
    }


def test_more_tables_than_a_word_of_bits_and_lanes(spark):
    tables = {f"T{k}": spark.range(k, k + 3).selectExpr("id as K", "id % 2 as U") for k in range(70)}
    one = Pass(tables)
    for k in range(70):
        one.orphans(k, f"T{k}", "K", [("T0", "K")])
    for k in range(LANES + 3):
        one.duplicated(100 + k, f"T{k}", "K", "U")
    got = found(one.evidence())
    assert [got[k] for k in (0, 1, 2, 3, 69)] == [(0, 3), (1, 3), (2, 3), (3, 3), (3, 3)]
    assert all(got[100 + k] == (0, 3) for k in range(LANES + 3))


def test_keys_of_several_types_meet(spark):
    whole = spark.createDataFrame([(1,), (2,)], "K int")
    long = spark.createDataFrame([(2,), (3,)], "K long")
    texts = spark.createDataFrame([("1",), ("x",)], "K string")
    check = links.link_evidence({"C": long, "P": whole}, {0: links.Link("C", "K")}, [("P", "K")])
    assert found(check) == {0: (1, 2)}
    check = links.link_evidence({"C": whole, "P": texts}, {0: links.Link("C", "K")}, [("P", "K")])
    assert found(check) == {0: (1, 2)}
    moments = spark.sql("select timestamp'2024-10-27 01:30:00' as K union all select timestamp'2024-10-27 01:30:00' + interval 1 hour")
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),)], "K double")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert found(keys.primary_key_evidence(moments, "K", 0)) == {0: (0, 2)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found(keys.primary_key_evidence(zeros, "K", 0)) == {0: (2, 2)}


def test_composite_keys_do_not_run_together(spark):
    df = spark.createDataFrame([("1:a", None), ("1", "a"), ("a", "1:"), (None, "1:a"), (None, None), (None, None)], "A string, B string")
    assert found(keys.primary_key_evidence(df, "A, B", 3)) == {3: (1, 5)}


def test_duplication_does_not_sort(spark):
    df = spark.range(1000).selectExpr("cast(id % 90 as string) as X", "cast(id % 7 as string) as PATID")
    check = keys.duplication_evidence({0: (df, "X", "PATID")})
    assert found(check) == {0: (90, 90)}
    plan = check._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Sort" not in plan and len(re.findall(r"hashpartitioning\(family", plan)) <= 2


# ---- counts by value ----------------------------------------------------------------

def test_members_share_a_scan_and_an_exchange(spark):
    df = spark.createDataFrame(
        [("IP", D(2024, m, 1), "09") for m in range(1, 13)] + [("AV", D(2023, m, 9), "x") for m in range(1, 13)] + [(None, None, None)],
        "ENC_TYPE string, DAY date, CODE string")
    members = {0: Member("T", "CODE", "CODE is not null"), 1: Member("T", "cast(year(DAY) * 100 + month(DAY) as string)", "DAY is not null"),
               2: Member("T", "ENC_TYPE", "ENC_TYPE = 'IP' and CODE = '09'"), 3: Member("T", "ENC_TYPE", "ENC_TYPE is not null")}
    uses = [Use(10, 0, "set"), Use(11, 1, "month"), Use(12, 2, "numerator", "IP"), Use(12, 3, "denominator", "IP"),
            Use(13, 2, "numerator", "AV"), Use(13, 3, "denominator", "AV")]
    allowed = spark.createDataFrame([(0, "09")], "member int, value string")
    check = grains.evidence({"T": df}, members, uses, allowed)
    # newest month 1 row; ranks 10 to 21 hold 12 months of one row
    assert found(check) == {10: (12, 24), 11: (12, 12), 12: (12, 12)}
    assert found(grains.evidence({"T": df}, members, uses, allowed, include_empty=True))[13] == (0, 12)
    assert found(grains.evidence({"T": df.limit(0)}, members, uses, allowed)) == {10: (0, 0), 11: (0, 0)}


# ---- percentiles ---------------------------------------------------------------------

def bits(value: float) -> int:
    if value != value:
        return (2047 << 52) + 1
    size = struct.unpack("<q", struct.pack("<d", abs(value)))[0]
    return -size if value < 0 else size


def test_order_keys_are_the_bits_of_doubles(spark):
    values = [0.0, -0.0, float("nan"), float("inf"), 5e-324, 2.225073858507201e-308, 1.7976931348623157e308, 1 / 3, 1e15 + 0.5]
    values += [2.0**k for k in range(-1074, 1024, 7)] + [float(np.nextafter(2.0**k, 0)) for k in range(-1073, 1024, 5)]
    df = spark.createDataFrame([(s * v,) for v in values for s in (1, -1)], "value double")
    for r in percentiles.with_order_key(df).collect():
        assert r["key"] == bits(r["value"]), r


@pytest.fixture(scope="module")
def samples():
    rng = np.random.default_rng(7)
    return {
        "two levels": np.concatenate([[1e300], 5 + rng.uniform(0, 1e-3, 60_000), 5 + rng.uniform(0, 1e-9, 90_000)]),
        "log uniform": 10.0 ** rng.uniform(-300, 300, 120_000) * rng.choice([-1, 1], 120_000),
        "ties": rng.integers(-2, 3, 5_000).astype(float), "one": np.array([3.5]),
    }


def test_selection_is_exact_and_its_windows_are_bounded(spark, samples):
    rows = spark.createDataFrame(
        [(k, x.tolist()) for k, x in enumerate(samples.values())], "column_id int, v array<double>"
    ).selectExpr("column_id", "explode(v) as value").repartition(8)
    counts = rows.groupBy("column_id", "value").count().withColumnRenamed("count", "n")
    got = {r["column_id"]: r for r in percentiles.value_statistics(counts, profile.PERCENTILES).collect()}
    for k, x in enumerate(samples.values()):
        assert got[k]["nd"] == len(np.unique(x))
        for name, p in profile.PERCENTILES.items():
            assert got[k][name] == pytest.approx(np.quantile(x, p), rel=1e-12)
    keyed = percentiles.with_order_key(counts)
    for above, shift in zip((64, *percentiles.ROUNDS), percentiles.ROUNDS):
        top = "0L" if above == 64 else f"shiftright(key, {above})"
        group = keyed.selectExpr("column_id", f"{top} as top", f"shiftright(key, {shift}) as bits").distinct().groupBy("column_id", "top").count()
        assert group.agg(F.max("count")).first()[0] <= 1 << 16


def test_profiles_of_numbers_beyond_doubles(spark):
    df = spark.createDataFrame([(2**53 + 1,), (2**53 + 3,), (None,)], "N long").withColumn("D", F.expr("cast(N as decimal(30,5))"))
    got = {r["field"]: r for r in profile.profile(df, "T").collect()}
    assert (got["N"]["min_exact"], got["N"]["max_exact"], got["N"]["nd"]) == (str(2**53 + 1), str(2**53 + 3), 2)
    assert got["D"]["min_exact"] == f"{2**53 + 1}.00000"
    assert {r["field"]: r["max"] for r in profile.report(profile.profile(df, "T")).collect()}["N"] == str(2**53 + 3)


# ---- sketches -------------------------------------------------------------------------

def test_sketches_of_parts_merge_within_their_errors(spark):
    df = spark.range(200_000).selectExpr("id", "cast(id % 70000 as string) as NAME", "pow(1.00005D, id) as VALUE",
                                         "if(id % 3 = 0, null, id) as HOLED", "id % 4 as part")
    whole = sketches.sketches(df.drop("part"), "T")
    merged = sketches.merge(sketches.sketches(df, "T", by="part").where("field <> 'PART'"))
    for made in (whole, merged):
        got = {r["field"]: r for r in sketches.estimates(made).collect()}
        assert got["NAME"]["nd"] == pytest.approx(70_000, rel=0.03) and got["ID"]["nd"] == pytest.approx(200_000, rel=0.03)
        assert (got["HOLED"]["cn"], got["HOLED"]["n_null"], got["ID"]["max_num"], got["NAME"]["max_text"]) == (200_000, 66_667, 199_999, "9999")
        for name, p in profile.PERCENTILES.items():
            rank = np.log(got["VALUE"][name]) / np.log(1.00005) / 200_000
            assert abs(rank - p) < 0.01, (name, rank)
    empty = {r["field"]: r for r in sketches.estimates(sketches.sketches(df.limit(0), "T")).collect()}
    assert (empty["VALUE"]["nd"], empty["VALUE"]["median"]) == (0, None)


# ---- units, deaths, replication ----------------------------------------------------------

JUDGED = {
    **UNITS, "((m))": True, "(mg/(dL.(h.d)))/L": True, "10^6/mL": True, "1/s": True, "ng/mL{FEU}": True, "{a}": True, "dam2": True,
    "/": False, "": False, "((m)": False, "m))": False, "()": False, "{a}{b}": False, "mg(l)": False, "{": False, "m.": False, ".m": False,
    "m/-2": False, "[iU": False, " mg": False, "Mg": True, "mG": False, "//m": False, "/m/s": True, "(/m)": True, "m-": False,
}


def test_units_by_grammar(spark):
    df = spark.createDataFrame([(u, v) for u, v in JUDGED.items()] + [(None, False)], "u string, judged boolean")
    wrong = df.where(f"judged <> {units.valid_code('u')}").collect()
    assert not wrong


def test_one_death_a_person(spark):
    rows = [("a", D(2001, 1, 1), "L"), ("a", D(2000, 1, 1), "X"), ("a", D(2002, 1, 1), "S"), ("b", None, "S"), ("b", D(1903, 5, 5), "L"),
            ("b", D(1902, 5, 5), "L"), ("c", None, "S"), (None, D(2000, 1, 1), "S"), ("d", D(9999, 12, 31), None), ("e", D(1, 1, 1), "L")]
    df = spark.createDataFrame(rows, "PATID string, DEATH_DATE date, DEATH_SOURCE string")
    for part in (df, df.orderBy(F.desc("DEATH_DATE")), df.repartition(5)):
        assert {tuple(r) for r in age.one_death(part, ["S", "L"]).collect()} == {
            ("a", D(2002, 1, 1)), ("b", D(1902, 5, 5)), ("c", None), ("d", D(9999, 12, 31)), ("e", D(1, 1, 1))}
    born = spark.createDataFrame([("a", D(1900, 1, 1)), ("b", D(1902, 1, 1)), ("b", D(1800, 1, 1))], "PATID string, BIRTH_DATE date")
    assert found(age.extreme_age_evidence(born, df, 0, D(2024, 1, 1))) == {0: (7, 3)}
    assert found(age.extreme_age_evidence(born, df, 0, D(2024, 1, 1), sources=["S", "L"])) == {0: (2, 3)}


def test_values_of_a_hot_key_are_spread(spark):
    """A key with very many values: no task holds much more than another."""
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = spark.range(300_000).selectExpr("if(id % 10 < 9, 'hot', 'k' || id) as key", "id as v0", "1L as p", "0L as c0")
        spread = replication.by_value(hot, 1, ["p", "c0"]).groupBy(F.spark_partition_id().alias("task")).count().collect()
        sizes = sorted(r["count"] for r in spread)
        assert len(sizes) == 16 and sizes[-1] <= 3 * sizes[len(sizes) // 2]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.enabled")
    parent = spark.range(4000).selectExpr("'hot' as ENCOUNTERID", "cast(id as string) as F")
    child = spark.range(3000).selectExpr("'hot' as ENCOUNTERID", "cast(id * 2 as string) as F")
    check = replication.replication_evidence({"P": parent, "C": child}, "P", "ENCOUNTERID", {0: ("C", "F")})
    assert found(check) == {0: (4000 * 3000 - 2000, 4000 * 3000)}


def test_values_of_one_pass_are_read_once(spark, tmp_path):
    frame(spark, "/root/testdata/sf0.001", "LAB_RESULT_CM").write.parquet(f"{tmp_path}/t")
    df = profile.profile(spark.read.parquet(f"{tmp_path}/t"), "LAB_RESULT_CM")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 2
