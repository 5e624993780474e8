"""Profiles, against hand-worked results and against Spark's own aggregates."""

from __future__ import annotations

import datetime
import decimal
import math
import random

import pytest
from pyspark.sql import functions as F

from assayer.operators.percentiles import value_statistics
from assayer.operators.profile import PERCENTILES, profile, profile_tables, report


def by_field(df):
    return {r["field"]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [("NI", 1.0, 10, datetime.date(2020, 1, 2), 7), ("a", 2.0, 10, None, 7), ("b", 3.0, 20, None, 7),
         ("b", 4.0, None, None, 7), (None, 5.0, 30, datetime.date(2019, 1, 2), 7)],
        "SEX string, HT double, WT bigint, BORN date, DATE_CODE int",
    )


def test_text_and_date_columns(people):
    got = by_field(profile(people, "T"))
    sex = got["SEX"]
    assert (sex["cn"], sex["nd"], sex["n_null"], sex["n_ni"], sex["min_text"], sex["max_text"]) == (5, 3, 1, 1, "NI", "b")
    assert (sex["pct_dist"], sex["pct_null"], sex["pct_missing"]) == (60.0, 20.0, 20.0)
    assert sex["mean"] is None and sex["median"] is None
    born = got["BORN"]
    assert (born["nd"], born["n_null"], born["min_text"], born["max_text"]) == (2, 3, "2019-01-02", "2020-01-02")


def test_numeric_columns(people):
    got = by_field(profile(people, "T"))
    ht = got["HT"]
    assert (ht["min_num"], ht["p05"], ht["p25"], ht["median"], ht["p75"], ht["p95"], ht["max_num"]) == pytest.approx(
        (1.0, 1.2, 2.0, 3.0, 4.0, 4.8, 5.0))
    assert ht["mean"] == 3.0 and ht["n_ni"] is None and ht["pct_missing"] is None
    assert (got["WT"]["nd"], got["WT"]["n_null"], got["WT"]["median"]) == (3, 1, 15.0)
    assert "DATE_CODE" not in got


def test_filter_applies_to_every_column(people):
    got = by_field(profile(people, "T", only=("SEX", "b")))
    assert got["HT"]["cn"] == 2 and got["HT"]["median"] == 3.5
    assert got["SEX"]["nd"] == 1


def test_columns_without_values(spark):
    df = spark.createDataFrame([], "A string, B double")
    got = by_field(profile(df, "T"))
    assert (got["A"]["cn"], got["A"]["nd"], got["A"]["pct_null"]) == (0, 0, None)
    assert (got["B"]["nd"], got["B"]["median"]) == (0, None)
    nulls = by_field(profile(spark.createDataFrame([(None, None)], "A string, B double"), "T"))
    assert (nulls["A"]["nd"], nulls["B"]["nd"], nulls["B"]["pct_null"]) == (0, 0, 100.0)


def test_large_integers_stay_distinct(spark):
    big = 2 ** 53
    df = spark.createDataFrame(
        [(big, decimal.Decimal(big)), (big + 1, decimal.Decimal(big + 1))], "A bigint, B decimal(38,0)")
    got = by_field(profile(df, "T"))
    assert got["A"]["nd"] == 2 and got["B"]["nd"] == 2


def test_order_and_required_come_from_the_specification(spark, people):
    spec = spark.createDataFrame(
        [("T", "HT", 1, "Y"), ("T", "SEX", 2, "N")], "table string, field string, ordinal int, required string")
    rows = profile_tables({"T": people}, ["T", "ABSENT"], spec).collect()
    assert [r["field"] for r in rows][:1] == ["HT"]
    assert {r["field"]: r["required"] for r in rows}["HT"] == "Y"
    text = report(profile(people, "T")).collect()
    assert {r["field"]: (r["min"], r["max"]) for r in text}["HT"] == ("1.0", "5.0")


SAMPLES = {
    "ties": [float(random.Random(1).randrange(5)) for _ in range(500)],
    "spread": [random.Random(2).gauss(0, 1e6) for _ in range(1)] + [random.Random(i).gauss(0, 1e6) for i in range(400)],
    "crowded": [1e9 + i * 1e-6 for i in range(300)] + [-1e300, 1e300],
    "negative": [-(x ** 3) / 7 for x in range(101)],
    "single": [42.5],
    "zero and minus zero": [0.0, -0.0, 1.0],
    "unbounded": [float("-inf"), 1.0, 2.0, 3.0, float("inf"), float("inf")],
    "not a number": [1.0, 2.0, float("nan"), float("nan")],
}


@pytest.mark.parametrize("name", SAMPLES)
def test_percentiles_equal_the_built_in(spark, name):
    df = spark.createDataFrame([(0, v) for v in SAMPLES[name]], "column_id int, value double")
    counts = df.groupBy("column_id", "value").agg(F.count(F.lit(1)).alias("n"))
    got = value_statistics(counts, PERCENTILES).collect()[0]
    want = df.agg(F.percentile("value", list(PERCENTILES.values())).alias("p"), F.countDistinct("value").alias("nd")).collect()[0]
    assert got["nd"] == want["nd"]
    for p, w in zip(PERCENTILES, want["p"]):
        g = got[p]
        assert (math.isnan(g) and math.isnan(w)) or g == w or math.isclose(g, w, rel_tol=1e-12), (p, g, w)
