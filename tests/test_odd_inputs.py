"""Odd manifests and column types give rows of the report, and right ones."""

from __future__ import annotations

import datetime

import pytest

from assayer.operators import keys, percentiles, replication, values
from assayer.plans.manifest import manifest_frame
from assayer.plans.run import run_checks


def _results(spark, tables, rows, **given):
    found = run_checks(tables, manifest_frame(spark, rows), as_of=datetime.date(2024, 1, 1), **given).collect()
    return {(r["test"], r["table"], r["field"]): r for r in found}


@pytest.fixture(scope="module")
def vital(spark):
    rows = [("e1", 60.5, datetime.date(2020, 1, 1), "70"), ("e2", None, None, "abc"), ("e3", 4.0, None, "9999")]
    return spark.createDataFrame(rows, "ENCOUNTERID string, HT double, MEASURE_DATE date, WT string")


def test_missing_and_extreme_on_any_type(spark, vital):
    got = _results(spark, {"VITAL": vital}, [
        ("VITAL", "HT", "DC 1.07"), ("VITAL", "MEASURE_DATE", "DC 1.07"), ("VITAL", "WT", "DC 2.02"),
    ])
    assert got["DC 1.07", "VITAL", "HT"]["numerator"] == 1
    assert got["DC 1.07", "VITAL", "MEASURE_DATE"]["numerator"] == 2
    assert got["DC 2.02", "VITAL", "WT"]["numerator"] == 1  # 9999; abc is no number


def test_rows_that_cannot_be_measured_are_reported(spark, vital):
    got = _results(spark, {"VITAL": vital}, [
        ("VITAL", None, "DC 1.07"), ("VITAL", None, "DC 1.05"), ("VITAL", None, "DC 1.13"), ("VITAL", "ENCOUNTERID", "DC 2.02"),
    ])
    assert len(got) == 4 and all(r["result"] is None for r in got.values())


def test_value_sets_whatever_the_case_of_names(spark):
    table = spark.createDataFrame([("F",), ("Q",)], "sex string")
    sets = spark.createDataFrame([("DEMOGRAPHIC", "SEX", "F")], "table string, field string, item string")
    for field in ("SEX", "sex"):
        found = values.invalid_values({"DEMOGRAPHIC": table}, [("DEMOGRAPHIC", field)], sets).collect()
        assert [r["value"] for r in found] == ["Q"]


def test_replicated_moments(spark):
    parent = [("e", datetime.datetime(2024, 1, 1, 10), datetime.datetime(2024, 1, 1, 10))]
    child = [("e", datetime.datetime(2024, 1, 1, 11), datetime.datetime(2024, 1, 1, 11))]
    schema = "ENCOUNTERID string, ADMIT_DATE timestamp, SEEN timestamp"
    tables = {"ENCOUNTER": spark.createDataFrame(parent, schema), "DIAGNOSIS": spark.createDataFrame(child, schema)}
    found = replication.replication_evidence(
        tables, "ENCOUNTER", "ENCOUNTERID", {0: ("DIAGNOSIS", "ADMIT_DATE"), 1: ("DIAGNOSIS", "SEEN")}
    )
    assert {r["check_id"]: (r["numerator"], r["denominator"]) for r in found.collect()} == {0: (0, 1), 1: (1, 1)}


def test_duplication_is_one_shuffle_by_value(spark):
    rows = [("a", "1"), ("a", "1"), ("a", None), ("b", "1"), ("b", "2"), (None, "1"), (None, "2"), ("c", None)]
    df = spark.createDataFrame(rows, "X string, PATID string")
    found = keys.duplication_evidence({0: (df, "X", "PATID")})
    assert found.select("numerator", "denominator").first() == (2, 3)


def test_percentiles_of_values_crowded_near_zero(spark):
    df = spark.range(20001).selectExpr("0 as column_id", "pow(10D, -300 + 300 * id / 20000) as value", "1L as n")
    assert percentiles.__doc__
    low = df.selectExpr("min(value)").first()[0]
    # every part of the grid's first scale is used, not the last one alone
    used = df.selectExpr(f"floor((1 + ln(value) - ln({low!r}D)) / 691 * 100) as cell").distinct().count()
    assert used > 95
