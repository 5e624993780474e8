"""Whole runs: reference SQL, fused against single plans, plans themselves, sinks."""

from __future__ import annotations

import datetime
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import reference, spark_rows, sql_rows
from assayer.model import RESULT_COLUMNS
from assayer.operators import row
from assayer.operators.profile import profile, report
from assayer.plans.manifest import Settings, derive_manifest, manifest_frame
from assayer.plans.run import run_checks
from assayer.sources import control, registry, sinks
from suite import fixtures
from suite.oracle import ORACLE
from suite.projections import frames
from suite.queries import QUERIES, AS_OF



@pytest.fixture(scope="module")
def con(data):
    return reference(data)


@pytest.fixture(scope="module")
def tables(spark, data):
    return frames(spark, data)


def run(spark, tables, rows=fixtures.MANIFEST, **options):
    return run_checks(tables, manifest_frame(spark, rows), fixtures.specification(spark),
                      fixtures.value_sets(spark), as_of=AS_OF, **options)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_reference_sql(spark, data, con, name):
    assert spark_rows(QUERIES[name](spark, data)) == sql_rows(con, ORACLE[name])


def test_entry(spark):
    assert entry.entry(spark).columns == ["test", "table", "field", "group", "numerator", "denominator", "value", "result"]


def test_fused_run_equals_one_plan_per_row(spark, tables):
    columns = [c for c in RESULT_COLUMNS]
    fused = run(spark, tables).select(*columns)
    single = run(spark, tables, fused=False).select(*columns)
    assert spark_rows(fused) == spark_rows(single)


def test_result_does_not_depend_on_partitions(spark, tables):
    spread = {name: df.repartition(7) for name, df in tables.items()}
    assert spark_rows(run(spark, tables)) == spark_rows(run(spark, spread))


def test_empty_tables_raise_nothing(spark, tables):
    empty = {name: df.limit(0) for name, df in tables.items()}
    got = run(spark, empty).collect()
    assert got
    for r in got:
        if r["value"] is None:
            assert r["result"] == ("FAIL" if r["test"] == "DC 1.02" else None)


def test_absent_tables_and_columns_give_a_row_without_result(spark, tables):
    some = {"DIAGNOSIS": tables["DIAGNOSIS"].drop("DX")}
    rows = [("DIAGNOSIS", "DX", "DC 1.07"), ("VITAL", "HT", "DC 2.02"), ("DIAGNOSIS", None, "DC 1.08")]
    got = run(spark, some, rows).collect()
    assert [(r["numerator"], r["result"]) for r in got] == [(None, None)] * 3


def test_observed_lengths_in_a_run(spark, tables):
    found = run(spark, tables, [(None, None, "DC 1.04")], settings=Settings(lengths="observed"))
    lengths = {(r["table"], r["field"]) for r in found.where("`group` = 'length'").collect()}
    assert ("DIAGNOSIS", "DX") in lengths and ("DEMOGRAPHIC", "SEX") not in lengths


def test_unknown_test_gives_no_row(spark, tables):
    assert run(spark, tables, [("DIAGNOSIS", "DX", "DC 9.99")]).collect() == []


def test_row_checks_of_a_table_share_one_scan(spark, tables):
    rows = [r for r in fixtures.MANIFEST if r[0] == "VITAL"] + [
        ("VITAL", f, "DC 2.02") for f in ("WT", "DIASTOLIC", "SYSTOLIC")
    ] + [("VITAL", "MEASURE_DATE", "DC 1.07")]
    df = run(spark, tables, rows)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" parquet") == 1
    schema = re.search(r"ReadSchema: struct<([^>]*)>", final_plan(df)).group(1)
    assert set(c.split(":")[0] for c in schema.split(",")) == {"l_partkey", "l_quantity", "l_shipdate"}


def test_plans_have_no_products_and_no_global_window(spark, tables):
    for df in (run(spark, tables), profile(tables["VITAL"], "VITAL")):
        plan = final_plan(df)
        assert "CartesianProduct" not in plan
        assert "BroadcastNestedLoopJoin" not in plan
        assert not re.search(r"Window \[[^\]]*\], \[\]", plan)


def test_filters_and_columns_reach_the_files(spark, tables, tmp_path):
    stored = {}
    for name in ("ENCOUNTER", "DIAGNOSIS", "DEMOGRAPHIC"):
        tables[name].write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_path}/{name}")

    def scans(rows):
        plan = final_plan(run(spark, stored, rows)).split("== Initial Plan ==")[0]
        return [
            (set(re.findall(r"(\w+):", m[2])), m[1])
            for m in re.finditer(r"PushedFilters: \[(.*?)\], ReadSchema: struct<([^>]*)>", plan)
        ]

    months = scans([("DIAGNOSIS", "ADMIT_DATE", "DC 3.07")])
    assert months == [({"ADMIT_DATE", "ENC_TYPE"}, "IsNotNull(ADMIT_DATE)")]
    events = scans([("DIAGNOSIS", "DX", "DC 3.01")])
    assert {frozenset(c) for c, _ in events} == {frozenset({"ENC_TYPE"}), frozenset({"ENC_TYPE", "DX_TYPE"})}
    assert all("In(ENC_TYPE" in f for _, f in events)
    orphans = scans([("DIAGNOSIS", None, "DC 1.08"), ("ENCOUNTER", None, "DC 1.08")])
    assert orphans == [({"PATID"}, "IsNotNull(PATID)")] * 3


def test_links_shuffle_the_parent_once(spark, tables):
    rows = [(t, None, "DC 1.08") for t in ("ENCOUNTER", "DIAGNOSIS", "PROCEDURES", "PRESCRIBING", "CONDITION")]
    rows += [("DIAGNOSIS", "DX", "DC 3.04"), ("PROCEDURES", "PX", "DC 3.05")]
    plan = run(spark, tables, rows)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Aggregate \[family#\d+, key#\d+\]", plan)) == 1
    assert plan.count(" parquet") == 8 and "LeftAnti" not in plan  # two tables join two files, four read one


def test_percentiles_read_the_table_once(spark, tables):
    df = profile(tables["VITAL"].select("HT", "WT"), "VITAL")
    plan = final_plan(df).split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 2  # one for counts and ranges, one for values
    assert plan.count("ReusedExchange") >= 3


def test_more_measures_than_one_pass_holds(spark):
    df = spark.range(10).selectExpr(*[f"if(id % {i + 2} = 0, null, 'A') as C{i}" for i in range(70)])
    measures = {i: row.missing_or_unknown("T", f"C{i}", "DC 1.07", 0) for i in range(70)}
    got = {r["check_id"]: r["numerator"] for r in row.row_evidence(df, measures).collect()}
    assert got == {i: len([k for k in range(10) if k % (i + 2) == 0]) for i in range(70)}


def test_names_and_values_are_quoted(spark):
    df = spark.createDataFrame([("it's \\ x", 1)], "`odd name` string, other int")
    from assayer.operators import values

    sets = spark.createDataFrame([("T", "odd name", "it's \\ x")], "table string, field string, item string")
    e = values.value_set_evidence({"T": df}, {0: ("T", "odd name")}, sets)
    assert e.collect()[0]["numerator"] == 0
    assert row.row_evidence(df, {0: row.missing_or_unknown("T", "odd name", "DC 1.07", 0)}).collect()[0]["numerator"] == 0


def test_derived_manifest(spark):
    spec = spark.createDataFrame(
        [("DEMOGRAPHIC", "PATID", 1, "Y", "P"), ("DEMOGRAPHIC", "SEX", 2, "N", None),
         ("ENCOUNTER", "ENCOUNTERID", 1, "Y", "P"), ("ENCOUNTER", "PATID", 2, "Y", None),
         ("ENCOUNTER", "PROVIDERID", 3, "N", None), ("ENCOUNTER", "ADMIT_DATE", 4, "Y", None),
         ("DIAGNOSIS", "DIAGNOSISID", 1, "Y", "P"), ("DIAGNOSIS", "PATID", 2, "Y", None),
         ("DIAGNOSIS", "ENCOUNTERID", 3, "N", None), ("DIAGNOSIS", "ENC_TYPE", 4, "N", None),
         ("VITAL", "HT", 1, "N", None)],
        "table string, field string, ordinal int, required string, primary string")
    rows = {(r["table"], r["field"], r["test"])
            for r in derive_manifest(spec, fixtures.value_sets(spark), {"DEMOGRAPHIC": "PATID, SEX"}).collect()}
    for expected in [
        (None, None, "DC 1.01"), ("DEMOGRAPHIC", "PATID, SEX", "DC 1.05"), ("ENCOUNTER", "ENCOUNTERID", "DC 1.05"),
        ("DEMOGRAPHIC", "SEX", "DC 1.06"), ("ENCOUNTER", "ADMIT_DATE", "DC 1.07"), ("ENCOUNTER", None, "DC 1.08"),
        ("DIAGNOSIS", None, "DC 1.09"), ("DIAGNOSIS", "ENC_TYPE", "DC 1.10"), ("DIAGNOSIS", "ENCOUNTERID", "DC 1.11"),
        ("ENCOUNTER", "PROVIDERID", "DC 1.12"), ("DIAGNOSIS", None, "DC 1.13"), ("VITAL", "HT", "DC 2.02"),
        ("DEMOGRAPHIC", "AGE", "DC 2.02"), ("ENCOUNTER", "ADMIT_DATE", "DC 3.07"),
    ]:
        assert expected in rows
    assert ("DEMOGRAPHIC", None, "DC 1.08") not in rows
    assert ("DEMOGRAPHIC", "RACE", "DC 1.06") not in rows


# ---- sources and sinks -------------------------------------------------------------

def test_control_files(spark, tmp_path):
    (tmp_path / "manifest.csv").write_text('table,field,test\n,,DC 1.01\nT,"A, B",DC 1.05\n')
    got = [tuple(r) for r in control.read_manifest(spark, str(tmp_path / "manifest.csv")).collect()]
    assert got == [(None, None, "DC 1.01"), ("T", "A, B", "DC 1.05")]
    (tmp_path / "sets.csv").write_text("TABLE_NAME,FIELD_NAME,VALUESET_ITEM\nT,F,01\n")
    assert [tuple(r) for r in control.read_valuesets(spark, str(tmp_path / "sets.csv")).collect()] == [("T", "F", "01")]
    (tmp_path / "units.csv").write_text("unit\nmg/dL\n")
    assert control.read_units(spark, str(tmp_path / "units.csv")).collect()[0]["unit"] == "mg/dL"
    (tmp_path / "spec.csv").write_text(
        "Table,key,Field,Order,Required,Primary,Oracle_dtype,mssql_dtype,postgres_dtype,mysql_dtype,LENGTH\n"
        "T,F,F,1,Y,P,VARCHAR2,VARCHAR,varchar,varchar,2\n")
    assert tuple(control.read_metadata(spark, str(tmp_path / "spec.csv"), "mssql").collect()[0]) == (
        "T", "F", 1, "Y", "P", "string", 2)


def test_files_and_session_tables(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    df.write.parquet(str(tmp_path / "T.parquet"))
    df.write.option("header", True).csv(str(tmp_path / "U.csv"))
    assert registry.open_directory(spark, str(tmp_path), ["T"])["T"].count() == 1
    got = registry.open_files(spark, {"u": str(tmp_path / "U.csv")}, "csv", header=True)
    assert got["U"].columns == ["k", "n"]
    df.createOrReplaceTempView("session_table")
    assert registry.open_database(spark, ["session_table"])["SESSION_TABLE"].count() == 1


def test_database_reads_are_split(spark, monkeypatch):
    from types import SimpleNamespace

    calls = []
    fake = SimpleNamespace(read=SimpleNamespace(jdbc=lambda *a, **k: calls.append((a, k))))
    registry.open_jdbc(fake, "jdbc:x", ["A", "B", "C"], "s", {"user": "u"},
                       predicates={"B": ["mod(h, 2) = 0", "mod(h, 2) = 1"]}, ranges={"A": ("id", "0", "9", 3)})
    (a, ka), (b, kb), (c, kc) = calls
    assert a == ("jdbc:x", "s.A") and ka["numPartitions"] == 3
    assert kb["predicates"] == ["mod(h, 2) = 0", "mod(h, 2) = 1"]
    assert c == ("jdbc:x", "s.C") and kc == {"properties": {"user": "u"}}


def test_sinks(spark, tables, tmp_path):
    out = str(tmp_path)
    results = run(spark, tables, [("DEMOGRAPHIC", "SEX", "DC 1.07"), ("VITAL", "HT", "DC 2.02")])
    target = sinks.write_results(results, out + "/results", datetime.date(2024, 12, 31))
    assert target.endswith("run_date=2024-12-31")
    assert spark.read.csv(target, header=True).count() == 2
    from assayer.operators import values

    two = {"A": spark.createDataFrame([("x",)], "F string"), "B": spark.createDataFrame([("y",)], "F string")}
    sets = spark.createDataFrame([("A", "F", "q"), ("B", "F", "q")], "table string, field string, item string")
    invalid = values.invalid_values(two, [("A", "F"), ("B", "F")], sets)
    sinks.write_invalid_values(invalid, out + "/invalid")
    back = spark.read.csv(out + "/invalid", header=True)
    assert {(r["table"], r["value"]) for r in back.collect()} == {("A", "x"), ("B", "y")}
    units = values.unit_validity(invalid, spark.createDataFrame([("x",)], "unit string"))
    sinks.write_unit_validity(units, out + "/units")
    assert spark.read.csv(out + "/units", header=True).where("valid = 'VALID'").count() == 1
    one = report(profile(tables["LAB_RESULT_CM"], "LAB_RESULT_CM", only=("RESULT_UNIT", "click")))
    sinks.write_profile(one, out + "/profile", only=("RESULT_UNIT", "click"))
    assert spark.read.csv(out + "/profile/table=LAB_RESULT_CM/only_field=RESULT_UNIT/only_value=click",
                          header=True).count() == 10


def test_hot_keys_are_combined_before_they_are_shuffled(spark):
    """A key holding most rows reaches the reducer as one row per task."""
    hot = spark.range(0, 20000, 1, 8).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("PATID"))
    parents = spark.range(0, 20000, 3, 4).select(F.col("id").cast("string").alias("PATID"))
    tables = {"ENCOUNTER": hot, "DEMOGRAPHIC": parents}
    got = run(spark, tables, [("ENCOUNTER", None, "DC 1.08")]).collect()[0]
    kept = [i for i in range(20000) if i % 10 >= 8]
    assert (got["numerator"], got["denominator"]) == (len([i for i in kept if i % 3]) + 1, len(kept) + 1)
