"""Hand-worked results: small tables with one planted defect per rule."""

from __future__ import annotations

import datetime
import decimal

import pytest

from assayer.model import judge
from assayer.operators import age, codes, groups, keys, links, recency, replication, row, schema, values
from assayer.plans.manifest import Settings, manifest_frame
from assayer.plans.run import run_checks
from assayer.sources.control import normalise_metadata

D = datetime.date


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def measure(df, m: row.Measure):
    return one(judge(row.row_evidence(df, {0: m}), {0: m.check}))


def outcome(r):
    return (r["numerator"], r["denominator"], r["value"], r["result"])


def run(tables, rows, spark, **options):
    return run_checks(tables, manifest_frame(spark, rows), **options)


# ---- schema ------------------------------------------------------------------------

SPEC = "table string, field string, ordinal int, required string, primary string, dtype string, length int"


def test_required_tables_names_the_missing_one(spark):
    t = frame(spark, "PATID string", ("p",))
    required = frame(spark, "table string", ("DEMOGRAPHIC",), ("HARVEST",))
    r = one(schema.required_tables({"DEMOGRAPHIC": t}, required))
    assert (r["table"], r["result"]) == ("HARVEST", "FAIL")


def test_required_tables_passes_with_one_row(spark):
    t = frame(spark, "PATID string", ("p",))
    required = frame(spark, "table string", ("demographic",))
    r = one(schema.required_tables({"DEMOGRAPHIC": t}, required))
    assert (r["table"], r["result"]) == (None, "PASS")


def test_populated_tables(spark):
    tables = {"DIAGNOSIS": frame(spark, "DX string"), "ENCOUNTER": frame(spark, "ENC_TYPE string", ("IP",))}
    got = {r["table"]: (r["numerator"], r["result"]) for r in run(tables, [(None, None, "DC 1.02")], spark).collect()}
    assert got["DIAGNOSIS"] == (0, "FAIL")
    assert got["ENCOUNTER"] == (1, "PASS")
    assert got["HARVEST"] == (None, "FAIL")
    assert len(got) == 6


def test_required_fields_lists_required_ones_only(spark):
    spec = frame(spark, SPEC, ("DIAGNOSIS", "DX", 1, "Y", None, "string", None),
                 ("DIAGNOSIS", "RAW_DX", 2, "N", None, "string", None))
    tables = {"DIAGNOSIS": frame(spark, "PATID string", ("p",))}
    assert [r["field"] for r in schema.required_fields(tables, spec).collect()] == ["DX"]
    clean = {"DIAGNOSIS": frame(spark, "dx string", ("1",))}
    assert schema.required_fields(clean, spec).collect() == []
    r = one(run(clean, [(None, None, "DC 1.03")], spark, metadata=spec))
    assert (r["test"], r["result"]) == ("DC 1.03", "PASS")


def test_field_conformance(spark):
    spec = frame(spark, SPEC, ("D", "PATID", 1, "Y", "P", "string", None),
                 ("D", "SEX", 2, "N", None, "string", 2), ("D", "RAW_DX", 3, "N", None, "string", None),
                 ("D", "RACE", 4, "N", None, "string", 2))
    tables = {"D": frame(spark, "PATID int, SEX string, RACE string", (1, "FEM", "01"), (2, None, "02"))}
    got = sorted(
        (r["field"], r["group"], r["numerator"], r["denominator"])
        for r in schema.field_conformance(tables, spec, lengths="observed").collect()
    )
    assert got == [("PATID", "dtype", None, None), ("RAW_DX", "dtype", None, None),
                   ("RAW_DX", "name", None, None), ("SEX", "length", 3, 2)]


def test_declared_lengths(spark):
    spec = frame(spark, SPEC, ("D", "A", 1, "N", None, "string", 2), ("D", "B", 2, "N", None, "string", 2),
                 ("D", "C", 3, "N", None, "string", 2))
    from pyspark.sql import types as T

    note = "__CHAR_VARCHAR_TYPE_STRING"
    live = T.StructType([
        T.StructField("A", T.StringType(), True, {note: "varchar(2)"}),
        T.StructField("B", T.StringType(), True, {note: "varchar(5)"}),
        T.StructField("C", T.StringType()),
    ])
    tables = {"D": spark.createDataFrame([], live)}
    got = {(r["field"], r["numerator"]) for r in schema.field_conformance(tables, spec).collect()
           if r["group"] == "length"}
    assert got == {("B", 5), ("C", None)}


def test_specification_types(spark):
    raw = frame(spark, "Table string, key string, Field string, Order int, Required string, Primary string,"
                " Oracle_dtype string, mssql_dtype string, postgres_dtype string, mysql_dtype string, LENGTH int",
                ("d", "A", "a", 1, "Y", "P", "VARCHAR2", "VARCHAR", "varchar", "varchar", 5),
                ("d", "B", "b", 2, "N", None, "NUMBER", "NUMERIC", "numeric", "decimal", None),
                ("d", "C", "c", 3, "N", None, "TIMESTAMP(0)", None, "timestamp", "datetime", None),
                ("d", "E", "e", 4, "N", None, "FLOAT", "FLOAT", "float4", "float", None))
    for dialect in ("Oracle", "postgres", "mysql"):
        got = {r["field"]: r["dtype"] for r in normalise_metadata(raw, f"{dialect}_dtype").collect()}
        assert got == {"A": "string", "B": "decimal", "C": "timestamp", "E": "float"}
    missing = {r["field"]: r["dtype"] for r in normalise_metadata(raw, "mssql_dtype").collect()}
    assert missing["C"] is None


# ---- keys --------------------------------------------------------------------------

def test_primary_key_groups_nulls_together(spark):
    df = frame(spark, "K string", *[(k,) for k in ("a", "a", "b", "b", "b", "c", None, None)])
    r = one(judge(keys.primary_key_evidence(df, "K", 0), {0: keys.primary_key_check("T", "K")}))
    assert outcome(r) == (3, 4, 3.0, "FAIL")


def test_primary_key_composite(spark):
    df = frame(spark, "A string, B int", ("x", 1), ("x", 2), ("y", 1))
    r = one(judge(keys.primary_key_evidence(df, "A, B", 0), {0: keys.primary_key_check("T", "A, B")}))
    assert outcome(r) == (0, 3, 0.0, "PASS")


def test_record_duplication_counts_the_null_visit_above_only(spark):
    df = frame(spark, "ENCOUNTERID string, PATID string", ("e1", "p1"), ("e1", "p2"), ("e2", "p3"),
               (None, "p4"), (None, "p5"), ("e2", "p3"), ("e2", None))
    r = one(judge(keys.duplication_evidence({0: (df, "ENCOUNTERID", "PATID")}),
                  {0: keys.duplication_check("T", "ENCOUNTERID")}))
    assert outcome(r) == (2, 2, 100.0, "FAIL")


def children(spark):
    return {
        "CHILD": frame(spark, "K string", ("p1",), ("p9",), ("p9",), (None,)),
        "PARENT": frame(spark, "K string", ("p1",), ("p1",), (None,)),
        "PARENT_STG": frame(spark, "K string", ("p9",)),
    }


@pytest.mark.parametrize("test, expected", [
    ("DC 1.08", (1, 2, 1.0, "FAIL")), ("DC 1.09", (1, 2, 50.0, "FAIL")), ("DC 1.12", (1, 2, 1.0, "FAIL")),
])
def test_orphans(spark, test, expected):
    e = links.link_evidence(children(spark), {0: links.Link("CHILD", "K")}, [("PARENT", "K")])
    assert outcome(one(judge(e, {0: links.orphan_check("CHILD", "K", test)}))) == expected


def test_orphans_with_a_staging_and_a_production_parent(spark):
    e = links.link_evidence(children(spark), {0: links.Link("CHILD", "K")},
                            [("PARENT_STG", "K"), ("PARENT", "K")])
    assert outcome(one(judge(e, {0: links.orphan_check("CHILD", "K", "DC 1.08")}))) == (0, 2, 0.0, "PASS")


def test_many_children_share_the_parent(spark):
    tables = {f"C{i}": frame(spark, "K int", (i,), (i + 1,)) for i in range(70)}
    tables["PARENT"] = frame(spark, "K int", *[(i,) for i in range(0, 71, 2)])
    e = links.link_evidence(tables, {i: links.Link(f"C{i}", "K") for i in range(70)}, [("PARENT", "K")])
    assert {(r["numerator"], r["denominator"]) for r in e.collect()} == {(1, 2)}
    assert e.count() == 70


@pytest.mark.parametrize("child, parent, orphans", [
    ("K int", "K decimal(10,2)", 1), ("K string", "K int", 1), ("K bigint", "K string", 1),
])
def test_keys_of_different_types(spark, child, parent, orphans):
    text = {"K string": str, "K decimal(10,2)": decimal.Decimal}
    make = lambda schema, *v: frame(spark, schema, *[(text.get(schema, int)(x),) for x in v])
    tables = {"CHILD": make(child, 1, 2), "PARENT": make(parent, 1, 3)}
    e = links.link_evidence(tables, {0: links.Link("CHILD", "k")}, [("PARENT", "K")])
    assert one(e)["numerator"] == orphans


def test_patients_per_encounter(spark):
    tables = {"DIAGNOSIS": frame(spark, "PATID string", ("a",), ("a",)),
              "ENCOUNTER": frame(spark, "PATID string", ("a",), ("b",), ("c",))}
    e = links.link_evidence(tables, {0: links.Link("DIAGNOSIS", "PATID", base="ENCOUNTER")}, [])
    r = one(judge(e, {0: links.patients_check("DIAGNOSIS", "DX", "DC 3.04")}))
    assert outcome(r) == (1, 3, 33.3, "FAIL")


def test_replication(spark):
    ts = datetime.datetime
    parent = frame(spark, "ENCOUNTERID string, ENC_TYPE string, ADMIT_DATE timestamp",
                   ("e1", "IP", ts(2020, 1, 1, 8)), ("e2", "AV", ts(2020, 1, 2)), ("e3", None, ts(2020, 1, 3)),
                   (None, "IP", ts(2020, 1, 1)))
    child = frame(spark, "ENCOUNTERID string, ENC_TYPE string, ADMIT_DATE timestamp",
                  ("e1", "IP", ts(2020, 1, 1, 23)), ("e2", "ED", ts(2020, 1, 5)), ("e3", "IP", ts(2020, 1, 3)),
                  ("e9", "IP", ts(2020, 1, 3)), (None, "ED", None))
    tables = {"ENCOUNTER": parent, "DIAGNOSIS": child}
    e = replication.replication_evidence(tables, "ENCOUNTER", "ENCOUNTERID",
                                         {0: ("DIAGNOSIS", "ENC_TYPE"), 1: ("DIAGNOSIS", "ADMIT_DATE")})
    got = {r["check_id"]: (r["numerator"], r["denominator"]) for r in e.collect()}
    assert got == {0: (1, 2), 1: (1, 3)}


def test_replication_counts_pairs_of_repeated_keys(spark):
    # 2 x 3 pairs, of which (x, x) twice are equal.
    tables = {"P": frame(spark, "K int, F string", (1, "x"), (1, "y")),
              "C": frame(spark, "K int, F string", (1, "x"), (1, "x"), (1, "z"))}
    e = replication.replication_evidence(tables, "P", "K", {0: ("C", "F")})
    assert [(r["numerator"], r["denominator"]) for r in e.collect()] == [(4, 6)]


# ---- values ------------------------------------------------------------------------

def sets(spark, *items, table="T", field="F"):
    return frame(spark, "table string, field string, item string", *[(table, field, i) for i in items])


def coded(spark):
    return frame(spark, "F string", *[(v,) for v in ("F", "F", "M", "X", "X", "Y", None)])


def test_value_set(spark):
    e = values.value_set_evidence({"T": coded(spark)}, {0: ("T", "F")}, sets(spark, "F", "M"))
    assert outcome(one(judge(e, {0: values.value_set_check("T", "F")}))) == (3, 6, 3.0, "FAIL")
    listing = values.invalid_values({"T": coded(spark)}, [("T", "F")], sets(spark, "F", "M"))
    assert [(r["value"], r["n"]) for r in listing.collect()] == [("X", 2), ("Y", 1)]


def test_staging_tables_use_the_production_set(spark):
    e = values.value_set_evidence({"T_STG": coded(spark)}, {0: ("T_STG", "F")}, sets(spark, "F", "M", "X", "Y"))
    assert [(r["numerator"], r["denominator"]) for r in e.collect()] == [(0, 6)]


@pytest.mark.parametrize("unlisted, invalid", [("valid", 0), ("invalid", 6)])
def test_field_without_a_set(spark, unlisted, invalid):
    e = values.value_set_evidence({"T": coded(spark)}, {0: ("T", "F")},
                                  sets(spark, "a", field="OTHER"), unlisted)
    assert one(e)["numerator"] == invalid


def test_empty_table_has_no_invalid_value(spark):
    e = values.value_set_evidence({"T": frame(spark, "F string")}, {0: ("T", "F")}, sets(spark, "a"))
    assert outcome(one(judge(e, {0: values.value_set_check("T", "F")}))) == (0, 0, 0.0, "PASS")


def test_unit_validity(spark):
    tables = {"T": frame(spark, "F string", ("mg",), ("foo",), ("g",))}
    invalid = values.invalid_values(tables, [("T", "F")], sets(spark, "g"))
    known = frame(spark, "unit string", ("mg",), ("mg",))
    got = {r["unit"]: r["valid"] for r in values.unit_validity(invalid, known).collect()}
    assert got == {"mg": "VALID", "foo": "INVALID"}


# ---- missing, extreme, normal range ------------------------------------------------

def test_missing_kinds(spark):
    df = frame(spark, "SEX string, BIRTH_DATE string, DISCHARGE_DATE string, DISCHARGE_DISPOSITION string,"
               " ENC_TYPE string",
               (None, None, None, None, "IP"), ("NI", "NI", "d", "NI", "EI"), ("OT", "d", "d", "A", "IP"),
               ("UN", "d", "d", "A", "EI"), ("A", "d", None, None, "AV"), ("A", "d", None, None, None))
    def got(field):
        return outcome(measure(df, row.missing_or_unknown("T", field, "DC 3.03", 10)))
    assert got("SEX") == (4, 6, 66.67, "FAIL")
    assert got("BIRTH_DATE") == (1, 6, 16.67, "FAIL")
    assert got("DISCHARGE_DATE") == (1, 4, 25.0, "FAIL")
    assert got("DISCHARGE_DISPOSITION") == (2, 4, 50.0, "FAIL")


def test_nothing_to_measure_gives_no_result(spark):
    df = frame(spark, "DISCHARGE_DATE string, ENC_TYPE string", (None, "AV"))
    assert outcome(measure(df, row.missing_or_unknown("T", "DISCHARGE_DATE", "DC 3.03", 10))) == (0, 0, None, None)


def test_threshold_is_allowed(spark):
    df = frame(spark, "SEX string", *[("A",)] * 9, (None,))
    assert measure(df, row.missing_or_unknown("T", "SEX", "DC 3.03", 10))["result"] == "PASS"
    assert measure(df, row.missing_or_unknown("T", "SEX", "DC 1.07", 0))["result"] == "FAIL"


def test_extreme_bounds_are_inside(spark):
    df = frame(spark, "HT double, DISPENSE_SUP double",
               (-1.0, 0.0), (0.0, 1.0), (94.0, 90.0), (94.5, 90.5), (None, None))
    assert outcome(measure(df, row.extreme_values("VITAL", "HT"))) == (2, 4, 50.0, "FAIL")
    assert outcome(measure(df, row.extreme_values("DISPENSING", "DISPENSE_SUP"))) == (2, 5, 40.0, "FAIL")


def test_normal_range(spark):
    columns = ["LAB_LOINC", "RESULT_NUM", "NORM_RANGE_LOW", "NORM_RANGE_HIGH", "NORM_MODIFIER_LOW",
               "NORM_MODIFIER_HIGH"]
    df = frame(spark, ", ".join(f"{c} string" for c in columns),
               ("l", "1", "1", "1", "1", "1"), ("l", "1", "1", None, "1", "1"), (None, "1", "1", "1", "1", "1"))
    assert outcome(measure(df, row.normal_range("LAB_RESULT_CM", "RESULT_NUM"))) == (1, 2, 50.0, "FAIL")


def test_extreme_age(spark):
    demographic = frame(spark, "PATID string, BIRTH_DATE date",
                        ("alive90", D(1934, 1, 1)), ("dead50", D(1920, 1, 1)), ("dead95", D(1900, 1, 1)),
                        ("unborn", None), ("fine", D(2000, 1, 1)))
    death = frame(spark, "PATID string, DEATH_DATE date",
                  ("dead50", D(1970, 1, 1)), ("dead95", D(1995, 1, 1)), ("dead95", D(1995, 1, 1)),
                  (None, D(1995, 1, 1)), ("fine", None))
    e = age.extreme_age_evidence(demographic, death, 0, D(2024, 12, 31))
    assert outcome(one(judge(e, {0: age.extreme_age_check("DEMOGRAPHIC")}))) == (3, 5, 60.0, "FAIL")


# ---- codes -------------------------------------------------------------------------

def flagged(spark, table, columns, rows, **options):
    df = frame(spark, ", ".join(f"{c} string" for c in columns), *rows)
    measures = dict(enumerate(codes.code_errors(table, **options)))
    out = judge(row.row_evidence(df, measures), {i: m.check for i, m in measures.items()})
    return {r["group"]: (r["numerator"], r["denominator"]) for r in out.collect()}


@pytest.mark.parametrize("table, kind, code, bad", [
    ("DIAGNOSIS", "09", "A12", 1), ("DIAGNOSIS", "09", "E12", 0), ("DIAGNOSIS", "09", "V12.1", 0),
    ("DIAGNOSIS", "09", "12", 1), ("DIAGNOSIS", "09", "123.456", 1), ("DIAGNOSIS", "09", "123.45", 0),
    ("DIAGNOSIS", "09", "000", 1), ("DIAGNOSIS", "09", None, 0), ("DIAGNOSIS", "10", "1AB", 1),
    ("DIAGNOSIS", "10", "A00.1234", 0), ("DIAGNOSIS", "10", "A00.12345", 1), ("DIAGNOSIS", "10", "999", 1),
    ("CONDITION", "10", "000", 1), ("CONDITION", "09", "a12", 0),
    ("PROCEDURES", "09", "1A3", 1), ("PROCEDURES", "09", "12.34", 0), ("PROCEDURES", "09", "12", 1),
    ("PROCEDURES", "10", "0ABCDEF", 0), ("PROCEDURES", "10", "ABCDEFG", 1), ("PROCEDURES", "10", "0000000", 1),
    ("PROCEDURES", "CH", "1234", 1), ("PROCEDURES", "CH", "12345", 0), ("PROCEDURES", "CH", "99999", 1),
    ("PROCEDURES", "CH", None, 1),
    ("IMMUNIZATION", "CX", "12", 0), ("IMMUNIZATION", "CX", "1234", 1), ("IMMUNIZATION", "CX", "000", 1),
    ("IMMUNIZATION", "RX", "A12", 1), ("IMMUNIZATION", "RX", "12345678", 1), ("IMMUNIZATION", "CH", "0001A", 0),
    ("IMMUNIZATION", "RX", None, 1),
])
def test_typed_codes(spark, table, kind, code, bad):
    spec = codes.CODE_TABLES[table]
    got = flagged(spark, table, [spec.type_field, spec.code], [(kind, code)])
    assert got == {kind: (bad, 0 if code is None else 1)}


@pytest.mark.parametrize("table, code, bad", [
    ("PRESCRIBING", "12", 0), ("PRESCRIBING", "1", 1), ("PRESCRIBING", "12a", 1), ("PRESCRIBING", "12345678", 1),
    ("DISPENSING", "12345678901", 0), ("DISPENSING", "1234567890", 1), ("DISPENSING", "99999999999", 1),
    ("DISPENSING", "1234567890A", 1), ("LAB_RESULT_CM", "1234-5", 0), ("LAB_RESULT_CM", "12345", 1),
    ("LAB_RESULT_CM", "1-23", 1), ("LAB_RESULT_CM", "X12-3", 1), ("LAB_RESULT_CM", "12345678-9", 1),
    ("LAB_RESULT_CM", None, 0),
])
def test_untyped_codes(spark, table, code, bad):
    spec = codes.CODE_TABLES[table]
    (got,) = flagged(spark, table, [spec.code], [(code,)]).values()
    assert got == (bad, 0 if code is None else 1)


def test_two_flags(spark):
    rows = [("09", "A1"), ("09", "12")]
    assert flagged(spark, "DIAGNOSIS", ["DX_TYPE", "DX"], rows) == {"09": (2, 2)}
    assert flagged(spark, "DIAGNOSIS", ["DX_TYPE", "DX"], rows, min_flags=2) == {"09": (1, 2)}


# ---- groups and recency ------------------------------------------------------------

def visits(spark):
    rows = [("AV",)] * 2 + [("ED",)] * 2 + [("IP",)] + [("OA",)]
    events = [("AV", "10")] * 3 + [("ED", "09"), ("ED", "NI"), ("OA", "10")]
    return frame(spark, "ENC_TYPE string", *rows), frame(spark, "ENC_TYPE string, DX_TYPE string", *events)


def test_events_per_encounter(spark):
    encounter, diagnosis = visits(spark)
    tables = {"ENCOUNTER": encounter, "DIAGNOSIS": diagnosis}
    rows = [("DIAGNOSIS", "DX", "DC 3.01")]
    got = {r["group"]: outcome(r) for r in run(tables, rows, spark).collect()}
    assert got == {"AV": (3, 2, 1.5, "PASS"), "ED": (1, 2, 0.5, "FAIL")}
    wide = run(tables, rows, spark, settings=Settings(include_empty=True))
    assert {r["group"]: outcome(r) for r in wide.collect()} == got | {"IP": (0, 1, 0.0, "FAIL")}


def monthly(spark, newest, *, quiet=()):
    rows = []
    for k in range(22):
        year, month = 2020 - k // 12, 12 - k % 12
        kind = "OA" if k in quiet else "AV"
        rows += [(D(year, month, d + 1), kind) for d in range(newest if k == 0 else 10)]
    rows += [(None, "AV")] * 5
    return frame(spark, "ADMIT_DATE date, ENC_TYPE string", *rows)


def latency(df, by_type):
    check = recency.latency_check("T", "ADMIT_DATE", "DC 3.07" if by_type else "DC 3.11")
    return one(judge(recency.latency_evidence({0: (df, "ADMIT_DATE", by_type)}), {0: check}))


def test_latency(spark):
    assert outcome(latency(monthly(spark, 7), False))[2:] == (70.0, "FAIL")
    assert outcome(latency(monthly(spark, 8), False))[2:] == (80.0, "PASS")


def test_latency_by_encounter_type(spark):
    assert outcome(latency(monthly(spark, 7, quiet=(0,)), True))[2:] == (0.0, "FAIL")
    parts = recency.latency_parts({0: (monthly(spark, 7, quiet=(12,)), "ADMIT_DATE", True)})
    assert one(parts).asDict() == {"check_id": 0, "newest": 7, "baseline_rows": 110, "baseline_months": 11}


def test_latency_without_rows_or_baseline(spark):
    empty = frame(spark, "ADMIT_DATE date, ENC_TYPE string")
    assert outcome(latency(empty, False))[2:] == (None, None)
    short = frame(spark, "ADMIT_DATE date, ENC_TYPE string", (D(2020, 1, 1), "AV"))
    assert outcome(latency(short, False))[2:] == (None, None)
