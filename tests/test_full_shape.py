"""A manifest of full shape: 22 tables, 425 columns, every kind of check, four reads a table."""

from __future__ import annotations

import datetime
import re

import pytest
from compare import spark_rows

from assayer import model
from assayer.operators.codes import CODE_TABLES
from assayer.plans.manifest import Settings, derive_manifest, manifest_frame
from assayer.plans.run import run_checks

COLUMNS = 425
AS_OF = datetime.date(2024, 12, 31)
# Columns that rules ask for, by table; the rest is filled up with coded fields.
KNOWN = {
    "DEMOGRAPHIC": ["PATID", "BIRTH_DATE", "SEX", "RACE"],
    "ENROLLMENT": ["PATID", "ENR_START_DATE", "ENR_END_DATE"],
    "ENCOUNTER": ["ENCOUNTERID", "PATID", "PROVIDERID", "ADMIT_DATE", "DISCHARGE_DATE", "ENC_TYPE", "DISCHARGE_DISPOSITION"],
    "DIAGNOSIS": ["DIAGNOSISID", "PATID", "ENCOUNTERID", "PROVIDERID", "ENC_TYPE", "ADMIT_DATE", "DX", "DX_TYPE"],
    "PROCEDURES": ["PROCEDURESID", "PATID", "ENCOUNTERID", "PROVIDERID", "ENC_TYPE", "ADMIT_DATE", "PX", "PX_TYPE"],
    "VITAL": ["VITALID", "PATID", "ENCOUNTERID", "MEASURE_DATE", "HT", "WT", "DIASTOLIC", "SYSTOLIC"],
    "DISPENSING": ["DISPENSINGID", "PATID", "PRESCRIBINGID", "DISPENSE_DATE", "NDC", "DISPENSE_SUP"],
    "LAB_RESULT_CM": ["LAB_RESULT_CM_ID", "PATID", "ENCOUNTERID", "LAB_ORDER_DATE", "LAB_LOINC", "RESULT_NUM", "RESULT_UNIT",
                      "NORM_RANGE_LOW", "NORM_RANGE_HIGH", "NORM_MODIFIER_LOW", "NORM_MODIFIER_HIGH"],
    "CONDITION": ["CONDITIONID", "PATID", "ENCOUNTERID", "CONDITION", "CONDITION_TYPE"],
    "PRO_CM": ["PRO_CM_ID", "PATID", "ENCOUNTERID", "PRO_DATE"],
    "PRESCRIBING": ["PRESCRIBINGID", "PATID", "ENCOUNTERID", "RX_PROVIDERID", "RX_ORDER_DATE", "RXNORM_CUI"],
    "PCORNET_TRIAL": ["PATID", "TRIALID"], "DEATH": ["PATID", "DEATH_DATE", "DEATH_SOURCE"],
    "DEATH_CAUSE": ["PATID", "DEATH_CAUSE"], "HARVEST": ["NETWORKID"], "PROVIDER": ["PROVIDERID", "PROVIDER_SEX"],
    "MED_ADMIN": ["MEDADMINID", "PATID", "ENCOUNTERID", "MEDADMIN_PROVIDERID"],
    "OBS_CLIN": ["OBSCLINID", "PATID", "ENCOUNTERID", "OBSCLIN_PROVIDERID", "OBSCLIN_DATE"],
    "OBS_GEN": ["OBSGENID", "PATID", "ENCOUNTERID", "OBSGEN_PROVIDERID", "OBSGEN_DATE"],
    "HASH_TOKEN": ["PATID", "TOKEN_01"], "IMMUNIZATION": ["IMMUNIZATIONID", "PATID", "ENCOUNTERID", "VX_PROVIDERID",
                                                         "VX_RECORD_DATE", "VX_CODE", "VX_CODE_TYPE"],
    "LDS_ADDRESS_HISTORY": ["ADDRESSID", "PATID"],
}
NUMBERS = ["HT", "WT", "DIASTOLIC", "SYSTOLIC", "RESULT_NUM", "DISPENSE_SUP"]


def expression(column: str) -> str:
    if column.endswith("PATID"):
        return "'P' || (id * 7 % 90)"
    if column == "ENCOUNTERID":
        return "if(id % 19 = 0, null, 'E' || (id % 130))"
    if column.endswith("PROVIDERID"):
        return "'V' || (id % 40)"
    if column.endswith("DATE"):
        return "if(id % 11 = 0, null, date'2021-01-15' + cast(id * 13 % 1400 as int))"
    if column == "ENC_TYPE":
        return "element_at(array('AV', 'ED', 'EI', 'IP', 'OA'), 1 + cast(id % 5 as int))"
    if column in NUMBERS:
        return "cast(id % 220 as double)"
    if column.endswith("_TYPE"):
        return "element_at(array('09', '10', 'CH', 'CX', 'RX'), 1 + cast(id % 5 as int))"
    if column in ("DX", "PX", "NDC", "LAB_LOINC", "RXNORM_CUI", "VX_CODE", "CONDITION"):
        return "if(id % 17 = 0, null, 'A' || (id * 37 % 100000))"
    if column.endswith("ID"):
        return "'K' || (id - if(id % 50 = 1, 1, 0))"
    return "element_at(array('01', '02', 'NI', 'OT', null, 'longer'), 1 + cast(id % 6 as int))"


@pytest.fixture(scope="module")
def shape(spark, tmp_path_factory):
    names = model.REQUIRED_TABLES["5.1"]
    columns = {t: list(KNOWN[t]) for t in names}
    missing = COLUMNS - sum(map(len, columns.values()))
    for k in range(missing):
        columns[names[k % len(names)]].append(f"CODED_{k}")
    root, tables = tmp_path_factory.mktemp("shape"), {}
    for n, (t, own) in enumerate(columns.items()):
        size = {"ENCOUNTER": 120, "DEMOGRAPHIC": 80, "PROVIDER": 30}.get(t, 100 + n)
        spark.range(size).selectExpr(*[f"{expression(c)} as {c}" for c in own]).coalesce(1).write.parquet(f"{root}/{t}")
        tables[t] = spark.read.parquet(f"{root}/{t}")
    spec = spark.createDataFrame(
        [(t, c, k + 1, "Y" if k < 5 else "N", "P" if k == 0 else None,
          "date" if c.endswith("DATE") else "float" if c in NUMBERS else "string", 3 if "CODED" in c else None)
         for t, own in columns.items() for k, c in enumerate(own)],
        "table string, field string, ordinal int, required string, primary string, dtype string, length int")
    coded = [(t, c) for t, own in columns.items() for c in own if "CODED" in c or c == "ENC_TYPE"][:150]
    sets = spark.createDataFrame([(t, c, v) for t, c in coded for v in ("01", "02", "NI", "AV", "IP")],
                                 "table string, field string, item string")
    more = [(t, c, "DC 3.03") for t, own in columns.items() for c in own[5:8]]
    rows = [tuple(r) for r in derive_manifest(spec, sets, {"DEATH": "PATID, DEATH_SOURCE"}, more).collect()]
    return tables, spec, sets, rows


def scans(df) -> dict[str, int]:
    """Reads by table in the plan that ran, those of reused exchanges counted once."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    found: dict[str, int] = {}
    for path in re.findall(r"FileScan parquet .*?Location: InMemoryFileIndex\(1 paths\)\[file:([^\]]*)\]", plan):
        found[path.rsplit("/", 1)[1]] = found.get(path.rsplit("/", 1)[1], 0) + 1
    return found


def test_four_reads_a_table(spark, shape):
    tables, spec, sets, rows = shape
    assert sum(len(df.columns) for df in tables.values()) == COLUMNS and len(tables) == 22 and len(rows) > 290
    df = run_checks(tables, manifest_frame(spark, rows), spec, sets, as_of=AS_OF)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        found = scans(df)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert set(found) == set(tables) and max(found.values()) <= 4, found
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    exchanges = [x for x in re.findall(r"^.*\bExchange (?:hash|Single|range|Round).*$", plan, re.M) if "ReusedExchange" not in x]
    assert len(exchanges) <= 46, len(exchanges)  # 22 of them carry one row a task
    assert "SortAggregate" not in plan and "CartesianProduct" not in plan


def test_full_shape_equals_one_plan_per_row(spark, shape):
    """Rows planned alone, three of each test, give what they give among all others."""
    tables, spec, sets, rows = shape
    by_test: dict[str, list] = {}
    for r in rows:
        by_test.setdefault(r[2], []).append(r)
    chosen = [r for own in by_test.values() for r in own[:: max(1, len(own) // 3)]]
    options = {"as_of": AS_OF, "settings": Settings(include_empty=True)}
    fused = run_checks(tables, manifest_frame(spark, rows), spec, sets, **options).collect()
    alone = run_checks(tables, manifest_frame(spark, chosen), spec, sets, **options, fused=False).collect()
    assert len(by_test) > 15 and len(alone) > 60 and set(alone) <= set(fused)


def test_table_names_of_any_case(spark, shape):
    tables, spec, sets, _ = shape
    upper = [("DEMOGRAPHIC", "SEX", "DC 1.07"), ("DIAGNOSIS", None, "DC 1.09"), ("VITAL", "HT", "DC 2.02")]
    lower = [(t.lower(), f, x) for t, f, x in upper]
    given = {t.lower() if k % 2 else t: df for k, (t, df) in enumerate(tables.items())}
    assert spark_rows(run_checks(given, manifest_frame(spark, lower))) == spark_rows(run_checks(tables, manifest_frame(spark, upper)))
    assert all(r["result"] for r in run_checks(given, manifest_frame(spark, lower)).collect())
