"""What a check is, what a result row looks like, and the fixed values of the rules.

A check measures two integers, a numerator and a denominator, over the data.  The
value is derived from them by ``scale`` and compared with ``threshold``.  Operators
produce *evidence* ``(check_id, numerator, denominator)``; ``judge`` turns evidence
into result rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from assayer.functions.exprs import half_up, name, text

RESULT_COLUMNS = [
    "test", "table", "field", "group", "numerator", "denominator",
    "value", "threshold", "result", "text",
]

EVIDENCE_SCHEMA = "check_id int, numerator bigint, denominator bigint"

# ---- fixed values of the rules -------------------------------------------------

MISSING_CODES = ["NI", "OT", "UN"]
INPATIENT_TYPES = ["IP", "EI"]
ENCOUNTER_TYPES = ["AV", "ED", "EI", "IP"]

# Fields where only NULL counts as missing.
NULL_ONLY_FIELDS = [
    "BIRTH_DATE", "MEASURE_DATE", "PX_DATE", "DISPENSE_DATE", "RESULT_DATE",
    "RX_ORDER_DATE", "OBSCLIN_DATE", "OBSGEN_DATE", "DISPENSE_SUP",
    "ENR_START_DATE", "ENR_END_DATE", "PRO_DATE", "VX_RECORD_DATE",
]
# Fields whose missingness is asked of inpatient encounters only.
INPATIENT_DATE_FIELDS = ["ADMIT_DATE", "DISCHARGE_DATE"]
INPATIENT_CODED_FIELDS = ["DISCHARGE_DISPOSITION"]

# Plausible ranges, bounds included.
BOUNDS = {
    "AGE": (0, 89),
    "DISPENSE_SUP": (1, 90),
    "SYSTOLIC": (40, 210),
    "DIASTOLIC": (40, 120),
    "HT": (0, 94),
    "WT": (0, 350),
}
# Fields whose extreme share is taken of the recorded values, not of all rows.
RECORDED_VALUE_FIELDS = ["HT", "WT", "DIASTOLIC", "SYSTOLIC"]

KNOWN_DX_TYPES = ["09", "10", "11", "SM"]
KNOWN_PX_TYPES = ["09", "10", "11", "CH", "LC", "ND", "RE"]
DX_PER_ENCOUNTER = {"AV": 1.0, "ED": 1.0, "IP": 1.0, "EI": 1.0}
PX_PER_ENCOUNTER = {"AV": 0.75, "ED": 0.75, "IP": 1.0, "EI": 1.0}

REQUIRED_TABLES = {
    "4.1": [
        "DEMOGRAPHIC", "ENROLLMENT", "ENCOUNTER", "DIAGNOSIS", "PROCEDURES", "VITAL",
        "DISPENSING", "LAB_RESULT_CM", "CONDITION", "PRO_CM", "PRESCRIBING",
        "PCORNET_TRIAL", "DEATH", "DEATH_CAUSE", "HARVEST", "PROVIDER", "MED_ADMIN",
        "OBS_CLIN", "OBS_GEN",
    ],
    "5.1": [
        "DEMOGRAPHIC", "ENROLLMENT", "ENCOUNTER", "DIAGNOSIS", "PROCEDURES", "VITAL",
        "DISPENSING", "LAB_RESULT_CM", "CONDITION", "PRO_CM", "PRESCRIBING",
        "PCORNET_TRIAL", "DEATH", "DEATH_CAUSE", "HARVEST", "PROVIDER", "MED_ADMIN",
        "OBS_CLIN", "OBS_GEN", "HASH_TOKEN", "IMMUNIZATION", "LDS_ADDRESS_HISTORY",
    ],
}
POPULATED_TABLES = [
    "DEMOGRAPHIC", "ENROLLMENT", "ENCOUNTER", "DIAGNOSIS", "PROCEDURES", "HARVEST",
]
PROFILED_TABLES = [
    "CONDITION", "DEATH", "DEATH_CAUSE", "DEMOGRAPHIC", "DIAGNOSIS", "DISPENSING",
    "ENCOUNTER", "ENROLLMENT", "LAB_RESULT_CM", "MED_ADMIN", "OBS_CLIN", "OBS_GEN",
    "PCORNET_TRIAL", "PRESCRIBING", "PROCEDURES", "PRO_CM", "PROVIDER", "VITAL",
    "IMMUNIZATION",
]
NORMAL_RANGE_FIELDS = [
    "NORM_RANGE_LOW", "NORM_RANGE_HIGH", "NORM_MODIFIER_LOW", "NORM_MODIFIER_HIGH",
]
UNIT_FIELDS = ["RESULT_UNIT", "OBSCLIN_RESULT_UNIT", "OBSGEN_RESULT_UNIT"]

# Pass marks.
ORPHAN_ENCOUNTER_PCT = 5.0
DUPLICATION_PCT = 5.0
CODE_ERROR_PCT = 5.0
EXTREME_PCT = 10.0
MISSING_PCT = {"DC 1.07": 0.0, "DC 3.03": 10.0}
PATIENTS_PCT = 50.0
LATENCY_PCT = 75.0
NORMAL_RANGE_PCT = 80.0
# Months, newest first, whose average volume is the baseline of recency.
BASELINE_RANKS = (10, 21)

# --------------------------------------------------------------------------------

# scale -> (multiplier before rounding half up, divisor after it)
SCALES = {
    "pct2": (10000, 100.0),   # percent, two decimals
    "pct0": (100, 1.0),       # percent, rounded to whole percents
    "pct1": (1000, 10.0),     # percent, ratio rounded to three decimals first
    "ratio2": (100, 100.0),   # ratio, two decimals
}


@dataclass(frozen=True)
class Check:
    """One line of the report before it is measured.

    ``scale`` is a key of ``SCALES`` or ``"count"`` (the value is the numerator).
    ``fails`` says on which side of the threshold the check fails: ``above``,
    ``below`` or ``not_above``.
    """

    test: str
    table: str | None = None
    field: str | None = None
    group: str | None = None
    threshold: float = 0.0
    scale: str = "count"
    fails: str = "above"
    text: str = "{value}"


def local_table(spark: SparkSession, schema: pa.Schema, rows: Sequence[dict]) -> DataFrame:
    """A control table whose size Catalyst knows, so joins with it broadcast by statistics."""
    return spark.createDataFrame(pa.Table.from_pylist(list(rows), schema=schema))


def evidence_rows(spark: SparkSession, rows: Sequence[tuple[int, int | None, int | None]]) -> DataFrame:
    schema = pa.schema(
        [("check_id", pa.int32()), ("numerator", pa.int64()), ("denominator", pa.int64())]
    )
    return local_table(
        spark, schema,
        [{"check_id": i, "numerator": n, "denominator": d} for i, n, d in rows],
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def judge(evidence: DataFrame, checks: dict[int, Check]) -> DataFrame:
    """Result rows for evidence; ``checks`` maps ``check_id`` to its check."""
    spec = local_table(
        evidence.sparkSession,
        pa.schema([
            ("check_id", pa.int32()), ("test", pa.string()), ("table", pa.string()),
            ("field", pa.string()), ("group", pa.string()), ("threshold", pa.float64()),
            ("scale", pa.string()), ("fails", pa.string()), ("template", pa.string()),
        ]),
        [
            {
                "check_id": i, "test": c.test, "table": c.table, "field": c.field,
                "group": c.group, "threshold": float(c.threshold), "scale": c.scale,
                "fails": c.fails, "template": c.text,
            }
            for i, c in checks.items()
        ],
    )
    cases = " ".join(
        f"when {text(scale)} then {half_up('numerator', 'denominator', multiplier)} / {divisor}D"
        for scale, (multiplier, divisor) in SCALES.items()
    )
    # Where something must be there, nothing measured is as bad as zero.
    failed = (
        "case fails when 'above' then value > threshold when 'below' then value < threshold"
        " else coalesce(value <= threshold, true) end"
    )
    shown = (
        "case when value is null then 'no' when scale = 'count' then cast(numerator as string)"
        " else cast(value as string) end"
    )
    columns = {
        "result": "case when failed then 'FAIL' when not failed then 'PASS' end",
        "text": f"replace(template, '{{value}}', {shown})",
    }
    return (
        evidence.join(spec, "check_id")
        .selectExpr("*", f"case scale when 'count' then cast(numerator as double) {cases} end as value")
        .selectExpr("*", f"{failed} as failed")
        .selectExpr(*[f"{columns.get(c, name(c))} as {name(c)}" for c in RESULT_COLUMNS])
    )
