"""The queries: each operator of the library over the derived clinical tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.model import judge
from assayer.operators import age, codes, groups, keys, links, recency, replication, row, schema, sketches, values
from assayer.operators.profile import PERCENTILES, profile, profile_tables
from assayer.plans.manifest import Settings, manifest_frame
from assayer.plans.run import run_checks
from assayer.sources.control import reference_valuesets
from suite import fixtures
from suite.projections import frame, frames

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime.date(2024, 12, 31)
EVIDENCE = ["numerator", "denominator", "value", "result"]


def _open(spark: SparkSession, root: str, *names: str) -> dict[str, DataFrame]:
    return frames(spark, root, *names)


# ---- row checks ----------------------------------------------------------------

def _row_query(table: str, make: Callable[[], list[row.Measure]], grouped: bool = False) -> Query:
    def query(spark: SparkSession, root: str) -> DataFrame:
        measures = dict(enumerate(make()))
        evidence = row.row_evidence(frame(spark, root, table), measures)
        out = judge(evidence, {i: m.check for i, m in measures.items()})
        if grouped:
            return out.select(F.col("group").alias("code_type"), *EVIDENCE)
        return out.select(*EVIDENCE)
    return query


def _missing(table: str, field: str, test: str, threshold: float) -> Query:
    return _row_query(table, lambda: [row.missing_or_unknown(table, field, test, threshold)])


def _extreme(table: str, field: str) -> Query:
    return _row_query(table, lambda: [row.extreme_values(table, field)])


def _codes(table: str, min_flags: int = 1) -> Query:
    return _row_query(table, lambda: codes.code_errors(table, min_flags=min_flags), grouped=True)


# ---- keys and links ------------------------------------------------------------

def primary_key_error(spark, root):
    check = keys.primary_key_check("DIAGNOSIS", "DIAGNOSISID")
    return judge(keys.primary_key_evidence(frame(spark, root, "DIAGNOSIS"), "DIAGNOSISID", 0),
                 {0: check}).select(*EVIDENCE)


def primary_key_composite(spark, root):
    lines = spark.read.parquet(f"{root}/lineitem.parquet")
    check = keys.primary_key_check("LINEITEM", "l_orderkey, l_linenumber")
    return judge(keys.primary_key_evidence(lines, "l_orderkey, l_linenumber", 0),
                 {0: check}).select(*EVIDENCE)


def record_duplication(spark, root):
    source = (frame(spark, root, "DIAGNOSIS"), "ENCOUNTERID", "PATID")
    check = keys.duplication_check("DIAGNOSIS", "ENCOUNTERID")
    return judge(keys.duplication_evidence({0: source}), {0: check}).select(*EVIDENCE)


def _orphans(child: str, key: str, test: str, parent: str, parent_key: str) -> Query:
    def query(spark: SparkSession, root: str) -> DataFrame:
        evidence = links.link_evidence(
            _open(spark, root, child, parent), {0: links.Link(child, key)}, [(parent, parent_key)]
        )
        return judge(evidence, {0: links.orphan_check(child, key, test)}).select(*EVIDENCE)
    return query


def orphan_staging_union(spark, root):
    """The parent is the union of a staging and a production part of the encounters."""
    encounter = frame(spark, root, "ENCOUNTER")
    tables = {
        "DIAGNOSIS": frame(spark, root, "DIAGNOSIS"),
        "ENCOUNTER_STG": encounter.where(F.col("ENC_TYPE").isin("IP", "EI")),
        "ENCOUNTER": encounter.where("ENC_TYPE = 'AV'"),
    }
    evidence = links.link_evidence(
        tables, {0: links.Link("DIAGNOSIS", "ENCOUNTERID")},
        [("ENCOUNTER_STG", "ENCOUNTERID"), ("ENCOUNTER", "ENCOUNTERID")],
    )
    return judge(evidence, {0: links.orphan_check("DIAGNOSIS", "ENCOUNTERID", "DC 1.09")}).select(*EVIDENCE)


def patients_per_encounter(spark, root):
    evidence = links.link_evidence(
        _open(spark, root, "DIAGNOSIS", "ENCOUNTER"),
        {0: links.Link("DIAGNOSIS", "PATID", base="ENCOUNTER")}, [],
    )
    return judge(evidence, {0: links.patients_check("DIAGNOSIS", "DX", "DC 3.04")}).select(*EVIDENCE)


def _replication(field: str, child: str = "DIAGNOSIS", parent: str = "ENCOUNTER") -> Query:
    def query(spark: SparkSession, root: str) -> DataFrame:
        evidence = replication.replication_evidence(
            _open(spark, root, parent, child), parent, "ENCOUNTERID", {0: (child, field)},
        )
        return judge(evidence, {0: replication.replication_check(child, field)}).select(*EVIDENCE)
    return query


# ---- values --------------------------------------------------------------------

def _value_query(table: str, field: str, reference: bool) -> Query:
    def query(spark: SparkSession, root: str) -> DataFrame:
        sets = fixtures.value_sets(spark)
        if reference:
            named = sets.select(F.col("table").alias("TABLE_NAME"), F.col("field").alias("FIELD_NAME"),
                                F.col("item").alias("VALUESET_ITEM"))
            sets = reference_valuesets(named)
        evidence = values.value_set_evidence(
            {table: frame(spark, root, table)}, {0: (table, field)}, sets,
            unlisted="invalid" if reference else "valid",
        )
        return judge(evidence, {0: values.value_set_check(table, field)}).select(*EVIDENCE)
    return query


def invalid_values(spark, root):
    fields = [("DEMOGRAPHIC", "SEX"), ("DEMOGRAPHIC", "RACE"), ("DIAGNOSIS", "DX_TYPE")]
    return values.invalid_values(_open(spark, root, "DEMOGRAPHIC", "DIAGNOSIS"), fields,
                                 fixtures.value_sets(spark))


def unit_validity(spark, root):
    invalid = values.invalid_values(_open(spark, root, "LAB_RESULT_CM"),
                                    [("LAB_RESULT_CM", "RESULT_UNIT")], fixtures.value_sets(spark))
    return values.unit_validity(invalid, fixtures.known_units(spark)).select("unit", "n", "valid")


def unit_validity_grammar(spark, root):
    """Units outside their set, judged by the grammar of unit codes."""
    invalid = values.invalid_values(_open(spark, root, "LAB_UNITS"), [("LAB_UNITS", "RESULT_UNIT")],
                                    fixtures.value_sets(spark))
    return values.unit_validity(invalid, grammar=True).select("unit", "n", "valid")


# ---- groups, ages, recency -----------------------------------------------------

def _events(table: str, field: str, test: str) -> Query:
    def query(spark: SparkSession, root: str) -> DataFrame:
        manifest = manifest_frame(spark, [(table, field, test)])
        out = run_checks(_open(spark, root, table, "ENCOUNTER"), manifest)
        return out.select(F.col("group").alias("enc_type"), *EVIDENCE, "threshold")
    return query


def _age(unit: str, sources: tuple[str, ...] | None = None) -> Query:
    def query(spark: SparkSession, root: str) -> DataFrame:
        tables = _open(spark, root, "DEMOGRAPHIC", "DEATH")
        evidence = age.extreme_age_evidence(tables["DEMOGRAPHIC"], tables["DEATH"], 0, AS_OF, unit, sources)
        return judge(evidence, {0: age.extreme_age_check("DEMOGRAPHIC")}).select(*EVIDENCE)
    return query


def _latency(table: str, field: str, test: str) -> Query:
    def query(spark: SparkSession, root: str) -> DataFrame:
        by_type = test == "DC 3.07"
        sources = {0: (frame(spark, root, table), field, by_type)}
        judged = judge(recency.latency_evidence(sources), {0: recency.latency_check(table, field, test)})
        return judged.select(*EVIDENCE)
    return query


def latency_months(spark, root):
    """The parts of the recency ratio: newest month, baseline rows, baseline months."""
    sources = {
        0: (frame(spark, root, "ENCOUNTER"), "ADMIT_DATE", True),
        1: (frame(spark, root, "PRESCRIBING"), "RX_ORDER_DATE", False),
    }
    return recency.latency_parts(sources)


# ---- schemas -------------------------------------------------------------------

SCHEMA_COLUMNS = ["test", "table", "field", "group", "numerator", "denominator", "result"]


def required_tables(spark, root):
    """Required tables that are missing, and the rows of those that must be populated."""
    manifest = manifest_frame(spark, [(None, None, "DC 1.01"), (None, None, "DC 1.02")])
    return run_checks(_open(spark, root), manifest).select("test", "table", "numerator", "result")


def tables_populated(spark, root):
    manifest = manifest_frame(spark, [(None, None, "DC 1.02")])
    return run_checks(_open(spark, root), manifest).select("table", "numerator", "result")


def required_fields(spark, root):
    """Required columns that are missing, and missing values in those that are there."""
    spec = fixtures.specification(spark)
    required = [(t, f) for t, f, _, need, *_ in fixtures.SPECIFICATION if need == "Y"]
    tables = _open(spark, root, "DEMOGRAPHIC", "DIAGNOSIS", "VITAL", "LAB_RESULT_CM")
    rows = [(None, None, "DC 1.03")] + [
        (t, f, "DC 1.07") for t, f in required if f in tables[t].columns
    ]
    return run_checks(tables, manifest_frame(spark, rows), spec).select(
        "test", "table", "field", "numerator", "denominator", "result"
    )


def field_conformance(spark, root):
    tables = _open(spark, root, "DEMOGRAPHIC", "DIAGNOSIS", "VITAL", "LAB_RESULT_CM")
    found = schema.field_conformance(tables, fixtures.specification(spark), lengths="observed")
    return found.select("table", "field", F.col("group").alias("part"), "numerator", "denominator", "result")


# ---- profiles ------------------------------------------------------------------

TEXT_PROFILE = ["field", "cn", "nd", "pct_dist", "n_null", "pct_null", "n_ni", "pct_missing",
                "min_text", "max_text"]
NUMERIC_PROFILE = ["field", "cn", "nd", "pct_dist", "n_null", "pct_null", "min_num", "p05", "p25",
                   "median", "mean", "p75", "p95", "max_num"]
# Sums of doubles depend on the order of addition, so means are compared to four decimals,
# interpolated percentiles to six.
ROUNDED = {"mean": 4, "p05": 6, "p25": 6, "median": 6, "p75": 6, "p95": 6}


def _rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.round(c, ROUNDED[c]).alias(c) if c in ROUNDED else F.col(c) for c in columns])


def profile_strings(spark, root):
    return profile(frame(spark, root, "DEMOGRAPHIC"), "DEMOGRAPHIC").select(*TEXT_PROFILE)


def profile_numeric(spark, root):
    df = profile(frame(spark, root, "VITAL"), "VITAL").where("kind = 'numeric'")
    return _rounded(df, NUMERIC_PROFILE)


def profile_filtered(spark, root):
    df = profile(frame(spark, root, "LAB_RESULT_CM"), "LAB_RESULT_CM", only=("RESULT_UNIT", "click"))
    return _rounded(df, [*TEXT_PROFILE, *NUMERIC_PROFILE[6:]])


def profile_long_integers(spark, root):
    """Extremes and distinct values of numbers that doubles cannot hold."""
    df = profile(frame(spark, root, "LONG_NUMBERS"), "LONG_NUMBERS")
    return df.select("field", "cn", "nd", "n_null", "min_exact", "max_exact")


CLOSE = {"nd": 0.04, "rank": 0.01}


def profile_sketches(spark, root):
    """Sketches of each year of a table, merged: exact counts, and whether distinct counts and
    percentiles are as close to the whole table as the library says."""
    df = frame(spark, root, "VITAL")
    merged = sketches.merge(sketches.sketches(df, "VITAL", by="year(MEASURE_DATE)"))
    found = sketches.estimates(merged).where("kind = 'numeric'")
    names = list(PERCENTILES)
    long = df.selectExpr("inline(array(" + ", ".join(
        f"named_struct('field', '{f}', 'value', {f})" for f in ("HT", "WT", "DIASTOLIC", "SYSTOLIC")) + "))").where("value is not null")
    real = long.join(found.select("field", *names), "field").groupBy("field").agg(
        F.countDistinct("value").alias("real_nd"), F.count(F.lit(1)).alias("rows"),
        *[F.expr(f"count_if(value {sign} {p})").alias(f"{side}_{p}") for p in names for side, sign in (("under", "<"), ("upto", "<="))],
    )
    close = [f"under_{n} <= rows * {p + CLOSE['rank']}D and upto_{n} >= rows * {p - CLOSE['rank']}D as {n}_close"
             for n, p in PERCENTILES.items()]
    return found.join(real, "field").selectExpr(
        "field", "cn", "n_null", "min_num", "max_num", f"abs(nd - real_nd) <= {CLOSE['nd']}D * real_nd as nd_close", *close)


REPORT = ["table", "field", "required", "ordinal", *TEXT_PROFILE[1:], *NUMERIC_PROFILE[6:]]


def profile_report(spark, root):
    tables = _open(spark, root, "DEMOGRAPHIC", "VITAL", "LAB_RESULT_CM")
    return _rounded(profile_tables(tables, metadata=fixtures.specification(spark)), REPORT)


# ---- the runner ----------------------------------------------------------------

MANIFEST_COLUMNS = ["test", "table", "field", "group", "numerator", "denominator", "value", "result"]


def run_manifest(spark, root):
    return run_checks(
        _open(spark, root), fixtures.manifest(spark), fixtures.specification(spark),
        fixtures.value_sets(spark), as_of=AS_OF,
    ).select(*MANIFEST_COLUMNS)


def run_staging_manifest(spark, root):
    """Staging tables checked against staging and production encounters together."""
    encounter, diagnosis = frame(spark, root, "ENCOUNTER"), frame(spark, root, "DIAGNOSIS")
    tables = {
        "DEMOGRAPHIC": frame(spark, root, "DEMOGRAPHIC"),
        "DIAGNOSIS_STG": diagnosis,
        "ENCOUNTER_STG": encounter.where(F.col("ENC_TYPE").isin("IP", "EI")),
        "ENCOUNTER": encounter.where("ENC_TYPE = 'AV'"),
    }
    manifest = manifest_frame(spark, [
        ("DIAGNOSIS_STG", "DX_TYPE", "DC 1.06"),
        ("DIAGNOSIS_STG", None, "DC 1.08"),
        ("DIAGNOSIS_STG", None, "DC 1.09"),
        ("DIAGNOSIS_STG", "ENC_TYPE", "DC 1.10"),
        ("DIAGNOSIS_STG", None, "DC 1.13"),
        ("DIAGNOSIS_STG", "DX", "DC 3.04"),
    ])
    return run_checks(
        tables, manifest, valuesets=fixtures.value_sets(spark), version="5.1_STG",
        settings=Settings(union_parents=True),
    ).select(*MANIFEST_COLUMNS)


QUERIES: dict[str, Query] = {
    "primary_key_error": primary_key_error,
    "primary_key_composite": primary_key_composite,
    "value_validation": _value_query("DEMOGRAPHIC", "SEX", reference=False),
    "value_validation_name_case": _value_query("DEMOGRAPHIC", "sex", reference=False),
    "value_validation_ref": _value_query("DEMOGRAPHIC", "RACE", reference=True),
    "invalid_values": invalid_values,
    "unit_validity": unit_validity,
    "unit_validity_grammar": unit_validity_grammar,
    "missing_default": _missing("DEMOGRAPHIC", "SEX", "DC 1.07", 0),
    "missing_null_only": _missing("DEMOGRAPHIC", "BIRTH_DATE", "DC 3.03", 10),
    "missing_numeric": _missing("VITAL", "HT", "DC 1.07", 0),
    "missing_date": _missing("DEATH", "DEATH_DATE", "DC 1.07", 0),
    "missing_inpatient_date": _missing("ENCOUNTER", "DISCHARGE_DATE", "DC 3.03", 10),
    "missing_disposition": _missing("ENCOUNTER", "DISCHARGE_DISPOSITION", "DC 3.03", 10),
    "orphan_patients": _orphans("ENCOUNTER", "PATID", "DC 1.08", "DEMOGRAPHIC", "PATID"),
    "orphan_staging_union": orphan_staging_union,
    "orphan_encounters_pct": _orphans("DIAGNOSIS", "ENCOUNTERID", "DC 1.09", "ENCOUNTER", "ENCOUNTERID"),
    "orphan_providers": _orphans("ENCOUNTER", "PROVIDERID", "DC 1.12", "PROVIDER", "PROVIDERID"),
    "replication_field": _replication("ENC_TYPE"),
    "replication_date": _replication("ADMIT_DATE"),
    "replication_timestamp": _replication("SEEN", "LINE_MOMENTS", "VISIT_MOMENTS"),
    "record_duplication": record_duplication,
    "code_errors_diagnosis": _codes("DIAGNOSIS"),
    "code_errors_diagnosis_two_flags": _codes("DIAGNOSIS", min_flags=2),
    "code_errors_procedures": _codes("PROCEDURES"),
    "code_errors_condition": _codes("CONDITION"),
    "code_errors_prescribing": _codes("PRESCRIBING"),
    "code_errors_dispensing": _codes("DISPENSING"),
    "code_errors_lab_result_cm": _codes("LAB_RESULT_CM"),
    "code_errors_immunization": _codes("IMMUNIZATION"),
    "extreme_ht": _extreme("VITAL", "HT"),
    "extreme_wt": _extreme("VITAL", "WT"),
    "extreme_diastolic": _extreme("VITAL", "DIASTOLIC"),
    "extreme_systolic": _extreme("VITAL", "SYSTOLIC"),
    "extreme_supply": _extreme("DISPENSING", "DISPENSE_SUP"),
    "extreme_age": _age("days"),
    "extreme_age_years": _age("years"),
    "extreme_age_one_death": _age("days", ("S", "L")),
    "events_per_encounter_dx": _events("DIAGNOSIS", "DX", "DC 3.01"),
    "events_per_encounter_px": _events("PROCEDURES", "PX", "DC 3.02"),
    "patients_per_encounter": patients_per_encounter,
    "latency": _latency("PRESCRIBING", "RX_ORDER_DATE", "DC 3.11"),
    "latency_enc_type": _latency("ENCOUNTER", "ADMIT_DATE", "DC 3.07"),
    "latency_months": latency_months,
    "normal_range": _row_query("LAB_RESULT_CM", lambda: [row.normal_range("LAB_RESULT_CM", "RESULT_NUM")]),
    "required_tables": required_tables,
    "tables_populated": tables_populated,
    "required_fields": required_fields,
    "field_conformance": field_conformance,
    "profile_strings": profile_strings,
    "profile_numeric": profile_numeric,
    "profile_filtered": profile_filtered,
    "profile_long_integers": profile_long_integers,
    "profile_sketches": profile_sketches,
    "profile_report": profile_report,
    "run_manifest": run_manifest,
    "run_staging_manifest": run_staging_manifest,
}
