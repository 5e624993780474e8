"""Reference SQL for the queries, written for an independent SQL engine.

It states each rule as a plain query over the derived tables, not in the way the library
computes it: orphans by NOT EXISTS, replication by a join, percentiles by quantile_cont.
"""

from __future__ import annotations

from suite import fixtures
from suite.projections import TABLES, UNITS, with_tables

VALUE = {
    "count": "cast(numerator as double)",
    "pct2": "((20000*numerator + denominator) // (2*denominator)) / 100.0",
    "pct0": "cast((200*numerator + denominator) // (2*denominator) as double)",
    "pct1": "((2000*numerator + denominator) // (2*denominator)) / 10.0",
    "ratio2": "((200*numerator + denominator) // (2*denominator)) / 100.0",
}
FAILS = {"above": "value > threshold", "below": "value < threshold"}


def judged(inner: str, scale: str, threshold: str, fails: str = "above", extra: str = "") -> str:
    """Evidence rows with value and result; ``extra`` names columns carried along."""
    carry = f"{extra}, " if extra else ""
    bad = FAILS[fails]
    return (
        f"select {carry}numerator, denominator, value,"
        f" case when {bad} then 'FAIL' when not ({bad}) then 'PASS' end as result from ("
        f"select *, cast({VALUE[scale]} as double) as value, {threshold} as threshold from ("
        f"select {carry}cast(numerator as bigint) as numerator, cast(denominator as bigint) as denominator"
        f" from ({inner})))"
    )


def in_list(items) -> str:
    return "(" + ", ".join(f"'{v}'" for v in items) + ")"


# ---- evidence, as (numerator, denominator) --------------------------------------

def missing(table: str, field: str, coded: bool, inpatient: bool) -> str:
    bad = f"({field} in ('NI','OT','UN') or {field} is null)" if coded else f"{field} is null"
    scope = " where ENC_TYPE in ('IP','EI')" if inpatient else ""
    return f"select count(*) filter (where {bad}) as numerator, count(*) as denominator from {table}{scope}"


def orphans(child: str, key: str, parent: str, parent_key: str) -> str:
    return (
        f"select (select count(distinct {key}) from {child} c where not exists"
        f" (select 1 from {parent} p where p.{parent_key} = c.{key})) as numerator,"
        f" (select count(distinct {key}) from {child}) as denominator"
    )


def replicated(child: str, field: str, parent: str = "encounter") -> str:
    return (
        f"select count(*) filter (where a.{field} != b.{field}) as numerator,"
        f" count(*) filter (where a.{field} is not null and b.{field} is not null) as denominator"
        f" from {parent} a join {child} b on a.ENCOUNTERID = b.ENCOUNTERID"
    )


def primary_key(table: str, keys: str) -> str:
    return (
        f"select count(*) filter (where n > 1) as numerator, count(*) as denominator"
        f" from (select {keys}, count(*) as n from {table} group by {keys})"
    )


def duplication(table: str) -> str:
    return (
        f"select (select count(*) from (select ENCOUNTERID from {table} group by ENCOUNTERID"
        f" having count(distinct PATID) > 1)) as numerator,"
        f" (select count(distinct ENCOUNTERID) from {table}) as denominator"
    )


def outside(table: str, field: str, low: int, high: int, recorded: bool) -> str:
    den = f"count({field})" if recorded else "count(*)"
    return (
        f"select count(*) filter (where {field} not between {low} and {high}) as numerator,"
        f" {den} as denominator from {table}"
    )


#: The death of the best source, and of those the earliest.
ONE_DEATH = (
    "(select PATID, DEATH_DATE from (select *, row_number() over (partition by PATID order by"
    " case DEATH_SOURCE when 'S' then 0 when 'L' then 1 else 2 end, DEATH_DATE) as k from death"
    " where DEATH_DATE is not null) where k = 1)"
)


def age(unit: str, death: str = "death") -> str:
    until = "coalesce(h.DEATH_DATE, date '2024-12-31')"
    if unit == "days":
        years = f"date_diff('day', d.BIRTH_DATE, {until}) / 365.0"
    else:
        years = f"year({until}) - year(d.BIRTH_DATE)"
    return (
        f"select (select count(*) from demographic d left join {death} h on d.PATID = h.PATID"
        f" where {years} not between 0 and 89) as numerator,"
        f" (select count(*) from demographic) as denominator"
    )


def in_value_set(table: str, field: str, name: str) -> str:
    items = in_list(fixtures.VALUE_SETS[(name, field)])
    return (
        f"select count(*) filter (where {field} not in {items}) as numerator,"
        f" count({field}) as denominator from {table}"
    )


def share(table: str, base: str) -> str:
    return (
        f"select (select count(distinct PATID) from {table}) as numerator,"
        f" (select count(distinct PATID) from {base}) as denominator"
    )


NORMAL_RANGE = (
    "select count(*) filter (where NORM_RANGE_LOW is not null and NORM_RANGE_HIGH is not null"
    " and NORM_MODIFIER_LOW is not null and NORM_MODIFIER_HIGH is not null) as numerator,"
    " count(*) as denominator from lab_result_cm where LAB_LOINC is not null and RESULT_NUM is not null"
)


def months(table: str, field: str, counted: str) -> str:
    """Newest month, baseline rows and months: every row is ranked by its month."""
    return (
        f"select (select count(*) from ranked where rk = 1 and {counted}) as newest,"
        f" (select count(*) from ranked where rk between 10 and 21 and {counted}) as baseline_rows,"
        f" (select count(distinct rk) from ranked where rk between 10 and 21 and {counted}) as baseline_months"
        f" from (select 1)"
    ).replace("ranked", f"(select *, dense_rank() over (order by year({field})*100+month({field}) desc) as rk"
                        f" from {table} where {field} is not null)")


def latency(table: str, field: str, counted: str) -> str:
    return (
        f"select newest * baseline_months as numerator, baseline_rows as denominator"
        f" from ({months(table, field, counted)})"
    )


BY_TYPE = "ENC_TYPE in ('AV','ED','EI','IP')"


def events(table: str, type_field: str, known: list[str], thresholds: dict[str, float]) -> str:
    case = " ".join(f"when '{t}' then {v}" for t, v in thresholds.items())
    return (
        f"select a.enc_type as enc_type, a.n as numerator, b.n as denominator,"
        f" cast(case a.enc_type {case} end as double) as threshold from"
        f" (select ENC_TYPE as enc_type, count(*) as n from {table} where {type_field} in {in_list(known)}"
        f" group by ENC_TYPE) a full outer join"
        f" (select ENC_TYPE as enc_type, count(*) as n from encounter group by ENC_TYPE) b"
        f" on a.enc_type = b.enc_type where a.enc_type in ('AV','ED','EI','IP')"
    )


DX_EVENTS = ("DX_TYPE", ["09", "10", "11", "SM"], {"AV": 1.0, "ED": 1.0, "IP": 1.0, "EI": 1.0})
PX_EVENTS = ("PX_TYPE", ["09", "10", "11", "CH", "LC", "ND", "RE"],
             {"AV": 0.75, "ED": 0.75, "IP": 1.0, "EI": 1.0})


def judged_events(table: str, spec) -> str:
    return (
        f"select enc_type, cast(numerator as bigint) as numerator, cast(denominator as bigint) as denominator,"
        f" cast({VALUE['ratio2']} as double) as value,"
        f" case when {VALUE['ratio2']} < threshold then 'FAIL' else 'PASS' end as result, threshold"
        f" from ({events(table, *spec)})"
    )


def code_errors(table: str, code: str, type_expr: str, types: list[str], flags: list[str], least: int = 1) -> str:
    """``flags`` are CASE expressions over c (code) and t (type)."""
    total = " + ".join(f"(case when {f} then 1 else 0 end)" for f in flags)
    return (
        f"select t as code_type, sum(case when {total} >= {least} then 1 else 0 end) as numerator,"
        f" count(c) as denominator from (select {code} as c, {type_expr} as t,"
        f" length(replace({code}, '.', '')) as len from {table}) where t in {in_list(types)} group by t"
    )


ICD = [
    "t = '09' and regexp_matches(c, '^[A-DF-UW-Z]')",
    "(t = '09' and len not between 3 and 5) or (t = '10' and len not between 3 and 7)",
    "t = '10' and regexp_matches(c, '^[0-9]')",
    "(t = '09' and c in ('000')) or (t = '10' and c in ('000', '999'))",
]
LETTER = "regexp_matches(c, '[a-zA-Z]')"
NO_DIGIT = "not coalesce(regexp_matches(c, '[0-9]'), false)"
CODES = {
    "diagnosis": ("DX", "DX_TYPE", ["09", "10"], ICD, "pct2"),
    "condition": ("CONDITION", "CONDITION_TYPE", ["09", "10"], ICD, "pct2"),
    "procedures": ("PX", "PX_TYPE", ["CH", "09", "10"], [
        f"t = '09' and {LETTER}",
        "(t = 'CH' and len < 5) or (t = '09' and len not in (3, 4)) or (t = '10' and len != 7)",
        NO_DIGIT,
        "(t = 'CH' and c in ('00000', '99999')) or (t = '10' and c in ('0000000', '9999999'))",
    ], "pct2"),
    "prescribing": ("RXNORM_CUI", "'RX'", ["RX"], [LETTER, "len not between 2 and 7"], "pct0"),
    "dispensing": ("NDC", "'NC'", ["NC"], [
        LETTER, "len != 11", "c in ('00000000000', '99999999999')",
    ], "pct0"),
    "lab_result_cm": ("LAB_LOINC", "'LC'", ["LC"], [
        LETTER, "len not between 3 and 7", "length(c) - instr(c, '-') != 1",
    ], "pct0"),
    "immunization": ("VX_CODE", "VX_CODE_TYPE", ["CH", "CX", "RX"], [
        f"t in ('CX', 'RX') and {LETTER}",
        "(t = 'CH' and len < 5) or (t = 'CX' and len not in (2, 3)) or (t = 'RX' and len not between 2 and 7)",
        NO_DIGIT,
        "(t = 'CH' and c in ('00000', '99999')) or (t = 'CX' and c in ('000', '999'))",
    ], "pct2"),
}


def judged_codes(table: str, least: int = 1, extra: str = "code_type", source: str | None = None) -> str:
    code, kind, types, flags, scale = CODES[table]
    return judged(code_errors(source or table, code, kind, types, flags, least), scale, "5.0", extra=extra)


def listing(table: str, field: str, name: str) -> str:
    items = in_list(fixtures.VALUE_SETS[(name, field)])
    return (
        f"select '{name}' as \"table\", '{field}' as field, {field} as value, count(*) as n"
        f" from {table} where {field} not in {items} group by {field}"
    )


def populated() -> str:
    from assayer.model import POPULATED_TABLES

    rows = []
    for t in POPULATED_TABLES:
        if t in TABLES:
            rows.append(f"select '{t}' as \"table\", count(*) as numerator,"
                        f" case when count(*) > 0 then 'PASS' else 'FAIL' end as result from {t.lower()}")
        else:
            rows.append(f"select '{t}', null, 'FAIL'")
    return " union all ".join(rows)


# ---- specification ---------------------------------------------------------------

def specification() -> str:
    def lit(v):
        return "null" if v is None else (str(v) if isinstance(v, int) else f"'{v}'")
    rows = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in fixtures.SPECIFICATION)
    return f"(select * from (values {rows}) s(\"table\", field, ordinal, required, pk, dtype, len))"


SPEC_TABLES = ["DEMOGRAPHIC", "DIAGNOSIS", "VITAL", "LAB_RESULT_CM"]
FAMILY = {"VARCHAR": "string", "DATE": "date", "DOUBLE": "float"}


def live_columns() -> str:
    """(table, field, dtype, longest) of the derived tables, from their values."""
    family = " ".join(f"when '{k}' then '{v}'" for k, v in FAMILY.items())
    return "(" + " union all ".join(
        f"select '{t}' as \"table\", '{c}' as field, case typeof(any_value({c})) {family} end as dtype,"
        f" max(length(cast({c} as varchar))) as longest from {t.lower()}"
        for t in SPEC_TABLES for c in TABLES[t][0].columns
    ) + ")"


def conformance() -> str:
    joined = f"from {specification()} s left join {live_columns()} l on s.\"table\" = l.\"table\" and s.field = l.field"
    head = "select s.\"table\" as \"table\", s.field as field"
    none = "cast(null as bigint) as numerator, cast(null as bigint) as denominator, 'FAIL' as result"
    return (
        f"{head}, 'dtype' as part, {none} {joined} where l.field is null or l.dtype != s.dtype"
        f" union all {head}, 'name', {none} {joined} where l.field is null"
        f" union all {head}, 'length', cast(l.longest as bigint), cast(s.len as bigint), 'FAIL' {joined}"
        f" where s.len is not null and (l.field is null or l.longest > s.len)"
    )


def required_fields() -> str:
    parts = [
        f"select 'DC 1.03' as test, s.\"table\" as \"table\", s.field as field,"
        f" cast(null as bigint) as numerator, cast(null as bigint) as denominator, 'FAIL' as result"
        f" from {specification()} s left join {live_columns()} l on s.\"table\" = l.\"table\" and s.field = l.field"
        f" where s.required = 'Y' and l.field is null"
    ]
    for t, f, _, need, *_ in fixtures.SPECIFICATION:
        if need == "Y" and f in TABLES[t][0].columns:
            coded = f != "MEASURE_DATE"
            parts.append(
                f"select 'DC 1.07', '{t}', '{f}', numerator, denominator, result from"
                f" ({judged(missing(t.lower(), f, coded, False), 'pct2', '0.0')})"
            )
    return " union all ".join(parts)


# ---- profiles --------------------------------------------------------------------

def pct(part: str) -> str:
    return f"((2000*{part} + cn) // (2*cn)) / 10.0"


def text_profile(table: str, field: str, where: str = "") -> str:
    return (
        f"select '{field}' as field, cn, nd, {pct('nd')} as pct_dist, n_null, {pct('n_null')} as pct_null,"
        f" n_ni, {pct('n_ni')} as pct_missing, min_text, max_text from ("
        f"select count(*) as cn, count(distinct {field}) as nd, count(*) - count({field}) as n_null,"
        f" count(*) filter (where cast({field} as varchar) in ('NI','UN','OT')) as n_ni,"
        f" cast(min({field}) as varchar) as min_text, cast(max({field}) as varchar) as max_text from {table} {where})"
    )


def numeric_profile(table: str, field: str, where: str = "") -> str:
    q = ", ".join(
        f"round(quantile_cont({field}, {p}), 6) as {n}"
        for n, p in (("p05", 0.05), ("p25", 0.25), ("median", 0.5), ("p75", 0.75), ("p95", 0.95))
    )
    return (
        f"select '{field}' as field, cn, nd, {pct('nd')} as pct_dist, n_null, {pct('n_null')} as pct_null,"
        f" min_num, p05, p25, median, mean, p75, p95, max_num from ("
        f"select count(*) as cn, count(distinct {field}) as nd, count(*) - count({field}) as n_null,"
        f" min({field}) as min_num, max({field}) as max_num, round(avg({field}), 4) as mean, {q}"
        f" from {table} {where})"
    )


def exact_profile(table: str, field: str) -> str:
    return (
        f"select '{field}' as field, count(*) as cn, count(distinct {field}) as nd, count(*) - count({field}) as n_null,"
        f" cast(min({field}) as varchar) as min_exact, cast(max({field}) as varchar) as max_exact from {table}"
    )


def sketch_profile(table: str, field: str) -> str:
    close = ", ".join(f"true as {n}_close" for n in ("nd", "p05", "p25", "median", "p75", "p95"))
    return (
        f"select '{field}' as field, count(*) as cn, count(*) - count({field}) as n_null,"
        f" min({field}) as min_num, max({field}) as max_num, {close} from {table}"
    )


NUMERIC_ONLY = ["min_num", "p05", "p25", "median", "mean", "p75", "p95", "max_num"]


def profile_filtered() -> str:
    where, parts = "where RESULT_UNIT = 'click'", []
    for column in TABLES["LAB_RESULT_CM"][0].columns:
        if column == "RESULT_NUM":
            shown = ["cn", "nd", "pct_dist", "n_null", "pct_null", "cast(null as bigint) as n_ni", "cast(null as double) as pct_missing",
                     "cast(null as varchar) as min_text", "cast(null as varchar) as max_text", *NUMERIC_ONLY]
            inner = numeric_profile("lab_result_cm", column, where)
        else:
            shown = ["cn", "nd", "pct_dist", "n_null", "pct_null", "n_ni", "pct_missing", "min_text", "max_text",
                     *[f"cast(null as double) as {c}" for c in NUMERIC_ONLY]]
            inner = text_profile("lab_result_cm", column, where)
        parts.append(f"select field, {', '.join(shown)} from ({inner})")
    return " union all ".join(parts)


def profile_report() -> str:
    parts = []
    for t in ("DEMOGRAPHIC", "VITAL", "LAB_RESULT_CM"):
        spec = {f: (need, ordinal) for name, f, ordinal, need, *_ in fixtures.SPECIFICATION if name == t}
        for position, (column, expression) in enumerate(TABLES[t][0].columns.items(), 1):
            need, ordinal = spec.get(column, (None, position))
            numeric = column in ("HT", "WT", "DIASTOLIC", "SYSTOLIC", "RESULT_NUM")
            inner = numeric_profile(t.lower(), column) if numeric else text_profile(t.lower(), column)
            nothing = "cast(null as double)"
            columns = ["cn", "nd", "pct_dist", "n_null", "pct_null"]
            columns += (
                ["cast(null as bigint) as n_ni", f"{nothing} as pct_missing",
                 "cast(null as varchar) as min_text", "cast(null as varchar) as max_text",
                 "min_num", "p05", "p25", "median", "mean", "p75", "p95", "max_num"]
                if numeric else
                ["n_ni", "pct_missing", "min_text", "max_text"]
                + [f"{nothing} as {c}" for c in ("min_num", "p05", "p25", "median", "mean", "p75", "p95", "max_num")]
            )
            required = "cast(null as varchar)" if need is None else f"'{need}'"
            parts.append(
                f"select '{t}' as \"table\", field, {required} as required, cast({ordinal} as integer) as ordinal,"
                f" {', '.join(columns)} from ({inner})"
            )
    return " union all ".join(parts)


# ---- the runner ------------------------------------------------------------------

def line(test: str, table: str, field: str | None, inner: str, scale: str, threshold: str,
         fails: str = "above", group: str | None = None) -> str:
    def lit(v):
        return "cast(null as varchar)" if v is None else f"'{v}'"
    return (
        f"select {lit(test)} as test, {lit(table)} as \"table\", {lit(field)} as field, {lit(group)} as \"group\","
        f" numerator, denominator, value, result from ({judged(inner, scale, threshold, fails)})"
    )


def code_lines(table: str, name: str, source: str | None = None) -> str:
    field = CODES[table][0]
    return (
        f"select 'DC 1.13' as test, '{name}' as \"table\", '{field}' as field, code_type as \"group\","
        f" numerator, denominator, value, result from ({judged_codes(table, source=source)})"
    )


def event_lines(test: str, table: str, field: str, spec) -> str:
    return (
        f"select '{test}', '{table.upper()}', '{field}', enc_type, numerator, denominator, value, result"
        f" from ({judged_events(table, spec)})"
    )


def populated_lines() -> str:
    return (
        "select 'DC 1.02', \"table\", null, null, numerator,"
        " numerator, cast(numerator as double), result"
        f" from ({populated()})"
    )


def run_manifest() -> str:
    return " union all ".join([
        line("DC 1.05", "DIAGNOSIS", "DIAGNOSISID", primary_key("diagnosis", "DIAGNOSISID"), "count", "0.0"),
        line("DC 1.05", "DEATH", "PATID, DEATH_SOURCE", primary_key("death", "PATID, DEATH_SOURCE"), "count", "0.0"),
        populated_lines(),
        line("DC 1.06", "DEMOGRAPHIC", "SEX", in_value_set("demographic", "SEX", "DEMOGRAPHIC"), "count", "0.0"),
        line("DC 1.06", "DIAGNOSIS", "DX_TYPE", in_value_set("diagnosis", "DX_TYPE", "DIAGNOSIS"), "count", "0.0"),
        line("DC 1.07", "DEMOGRAPHIC", "SEX", missing("demographic", "SEX", True, False), "pct2", "0.0"),
        line("DC 1.07", "ENCOUNTER", "DISCHARGE_DATE", missing("encounter", "DISCHARGE_DATE", False, True), "pct2", "0.0"),
        line("DC 1.08", "ENCOUNTER", "PATID", orphans("encounter", "PATID", "demographic", "PATID"), "count", "0.0"),
        line("DC 1.08", "DIAGNOSIS", "PATID", orphans("diagnosis", "PATID", "demographic", "PATID"), "count", "0.0"),
        line("DC 1.09", "DIAGNOSIS", "ENCOUNTERID",
             orphans("diagnosis", "ENCOUNTERID", "encounter", "ENCOUNTERID"), "pct2", "5.0"),
        line("DC 1.09", "PROCEDURES", "ENCOUNTERID",
             orphans("procedures", "ENCOUNTERID", "encounter", "ENCOUNTERID"), "pct2", "5.0"),
        *[line("DC 1.10", t.upper(), f, replicated(t, f), "count", "0.0")
          for t in ("diagnosis", "procedures") for f in ("ENC_TYPE", "ADMIT_DATE")],
        line("DC 1.11", "DIAGNOSIS", "ENCOUNTERID", duplication("diagnosis"), "pct2", "5.0"),
        line("DC 1.11", "ENCOUNTER", "ENCOUNTERID", duplication("encounter"), "pct2", "5.0"),
        line("DC 1.12", "ENCOUNTER", "PROVIDERID",
             orphans("encounter", "PROVIDERID", "provider", "PROVIDERID"), "count", "0.0"),
        code_lines("diagnosis", "DIAGNOSIS"),
        code_lines("lab_result_cm", "LAB_RESULT_CM"),
        line("DC 2.02", "DEMOGRAPHIC", "AGE", age("days"), "pct2", "10.0"),
        line("DC 2.02", "DISPENSING", "DISPENSE_SUP", outside("dispensing", "DISPENSE_SUP", 1, 90, False), "pct2", "10.0"),
        line("DC 2.02", "VITAL", "HT", outside("vital", "HT", 0, 94, True), "pct2", "10.0"),
        event_lines("DC 3.01", "diagnosis", "DX", DX_EVENTS),
        event_lines("DC 3.02", "procedures", "PX", PX_EVENTS),
        line("DC 3.03", "ENCOUNTER", "DISCHARGE_DISPOSITION",
             missing("encounter", "DISCHARGE_DISPOSITION", True, True), "pct2", "10.0"),
        line("DC 3.04", "DIAGNOSIS", "DX", share("diagnosis", "encounter"), "pct1", "50.0", "below"),
        line("DC 3.05", "PROCEDURES", "PX", share("procedures", "encounter"), "pct1", "50.0", "below"),
        line("DC 3.07", "ENCOUNTER", "ADMIT_DATE", latency("encounter", "ADMIT_DATE", BY_TYPE), "pct2", "75.0", "below"),
        line("DC 3.10", "LAB_RESULT_CM", "RESULT_NUM", NORMAL_RANGE, "pct2", "80.0", "below"),
        line("DC 3.11", "PRESCRIBING", "RX_ORDER_DATE", latency("prescribing", "RX_ORDER_DATE", "true"), "pct2", "75.0", "below"),
    ])


STAGED = "(select * from encounter where ENC_TYPE in ('IP','EI'))"
BOTH = "(select * from encounter where ENC_TYPE in ('IP','EI','AV'))"


def run_staging_manifest() -> str:
    return " union all ".join([
        line("DC 1.06", "DIAGNOSIS_STG", "DX_TYPE", in_value_set("diagnosis", "DX_TYPE", "DIAGNOSIS"), "count", "0.0"),
        line("DC 1.08", "DIAGNOSIS_STG", "PATID", orphans("diagnosis", "PATID", "demographic", "PATID"), "count", "0.0"),
        line("DC 1.09", "DIAGNOSIS_STG", "ENCOUNTERID",
             orphans("diagnosis", "ENCOUNTERID", BOTH, "ENCOUNTERID"), "pct2", "5.0"),
        line("DC 1.10", "DIAGNOSIS_STG", "ENC_TYPE", replicated("diagnosis", "ENC_TYPE", STAGED), "count", "0.0"),
        code_lines("diagnosis", "DIAGNOSIS_STG"),
        line("DC 3.04", "DIAGNOSIS_STG", "DX", share("diagnosis", STAGED), "pct1", "50.0", "below"),
    ])


def required_tables() -> str:
    from assayer.model import REQUIRED_TABLES

    absent = [t for t in REQUIRED_TABLES["5.1"] if t not in TABLES]
    return " union all ".join(
        [f"select 'DC 1.02' as test, \"table\", numerator, result from ({populated()})"]
        + [f"select 'DC 1.01', '{t}', null, 'FAIL'" for t in absent]
    )


def build() -> dict[str, str]:
    every = list(TABLES)

    def simple(inner, scale, threshold, *tables, fails="above"):
        return with_tables(judged(inner, scale, threshold, fails), *tables)

    out = {
        "primary_key_error": simple(primary_key("diagnosis", "DIAGNOSISID"), "count", "0.0", "DIAGNOSIS"),
        "primary_key_composite": judged(primary_key("lineitem", "l_orderkey, l_linenumber"), "count", "0.0"),
        "value_validation": simple(in_value_set("demographic", "SEX", "DEMOGRAPHIC"), "count", "0.0", "DEMOGRAPHIC"),
        "value_validation_name_case": simple(in_value_set("demographic", "SEX", "DEMOGRAPHIC"), "count", "0.0", "DEMOGRAPHIC"),
        "value_validation_ref": simple(in_value_set("demographic", "RACE", "DEMOGRAPHIC"), "count", "0.0", "DEMOGRAPHIC"),
        "invalid_values": with_tables(" union all ".join([
            listing("demographic", "SEX", "DEMOGRAPHIC"), listing("demographic", "RACE", "DEMOGRAPHIC"),
            listing("diagnosis", "DX_TYPE", "DIAGNOSIS"),
        ]), "DEMOGRAPHIC", "DIAGNOSIS"),
        "unit_validity": with_tables(
            f"select value as unit, n, case when value in {in_list(fixtures.KNOWN_UNITS)} then 'VALID'"
            f" else 'INVALID' end as valid from ({listing('lab_result_cm', 'RESULT_UNIT', 'LAB_RESULT_CM')})",
            "LAB_RESULT_CM"),
        "missing_default": simple(missing("demographic", "SEX", True, False), "pct2", "0.0", "DEMOGRAPHIC"),
        "missing_null_only": simple(missing("demographic", "BIRTH_DATE", False, False), "pct2", "10.0", "DEMOGRAPHIC"),
        "missing_numeric": simple(missing("vital", "HT", False, False), "pct2", "0.0", "VITAL"),
        "missing_date": simple(missing("death", "DEATH_DATE", False, False), "pct2", "0.0", "DEATH"),
        "unit_validity_grammar": with_tables(
            "select value as unit, n, case when good then 'VALID' else 'INVALID' end as valid"
            f" from ({listing('lab_units', 'RESULT_UNIT', 'LAB_UNITS')}) join (values "
            + ", ".join(f"('{u}', {str(good).lower()})" for u, good in UNITS.items()) + ") judged(unit, good) on unit = value",
            "LAB_UNITS"),
        "missing_inpatient_date": simple(missing("encounter", "DISCHARGE_DATE", False, True), "pct2", "10.0", "ENCOUNTER"),
        "missing_disposition": simple(
            missing("encounter", "DISCHARGE_DISPOSITION", True, True), "pct2", "10.0", "ENCOUNTER"),
        "orphan_patients": simple(
            orphans("encounter", "PATID", "demographic", "PATID"), "count", "0.0", "ENCOUNTER", "DEMOGRAPHIC"),
        "orphan_staging_union": simple(
            orphans("diagnosis", "ENCOUNTERID", BOTH, "ENCOUNTERID"), "pct2", "5.0", "DIAGNOSIS", "ENCOUNTER"),
        "orphan_encounters_pct": simple(
            orphans("diagnosis", "ENCOUNTERID", "encounter", "ENCOUNTERID"), "pct2", "5.0", "DIAGNOSIS", "ENCOUNTER"),
        "orphan_providers": simple(
            orphans("encounter", "PROVIDERID", "provider", "PROVIDERID"), "count", "0.0", "ENCOUNTER", "PROVIDER"),
        "replication_field": simple(replicated("diagnosis", "ENC_TYPE"), "count", "0.0", "ENCOUNTER", "DIAGNOSIS"),
        "replication_date": simple(replicated("diagnosis", "ADMIT_DATE"), "count", "0.0", "ENCOUNTER", "DIAGNOSIS"),
        "replication_timestamp": simple(
            replicated("line_moments", "SEEN", "visit_moments"), "count", "0.0", "VISIT_MOMENTS", "LINE_MOMENTS"),
        "record_duplication": simple(duplication("diagnosis"), "pct2", "5.0", "DIAGNOSIS"),
        "extreme_ht": simple(outside("vital", "HT", 0, 94, True), "pct2", "10.0", "VITAL"),
        "extreme_wt": simple(outside("vital", "WT", 0, 350, True), "pct2", "10.0", "VITAL"),
        "extreme_diastolic": simple(outside("vital", "DIASTOLIC", 40, 120, True), "pct2", "10.0", "VITAL"),
        "extreme_systolic": simple(outside("vital", "SYSTOLIC", 40, 210, True), "pct2", "10.0", "VITAL"),
        "extreme_supply": simple(outside("dispensing", "DISPENSE_SUP", 1, 90, False), "pct2", "10.0", "DISPENSING"),
        "extreme_age": simple(age("days"), "pct2", "10.0", "DEMOGRAPHIC", "DEATH"),
        "extreme_age_one_death": simple(age("days", ONE_DEATH), "pct2", "10.0", "DEMOGRAPHIC", "DEATH"),
        "extreme_age_years": simple(age("years"), "pct2", "10.0", "DEMOGRAPHIC", "DEATH"),
        "events_per_encounter_dx": with_tables(judged_events("diagnosis", DX_EVENTS), "DIAGNOSIS", "ENCOUNTER"),
        "events_per_encounter_px": with_tables(judged_events("procedures", PX_EVENTS), "PROCEDURES", "ENCOUNTER"),
        "patients_per_encounter": simple(
            share("diagnosis", "encounter"), "pct1", "50.0", "DIAGNOSIS", "ENCOUNTER", fails="below"),
        "latency": simple(
            latency("prescribing", "RX_ORDER_DATE", "true"), "pct2", "75.0", "PRESCRIBING", fails="below"),
        "latency_enc_type": simple(
            latency("encounter", "ADMIT_DATE", BY_TYPE), "pct2", "75.0", "ENCOUNTER", fails="below"),
        "latency_months": with_tables(
            f"select cast(0 as integer) as check_id, * from ({months('encounter', 'ADMIT_DATE', BY_TYPE)})"
            f" union all select 1, * from ({months('prescribing', 'RX_ORDER_DATE', 'true')})",
            "ENCOUNTER", "PRESCRIBING"),
        "normal_range": simple(NORMAL_RANGE, "pct2", "80.0", "LAB_RESULT_CM", fails="below"),
        "required_tables": with_tables(required_tables(), *every),
        "tables_populated": with_tables(populated(), *every),
        "required_fields": with_tables(required_fields(), *SPEC_TABLES),
        "field_conformance": with_tables(conformance(), *SPEC_TABLES),
        "profile_strings": with_tables(
            " union all ".join(text_profile("demographic", c) for c in TABLES["DEMOGRAPHIC"][0].columns),
            "DEMOGRAPHIC"),
        "profile_numeric": with_tables(
            " union all ".join(numeric_profile("vital", c) for c in ("HT", "WT", "DIASTOLIC", "SYSTOLIC")), "VITAL"),
        "profile_filtered": with_tables(profile_filtered(), "LAB_RESULT_CM"),
        "profile_long_integers": with_tables(
            " union all ".join(exact_profile("long_numbers", c) for c in ("NUMBER", "AMOUNT")), "LONG_NUMBERS"),
        "profile_sketches": with_tables(
            " union all ".join(sketch_profile("vital", c) for c in ("HT", "WT", "DIASTOLIC", "SYSTOLIC")), "VITAL"),
        "profile_report": with_tables(profile_report(), "DEMOGRAPHIC", "VITAL", "LAB_RESULT_CM"),
        "run_manifest": with_tables(run_manifest(), *every),
        "run_staging_manifest": with_tables(run_staging_manifest(), "DEMOGRAPHIC", "DIAGNOSIS", "ENCOUNTER"),
    }
    for table in CODES:
        out[f"code_errors_{table}"] = with_tables(judged_codes(table), table.upper())
    out["code_errors_diagnosis_two_flags"] = with_tables(judged_codes("diagnosis", least=2), "DIAGNOSIS")
    return out


ORACLE = build()
