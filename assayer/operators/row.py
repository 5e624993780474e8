"""Checks that look at one row at a time: populated tables, missing values, extreme
values, normal ranges and code formats.

Each is a pair of predicates counted over the table, so any number of them share one
scan and one aggregate without a grouping key: a few longs per task are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer import model
from assayer.functions.exprs import missing_or_null, name, outside, rows_of, texts
from assayer.model import Check, union_all

# Aggregates with more output fields than spark.sql.codegen.maxFields (100) lose
# whole-stage code generation, so a pass holds at most this many counters.
COUNTERS_PER_PASS = 90


@dataclass(frozen=True)
class Measure:
    """Predicates to count.  ``denominator`` None counts all rows; with ``seen`` the check
    gives no result row unless that predicate occurs.  With ``whole`` the numerator is an
    aggregate itself.  ``filled``: aggregates that count rows and values only and give the same
    numerator by subtraction, see ``footer_evidence``."""

    check: Check | None
    numerator: str
    denominator: str | None = None
    seen: str | None = None
    whole: bool = False
    filled: str | None = None

    def counters(self) -> dict[str, str | None]:
        """The aggregates of the measure, by what they stand for."""
        def count(predicate: str | None) -> str:
            return "count(*)" if predicate is None else f"count_if({predicate})"

        return {
            "numerator": self.numerator if self.whole else count(self.numerator),
            "denominator": count(self.denominator),
            "seen": None if self.seen is None else count(self.seen),
        }


def row_evidence(df: DataFrame, measures: dict[int, Measure], footers: bool = False) -> DataFrame:
    """Evidence of all measures of one table, from one scan unless they need very many counters.
    With ``footers`` what counts rows and NULLs only is asked apart, without reading a value
    where the source knows these counts."""
    if footers and any(m.filled for m in measures.values()):
        rest = {i: m for i, m in measures.items() if not m.filled}
        counted = footer_evidence(df, {i: m for i, m in measures.items() if m.filled})
        return union_all([counted, row_evidence(df, rest)] if rest else [counted])
    passes: list[list[tuple[int, Measure]]] = []
    counted: set[str] = set()
    for item in measures.items():
        own = {c for c in item[1].counters().values() if c}
        if not passes or len(counted | own) > COUNTERS_PER_PASS:
            passes.append([])
            counted = set()
        counted |= own
        passes[-1].append(item)
    return union_all([_one_pass(df, items) for items in passes])


def _one_pass(df: DataFrame, items: Sequence[tuple[int, Measure]]) -> DataFrame:
    # Equal predicates are counted once.
    counted: dict[str, str] = {}
    rows = []
    for i, m in items:
        parts = {k: c and counted.setdefault(c, f"k{len(counted)}") for k, c in m.counters().items()}
        rows.append({"check_id": str(i), **parts, "seen": parts["seen"] or "1L"})
    totals = df.agg(*[F.expr(f"{expression} as {alias}") for expression, alias in counted.items()])
    return totals.selectExpr(rows_of(rows)).where("seen > 0").drop("seen")


def footer_evidence(df: DataFrame, measures: dict[int, Measure]) -> DataFrame:
    """Evidence of measures with ``filled``, from plain counts of rows and of values."""
    counted = {"count(*)": "k0"}
    for m in measures.values():
        counted.setdefault(m.filled, f"k{len(counted)}")
    totals = df.agg(*[F.expr(f"{expression} as {alias}") for expression, alias in counted.items()])
    return totals.selectExpr(rows_of(
        {"check_id": str(i), "numerator": "k0" if m.filled == "count(*)" else f"k0 - {counted[m.filled]}", "denominator": "k0"}
        for i, m in measures.items()
    ))


def longest(field: str) -> Measure:
    """Length of the longest value of a column, as text."""
    return Measure(None, f"cast(max(length(cast({name(field)} as string))) as bigint)", whole=True)


def rows_present(table: str, test: str = "DC 1.02") -> Measure:
    return Measure(
        Check(test, table, fails="not_above", text=f"{table} has {{value}} rows."), "true", filled="count(*)",
    )


def missing_or_unknown(table: str, field: str, test: str, threshold: float) -> Measure:
    """Share of rows where the field is missing, by the field's own notion of missing."""
    kind = field.upper()
    coded = missing_or_null(field, model.MISSING_CODES)
    absent = f"{name(field)} is null"
    inpatient = f"ENC_TYPE in {texts(model.INPATIENT_TYPES)}"
    if kind in model.INPATIENT_CODED_FIELDS:
        num, den = f"{coded} and {inpatient}", inpatient
    elif kind in model.INPATIENT_DATE_FIELDS:
        num, den = f"{absent} and {inpatient}", inpatient
    elif kind in model.NULL_ONLY_FIELDS:
        num, den = absent, None
    else:
        num, den = coded, None
    message = f"{{value}} percent of {table}.{field} is missing or unknown."
    filled = f"count({name(field)})" if (num, den) == (absent, None) else None
    return Measure(Check(test, table, field, None, threshold, "pct2", "above", message), num, den, filled=filled)


def extreme_values(table: str, field: str, test: str = "DC 2.02") -> Measure:
    """Share of values outside the plausible range (AGE needs a join: ``age.py``)."""
    low, high = model.BOUNDS[field.upper()]
    den = f"{name(field)} is not null" if field.upper() in model.RECORDED_VALUE_FIELDS else None
    message = f"{{value}} percent of {table}.{field} is outside {low} to {high}."
    check = Check(test, table, field, None, model.EXTREME_PCT, "pct2", "above", message)
    return Measure(check, outside(field, low, high), den)


def normal_range(table: str, field: str, test: str = "DC 3.10") -> Measure:
    """Share of numeric results of mapped tests whose normal range is fully given."""
    scope = "LAB_LOINC is not null and RESULT_NUM is not null"
    full = " and ".join(f"{c} is not null" for c in model.NORMAL_RANGE_FIELDS)
    message = f"{{value}} percent of numeric results in {table} have a full normal range."
    check = Check(test, table, field, None, model.NORMAL_RANGE_PCT, "pct2", "below", message)
    return Measure(check, f"{scope} and {full}", scope)
