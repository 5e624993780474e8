"""Recency: rows of the newest month against the average of an earlier year of months."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer import model
from assayer.functions.exprs import month_index, name, texts
from assayer.model import Check, local_table
from assayer.operators import grains
from assayer.operators.grains import Member


def latency_check(table: str, field: str, test: str) -> Check:
    return Check(test, table, field, None, model.LATENCY_PCT, "pct2", "below",
                 f"The newest month of {table}.{field} holds {{value}} percent of the baseline rows.")


def months(table: str, field: str, by_enc_type: bool) -> Member:
    """Rows by month of ``field``; with ``by_enc_type`` rows of other than the main encounter
    types weigh nothing, but their months are ranked."""
    weight = f"if(ENC_TYPE in {texts(model.ENCOUNTER_TYPES)}, 1L, 0L)" if by_enc_type else "1L"
    return Member(table, f"cast({month_index(field)} as string)", f"{name(field)} is not null", weight)


def latency_parts(sources: dict[int, tuple[DataFrame, str, bool]]) -> DataFrame:
    """``(check_id, newest, baseline_rows, baseline_months)``.

    ``sources``: check id -> (table, date field, by encounter type).  Months are ranked
    by presence in the table, newest first; with ``by encounter type`` the ranks still
    come from all rows but only rows of the main encounter types are counted, and months
    without any leave the average.  Rows are counted per month before they are ranked, so
    what is ranked is months, not rows.
    """
    tables = {str(i): df for i, (df, *_) in sources.items()}
    counted = grains.counts(tables, {i: months(str(i), f, by_type) for i, (_, f, by_type) in sources.items()})
    # A row without a month keeps a check on an empty table in the result.
    empty = local_table(
        counted.sparkSession,
        pa.schema([("member", pa.int32()), ("value", pa.string()), ("n", pa.int64())]),
        [{"member": i, "value": None, "n": 0} for i in sources],
    )
    ranked = counted.unionByName(empty).groupBy("member", "value").agg(F.sum("n").alias("n")).groupBy("member").agg(
        F.expr(grains.MONTHS.format("true")).alias("months"))
    return ranked.selectExpr("member as check_id", *[f"{e} as {c}" for c, e in grains.recency("months").items()])


def latency_evidence(sources: dict[int, tuple[DataFrame, str, bool]]) -> DataFrame:
    """newest / (baseline_rows / baseline_months), kept in integers."""
    return latency_parts(sources).selectExpr(
        "check_id", "newest * baseline_months as numerator", "baseline_rows as denominator",
    )
