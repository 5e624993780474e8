"""Conformance of live schemas to the specification: tables, columns, types, lengths.

Catalog and specification are control data; only observed lengths read the tables.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.model import RESULT_COLUMNS, evidence_rows, local_table, union_all
from assayer.operators import row
from assayer.sources.registry import Tables, catalog


def _result(df: DataFrame, test: str, text: Column, **given: Column) -> DataFrame:
    types = {"numerator": "bigint", "denominator": "bigint", "value": "double", "threshold": "double"}
    columns = {
        "test": F.lit(test), "result": F.lit("FAIL"), "text": text, **given,
    }
    return df.select(*[
        columns.get(c, F.lit(None)).cast(types.get(c, "string")).alias(c) for c in RESULT_COLUMNS
    ])


def pass_when_empty(failures: DataFrame, test: str, text: str) -> DataFrame:
    """The failures, or one PASS row when there is none."""
    clean = failures.agg(F.count(F.lit(1)).alias("n")).where("n = 0")
    return failures.unionByName(_result(clean, test, F.lit(text), result=F.lit("PASS")))


def required_tables(tables: Tables, required: DataFrame, test: str = "DC 1.01") -> DataFrame:
    """One FAIL row per required table that is not registered, or one PASS row.

    ``required`` has a column ``table``.
    """
    present = catalog(required.sparkSession, tables).select("table").distinct()
    missing = required.select(F.upper("table").alias("table")).join(present, "table", "left_anti")
    failures = _result(
        missing, test, F.format_string("Required table %s is not present.", "table"),
        table=F.col("table"),
    )
    return pass_when_empty(failures, test, "All required tables are present.")


def required_fields(tables: Tables, metadata: DataFrame, test: str = "DC 1.03") -> DataFrame:
    """One FAIL row per required column that is absent; no row when all are there."""
    live = catalog(metadata.sparkSession, tables).select("table", "field")
    missing = metadata.where("required = 'Y'").join(live, ["table", "field"], "left_anti")
    return _result(
        missing, test, F.format_string("Required field %s of %s is not present.", "field", "table"),
        table=F.col("table"), field=F.col("field"),
    )


def field_conformance(
    tables: Tables, metadata: DataFrame, test: str = "DC 1.04", lengths: str = "declared",
    observed: DataFrame | None = None,
) -> DataFrame:
    """FAIL rows for columns deviating in type, length or name; ``group`` says which.

    An absent column deviates in type and name, and in length when it has one.  With
    ``lengths="declared"`` the live declared length must equal the specified one; with
    ``"observed"`` no value may be longer; ``"auto"`` takes the declared length where there
    is one and else the observed one, which suits files, where strings carry no length.
    ``observed`` gives the observed lengths where a run has measured them already.
    """
    live = catalog(metadata.sparkSession, tables)
    dtype = metadata.join(live, ["table", "field", "dtype"], "left_anti").select("table", "field")
    name = metadata.join(live, ["table", "field"], "left_anti").select("table", "field")
    spec = metadata.where("length is not null").select("table", "field", F.col("length").alias("spec"))
    declared = live.select("table", "field", "length", F.lit(True).alias("exact"))
    if lengths == "declared":
        found = declared
    else:
        known = declared.where("length is not null" if lengths == "auto" else "false")
        rest = metadata.join(known, ["table", "field"], "left_anti")
        seen = observed_lengths(tables, rest) if observed is None else observed.join(
            known.select("table", "field"), ["table", "field"], "left_anti")
        found = known.unionByName(seen.withColumn("exact", F.lit(False)))
    fits = F.when(F.col("exact"), F.col("length") == F.col("spec")).otherwise(
        F.coalesce(F.col("length"), F.lit(0)) <= F.col("spec")
    )
    length = (
        spec.join(found.withColumn("present", F.lit(True)), ["table", "field"], "left")
        .where(~F.coalesce(F.col("present") & fits, F.lit(False)))
    )

    def rows(df: DataFrame, group: str, **given: Column) -> DataFrame:
        text = F.format_string(f"%s of %s does not conform to the specification ({group}).", "field", "table")
        return _result(df, test, text, table=F.col("table"), field=F.col("field"),
                       group=F.lit(group), **given)

    return union_all([
        rows(dtype, "dtype"),
        rows(length, "length", numerator=F.col("length"), denominator=F.col("spec")),
        rows(name, "name"),
    ])


def limited_columns(tables: Tables, metadata: DataFrame) -> list[tuple[str, str]]:
    """Live columns with a specified length."""
    limited = {
        (r["table"], r["field"])
        for r in metadata.where("length is not null").select("table", "field").collect()
    }
    return [(t, f) for t, df in tables.items() for f in df.columns if (t, f.upper()) in limited]


def named_lengths(measured: DataFrame, columns: dict[int, tuple[str, str]]) -> DataFrame:
    """``(table, field, length)`` from evidence of ``row.longest`` by check id."""
    names = local_table(
        measured.sparkSession, pa.schema([("check_id", pa.int32()), ("table", pa.string()), ("field", pa.string())]),
        [{"check_id": i, "table": t, "field": f.upper()} for i, (t, f) in columns.items()],
    )
    return measured.join(names, "check_id").select("table", "field", F.col("numerator").cast("int").alias("length"))


def observed_lengths(tables: Tables, metadata: DataFrame) -> DataFrame:
    """``(table, field, length)``: longest value of each column with a specified length."""
    columns = dict(enumerate(limited_columns(tables, metadata)))
    parts = [evidence_rows(metadata.sparkSession, [])]
    for table in dict.fromkeys(t for t, _ in columns.values()):
        own = {i: row.longest(f) for i, (t, f) in columns.items() if t == table}
        parts.append(row.row_evidence(tables[table], own))
    return named_lengths(union_all(parts), columns)
