"""Value-set validation: counts and listings of values outside their set, unit validity."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.functions.exprs import name
from assayer.model import Check, local_table
from assayer.operators import grains, units
from assayer.operators.grains import Member, Use


def value_set_check(table: str, field: str, test: str = "DC 1.06") -> Check:
    return Check(test, table, field, threshold=0,
                 text=f"{{value}} rows of {table}.{field} hold a value outside its set.")


def production_name(table: str) -> str:
    """Staging tables are validated against the sets of the tables they feed."""
    return table.removesuffix("_STG")


def field_values(table: str, field: str) -> Member:
    return Member(table, f"cast({name(field)} as string)", f"{name(field)} is not null")


def value_counts(tables: dict[str, DataFrame], fields: dict[int, tuple[str, str]]) -> DataFrame:
    """``(check_id, value, n)`` for all given (table, field) pairs."""
    found = grains.counts(tables, {i: field_values(t, f) for i, (t, f) in fields.items()})
    return found.withColumnRenamed("member", "check_id")


def allowed_values(fields: dict[int, tuple[str, str]], valuesets: DataFrame) -> DataFrame:
    """Value-set items keyed by check.  Joins carry no hint: Catalyst broadcasts the sets
    when their known or observed size is small and shuffles them when it is not."""
    wanted = local_table(
        valuesets.sparkSession,
        pa.schema([("check_id", pa.int32()), ("table", pa.string()), ("field", pa.string())]),
        [{"check_id": i, "table": production_name(t).upper(), "field": f.upper()} for i, (t, f) in fields.items()],
    )
    sets = valuesets.select(F.upper("table").alias("table"), F.upper("field").alias("field"), F.col("item").cast("string").alias("value"))
    return wanted.join(sets, ["table", "field"]).select("check_id", "value").distinct()


def invalid_counts(
    tables: dict[str, DataFrame],
    fields: dict[int, tuple[str, str]],
    valuesets: DataFrame,
    unlisted: str = "valid",
) -> DataFrame:
    """``(check_id, value, n, invalid)`` for every distinct value of the fields.

    ``unlisted`` says how a field without any value set is read: ``valid`` when sets come
    as a list per field (nothing to compare with), ``invalid`` when they come as a
    reference table (no value is found in it).
    """
    counts = value_counts(tables, fields)
    allowed = allowed_values(fields, valuesets)
    marked = counts.join(allowed.withColumn("listed", F.lit(True)), ["check_id", "value"], "left")
    invalid = F.col("listed").isNull()
    if unlisted == "valid":
        with_set = allowed.select("check_id").distinct().withColumn("has_set", F.lit(True))
        marked = marked.join(with_set, "check_id", "left")
        invalid = invalid & F.col("has_set").isNotNull()
    return marked.select("check_id", "value", "n", invalid.alias("invalid"))


def value_set_evidence(
    tables: dict[str, DataFrame],
    fields: dict[int, tuple[str, str]],
    valuesets: DataFrame,
    unlisted: str = "valid",
) -> DataFrame:
    """Invalid rows over non-NULL rows, per check.  NULL is never invalid."""
    allowed = allowed_values(fields, valuesets).withColumnRenamed("check_id", "member")
    members = {i: field_values(t, f) for i, (t, f) in fields.items()}
    return grains.evidence(tables, members, [Use(i, i, "set") for i in fields], allowed, unlisted)


def invalid_values(
    tables: dict[str, DataFrame],
    fields: list[tuple[str, str]],
    valuesets: DataFrame,
    unlisted: str = "valid",
) -> DataFrame:
    """``(table, field, value, n)``: each invalid value, the most frequent first."""
    numbered = dict(enumerate(fields))
    names = local_table(
        valuesets.sparkSession,
        pa.schema([("check_id", pa.int32()), ("table", pa.string()), ("field", pa.string())]),
        [{"check_id": i, "table": t, "field": f} for i, (t, f) in numbered.items()],
    )
    return (
        invalid_counts(tables, numbered, valuesets, unlisted).where("invalid")
        .join(names, "check_id")
        .select("table", "field", "value", "n")
        .orderBy("table", "field", F.desc("n"), "value")
    )


def unit_validity(invalid: DataFrame, known_units: DataFrame | None = None, grammar: bool = False) -> DataFrame:
    """Mark invalid unit values VALID when the user's unit table knows them, or when with
    ``grammar`` they are codes of the unit grammar (``units``).

    ``known_units`` has a column ``unit``.
    """
    if known_units is not None:
        known = known_units.select(F.col("unit").alias("value")).distinct().withColumn("known", F.lit(True))
        invalid = invalid.join(known, "value", "left")
    else:
        invalid = invalid.withColumn("known", F.lit(None).cast("boolean"))
    coded = units.valid_code("value") if grammar else "false"
    return invalid.select(
        "table", "field", F.col("value").alias("unit"), "n",
        F.expr(f"if(coalesce(known, false) or {coded}, 'VALID', 'INVALID')").alias("valid"),
    )
