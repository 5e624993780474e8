"""Replication errors: fields copied from a parent row that differ in the child row.

The number of differing (child row, parent row) pairs is the number of pairs with both
values present minus the pairs with equal values.  Both are sums of products of counts,
so no pair is ever formed.  Copies mostly agree with their source, so counting rows per
(key, field values) first leaves little more than one row per key.  Counts are then taken in
two levels: by (key, field, value), which spreads a key with very many values over all
tasks, and by (key, field), where each task adds up what it holds of a key before a row of
sums moves.  No task gathers the values of a key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.functions.exprs import column_type, comparable, name, rows_of, saturated
from assayer.model import Check, evidence_rows, union_all


def replication_check(child: str, field: str, test: str = "DC 1.10") -> Check:
    return Check(test, child, field, threshold=0,
                 text=f"{{value}} copies of {field} in {child} differ from their source.")


def _as_days(df: DataFrame, field: str) -> DataFrame:
    """Admission moments are compared as days; other moments as they are."""
    if field.upper() != "ADMIT_DATE":
        return df
    if isinstance(column_type(df, field), (T.TimestampType, T.TimestampNTZType)):
        return df.withColumn(field, F.col(field).cast("date"))
    return df


def by_value(combined: DataFrame, fields: int, sides: list[str]) -> DataFrame:
    """Rows of each side by ``(key, field, value)``, dealt out by all three."""
    return (
        combined.selectExpr("key", *sides, rows_of(
            {"field": str(n), "value": f"cast(v{n} as string)"} for n in range(fields)
        ))
        .where("value is not null")
        .groupBy("key", "field", "value").agg(*[F.sum(s).alias(s) for s in sides])
    )


def replication_evidence(
    tables: dict[str, DataFrame],
    parent: str,
    key: str,
    copies: dict[int, tuple[str, str]],
) -> DataFrame:
    """``copies`` maps check id to (child table, replicated field)."""
    children = list(dict.fromkeys(child for child, _ in copies.values()))
    side_of = {child: f"c{n}" for n, child in enumerate(children)}
    sides = ["p", *side_of.values()]
    fields = list(dict.fromkeys(field for _, field in copies.values()))

    # The fields each table brings; the parent brings all of them.
    members = {parent: fields} | {t: [f for f in fields if (t, f) in copies.values()] for t in children}
    frames = {}
    for table, own in members.items():
        frames[table] = reduce(_as_days, own, tables[table].where(f"{name(key)} is not null"))
    key_of = dict(zip(members, comparable((df, key) for df in frames.values())))
    value_of = {}
    for f in fields:
        holders = [t for t, own in members.items() if f in own]
        value_of |= dict(zip(((t, f) for t in holders), comparable((frames[t], f) for t in holders)))
    parts = [
        df.selectExpr(
            f"{key_of[table]} as key",
            *[f"{value_of.get((table, f), 'null')} as v{n}" for n, f in enumerate(fields)],
            *[f"{int(s == side_of.get(table, 'p'))}L as {s}" for s in sides],
        )
        for table, df in frames.items()
    ]

    combined = union_all(parts).groupBy("key", *[f"v{n}" for n in range(len(fields))]).agg(
        *[F.sum(s).alias(s) for s in sides]
    )
    by_key = by_value(combined, len(fields), sides).groupBy("key", "field").agg(
        F.sum("p").alias("p"),
        *[F.sum(c).alias(c) for c in side_of.values()],
        *[F.expr(f"sum(cast(p as decimal(19,0)) * {c}) as same_{c}") for c in side_of.values()],
    )
    totals = by_key.groupBy("field").agg(*[
        F.expr(e)
        for c in side_of.values()
        for e in (f"sum(cast(p as decimal(19,0)) * {c}) as pairs_{c}", f"sum(same_{c}) as same_{c}")
    ])
    rows = totals.selectExpr(rows_of(
        {
            "check_id": str(i),
            "numerator": f"if(field = {fields.index(f)}, pairs_{side_of[t]} - same_{side_of[t]}, 0)",
            "denominator": f"if(field = {fields.index(f)}, pairs_{side_of[t]}, 0)",
        }
        for i, (t, f) in copies.items()
    ))
    empty = evidence_rows(totals.sparkSession, [(i, 0, 0) for i in copies])
    return rows.unionByName(empty).groupBy("check_id").agg(
        *[F.expr(f"{saturated(f'sum({c})')} as {c}") for c in ("numerator", "denominator")]
    )
