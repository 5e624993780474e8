"""SQL expressions shared by the operators.  All are Spark built-ins.

Expressions are SQL text: a check over hundreds of columns is then one call into the
session per pass instead of one per operator.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def name(column: str) -> str:
    """A quoted column name."""
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def texts(values: Iterable[str]) -> str:
    """A parenthesised list of string literals."""
    return "(" + ", ".join(text(v) for v in values) + ")"


def rows_of(structs: Iterable[dict[str, str]]) -> str:
    """``inline`` over literal rows of expressions: one output row per mapping."""
    return "inline(array(" + ", ".join(
        "named_struct(" + ", ".join(f"{text(k)}, {v}" for k, v in row.items()) + ")"
        for row in structs
    ) + "))"


def half_up(numerator: str, denominator: str, multiplier: int) -> str:
    """``multiplier * numerator / denominator`` rounded half up, in exact integers.

    NULL when the denominator is zero.  Rounding doubles instead would make the value
    compared with a threshold depend on how a tie such as 2.675 is represented.
    """
    return (
        f"((({2 * multiplier}L * {numerator}) + {denominator})"
        f" div nullif(2L * {denominator}, 0L))"
    )


def missing_or_null(field: str, codes: list[str]) -> str:
    """True where the field is NULL or one of the coded flavours of missing.

    Values are compared as text, so a date or a number is missing only when NULL.
    """
    return f"coalesce(cast({name(field)} as string) in {texts(codes)}, true)"


def outside(field: str, low: float, high: float) -> str:
    """True where a recorded value lies outside the bounds; never for NULL, nor for text
    that is no number, which is no extreme value."""
    return f"(try_cast({name(field)} as double) not between {low} and {high})"


def month_index(field: str) -> str:
    """Year and month as one number; NULL for text that is no date."""
    day = f"try_cast({name(field)} as date)"
    return f"(year({day}) * 100 + month({day}))"


def saturated(total: str) -> str:
    """A decimal total as BIGINT, the largest one in place of anything above."""
    return f"cast(least({total}, 9223372036854775807) as bigint)"


def flag(condition: str) -> str:
    """1 where true, 0 where false or NULL."""
    return f"(case when {condition} then 1 else 0 end)"


def column_type(df: DataFrame, column: str) -> T.DataType:
    """Type of a column, whatever the case of its name."""
    return next(f.dataType for f in df.schema.fields if f.name.upper() == column.upper())


def comparable(members: Iterable[tuple[DataFrame, str]]) -> list[str]:
    """Expressions that make key columns of several tables fit into one column.

    Keys of one kind keep their type, numbers are widened by Spark.  Only a mix of text
    and other types is compared as text.
    """
    members = list(members)
    is_text = [isinstance(column_type(df, c), T.StringType) for df, c in members]
    mixed = any(is_text) and not all(is_text)
    return [f"cast({name(c)} as string)" if mixed else name(c) for _, c in members]
