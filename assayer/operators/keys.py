"""Key checks inside one table: duplicated primary keys, values tied to several units."""

from __future__ import annotations

from pyspark.sql import DataFrame

from assayer import model
from assayer.model import Check
from assayer.operators.keystate import Pass


def primary_key_check(table: str, field: str, test: str = "DC 1.05") -> Check:
    return Check(test, table, field, threshold=0,
                 text=f"{{value}} key values ({field}) occur more than once in {table}.")


def primary_key_evidence(df: DataFrame, field: str, check_id: int) -> DataFrame:
    """Number of key values held by more than one row; NULL keys are equal to each other.

    ``field`` may list several columns ("A, B").  Rows are counted per key before the
    shuffle, so a key held by a third of the rows reaches the reducer as one row per task.
    """
    one = Pass({"": df})
    one.primary_key(check_id, "", columns(field))
    return one.evidence()


def columns(field: str) -> list[str]:
    return [c.strip() for c in field.split(",")]


def duplication_check(table: str, field: str, unit: str = "PATID", test: str = "DC 1.11") -> Check:
    return Check(test, table, field, None, model.DUPLICATION_PCT, "pct2", "above",
                 f"{{value}} percent of {field} values in {table} belong to more than one {unit}.")


def duplication_evidence(sources: dict[int, tuple[DataFrame, str, str]]) -> DataFrame:
    """Per check, field values tied to more than one non-NULL unit over distinct values.

    ``sources`` maps check id to (table, field, unit).  The NULL field value counts as a
    group in the numerator and not in the denominator.  A value has several units when the
    least and greatest of their numbers differ (64-bit hashes, unless units are integers): one
    hash aggregate of fixed width, combined before the shuffle, so a hot value reaches its
    reducer as one row per task and nothing is sorted.
    """
    one = Pass({str(i): df for i, (df, *_) in sources.items()})
    for i, (_, field, unit) in sources.items():
        one.duplicated(i, str(i), field, unit)
    return one.evidence()
