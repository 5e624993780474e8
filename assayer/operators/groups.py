"""Events per encounter, by encounter type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from assayer.functions.exprs import name, texts
from assayer.model import Check
from assayer.operators import grains
from assayer.operators.grains import Member, Use


def events_checks(
    table: str, field: str, thresholds: dict[str, float], what: str, test: str
) -> list[Check]:
    """One check per encounter type."""
    return [
        Check(test, table, field, enc_type, minimum, "ratio2", "below",
              f"Encounter type {enc_type} has {{value}} {what} per encounter.")
        for enc_type, minimum in thresholds.items()
    ]


def encounters(table: str, enc_types: Sequence[str]) -> Member:
    """Rows by encounter type."""
    return Member(table, "ENC_TYPE", f"ENC_TYPE in {texts(enc_types)}")


def events(table: str, type_field: str, known: Sequence[str], enc_types: Sequence[str]) -> Member:
    """Rows of known code type by encounter type."""
    return Member(table, "ENC_TYPE", f"ENC_TYPE in {texts(enc_types)} and {name(type_field)} in {texts(known)}")


def events_evidence(
    encounter: DataFrame,
    sources: Sequence[tuple[DataFrame, str, list[str], dict[int, str]]],
    include_empty: bool = False,
) -> DataFrame:
    """Events of known code type over encounters, per encounter type.

    ``sources``: (table, code type column, known types, check id -> encounter type).  An
    encounter type without events gives no row unless ``include_empty``, which reports 0.
    """
    enc_types = sorted({t for *_, ids in sources for t in ids.values()})
    tables, members, uses = {"": encounter}, {0: encounters("", enc_types)}, []
    for n, (df, type_field, known, ids) in enumerate(sources, 1):
        tables[str(n)], members[n] = df, events(str(n), type_field, known, enc_types)
        uses += [Use(i, member, role, t) for i, t in ids.items() for member, role in ((n, "numerator"), (0, "denominator"))]
    return grains.evidence(tables, members, uses, include_empty=include_empty)
