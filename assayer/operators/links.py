"""Checks between the keys of several tables: orphans, and patients per encounter.

All children of one parent key are measured together (``keystate``): every table tags its
keys with a bit of its own, one aggregation by key ORs the bits, and each check counts keys
by their bits.  The parent is shuffled once however many children it has, and nothing is
joined.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from assayer import model
from assayer.model import Check
from assayer.operators.keystate import Pass


@dataclass(frozen=True)
class Link:
    """Keys of ``child`` looked up in the parent.  ``base``: compare with its key count."""

    child: str
    key: str
    base: str | None = None


def orphan_check(child: str, key: str, test: str) -> Check:
    """DC 1.09 is a share of the distinct keys; the other orphan checks are counts."""
    if test == "DC 1.09":
        return Check(test, child, key, None, model.ORPHAN_ENCOUNTER_PCT, "pct2", "above",
                     f"{{value}} percent of distinct {key} values in {child} are orphans.")
    return Check(test, child, key, threshold=0,
                 text=f"{{value}} distinct {key} values in {child} are orphans.")


def patients_check(table: str, field: str, test: str) -> Check:
    return Check(test, table, field, None, model.PATIENTS_PCT, "pct1", "below",
                 f"{{value}} percent of patients with encounters have {field} records.")


def link_evidence(
    tables: dict[str, DataFrame],
    links: dict[int, Link],
    parents: list[tuple[str, str]],
) -> DataFrame:
    """Evidence of orphan checks (distinct child keys without a parent, over distinct
    child keys) and of share checks (distinct keys in child over those in ``base``).

    ``parents`` lists (table, key column); a key present in any of them is no orphan.
    NULL keys are never orphans.
    """
    one = Pass(tables)
    for i, link in links.items():
        ask(one, i, link, parents)
    return one.evidence()


def ask(one: Pass, i: int, link: Link, parents: Iterable[tuple[str, str]]) -> None:
    if link.base:
        one.share(i, link.child, link.base, link.key)
    else:
        one.orphans(i, link.child, link.key, parents)
