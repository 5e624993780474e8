"""Counts of rows by value, for many checks of many tables at once.

Value sets ask how often each value of a field occurs, recency asks it of months, events per
encounter of encounter types.  They differ in grain only, so all are members of one long
form: a table is read once, each row giving one short row per member, and one exchange counts
all tables and members by (member, value), the counting done before the shuffle.  What
follows works on counted values: sets are joined to them, months of a member are ranked in
one short array, and every check is a sum.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer import model
from assayer.functions.exprs import rows_of
from assayer.model import evidence_rows, local_table, union_all


@dataclass(frozen=True)
class Member:
    """Rows of ``table`` where ``where`` holds, counted by ``value`` (as text), ``weight`` each."""

    table: str
    value: str
    where: str
    weight: str = "1L"


@dataclass(frozen=True)
class Use:
    """What a check takes from a member: as ``set`` its rows and those outside the value set,
    as ``month`` its months, as ``numerator`` or ``denominator`` the rows of one ``value``."""

    check_id: int
    member: int
    role: str
    value: str | None = None


def counts(tables: dict[str, DataFrame], members: dict[int, Member]) -> DataFrame:
    """``(member, value, n)``: one scan per table, one exchange for all."""
    by_table: dict[str, dict[int, Member]] = {}
    for i, member in members.items():
        by_table.setdefault(member.table, {})[i] = member
    parts = []
    for table, own in by_table.items():
        wanted = " or ".join(dict.fromkeys(f"({m.where})" for m in own.values()))
        parts.append(tables[table].where(wanted).selectExpr(rows_of(
            {"member": f"if({m.where}, {i}, null)", "value": m.value, "n": m.weight} for i, m in own.items()
        )))
    return (
        union_all(parts).where("member is not null")
        .groupBy("member", "value").agg(F.sum("n").alias("n"))
    )


def recency(months: str) -> dict[str, str]:
    """Parts of the recency ratio, from an array of (month, n) sorted from the newest."""
    first, last = model.BASELINE_RANKS
    baseline = f"slice({months}, {first}, {last - first + 1})"
    return {
        "newest": f"coalesce(get({months}, 0).n, 0L)",
        "baseline_rows": f"aggregate({baseline}, 0L, (a, x) -> a + x.n)",
        "baseline_months": f"cast(size(filter({baseline}, x -> x.n > 0)) as bigint)",
    }


#: Months of a member, newest first; what is no month comes last.  Months are few.
MONTHS = "sort_array(collect_list(if({}, named_struct('month', try_cast(value as int), 'n', n), null)), false)"


def evidence(
    tables: dict[str, DataFrame],
    members: dict[int, Member],
    uses: Iterable[Use],
    allowed: DataFrame | None = None,
    unlisted: str = "valid",
    include_empty: bool = False,
) -> DataFrame:
    """Evidence of all checks in ``uses``.

    ``allowed`` holds the value sets as distinct ``(member, value)``; ``unlisted`` says
    whether a member without any is ``valid`` or ``invalid``.  A check of sets or months on
    an empty table reads 0 of 0; one of events without events gives no row unless
    ``include_empty``.
    """
    uses = list(uses)
    found = counts(tables, members)
    spark = found.sparkSession
    invalid = "false"
    if allowed is not None:
        # Joins carry no hint: sets are broadcast when their known or observed size is small.
        found = found.join(allowed.withColumn("listed", F.lit(True)), ["member", "value"], "left")
        invalid = "listed is null"
        if unlisted == "valid":
            found = found.join(allowed.select("member").distinct().withColumn("has_set", F.lit(True)), "member", "left")
            invalid += " and has_set is not null"
    asked = local_table(
        spark,
        pa.schema([("check_id", pa.int32()), ("member", pa.int32()), ("role", pa.string()), ("asked", pa.string())]),
        [{"check_id": u.check_id, "member": u.member, "role": u.role, "asked": u.value} for u in uses],
    )
    taken = found.join(asked, "member").where("asked is null or asked = value").selectExpr(
        "check_id", "role", "value", "n",
        f"case role when 'set' then if({invalid}, n, 0L) when 'numerator' then n else 0L end as numerator",
        "if(role in ('set', 'denominator'), n, 0L) as denominator",
    )
    by_month = any(u.role == "month" for u in uses)
    sums = taken.groupBy("check_id").agg(
        F.sum("numerator").alias("numerator"), F.sum("denominator").alias("denominator"),
        *([F.expr(MONTHS.format("role = 'month'")).alias("months")] if by_month else []),
    )
    events = sorted({u.check_id for u in uses if u.role == "numerator"})
    if events and not include_empty:
        sums = sums.where(f"numerator > 0 or check_id not in ({', '.join(map(str, events))})")
    if by_month:
        ranked = sorted({u.check_id for u in uses if u.role == "month"})
        part = recency("months")
        is_month = f"check_id in ({', '.join(map(str, ranked))})"
        sums = sums.selectExpr(
            "check_id", f"if({is_month}, {part['newest']} * {part['baseline_months']}, numerator) as numerator",
            f"if({is_month}, {part['baseline_rows']}, denominator) as denominator",
        )
    silent = sorted({u.check_id for u in uses if u.role in ("set", "month")})
    if not silent:
        return sums
    empty = evidence_rows(spark, [(i, 0, 0) for i in silent])
    return sums.unionByName(empty).groupBy("check_id").agg(
        F.sum("numerator").alias("numerator"), F.sum("denominator").alias("denominator")
    )
