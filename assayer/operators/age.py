"""Extreme ages: at death, or at a given day for those without a death date.

Births and deaths of a person meet on one time line, and a birth counts the deaths that
follow it within the plausible ages by a window over that line: nothing is joined and no
pair of a birth and a death is formed.  Rows are counted per (person, day) first, so an
identifier repeated in a third of the rows shrinks to its distinct days.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer import model
from assayer.functions.exprs import comparable, saturated, text
from assayer.model import Check

DAYS_PER_YEAR = 365  # the rule divides days by 365, leap years included
COUNTS = ["births", "extreme_now", "persons", "deaths", "undated"]


def extreme_age_check(table: str, field: str = "AGE", test: str = "DC 2.02") -> Check:
    low, high = model.BOUNDS["AGE"]
    return Check(test, table, field, None, model.EXTREME_PCT, "pct2", "above",
                 f"{{value}} percent of ages in {table} are outside {low} to {high}.")


def one_death(death: DataFrame, sources: Sequence[str]) -> DataFrame:
    """One row (PATID, DEATH_DATE) per person: of the best source that gives a date, the
    earliest date.  Sources that are not listed come last, persons without any date keep a
    row without one.  The pick does not depend on the order of rows, and is made before the
    shuffle as well as after, so no person's rows are gathered.
    """
    listed = " ".join(f"when {text(s)} then {rank}" for rank, s in enumerate(sources))
    rank = f"case DEATH_SOURCE {listed} else {len(sources)} end" if sources else "0"
    day = "datediff(try_cast(DEATH_DATE as date), date'1970-01-01')"
    # Rank and day as one number: the least of it is the pick.  Days fit 32 bits.
    return death.where("PATID is not null").selectExpr(
        "PATID", f"cast({rank} as bigint) * 8589934592L + {day} + 4294967296L as pick"
    ).groupBy("PATID").agg(F.min("pick").alias("pick")).selectExpr(
        "PATID", "date_add(date'1970-01-01', cast(pmod(pick, 8589934592L) - 4294967296L as int)) as DEATH_DATE"
    )


def extreme_age_evidence(
    demographic: DataFrame,
    death: DataFrame,
    check_id: int,
    as_of: datetime.date | None = None,
    unit: str = "days",
    sources: Sequence[str] | None = None,
) -> DataFrame:
    """Persons of implausible age, over the rows of ``demographic``.

    A person with several death rows counts once per row in the numerator, unless ``sources``
    ranks the values of DEATH_SOURCE, best first: then one death counts, see ``one_death``.
    ``unit`` is ``days`` (days / 365) or ``years`` (difference of the calendar years).
    """
    if sources is not None:
        death = one_death(death, sources)
    low, high = model.BOUNDS["AGE"]
    if unit == "days":
        point, scale = "datediff(try_cast({} as date), date'1970-01-01')", DAYS_PER_YEAR
    else:
        point, scale = "year(try_cast({} as date))", 1
    youngest, oldest = low * scale, high * scale
    today = "current_date()" if as_of is None else f"date'{as_of.isoformat()}'"
    person, dead = comparable([(demographic, "PATID"), (death, "PATID")])

    born = point.format("BIRTH_DATE")
    extreme_now = f"coalesce({point.format(today)} - {born} not between {youngest} and {oldest}, false)"
    births = demographic.selectExpr(
        f"{person} as person", f"{born} as at", "if(try_cast(BIRTH_DATE as date) is null, 0L, 1L) as births",
        f"if({extreme_now}, 1L, 0L) as extreme_now", "1L as persons", "0L as deaths", "0L as undated",
    )
    deaths = death.where("PATID is not null").selectExpr(
        f"{dead} as person", f"{point.format('DEATH_DATE')} as at",
        "0L as births", "0L as extreme_now", "0L as persons",
        "if(try_cast(DEATH_DATE as date) is null, 0L, 1L) as deaths", "if(try_cast(DEATH_DATE as date) is null, 1L, 0L) as undated",
    )
    per_day = births.unionByName(deaths).groupBy("person", "at").agg(*[F.sum(c).alias(c) for c in COUNTS])
    per_person = per_day.selectExpr(
        "person", *COUNTS,
        "cast(births as decimal(19,0)) * coalesce(sum(deaths) over (partition by person order by at"
        f" range between {youngest} following and {oldest} following), 0L) as plausible",
    ).groupBy("person").agg(*[F.sum(c).alias(c) for c in [*COUNTS, "plausible"]])
    return per_person.agg(
        F.expr(
            saturated(
                "coalesce(sum(cast(births as decimal(19,0)) * deaths - plausible"
                " + cast(extreme_now as decimal(19,0)) * if(deaths + undated = 0, 1L, undated)), 0)"
            ) + " as numerator"
        ),
        F.expr("coalesce(sum(persons), 0L) as denominator"),
    ).selectExpr(f"{check_id} as check_id", "numerator", "denominator")
