"""Column profiles: counts, distinct values, missing rates, ranges, means, percentiles.

A profile takes two passes over a table.  The first is one aggregate without a grouping
key (counts, ranges, means).  The second counts distinct values in long form, text and
numeric columns alike, with the counting done before the shuffle.  A value is shuffled as
numbers: a number as its order key, which percentiles are selected by, a text as 128 bits of
hashes, so long texts cost no more than short ones and two texts are taken for one with a
chance of 2^-128 a pair.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer import model
from assayer.functions.exprs import half_up, name, rows_of, texts as literals
from assayer.model import local_table, union_all
from assayer.operators.percentiles import percentiles_of
from assayer.sources.registry import Tables

# Four aggregates per column and spark.sql.codegen.maxFields = 100.
COLUMNS_PER_PASS = 24

PERCENTILES = {"p05": 0.05, "p25": 0.25, "median": 0.50, "p75": 0.75, "p95": 0.95}

PROFILE_COLUMNS = [
    "table", "field", "required", "ordinal", "kind", "cn", "nd", "pct_dist", "n_null",
    "pct_null", "n_ni", "pct_missing", "min_text", "max_text", "min_num", "p05", "p25",
    "median", "mean", "p75", "p95", "max_num", "min_exact", "max_exact",
]
REPORT_COLUMNS = [
    "table", "field", "required", "cn", "nd", "pct_dist", "n_null", "pct_null", "n_ni",
    "pct_missing", "min", "p05", "p25", "median", "mean", "p75", "p95", "max",
]


def text_columns(df: DataFrame) -> list[T.StructField]:
    kinds = (T.StringType, T.VarcharType, T.CharType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return [f for f in df.schema.fields if isinstance(f.dataType, kinds)]


def numeric_columns(df: DataFrame) -> list[T.StructField]:
    """Numeric columns, without those whose name speaks of a date or a time."""
    return [
        f for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType)
        and "DATE" not in f.name.upper() and "TIME" not in f.name.upper()
    ]


def _widens_to_double(kind: T.DataType) -> bool:
    """Whether distinct values stay distinct as doubles."""
    if isinstance(kind, T.DecimalType):
        return kind.precision <= 15
    return not isinstance(kind, T.LongType)


def profile(
    df: DataFrame,
    table: str,
    metadata: DataFrame | None = None,
    only: tuple[str, object] | None = None,
) -> DataFrame:
    """One row per profiled column, in the column order of the specification.

    ``only`` restricts the profile to rows where a field equals a value.  ``metadata``
    adds ``required`` and the specified order; without it the live order is used.
    """
    if only is not None:
        df = df.where(F.col(only[0]) == F.lit(only[1]))
    return _profile({table: df}, metadata)


def profile_tables(
    tables: Tables,
    names: Iterable[str] | None = None,
    metadata: DataFrame | None = None,
) -> DataFrame:
    """Profiles of all named tables that are registered; of every registered one by default
    (``model.PROFILED_TABLES`` names the usual ones).

    The value counts of all tables are one shuffle, and so are their percentiles.
    """
    wanted = [n for n in (names or tables) if n in tables]
    if not wanted:
        raise ValueError("none of the named tables is registered")
    return _profile({n: tables[n] for n in wanted}, metadata)


@dataclass(frozen=True)
class Profiled:
    """A column to profile, with the number that stands for it in long form."""

    column_id: int
    table: str
    name: str
    ordinal: int
    dtype: T.DataType
    numeric: bool

    @property
    def hashed(self) -> bool:
        """Whether distinct values are told apart by hash: also of numbers that lose digits as doubles."""
        return not self.numeric or not _widens_to_double(self.dtype)


def _columns(tables: Tables) -> list[Profiled]:
    out = []
    for table, df in tables.items():
        live = [f.name for f in df.schema.fields]
        numbers = numeric_columns(df)
        for f in text_columns(df) + numbers:
            out.append(Profiled(len(out), table, f.name, live.index(f.name) + 1, f.dataType, f in numbers))
    return out


def _profile(tables: Tables, metadata: DataFrame | None) -> DataFrame:
    columns = _columns(tables)
    if not columns:
        raise ValueError("no column to profile")
    spark = next(iter(tables.values())).sparkSession
    own = {t: [c for c in columns if c.table == t] for t in tables}
    basics = union_all([
        _basics(tables[t], fields[s:s + COLUMNS_PER_PASS])
        for t, fields in own.items() for s in range(0, len(fields), COLUMNS_PER_PASS)
    ])
    names = local_table(
        spark,
        pa.schema([("column_id", pa.int32()), ("table", pa.string()), ("field", pa.string()),
                   ("live_ordinal", pa.int32()), ("kind", pa.string())]),
        [{"column_id": c.column_id, "table": c.table, "field": c.name.upper(), "live_ordinal": c.ordinal,
          "kind": "numeric" if c.numeric else "text"} for c in columns],
    )
    out = names.join(basics, "column_id")

    # Both uses read all counts and pick by an aggregate, which no filter can go below: one
    # exchange serves them.
    counts = _long(tables, columns).groupBy("member", "key", "more", "value").agg(
        F.count(F.lit(1)).alias("n"), F.expr("max(if(value is null, 0, 1)) as plain"))
    distinct = counts.groupBy("member").agg(F.expr("count_if(n > 0 and plain >= 0) as nd"))
    # Of a column with two members the hashed one tells; chosen by a sum, as a filter on members
    # would go below the counting and make it another exchange.
    doubled = ", ".join(str(c.column_id) for c in columns if c.hashed) or "-1"
    told = distinct.selectExpr(
        "coalesce(if(member < 0, -1 - member, member), 0) as column_id", f"if(member in ({doubled}), 0L, nd) as nd"
    ).groupBy("column_id").agg(F.sum("nd").alias("nd"))
    out = out.join(told, "column_id", "left")
    if any(c.numeric for c in columns):
        numbers = counts.where("plain = 1").selectExpr("member as column_id", "value", "n")
        out = out.join(percentiles_of(numbers, PERCENTILES), "column_id", "left")
    else:
        out = out.selectExpr("*", *[f"cast(null as double) as {p}" for p in PERCENTILES])
    if metadata is not None:
        spec = metadata.select("table", "field", "required", "ordinal")
        out = out.join(spec, ["table", "field"], "left")
    else:
        out = out.selectExpr("*", "cast(null as string) as required", "cast(null as int) as ordinal")

    def percent(part: str) -> str:
        return f"{half_up(part, 'cn', 1000)} / 10D"

    nd = "coalesce(nd, 0L)"
    derived = {
        "nd": nd,
        "ordinal": "coalesce(ordinal, live_ordinal)",
        "pct_dist": percent(nd),
        "pct_null": percent("n_null"),
        "pct_missing": percent("n_ni"),
    }
    return out.selectExpr(
        *[f"{derived.get(c, name(c))} as {name(c)}" for c in PROFILE_COLUMNS]
    ).orderBy("table", "ordinal", "field")


def _long(tables: Tables, columns: list[Profiled]) -> DataFrame:
    """Non-NULL values in long form ``(member, key, more, value)``, one scan per table: texts,
    as member -1 - column_id, by a hash of 128 bits, numbers, as member column_id, as doubles."""
    parts = []
    for table, df in tables.items():
        rows = []
        for c in (c for c in columns if c.table == table):
            there = f"{name(c.name)} is not null"
            if c.hashed:
                as_text = f"cast({name(c.name)} as string)"
                rows.append({"member": f"if({there}, {-1 - c.column_id}, null)", "key": f"xxhash64({as_text})",
                             "more": f"xxhash64(1, {as_text})", "value": "cast(null as double)"})
            if c.numeric:
                rows.append({"member": f"if({there}, {c.column_id}, null)", "key": "0L", "more": "0L",
                             "value": f"cast({name(c.name)} as double)"})
        if rows:
            parts.append(df.selectExpr(rows_of(rows)).where("member is not null"))
    return union_all(parts).selectExpr("coalesce(member, 0) as member", "key", "more", "value")


def _basics(df: DataFrame, columns: list[Profiled]) -> DataFrame:
    """Counts, ranges and means, in one aggregate without a grouping key."""
    counts, rows = ["count(*) as cn"], []
    for c in columns:
        i, value = c.column_id, name(c.name)
        counts += [f"count({value}) as c{i}", f"min({value}) as lo{i}", f"max({value}) as hi{i}"]
        row = {"column_id": str(i), "cn": "cn", "n_null": f"cn - c{i}"}
        if c.numeric:
            counts.append(f"avg({value}) as m{i}")
            row |= {
                "n_ni": "cast(null as bigint)", "min_text": "cast(null as string)",
                "max_text": "cast(null as string)", "min_num": f"cast(lo{i} as double)",
                "max_num": f"cast(hi{i} as double)", "mean": f"cast(m{i} as double)",
                "min_exact": f"cast(lo{i} as string)", "max_exact": f"cast(hi{i} as string)",
            }
        else:
            coded = isinstance(c.dtype, T.StringType)
            if coded:
                counts.append(f"count_if({value} in {literals(model.MISSING_CODES)}) as ni{i}")
            row |= {
                "n_ni": f"ni{i}" if coded else "0L", "min_text": f"cast(lo{i} as string)",
                "max_text": f"cast(hi{i} as string)", "min_num": "cast(null as double)",
                "max_num": "cast(null as double)", "mean": "cast(null as double)",
                "min_exact": "cast(null as string)", "max_exact": "cast(null as string)",
            }
        rows.append(row)
    return df.agg(*[F.expr(e) for e in counts]).selectExpr(rows_of(rows))


def report(profiles: DataFrame) -> DataFrame:
    """The profile as text, with one ``min`` and one ``max`` column, for a CSV sink.  Extremes
    of numbers come with all their digits, not as doubles."""
    columns = {"min": "coalesce(min_text, min_exact)", "max": "coalesce(max_text, max_exact)"}
    return profiles.selectExpr(*[
        f"cast({columns.get(c, name(c))} as string) as {name(c)}" for c in REPORT_COLUMNS
    ])
