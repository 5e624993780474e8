"""The state of every key, gathered in one pass: which tables hold it, how many rows, and
whether they belong to several units.

Duplicated keys, values tied to several patients, orphans and patient shares all ask about
keys.  A table is read once and gives one short row per key column; one aggregation by
(family, key) serves all of them, families being the sets of columns that are compared with
each other.  A key's state has a fixed width: bits of the tables that hold it, a row count
where a primary key is checked, least and greatest unit where units are.  All of it combines
before the shuffle, so a key that a third of the rows hold arrives as one row per task, and
all of it is numbers, so no aggregate sorts.  Keys of equal state are then counted, and the
checks read the few states there are.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.functions.exprs import column_type, name, rows_of
from assayer.model import evidence_rows, union_all

# Bits of a signed long, and unit lanes that keep the aggregate under
# spark.sql.codegen.maxFields (100) output fields.
BITS, LANES = 60, 30
TEXTS = (T.StringType, T.VarcharType, T.CharType)
NUMBERED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def as_text(value: str, kind: T.DataType) -> str:
    """A text that equal values share and no others."""
    if isinstance(kind, TEXTS):
        return value
    if isinstance(kind, T.TimestampType):  # local times repeat when clocks go back
        return f"cast(unix_micros({value}) as string)"
    if isinstance(kind, T.BinaryType):
        return f"hex({value})"
    if isinstance(kind, (T.FloatType, T.DoubleType)):  # -0.0 is 0.0
        return f"cast(cast({value} as double) + 0D as string)"
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return f"to_json(struct({value}))"
    return f"cast({value} as string)"


def as_number(value: str, kind: T.DataType) -> str:
    """A long that equal values share and, but for one pair in 2^64, no others."""
    return f"cast({value} as bigint)" if isinstance(kind, NUMBERED) else f"xxhash64({as_text(value, kind)})"


@dataclass
class Holder:
    """Key columns of a table.  ``nulls``: rows with a NULL key are wanted too."""

    table: str
    columns: tuple[str, ...]
    family: int
    bit: int = 0
    rows: int | None = None
    units: dict[str, int] = field(default_factory=dict)
    nulls: bool = False


class Pass:
    """Collects what is asked of keys, then reads the tables once."""

    def __init__(self, tables: dict[str, DataFrame]):
        self.tables = tables
        self.holders: dict[tuple, Holder] = {}
        self.asked: list[tuple[int, Holder, str, object]] = []

    def holder(self, table: str, *columns: str) -> Holder:
        at = (table, tuple(c.upper() for c in columns))
        if at not in self.holders:
            self.holders[at] = Holder(table, columns, family=len(self.holders))
        return self.holders[at]

    def _join(self, a: Holder, b: Holder) -> None:
        low, high = sorted((a.family, b.family))
        for h in self.holders.values():
            if h.family == high:
                h.family = low

    def primary_key(self, i: int, table: str, fields: Iterable[str]) -> None:
        h = self.holder(table, *fields)
        h.nulls = True
        self.asked.append((i, h, "primary", None))

    def duplicated(self, i: int, table: str, column: str, unit: str) -> None:
        h = self.holder(table, column)
        h.nulls = True
        self.asked.append((i, h, "units", unit.upper()))

    def orphans(self, i: int, table: str, column: str, parents: Iterable[tuple[str, str]]) -> None:
        child, found = self.holder(table, column), [self.holder(*p) for p in parents]
        for parent in found:
            self._join(child, parent)
        self.asked.append((i, child, "orphans", found))

    def share(self, i: int, table: str, base: str, column: str) -> None:
        child, other = self.holder(table, column), self.holder(base, column)
        self._join(child, other)
        self.asked.append((i, child, "share", other))

    # ---- the plan ------------------------------------------------------------------

    def _number(self) -> tuple[int, int, int]:
        """Bits and lanes by family; returns the words of bits, row and unit lanes needed."""
        bits: dict[int, int] = {}
        for h in self.holders.values():
            h.bit = bits[h.family] = bits.get(h.family, -1) + 1
        rows: dict[int, int] = {}
        lanes: dict[int, int] = {}
        for _, h, kind, more in self.asked:
            if kind == "primary" and h.rows is None:
                h.rows = rows[h.family] = rows.get(h.family, -1) + 1
            if kind == "units" and more not in h.units:
                h.units[more] = lanes[h.family] = lanes.get(h.family, -1) + 1
        return (max(bits.values()) // BITS + 1, max(rows.values(), default=-1) + 1, max(lanes.values(), default=-1) + 1)

    def _keys(self) -> dict[int, str]:
        """By holder, its key as text.  Columns of a family are brought to one type first;
        only a mix of text and other types is compared as text."""
        out = {}
        for family in {h.family for h in self.holders.values()}:
            own = [h for h in self.holders.values() if h.family == family]
            if len(own) == 1 and len(own[0].columns) > 1:
                parts = [as_text(name(c), column_type(self.tables[own[0].table], c)) for c in own[0].columns]
                out[id(own[0])] = "concat(" + ", ".join(
                    f"coalesce(concat(length({p}), ':', {p}), '-')" for p in parts
                ) + ")"
                continue
            kinds = [column_type(self.tables[h.table], h.columns[0]) for h in own]
            texts = [isinstance(k, TEXTS) for k in kinds]
            common = kinds[0]
            if any(texts):
                common = T.StringType()
            elif any(k != kinds[0] for k in kinds):
                common = union_all([self.tables[h.table].selectExpr(f"{name(h.columns[0])} as key") for h in own]).schema[0].dataType
            for h, kind in zip(own, kinds):
                value = name(h.columns[0])
                out[id(h)] = as_text(value if kind == common or any(texts) and isinstance(kind, TEXTS)
                                     else f"cast({value} as {common.simpleString()})", common)
        return out

    def evidence(self) -> DataFrame:
        """``(check_id, numerator, denominator)`` of everything asked."""
        words, n_rows, n_units = self._number()
        if n_units > LANES:
            return self._split()
        keys = self._keys()
        families = {f: k for k, f in enumerate(sorted({h.family for h in self.holders.values()}))}
        by_table: dict[str, list[Holder]] = {}
        for h in self.holders.values():
            by_table.setdefault(h.table, []).append(h)

        def state(h: Holder) -> dict[str, str]:
            key, df = keys[id(h)], self.tables[h.table]
            absent = f"{name(h.columns[0])} is null" if len(h.columns) == 1 else "false"
            number = families[h.family]
            row = {"family": str(number) if h.nulls else f"if({absent}, null, {number})", "key": key}
            for w in range(words):
                bit = f"{1 << h.bit % BITS}L" if h.bit // BITS == w else "0L"
                row[f"bits{w}"] = f"if({absent}, 0L, {bit})" if h.nulls and bit != "0L" else bit
            for r in range(n_rows):
                row[f"rows{r}"] = "1L" if h.rows == r else "cast(null as bigint)"
            of_lane = {lane: unit for unit, lane in h.units.items()}
            for u in range(n_units):
                unit = of_lane.get(u)
                row[f"unit{u}"] = "cast(null as bigint)" if unit is None else (
                    f"if({name(unit)} is null, null, {as_number(name(unit), column_type(df, unit))})")
            return row

        parts = []
        for table, own in by_table.items():
            df = self.tables[table]
            if not any(h.nulls for h in own):
                df = df.where(" or ".join(f"({name(h.columns[0])} is not null)" for h in own))
            parts.append(df.selectExpr(rows_of(state(h) for h in own)).where("family is not null"))
        per_key = union_all(parts).groupBy("family", "key").agg(
            *[F.expr(f"bit_or(bits{w}) as bits{w}") for w in range(words)],
            *[F.expr(f"sum(rows{r}) as rows{r}") for r in range(n_rows)],
            *[F.expr(f"{f}(unit{u}) as {f}{u}") for u in range(n_units) for f in ("min", "max")],
        )
        bits = [f"bits{w}" for w in range(words)]
        flags = {
            "seen": [f"rows{r} is not null" for r in range(n_rows)],
            "many": [f"rows{r} > 1" for r in range(n_rows)],
            "several": [f"min{u} < max{u}" for u in range(n_units)],
        }
        states = per_key.selectExpr("family", *bits, *[
            (" + ".join(f"if({c}, {1 << k}L, 0L)" for k, c in enumerate(conditions)) or "0L") + f" as {flag}"
            for flag, conditions in flags.items()
        ]).groupBy("family", *bits, *flags).agg(F.count(F.lit(1)).alias("n"))

        def held(h: Holder) -> str:
            return f"(bits{h.bit // BITS} & {1 << h.bit % BITS}L) <> 0"

        by_family: dict[int, list[dict[str, str]]] = {}
        for i, h, kind, more in self.asked:
            if kind == "primary":
                num, den = f"(many & {1 << h.rows}L) <> 0", f"(seen & {1 << h.rows}L) <> 0"
            elif kind == "units":
                num, den = f"(several & {1 << h.units[more]}L) <> 0", held(h)
            elif kind == "orphans":
                num, den = f"{held(h)} and not ({' or '.join(map(held, more))})", held(h)
            else:
                num, den = held(h), held(more)
            by_family.setdefault(families[h.family], []).append(
                {"check_id": str(i), "numerator": f"if({num}, n, 0L)", "denominator": f"if({den}, n, 0L)"})
        cases = " ".join(f"when {f} then {rows_of(rows).removeprefix('inline(').removesuffix(')')}" for f, rows in by_family.items())
        found = states.selectExpr(f"inline(case family {cases} end)")
        empty = evidence_rows(found.sparkSession, [(i, 0, 0) for i, *_ in self.asked])
        return found.unionByName(empty).groupBy("check_id").agg(
            F.sum("numerator").alias("numerator"), F.sum("denominator").alias("denominator"))

    def _split(self) -> DataFrame:
        """Two passes in place of one that would be too wide."""
        units = [a for a in self.asked if a[2] == "units"]
        late = {id(a) for a in units[LANES:]}
        out = []
        for chosen in ([a for a in self.asked if id(a) not in late], units[LANES:]):
            part = Pass(self.tables)
            for i, h, kind, more in chosen:
                if kind == "primary":
                    part.primary_key(i, h.table, h.columns)
                elif kind == "units":
                    part.duplicated(i, h.table, h.columns[0], more)
                elif kind == "orphans":
                    part.orphans(i, h.table, h.columns[0], [(p.table, p.columns[0]) for p in more])
                else:
                    part.share(i, h.table, more.table, h.columns[0])
            out.append(part.evidence())
        return union_all(out)
