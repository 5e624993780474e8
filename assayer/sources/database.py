"""Tables of a database server, read in parts that are planned per table.

A table read over JDBC comes through one connection unless it is split.  The planner asks the
server for the row count and the range of a key column, one small query per table, and cuts
the table into parts of about equal size: by range where the column is a number or a date, by
a hash the server computes where it is text.  Through the catalog instead, filters and
aggregates without a split go to the server whole.
"""

from __future__ import annotations

import datetime
import decimal
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from assayer.functions.exprs import text
from assayer.sources.registry import Tables, open_jdbc

ROWS_PER_PART, MOST_PARTS = 2_000_000, 64

# ---- fixed values: the servers' own hash functions, non-negative -------------------
HASHES = {
    "oracle": "ora_hash({})",
    "sqlserver": "(checksum({}) & 2147483647)",
    "postgresql": "(hashtext(cast({} as text)) & 2147483647)",
    "mysql": "crc32({})",
}
MODULO = {"oracle": "mod({}, {})", "sqlserver": "{} % {}", "postgresql": "{} % {}", "mysql": "{} % {}"}
LISTINGS = {
    "oracle": "select table_name as name from all_tables where upper(owner) = {}",
    "sqlserver": "select table_name as name from information_schema.tables where upper(table_schema) = {}",
    "postgresql": "select table_name as name from information_schema.tables where upper(table_schema) = {}",
    "mysql": "select table_name as name from information_schema.tables where upper(table_schema) = {}",
}
# ------------------------------------------------------------------------------------


def dialect(url: str) -> str:
    """The kind of server a JDBC address names."""
    parts = url.split(":")
    if len(parts) < 3 or parts[0] != "jdbc" or parts[1] not in HASHES:
        raise ValueError(f"{url} is none of {', '.join(f'jdbc:{d}:…' for d in HASHES)}")
    return parts[1]


@dataclass(frozen=True)
class Split:
    """How a table is cut: ``ranges`` for a column with an order, else ``predicates``."""

    ranges: tuple[str, str, str, int] | None = None
    predicates: tuple[str, ...] | None = None


def parts_of(rows: int, rows_per_part: int = ROWS_PER_PART, most: int = MOST_PARTS) -> int:
    return max(1, min(most, -(-rows // rows_per_part)))


def split(kind: str, column: str, low: object, high: object, rows: int,
          rows_per_part: int = ROWS_PER_PART, most: int = MOST_PARTS) -> Split:
    """The split of a table with ``rows`` rows whose ``column`` runs from ``low`` to ``high``.

    Rows where the column is NULL are in the first part.  A table that fits one part, or
    whose column is NULL throughout, is not split.
    """
    n = parts_of(rows, rows_per_part, most)
    if n == 1 or low is None:
        return Split()
    if isinstance(low, (datetime.date, datetime.datetime)):
        return Split(ranges=(column, low.isoformat(sep=" ") if isinstance(low, datetime.datetime) else low.isoformat(),
                             high.isoformat(sep=" ") if isinstance(high, datetime.datetime) else high.isoformat(), n))
    if isinstance(low, (int, decimal.Decimal)) and not isinstance(low, bool):
        return Split(ranges=(column, str(int(low)), str(int(high) + 1), n))
    rest = [MODULO[kind].format(HASHES[kind].format(column), n) + f" = {k}" for k in range(n)]
    return Split(predicates=(f"{rest[0]} or {column} is null", *rest[1:]))


class Server:
    """A database server and how it is reached."""

    def __init__(self, spark: SparkSession, url: str, schema: str | None = None, properties: dict[str, str] | None = None):
        self.spark, self.url, self.schema, self.properties = spark, url, schema, properties or {}
        self.kind = dialect(url)

    def _query(self, sql: str) -> DataFrame:
        """The rows of a query the server runs."""
        return self.spark.read.jdbc(self.url, f"({sql}) asked", properties=self.properties)

    def target(self, table: str) -> str:
        return f"{self.schema}.{table}" if self.schema else table

    def present(self, names: Iterable[str]) -> list[str]:
        """Of the named tables, those the server has in the schema.  Needs a schema."""
        if not self.schema:
            return list(names)
        live = {r[0].upper() for r in self._query(LISTINGS[self.kind].format(text(self.schema.upper()))).collect()}
        return [n for n in names if n.upper() in live]

    def plan(self, columns: dict[str, str], rows_per_part: int = ROWS_PER_PART, most: int = MOST_PARTS) -> dict[str, Split]:
        """A split by table, from (table, column): one query per table, answered by one row."""
        out = {}
        for table, column in columns.items():
            rows, low, high = self._query(
                f"select count(*) as n, min({column}) as low, max({column}) as high from {self.target(table)}").collect()[0]
            out[table] = split(self.kind, column, low, high, int(rows), rows_per_part, most)
        return out

    def open(self, names: Iterable[str], splits: dict[str, Split] | None = None) -> Tables:
        names, splits = list(names), splits or {}
        return open_jdbc(
            self.spark, self.url, names, self.schema, self.properties,
            predicates={t: list(s.predicates) for t, s in splits.items() if s.predicates},
            ranges={t: s.ranges for t, s in splits.items() if s.ranges},
        )

    def open_catalog(self, names: Iterable[str], catalog: str = "server") -> Tables:
        """Tables by way of a catalog of the session: the server filters and aggregates what
        it can, so counts over a whole table move one row."""
        settings = {"url": self.url, "pushDownAggregate": "true", "pushDownLimit": "true", **self.properties}
        prefix = f"spark.sql.catalog.{catalog}"
        self.spark.conf.set(prefix, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
        for key, value in settings.items():
            self.spark.conf.set(f"{prefix}.{key}", value)
        return {n.upper(): self.spark.table(f"{catalog}.{self.target(n)}") for n in names}
