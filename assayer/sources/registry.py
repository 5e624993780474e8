"""Tables under test: a plain ``{NAME: DataFrame}`` mapping, and its catalog.

Names are upper case.  Anything Spark can read may be registered; the helpers cover the
usual stores.  None of them reads data: scans happen inside the checks, pruned to the
columns these ask for.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from assayer.model import local_table

Tables = dict[str, DataFrame]


def register(**frames: DataFrame) -> Tables:
    return {name.upper(): df for name, df in frames.items()}


FILE_SOURCES, FOOTER_COUNTS = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"


def open_files(
    spark: SparkSession, paths: dict[str, str], fmt: str = "parquet", footers: bool = False, **options
) -> Tables:
    """Tables stored as files, one path each.

    With ``footers`` Parquet tables are opened by the reader that answers counts of rows and
    of values from the files' footers where it can, and reads the files where it cannot; the
    session is set to do so.  A table without rows is opened the usual way: without any
    footer that reader has no count to give, where 0 is wanted.
    """
    def load(path: str) -> DataFrame:
        return spark.read.format(fmt).options(**options).load(path)

    plain = {name.upper(): load(path) for name, path in paths.items()}
    if not footers or fmt != "parquet":
        return plain
    sources = spark.conf.get(FILE_SOURCES)
    spark.conf.set(FOOTER_COUNTS, "true")
    spark.conf.set(FILE_SOURCES, ",".join(s for s in sources.split(",") if s != "parquet"))
    try:
        counted = {name.upper(): load(path) for name, path in paths.items()}
    finally:
        spark.conf.set(FILE_SOURCES, sources)
    return {name: plain[name] if df.isEmpty() else df for name, df in counted.items()}


def open_directory(spark: SparkSession, root: str, names: Iterable[str], suffix: str = ".parquet",
                   fmt: str = "parquet", footers: bool = False, **options) -> Tables:
    """Tables stored side by side as ``root/<name><suffix>``."""
    return open_files(spark, {n: f"{root.rstrip('/')}/{n}{suffix}" for n in names}, fmt, footers, **options)


def open_database(spark: SparkSession, names: Iterable[str], schema: str | None = None) -> Tables:
    """Tables of the session catalog."""
    return {n.upper(): spark.table(f"{schema}.{n}" if schema else n) for n in names}


def open_jdbc(
    spark: SparkSession,
    url: str,
    names: Iterable[str],
    schema: str | None = None,
    properties: dict[str, str] | None = None,
    predicates: dict[str, list[str]] | None = None,
    ranges: dict[str, tuple[str, str, str, int]] | None = None,
) -> Tables:
    """Tables of a database server.

    A table is read by one task unless it is split: ``ranges`` gives (column, lower,
    upper, partitions) for a numeric or date column, ``predicates`` one condition per
    partition, which suits text identifiers (a hash of the key modulo n).
    """
    predicates, ranges = predicates or {}, ranges or {}
    out = {}
    for n in names:
        target = f"{schema}.{n}" if schema else n
        if n in predicates:
            df = spark.read.jdbc(url, target, predicates=predicates[n], properties=properties)
        elif n in ranges:
            column, lower, upper, parts = ranges[n]
            df = spark.read.jdbc(url, target, column=column, lowerBound=lower,
                                 upperBound=upper, numPartitions=parts, properties=properties)
        else:
            df = spark.read.jdbc(url, target, properties=properties)
        out[n.upper()] = df
    return out


def _declared(field: T.StructField) -> tuple[str, int | None]:
    """Type family and declared length of a live column."""
    kind, length = field.dataType, None
    if isinstance(kind, (T.VarcharType, T.CharType)):
        return "string", kind.length
    if isinstance(kind, T.StringType):
        # Char and varchar columns of a stored table surface as strings with this note.
        note = (field.metadata or {}).get("__CHAR_VARCHAR_TYPE_STRING", "")
        if "(" in note:
            length = int(note[note.index("(") + 1:note.index(")")])
        return "string", length
    if isinstance(kind, T.DecimalType):
        return "decimal", None
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return "float", None
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp", None
    return kind.simpleString(), None


CATALOG_SCHEMA = pa.schema([
    ("table", pa.string()), ("field", pa.string()), ("ordinal", pa.int32()),
    ("dtype", pa.string()), ("length", pa.int32()),
])


def catalog(spark: SparkSession, tables: Tables) -> DataFrame:
    """``(table, field, ordinal, dtype, length)`` of the live schemas, names upper case."""
    rows = []
    for name, df in tables.items():
        for position, column in enumerate(df.schema.fields, 1):
            dtype, length = _declared(column)
            rows.append({
                "table": name.upper(), "field": column.name.upper(), "ordinal": position,
                "dtype": dtype, "length": length,
            })
    return local_table(spark, CATALOG_SCHEMA, rows)
