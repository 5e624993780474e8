"""Control inputs: manifest, schema specification, value sets, unit lists.

They are small by nature (a manifest names checks, a specification names columns).  The
manifest and the specification shape the plan, so the driver reads them; value sets and
unit lists may be large and stay DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = "table string, field string, test string"
METADATA_SCHEMA = (
    "Table string, key string, Field string, Order int, Required string, Primary string,"
    " Oracle_dtype string, mssql_dtype string, postgres_dtype string, mysql_dtype string,"
    " LENGTH int"
)
VALUESET_SCHEMA = "TABLE_NAME string, FIELD_NAME string, VALUESET_ITEM string"

# How the specification's type names map to Spark type families.
SPEC_TYPES = {
    "VARCHAR2": "string",
    "VARCHAR": "string",
    "DATE": "date",
    "NUMBER": "decimal",
    "NUMERIC": "decimal",
    "DECIMAL": "decimal",
    "FLOAT": "float",
    "FLOAT4": "float",
    "TIMESTAMP(0)": "timestamp",
    "TIMESTAMP": "timestamp",
    "DATETIME": "timestamp",
}


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """CSV with the columns table, field, test; table and field may be empty."""
    return spark.read.csv(path, header=True, schema=MANIFEST_SCHEMA)


def read_metadata(spark: SparkSession, path: str, dialect: str = "Oracle") -> DataFrame:
    """Schema specification CSV as ``(table, field, ordinal, required, primary, dtype, length)``.

    ``dialect`` (Oracle, mssql, postgres, mysql) picks the column holding the type names.
    """
    raw = spark.read.csv(path, header=True, schema=METADATA_SCHEMA)
    return normalise_metadata(raw, f"{dialect}_dtype")


def normalise_metadata(raw: DataFrame, dtype_column: str = "Oracle_dtype") -> DataFrame:
    families = F.create_map(*[F.lit(x) for pair in SPEC_TYPES.items() for x in pair])
    return raw.select(
        F.upper("Table").alias("table"),
        F.upper("Field").alias("field"),
        F.col("Order").alias("ordinal"),
        F.col("Required").alias("required"),
        F.col("Primary").alias("primary"),
        F.element_at(families, F.upper(dtype_column)).alias("dtype"),
        F.col("LENGTH").alias("length"),
    )


def read_valuesets(spark: SparkSession, path: str) -> DataFrame:
    """Value-set CSV as ``(table, field, item)``."""
    return reference_valuesets(spark.read.csv(path, header=True, schema=VALUESET_SCHEMA))


def reference_valuesets(reference: DataFrame) -> DataFrame:
    """A reference table (TABLE_NAME, FIELD_NAME, VALUESET_ITEM) as ``(table, field, item)``."""
    return reference.select(
        F.col("TABLE_NAME").alias("table"),
        F.col("FIELD_NAME").alias("field"),
        F.col("VALUESET_ITEM").alias("item"),
    )


def read_units(spark: SparkSession, path: str) -> DataFrame:
    """Known units, one per line under the header ``unit``."""
    return spark.read.csv(path, header=True, schema="unit string")
