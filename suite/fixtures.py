"""Control inputs of the queries: value sets, units, specification rows, a manifest."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from assayer.model import local_table
from assayer.plans.manifest import manifest_frame

VALUE_SETS = {
    ("DEMOGRAPHIC", "SEX"): ["F", "M", "NI", "UN", "OT"],
    ("DEMOGRAPHIC", "RACE"): ["00", "01", "02", "03", "04", "05", "06", "07"],
    ("ENCOUNTER", "ENC_TYPE"): ["AV", "ED", "EI", "IP"],
    ("DIAGNOSIS", "ENC_TYPE"): ["AV", "ED", "EI", "IP", "OA"],
    ("DIAGNOSIS", "DX_TYPE"): ["09", "10", "SM"],
    ("LAB_RESULT_CM", "RESULT_UNIT"): ["purchase"],
    ("LAB_UNITS", "RESULT_UNIT"): ["mg/dL"],
}
KNOWN_UNITS = ["click", "view"]

# (table, field, ordinal, required, primary, dtype, length); some rows deviate from the
# projections on purpose.
SPECIFICATION = [
    ("DEMOGRAPHIC", "PATID", 1, "Y", "P", "string", None),
    ("DEMOGRAPHIC", "BIRTH_DATE", 2, "N", None, "timestamp", None),
    ("DEMOGRAPHIC", "SEX", 3, "N", None, "string", 2),
    ("DEMOGRAPHIC", "HISPANIC", 4, "N", None, "string", 2),
    ("DEMOGRAPHIC", "RACE", 5, "N", None, "string", 2),
    ("DEMOGRAPHIC", "RAW_RACE", 6, "N", None, "string", 9),
    ("DIAGNOSIS", "DIAGNOSISID", 1, "Y", "P", "string", None),
    ("DIAGNOSIS", "PATID", 2, "Y", None, "string", None),
    ("DIAGNOSIS", "ENCOUNTERID", 3, "N", None, "string", None),
    ("DIAGNOSIS", "DX", 4, "Y", None, "string", 5),
    ("DIAGNOSIS", "DX_TYPE", 5, "Y", None, "string", 2),
    ("DIAGNOSIS", "DX_SOURCE", 6, "Y", None, "string", 2),
    ("VITAL", "VITALID", 1, "Y", "P", "string", None),
    ("VITAL", "MEASURE_DATE", 2, "Y", None, "date", None),
    ("VITAL", "HT", 3, "N", None, "float", None),
    ("VITAL", "WT", 4, "N", None, "decimal", None),
    ("VITAL", "VITAL_SOURCE", 5, "Y", None, "string", 2),
    ("LAB_RESULT_CM", "LAB_RESULT_CM_ID", 1, "Y", "P", "string", None),
    ("LAB_RESULT_CM", "RESULT_NUM", 2, "N", None, "float", None),
]

# One row or more per test id the library knows, and one it does not.
MANIFEST = [
    (None, None, "DC 1.02"),
    ("DIAGNOSIS", "DIAGNOSISID", "DC 1.05"),
    ("DEATH", "PATID, DEATH_SOURCE", "DC 1.05"),
    ("DEMOGRAPHIC", "SEX", "DC 1.06"),
    ("DIAGNOSIS", "DX_TYPE", "DC 1.06"),
    ("DEMOGRAPHIC", "SEX", "DC 1.07"),
    ("ENCOUNTER", "DISCHARGE_DATE", "DC 1.07"),
    ("ENCOUNTER", None, "DC 1.08"),
    ("DIAGNOSIS", None, "DC 1.08"),
    ("DIAGNOSIS", None, "DC 1.09"),
    ("PROCEDURES", None, "DC 1.09"),
    ("DIAGNOSIS", "ENC_TYPE", "DC 1.10"),
    ("DIAGNOSIS", "ADMIT_DATE", "DC 1.10"),
    ("PROCEDURES", "ENC_TYPE", "DC 1.10"),
    ("PROCEDURES", "ADMIT_DATE", "DC 1.10"),
    ("DIAGNOSIS", "ENCOUNTERID", "DC 1.11"),
    ("ENCOUNTER", "ENCOUNTERID", "DC 1.11"),
    ("ENCOUNTER", "PROVIDERID", "DC 1.12"),
    ("DIAGNOSIS", None, "DC 1.13"),
    ("LAB_RESULT_CM", None, "DC 1.13"),
    ("DEMOGRAPHIC", "AGE", "DC 2.02"),
    ("DISPENSING", "DISPENSE_SUP", "DC 2.02"),
    ("VITAL", "HT", "DC 2.02"),
    ("DIAGNOSIS", "DX", "DC 3.01"),
    ("PROCEDURES", "PX", "DC 3.02"),
    ("ENCOUNTER", "DISCHARGE_DISPOSITION", "DC 3.03"),
    ("DIAGNOSIS", "DX", "DC 3.04"),
    ("PROCEDURES", "PX", "DC 3.05"),
    ("ENCOUNTER", "ADMIT_DATE", "DC 3.07"),
    ("LAB_RESULT_CM", "RESULT_NUM", "DC 3.10"),
    ("PRESCRIBING", "RX_ORDER_DATE", "DC 3.11"),
    ("DIAGNOSIS", "DX", "DC 9.99"),
]


def value_sets(spark: SparkSession, *only: tuple[str, str]) -> DataFrame:
    return local_table(
        spark, pa.schema([("table", pa.string()), ("field", pa.string()), ("item", pa.string())]),
        [{"table": t, "field": f, "item": v} for (t, f), items in VALUE_SETS.items()
         if not only or (t, f) in only for v in items],
    )


def known_units(spark: SparkSession) -> DataFrame:
    return local_table(spark, pa.schema([("unit", pa.string())]), [{"unit": u} for u in KNOWN_UNITS])


def specification(spark: SparkSession) -> DataFrame:
    names = ["table", "field", "ordinal", "required", "primary", "dtype", "length"]
    kinds = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32()]
    return local_table(spark, pa.schema(list(zip(names, kinds))),
                       [dict(zip(names, r)) for r in SPECIFICATION])


def manifest(spark: SparkSession) -> DataFrame:
    return manifest_frame(spark, MANIFEST)
