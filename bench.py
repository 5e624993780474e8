"""Time the headline queries.  Prints one JSON line.

The derived clinical tables are written once to a scratch folder and read back, so that
the checks are timed and not the derivation.  ``manifest_fused`` runs the fixture
manifest as one job, ``manifest_one_by_one`` runs the same rows as one job each, which is
how a sequential client would; it is reported but not part of ``value``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from assayer.operators.profile import profile_tables  # noqa: E402
from assayer.plans.manifest import manifest_frame  # noqa: E402
from assayer.plans.run import run_checks  # noqa: E402
from suite import fixtures  # noqa: E402
from suite.projections import TABLES, frames  # noqa: E402
from suite.queries import AS_OF, QUERIES  # noqa: E402

SINGLE = [
    "primary_key_error", "value_validation", "missing_disposition", "orphan_patients",
    "orphan_encounters_pct", "replication_field", "record_duplication",
    "code_errors_diagnosis", "extreme_systolic", "extreme_age", "events_per_encounter_dx",
    "patients_per_encounter", "latency_enc_type", "normal_range", "profile_strings",
    "profile_numeric",
]


def session(cpus: int) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def checks(spark: SparkSession, tables: dict[str, DataFrame], rows) -> DataFrame:
    return run_checks(
        tables, manifest_frame(spark, rows), fixtures.specification(spark),
        fixtures.value_sets(spark), as_of=AS_OF,
    )


def main() -> None:
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    scratch = tempfile.mkdtemp(prefix="bench-", dir=os.environ.get("BENCH_SCRATCH"))

    def write_tables() -> None:
        for name, df in frames(spark, root).items():
            df.write.parquet(f"{scratch}/{name}.parquet")

    derive = timed(write_tables)
    tables = {name: spark.read.parquet(f"{scratch}/{name}.parquet") for name in TABLES}

    seconds = {}
    for name in SINGLE:
        QUERIES[name](spark, root).collect()
        seconds[name] = timed(lambda: QUERIES[name](spark, root).collect())
    checks(spark, tables, fixtures.MANIFEST).collect()
    seconds["manifest_fused"] = timed(lambda: checks(spark, tables, fixtures.MANIFEST).collect())
    profile_tables(tables, list(TABLES)).collect()
    seconds["profile_all_tables"] = timed(lambda: profile_tables(tables, list(TABLES)).collect())

    def one_by_one() -> None:
        for row in fixtures.MANIFEST:
            checks(spark, tables, [row]).collect()

    slow = timed(one_by_one)
    print(json.dumps({
        "metric": "headline queries, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(root).name.removeprefix("sf"),
        "cpus": cpus,
        "manifest_rows": len(fixtures.MANIFEST),
        "manifest_one_by_one": slow,
        "derive_tables": derive,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
