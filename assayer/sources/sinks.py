"""Where results go.  Every sink writes through Spark to a path the caller names.

Results and listings are replaced as a run: files go to a folder of the run's own, and a
manifest file beside it then names the folder and its leaves.  Whoever reads through the
manifest (``read_published``) sees one whole run or the one before, never half, and nothing a
rerun no longer found; the run that was replaced is removed after.
"""

from __future__ import annotations

import datetime
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "_published.json"


def write_results(results: DataFrame, path: str, run_date: datetime.date, fmt: str = "csv") -> str:
    """Check results, one directory per run date.  Returns the directory written.

    A report has one row per check, so it is written as one file.
    """
    return _publish(results.repartition(1), path, fmt, run_date)


def write_invalid_values(
    invalid: DataFrame, path: str, fmt: str = "csv", run_date: datetime.date | None = None
) -> str:
    """Invalid values under ``run_date=…/run=…/table=…/field=…``: equal field names of two
    tables stay apart, and so do run dates.  Returns the directory of the run date."""
    return _publish(invalid, path, fmt, run_date, ["table", "field"])


def write_unit_validity(
    units: DataFrame, path: str, fmt: str = "csv", run_date: datetime.date | None = None
) -> str:
    return _publish(units, path, fmt, run_date, ["table", "field"])


def write_sketches(sketches: DataFrame, path: str, run_date: datetime.date) -> str:
    """Sketches of a run, to be merged with those of other run dates."""
    return _publish(sketches, path, "parquet", run_date)


def write_profile(
    report: DataFrame, path: str, only: tuple[str, str] | None = None, fmt: str = "csv"
) -> None:
    """Profile report under ``table=…``, or ``table=…/only_field=…/only_value=…`` when filtered.

    Only the directories of the report itself are replaced: profiles of other tables, fields
    and values written to ``path`` before stay.
    """
    keys = ["table"]
    if only:
        report = report.withColumn("only_field", F.lit(only[0])).withColumn("only_value", F.lit(str(only[1])))
        keys += ["only_field", "only_value"]
    _writer(report, fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).save(path)


def _writer(df: DataFrame, fmt: str):
    writer = df.write.format(fmt)
    return writer.option("header", True) if fmt == "csv" else writer


# ---- published runs ----------------------------------------------------------------

class _Files:
    """The file system of a path, whichever store it is in."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.root = self.path(path)
        self.fs = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def children(self, path: str) -> list[str]:
        at = self.path(path)
        return sorted(s.getPath().toString() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def leaves(self, folder: str) -> list[str]:
        """Data files below a folder, relative to it."""
        found, files = [], self.fs.listFiles(self.path(folder), True)
        base = self.fs.makeQualified(self.path(folder)).toString() + "/"
        while files.hasNext():
            file = files.next().getPath()
            if not file.getName().startswith(("_", ".")):
                found.append(file.toString().removeprefix(base))
        return sorted(found)

    def read(self, path: str) -> dict | None:
        at = self.path(path)
        if not self.fs.exists(at):
            return None
        stream = self.fs.open(at)
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, path: str, content: dict) -> None:
        """Written beside and moved into place, so that no reader meets half a file."""
        part = self.path(f"{path}.{uuid.uuid4().hex}")
        stream = self.fs.create(part, True)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        if not self.fs.rename(part, self.path(path)):  # some stores do not rename onto a file
            self.fs.delete(self.path(path), False)
            self.fs.rename(part, self.path(path))

    def remove(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


def _publish(rows: DataFrame, path: str, fmt: str, run_date: datetime.date | None, keys: list[str] = ()) -> str:
    spark = rows.sparkSession
    target = path.rstrip("/") + (f"/run_date={run_date.isoformat()}" if run_date else "")
    run = uuid.uuid4().hex
    writer = _writer(rows, fmt)
    (writer.partitionBy(*keys) if keys else writer).save(f"{target}/run={run}")
    files = _Files(spark, target)
    before = files.read(f"{target}/{MANIFEST}")
    files.write(f"{target}/{MANIFEST}", {
        "run": run, "format": fmt, "schema": rows.schema.jsonValue(), "leaves": files.leaves(f"{target}/run={run}"),
    })
    if before:
        files.remove(f"{target}/run={before['run']}")
    return target


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the published runs below ``path``, with the column ``run_date`` where runs
    are dated.  Files that no manifest names, of unfinished or replaced runs, are not read."""
    path = path.rstrip("/")
    files = _Files(spark, path)
    dated = [c for c in files.children(path) if "/run_date=" in c]
    out = None
    for target in [path, *dated]:
        found = files.read(f"{target}/{MANIFEST}")
        if not found:
            continue
        schema, folder = T.StructType.fromJson(found["schema"]), f"{target}/run={found['run']}"
        reader = spark.read.format(found["format"]).schema(schema).option("basePath", folder)
        if found["format"] == "csv":
            reader = reader.option("header", True)
        rows = reader.load([f"{folder}/{leaf}" for leaf in found["leaves"]]) if found["leaves"] else spark.createDataFrame([], schema)
        rows = rows.select(schema.names)
        if target != path:
            rows = rows.withColumn("run_date", F.lit(target.rsplit("=", 1)[1]).cast("date"))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"nothing is published below {path}")
    return out
