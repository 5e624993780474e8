"""Published runs, footers, split reads of a server, and the command line's ways to them."""

from __future__ import annotations

import datetime
from types import SimpleNamespace

import pytest
from compare import spark_rows
from pyspark.sql import functions as F

from assayer.__main__ import _arguments, _server_tables
from assayer.operators import row
from assayer.plans.manifest import Settings, manifest_frame
from assayer.plans.run import run_checks
from assayer.sources import database, registry, sinks

DAY = datetime.date(2024, 1, 1)


# ---- published runs ----------------------------------------------------------------

def listing(spark, *fields):
    return spark.createDataFrame([("T", f, "01", 1) for f in fields], "table string, field string, value string, n long")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_a_rerun_leaves_nothing_that_is_no_longer_found(spark, tmp_path, fmt):
    out = str(tmp_path / "listing")
    sinks.write_invalid_values(listing(spark, "A", "B"), out, fmt, DAY)
    sinks.write_invalid_values(listing(spark, "A"), out, fmt, DAY)
    assert [tuple(r) for r in sinks.read_published(spark, out).drop("run_date").collect()] == [("T", "A", "01", 1)]
    plain = spark.read.format(fmt).option("header", True).load(out)
    assert plain.count() == 1
    sinks.write_invalid_values(listing(spark), out, fmt, DAY)
    assert sinks.read_published(spark, out).count() == 0


def test_dated_runs_stay_readable(spark, tmp_path):
    out = str(tmp_path / "listing")
    for k, day in enumerate((DAY, DAY + datetime.timedelta(1), DAY)):
        sinks.write_invalid_values(listing(spark, f"F{k}"), out, run_date=day)
    found = {(r["field"], r["run_date"]) for r in sinks.read_published(spark, out).collect()}
    assert found == {("F1", DAY + datetime.timedelta(1)), ("F2", DAY)}


def test_a_run_that_ends_early_is_not_read(spark, tmp_path):
    out = str(tmp_path / "listing")
    sinks.write_invalid_values(listing(spark, "A"), out, run_date=DAY)
    bad = listing(spark, "B").withColumn("value", F.expr("raise_error('lost')").cast("string"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_invalid_values(bad, out, run_date=DAY)
    assert [r["field"] for r in sinks.read_published(spark, out).collect()] == ["A"]
    with pytest.raises(ValueError):
        sinks.read_published(spark, str(tmp_path / "nothing"))


# ---- counts from footers -----------------------------------------------------------

def test_counts_come_from_footers(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "if(id % 3 = 0, null, date'2020-01-01') as MEASURE_DATE", "if(id % 4 = 0, null, 'NI') as SEX")
    df.repartition(3).write.parquet(f"{tmp_path}/VITAL.parquet")
    df.limit(0).write.parquet(f"{tmp_path}/ENCOUNTER.parquet")
    df.where("id < 9").write.parquet(f"{tmp_path}/DIAGNOSIS.parquet")
    before = spark.conf.get(registry.FILE_SOURCES)
    tables = registry.open_directory(spark, str(tmp_path), ["VITAL", "ENCOUNTER", "DIAGNOSIS"], footers=True)
    assert spark.conf.get(registry.FILE_SOURCES) == before
    plain = registry.open_directory(spark, str(tmp_path), ["VITAL", "ENCOUNTER", "DIAGNOSIS"])
    rows = [("VITAL", "MEASURE_DATE", "DC 1.07"), ("VITAL", "SEX", "DC 1.07"), (None, None, "DC 1.02")]

    def run(given, **options):
        return run_checks(given, manifest_frame(spark, rows), settings=Settings(**options))

    found = run(tables, footers=True)
    plan = found._jdf.queryExecution().optimizedPlan().toString() + found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(MEASURE_DATE)]" in plan and "PushedAggregation: [COUNT(*)]" in plan
    assert spark_rows(found) == spark_rows(run(plain)) == spark_rows(run(plain, footers=True))
    measures = {0: row.missing_or_unknown("VITAL", "MEASURE_DATE", "DC 1.07", 0), 1: row.rows_present("VITAL")}
    # What the footers cannot answer, a filtered table here, is read.
    part = row.row_evidence(tables["VITAL"].where("id % 2 = 0"), measures, footers=True)
    assert "PushedAggregation: []" in part._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in part.collect()} == {(0, 167, 500), (1, 500, 500)}


# ---- a database server, by a stub ---------------------------------------------------

class Stub:
    """Records the reads a session is asked for and answers the planner's queries."""

    def __init__(self, answers):
        self.calls, self.settings, self.tables = [], {}, []
        self.read = SimpleNamespace(jdbc=self._read)
        self.conf = SimpleNamespace(set=self.settings.__setitem__)
        self.answers = answers

    def _read(self, url, target, **options):
        self.calls.append((target, options))
        found = next((rows for part, rows in self.answers.items() if part in target), None)
        return SimpleNamespace(collect=lambda: found) if target.startswith("(") else target

    def table(self, target):
        self.tables.append(target)
        return target


def test_split_by_kind_of_column():
    day = datetime.date
    assert database.split("oracle", "ID", 1, 9_000_000, 5_000_000).ranges == ("ID", "1", "9000001", 3)
    assert database.split("oracle", "D", day(2020, 1, 1), day(2021, 1, 1), 4_000_001).ranges == ("D", "2020-01-01", "2021-01-01", 3)
    assert database.split("mysql", "K", "a", "z", 10, 5).predicates == ("crc32(K) % 2 = 0 or K is null", "crc32(K) % 2 = 1")
    assert database.split("oracle", "K", "a", "z", 10, 5).predicates[1] == "mod(ora_hash(K), 2) = 1"
    assert database.split("sqlserver", "K", "a", "z", 9, 5).predicates[1] == "(checksum(K) & 2147483647) % 2 = 1"
    assert database.split("postgresql", "K", "a", "z", 9, 5).predicates[1] == "(hashtext(cast(K as text)) & 2147483647) % 2 = 1"
    assert database.split("mysql", "K", None, None, 10**9) == database.split("mysql", "K", "a", "z", 3) == database.Split()
    assert len(database.split("mysql", "K", "a", "z", 10**12).predicates) == database.MOST_PARTS
    for url in ("oracle:thin:@h", "jdbc:unknown:h", "jdbc"):
        with pytest.raises(ValueError):
            database.dialect(url)


def test_server_tables_are_planned_and_read_in_parts(monkeypatch):
    monkeypatch.setenv("SECRET", "s")
    stub = Stub({"information_schema": [("diagnosis",), ("vital",)], "from cdm.DIAGNOSIS": [(9_000_000, "D1", "D9")],
                 "from cdm.VITAL": [(5_000_000, 1, 5_000_000)]})
    args = _arguments(["checks", "--out", "o", "--jdbc-url", "jdbc:postgresql://h/db", "--jdbc-schema", "cdm", "--jdbc-property",
                       "user=u", "driver=d", "--jdbc-password-env", "SECRET", "--split", "DIAGNOSIS=DIAGNOSISID", "VITAL=VITALID"])
    tables = _server_tables(stub, args, ["DEMOGRAPHIC", "DIAGNOSIS", "VITAL"])
    assert list(tables) == ["DIAGNOSIS", "VITAL"]
    secret = {"user": "u", "driver": "d", "password": "s"}
    assert all(options["properties"] == secret for _, options in stub.calls)
    reads = {target: options for target, options in stub.calls if not target.startswith("(")}
    assert len(reads["cdm.DIAGNOSIS"]["predicates"]) == 5 and reads["cdm.DIAGNOSIS"]["predicates"][0].endswith("or DIAGNOSISID is null")
    assert reads["cdm.VITAL"]["column"] == "VITALID" and reads["cdm.VITAL"]["numPartitions"] == 3
    assert sum(t.startswith("(select count(*)") for t, _ in stub.calls) == 2


def test_server_tables_through_a_catalog():
    stub = Stub({"all_tables": [("VITAL",)]})
    args = _arguments(["checks", "--out", "o", "--jdbc-url", "jdbc:oracle:thin:@h", "--jdbc-schema", "cdm", "--jdbc-catalog", "src",
                       "--jdbc-property", "user=u"])
    assert _server_tables(stub, args, ["VITAL", "DEATH"]) == {"VITAL": "src.cdm.VITAL"}
    assert stub.settings["spark.sql.catalog.src.pushDownAggregate"] == "true" and stub.settings["spark.sql.catalog.src.user"] == "u"
