"""The command line, end to end on stored tables."""

from __future__ import annotations

import datetime

import pytest

from assayer.__main__ import main
from assayer.sources import sinks
from suite.projections import frames


@pytest.fixture(scope="module")
def stored(spark, data, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    for name, df in frames(spark, data, "DEMOGRAPHIC", "LAB_RESULT_CM").items():
        df.write.parquet(f"{root}/{name}.parquet")
    (root / "manifest.csv").write_text(
        "table,field,test\n,,DC 1.01\nDEMOGRAPHIC,SEX,DC 1.06\nLAB_RESULT_CM,RESULT_UNIT,DC 1.06\n"
        "DEMOGRAPHIC,SEX,DC 3.03\nVITAL,HT,DC 2.02\n")
    (root / "sets.csv").write_text(
        "TABLE_NAME,FIELD_NAME,VALUESET_ITEM\nDEMOGRAPHIC,SEX,F\nDEMOGRAPHIC,SEX,M\nLAB_RESULT_CM,RESULT_UNIT,view\n")
    (root / "units.csv").write_text("unit\nclick\n")
    return str(root)


def test_checks(spark, stored, tmp_path):
    main(["checks", "--tables", stored, "--manifest", f"{stored}/manifest.csv", "--valuesets", f"{stored}/sets.csv",
          "--units", f"{stored}/units.csv", "--out", str(tmp_path)])
    results = spark.read.csv(f"{tmp_path}/results", header=True).collect()
    assert len([r for r in results if r["test"] == "DC 1.01" and r["result"] == "FAIL"]) == 20
    by = {(r["test"], r["table"]): r["result"] for r in results}
    assert by[("DC 1.06", "DEMOGRAPHIC")] == "FAIL" and by[("DC 3.03", "DEMOGRAPHIC")] == "FAIL"
    assert by[("DC 2.02", "VITAL")] is None
    invalid = spark.read.csv(f"{tmp_path}/invalid_values", header=True)
    assert {r["value"] for r in invalid.where("field = 'SEX'").collect()} == {"X", "NI", "UN"}
    units = spark.read.csv(f"{tmp_path}/unit_validity", header=True)
    assert {r["unit"] for r in units.where("valid = 'VALID'").collect()} == {"click"}


def test_profile(spark, stored, tmp_path):
    main(["profile", "--tables", stored, "--out", str(tmp_path / "all")])
    rows = spark.read.csv(f"{tmp_path}/all/profile", header=True)
    assert {r["table"] for r in rows.collect()} == {"DEMOGRAPHIC", "LAB_RESULT_CM"}
    main(["profile", "--tables", stored, "--names", "LAB_RESULT_CM", "--only", "RESULT_UNIT", "click",
          "--out", str(tmp_path / "one")])
    one = spark.read.csv(f"{tmp_path}/one/profile_filtered", header=True)
    assert one.where("field = 'RESULT_UNIT'").collect()[0]["nd"] in (1, "1")


def test_profiles_and_runs_stay_apart(spark, stored, tmp_path):
    out = str(tmp_path)
    for value in ("click", "view"):
        main(["profile", "--tables", stored, "--only", "result_unit", value, "--out", out])
    main(["profile", "--tables", stored, "--out", out])
    filtered = spark.read.csv(f"{out}/profile_filtered", header=True)
    assert {r["only_value"] for r in filtered.collect()} == {"click", "view"}
    main(["profile", "--tables", stored, "--names", "DEMOGRAPHIC", "--out", out])
    assert {r["table"] for r in spark.read.csv(f"{out}/profile", header=True).collect()} == {"DEMOGRAPHIC", "LAB_RESULT_CM"}
    first = spark.createDataFrame([("T", "F", "x", 1)], "table string, field string, value string, n long")
    for day in (1, 2):
        sinks.write_invalid_values(first, f"{out}/listing", run_date=datetime.date(2024, 1, day))
    assert spark.read.csv(f"{out}/listing", header=True).count() == 2
