"""From manifest rows to checks, and a manifest derived from a specification."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from assayer import model
from assayer.model import Check
from assayer.operators import age, codes, groups, keys, links, recency, replication, row, values
from assayer.operators.codes import CODE_TABLES
from assayer.sources.registry import Tables

PATIENT, VISIT, PROVIDER = "PATID", "ENCOUNTERID", "PROVIDERID"


@dataclass(frozen=True)
class Settings:
    """Choices that apply to a whole run.

    ``staging``: encounter checks use ``ENCOUNTER_STG``.  ``union_parents``: with staging,
    a key found in the staging or the production parent is no orphan.  ``min_flags``: parts
    of its rule a code must break to be an error.  ``include_empty``: report encounter types
    without events.  ``unlisted``: how a field without a value set reads.  ``lengths``:
    compare ``declared`` or ``observed`` lengths with the specification, or (``auto``) the
    declared one where there is one.  ``age_unit``: ``days`` (divided by 365) or ``years``.
    ``death_sources``: values of DEATH_SOURCE, best first, by which one death of a person is
    taken; without it every death row counts.  ``footers``: counts of rows and NULLs are asked
    apart, for tables opened with ``footers``.
    """

    staging: bool = False
    union_parents: bool = False
    min_flags: int = 1
    include_empty: bool = False
    unlisted: str = "valid"
    lengths: str = "auto"
    age_unit: str = "days"
    death_sources: tuple[str, ...] | None = None
    footers: bool = False

    @property
    def encounter(self) -> str:
        return "ENCOUNTER_STG" if self.staging else "ENCOUNTER"


@dataclass
class Workload:
    """Checks sorted by the kind of job that measures them, keyed by check id."""

    checks: dict[int, Check]
    rows: dict[str, dict[int, row.Measure]]            # table -> measures
    primary_keys: dict[int, tuple[str, str]]           # (table, fields)
    values: dict[int, tuple[str, str]]                 # (table, field)
    links: dict[int, tuple[links.Link, tuple[tuple[str, str], ...]]]  # with parents
    copies: dict[str, dict[int, tuple[str, str]]]      # parent -> (child, field)
    duplicates: dict[int, tuple[str, str, str]]        # (table, field, unit)
    ages: dict[int, str]                               # table
    events: dict[tuple[str, str, tuple[str, ...]], dict[int, str]]   # -> encounter type
    latency: dict[int, tuple[str, str, bool]]          # (table, field, by encounter type)
    unavailable: list[int]
    schema_tests: list[str]


#: Tests that ask about one field.
OF_FIELDS = frozenset({
    "DC 1.05", "DC 1.06", "DC 1.10", "DC 1.11", "DC 1.12", "DC 2.02", "DC 3.07", "DC 3.11", *model.MISSING_PCT,
})


class Compiler:
    """Sorts manifest rows into a workload.  Unknown test ids give nothing.  Table names are
    upper case from here on."""

    def __init__(self, tables: Tables, settings: Settings):
        self.tables = {name.upper(): df for name, df in tables.items()}
        self.settings = settings
        self.next_id = 0
        self.work = Workload({}, {}, {}, {}, {}, {}, {}, {}, {}, {}, [], [])

    def add(self, table: str | None, field: str | None, test: str) -> None:
        table = table.upper() if table else table
        if test in OF_FIELDS and not (table and field):
            self._unmeasured(table, field, test, f"{test} needs a table and a field.")
        elif test in ("DC 1.01", "DC 1.03", "DC 1.04"):
            if test not in self.work.schema_tests:
                self.work.schema_tests.append(test)
        elif test == "DC 1.02":
            for name in model.POPULATED_TABLES:
                if name in self.tables:
                    self._measure(name, row.rows_present(name, test))
                else:
                    self._new(Check(test, name, threshold=0, fails="not_above",
                                    text=f"{name} is not present."), available=False)
        elif test == "DC 1.05":
            i, ok = self._on(keys.primary_key_check(table, field, test), (table, *keys.columns(field)))
            if ok:
                self.work.primary_keys[i] = (table, field)
        elif test == "DC 1.06":
            i, ok = self._on(values.value_set_check(table, field, test), (table, field))
            if ok:
                self.work.values[i] = (table, field)
        elif test in model.MISSING_PCT:
            needs = [field]
            if field.upper() in model.INPATIENT_DATE_FIELDS + model.INPATIENT_CODED_FIELDS:
                needs.append("ENC_TYPE")
            self._measure(table, row.missing_or_unknown(table, field, test, model.MISSING_PCT[test]), needs)
        elif test == "DC 1.08":
            self._orphans(table, PATIENT, test, [("DEMOGRAPHIC", PATIENT)])
        elif test == "DC 1.09":
            self._orphans(table, VISIT, test, [(self.settings.encounter, VISIT)])
        elif test == "DC 1.12":
            self._orphans(table, field, test, [("PROVIDER", PROVIDER)])
        elif test == "DC 1.10":
            i, ok = self._on(replication.replication_check(table, field, test),
                             (table, VISIT, field), (self.settings.encounter, VISIT, field))
            if ok:
                self.work.copies.setdefault(self.settings.encounter, {})[i] = (table, field)
        elif test == "DC 1.11":
            i, ok = self._on(keys.duplication_check(table, field, PATIENT, test), (table, field, PATIENT))
            if ok:
                self.work.duplicates[i] = (table, field, PATIENT)
        elif test == "DC 1.13":
            spec = CODE_TABLES.get(table.removesuffix("_STG"))
            if spec:
                needs = [c for c in (spec.code, spec.type_field) if c]
                for measure in codes.code_errors(table, test, self.settings.min_flags):
                    self._measure(table, measure, needs)
            else:
                self._unmeasured(table, field, test, f"{table} has no rule for codes.")
        elif test == "DC 2.02" and field.upper() == "AGE":
            i, ok = self._on(age.extreme_age_check(table, field, test),
                             (table, PATIENT, "BIRTH_DATE"), ("DEATH", PATIENT, "DEATH_DATE",
                                                              *(["DEATH_SOURCE"] if self.settings.death_sources else [])))
            if ok:
                self.work.ages[i] = table
        elif test == "DC 2.02" and field.upper() in model.BOUNDS:
            self._measure(table, row.extreme_values(table, field, test), [field])
        elif test == "DC 2.02":
            self._unmeasured(table, field, test, f"{field} has no bounds.")
        elif test in ("DC 3.01", "DC 3.02"):
            self._events(table, field, test)
        elif test in ("DC 3.04", "DC 3.05"):
            base = self.settings.encounter
            i, ok = self._on(links.patients_check(table, field, test), (table, PATIENT), (base, PATIENT))
            if ok:
                self.work.links[i] = (links.Link(table, PATIENT, base), ())
        elif test in ("DC 3.07", "DC 3.11"):
            by_type = test == "DC 3.07"
            i, ok = self._on(recency.latency_check(table, field, test),
                             (table, field, *(["ENC_TYPE"] if by_type else [])))
            if ok:
                self.work.latency[i] = (table, field, by_type)
        elif test == "DC 3.10":
            self._measure(table, row.normal_range(table, field, test), [
                "LAB_LOINC", "RESULT_NUM", *model.NORMAL_RANGE_FIELDS,
            ])

    def _unmeasured(self, table: str | None, field: str | None, test: str, why: str) -> None:
        """A row of the report without result, whose text says why."""
        self._new(Check(test, table, field, text=why), available=False)

    def _has(self, table: str, *columns: str) -> bool:
        if table not in self.tables:
            return False
        live = {c.upper() for c in self.tables[table].columns}
        return all(c.upper() in live for c in columns)

    def _new(self, check: Check, available: bool = True) -> int:
        i, self.next_id = self.next_id, self.next_id + 1
        self.work.checks[i] = check
        if not available:
            self.work.unavailable.append(i)
        return i

    def _on(self, check: Check, *needs: tuple[str, ...]) -> tuple[int, bool]:
        ok = all(self._has(*n) for n in needs)
        return self._new(check, ok), ok

    def _measure(self, table: str, measure: row.Measure, columns: list[str] = ()) -> None:
        i, ok = self._on(measure.check, (table, *columns))
        if ok:
            self.work.rows.setdefault(table, {})[i] = measure

    def _parents(self, parents: list[tuple[str, str]]) -> tuple[tuple[str, str], ...]:
        if self.settings.union_parents:
            parents = parents + [
                (t.removesuffix("_STG"), k) for t, k in parents if t.endswith("_STG")
            ]
        return tuple(parents)

    def _orphans(self, table: str, key: str, test: str, parents: list[tuple[str, str]]) -> None:
        group = self._parents(parents)
        i, ok = self._on(links.orphan_check(table, key, test), (table, key), *group)
        if ok:
            self.work.links[i] = (links.Link(table, key), group)

    def _events(self, table: str, field: str, test: str) -> None:
        if test == "DC 3.01":
            thresholds, known, what = model.DX_PER_ENCOUNTER, model.KNOWN_DX_TYPES, "diagnoses of known type"
        else:
            thresholds, known, what = model.PX_PER_ENCOUNTER, model.KNOWN_PX_TYPES, "procedures of known type"
        type_field = f"{field}_TYPE"
        for check in groups.events_checks(table, field, thresholds, what, test):
            i, ok = self._on(check, (table, "ENC_TYPE", type_field), ("ENCOUNTER", "ENC_TYPE"))
            if ok:
                self.work.events.setdefault((table, type_field, tuple(known)), {})[i] = check.group


def derive_manifest(
    metadata: DataFrame,
    valuesets: DataFrame,
    wider_keys: dict[str, str] | None = None,
    more: list[tuple[str | None, str | None, str]] = (),
) -> DataFrame:
    """A manifest that follows from the specification.

    Keys, required columns, coded columns and references are found by rule: primary
    columns, required columns, columns with a value set, and the patient, visit and
    provider columns.  ``wider_keys`` replaces the key of a table ("A, B"); ``more`` adds
    rows no rule gives, such as the completeness checks a site asks for.
    """
    spark = metadata.sparkSession
    spec = metadata.orderBy("table", "ordinal").collect()
    columns: dict[str, list[str]] = {}
    for r in spec:
        columns.setdefault(r["table"], []).append(r["field"])
    primary: dict[str, list[str]] = {}
    for r in spec:
        if r["primary"] == "P":
            primary.setdefault(r["table"], []).append(r["field"])
    sets = valuesets.select("table", "field").distinct().orderBy("table", "field").collect()

    rows: list[tuple[str | None, str | None, str]] = [
        (None, None, t) for t in ("DC 1.01", "DC 1.02", "DC 1.03", "DC 1.04")
    ]
    rows += [(t, (wider_keys or {}).get(t, ", ".join(k)), "DC 1.05") for t, k in primary.items()]
    rows += [(r["table"], r["field"], "DC 1.06") for r in sets if r["field"] in columns.get(r["table"], [])]
    rows += [(r["table"], r["field"], "DC 1.07") for r in spec if r["required"] == "Y"]
    rows += [(t, None, "DC 1.08") for t, c in columns.items() if PATIENT in c and t != "DEMOGRAPHIC"]
    rows += [(t, None, "DC 1.09") for t, c in columns.items() if VISIT in c and t != "ENCOUNTER"]
    rows += [(t, f, "DC 1.10") for t, c in columns.items() if VISIT in c and t != "ENCOUNTER"
             for f in ("ENC_TYPE", "ADMIT_DATE") if f in c]
    rows += [(t, VISIT, "DC 1.11") for t, c in columns.items() if VISIT in c and PATIENT in c]
    rows += [(t, f, "DC 1.12") for t, c in columns.items() if t != "PROVIDER"
             for f in c if f.endswith(PROVIDER)]
    rows += [(t, None, "DC 1.13") for t in CODE_TABLES if t in columns]
    rows += [(t, f, "DC 2.02") for t, c in columns.items() for f in c if f in model.BOUNDS]
    rows += [("DEMOGRAPHIC", "AGE", "DC 2.02")]
    rows += [(t, f, test) for t, f, test in (
        ("DIAGNOSIS", "DX", "DC 3.01"), ("PROCEDURES", "PX", "DC 3.02"),
        ("DIAGNOSIS", "DX", "DC 3.04"), ("PROCEDURES", "PX", "DC 3.05"),
        ("ENCOUNTER", "ADMIT_DATE", "DC 3.07"), ("DIAGNOSIS", "ADMIT_DATE", "DC 3.07"),
        ("PROCEDURES", "ADMIT_DATE", "DC 3.07"), ("LAB_RESULT_CM", "RESULT_NUM", "DC 3.10"),
        ("VITAL", "MEASURE_DATE", "DC 3.11"), ("PRESCRIBING", "RX_ORDER_DATE", "DC 3.11"),
        ("LAB_RESULT_CM", "LAB_ORDER_DATE", "DC 3.11"),
    ) if t in columns]
    rows += list(more)
    return manifest_frame(spark, rows)


def manifest_frame(spark: SparkSession, rows: list[tuple[str | None, str | None, str]]) -> DataFrame:
    schema = pa.schema([("table", pa.string()), ("field", pa.string()), ("test", pa.string())])
    return model.local_table(spark, schema, [{"table": t, "field": f, "test": x} for t, f, x in rows])
