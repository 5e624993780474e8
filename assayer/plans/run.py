"""Running a manifest: many checks, few jobs.

Checks are grouped by what has to be read and shuffled.  A table is read at most four times,
however many checks ask about it: once for everything counted row by row, observed lengths
included (``row``); once for counts by value: value sets, months, encounter types
(``grains``); once for its keys (``keystate``); and once for replicated fields or for ages.
Each of these passes is one exchange over all tables.  The groups are unioned into a single
DataFrame, so one action runs their stages side by side.
"""

from __future__ import annotations

import datetime
from dataclasses import replace

from pyspark.sql import DataFrame

from assayer import model
from assayer.model import evidence_rows, judge, union_all
from assayer.operators import age, grains, groups, keys, links, recency, replication, row, schema, values
from assayer.operators.grains import Member, Use
from assayer.operators.keystate import Pass
from assayer.plans.manifest import Compiler, Settings, Workload, manifest_frame
from assayer.sources.registry import Tables


def run_checks(
    tables: Tables,
    manifest: DataFrame,
    metadata: DataFrame | None = None,
    valuesets: DataFrame | None = None,
    version: str = "5.1",
    as_of: datetime.date | None = None,
    settings: Settings | None = None,
    fused: bool = True,
) -> DataFrame:
    """Result rows (``RESULT_COLUMNS``) of every check the manifest names.

    ``metadata`` is needed by DC 1.03 and 1.04, ``valuesets`` by DC 1.06.  A check on a
    table or column that is not there gives a row without value and result.  ``fused=False``
    plans every manifest row by itself, for comparison.
    """
    settings = settings or Settings()
    if version.endswith("_STG"):
        settings = replace(settings, staging=True)
    rows = [(r["table"], r["field"], r["test"]) for r in manifest.collect()]
    if not fused and len(rows) > 1:
        spark = manifest.sparkSession
        return union_all([
            run_checks(tables, manifest_frame(spark, [r]), metadata, valuesets, version, as_of, settings)
            for r in rows
        ])
    compiler = Compiler(tables, settings)
    for table, field, test in rows:
        compiler.add(table, field, test)
    tables, work = compiler.tables, compiler.work
    measured, lengths = _row_pass(tables, work, metadata, settings)
    parts = []
    evidence = _evidence(tables, work, measured, manifest, valuesets, as_of, settings)
    if evidence is not None:
        parts.append(judge(evidence, work.checks))
    parts += _schema_results(tables, work, lengths, manifest, metadata, version, settings)
    if not parts:
        return judge(evidence_rows(manifest.sparkSession, []), {})
    return union_all(parts)


def _row_pass(
    tables: Tables, work: Workload, metadata: DataFrame | None, settings: Settings,
) -> tuple[list[DataFrame], DataFrame | None]:
    """Evidence by table of what is counted row by row, and observed lengths of columns.

    Lengths are measures of the same aggregate, with ids behind those of the checks; both
    results read all of it and filter after, so they share one exchange.
    """
    wanted: dict[int, tuple[str, str]] = {}
    if "DC 1.04" in work.schema_tests and settings.lengths != "declared" and metadata is not None:
        wanted = dict(enumerate(schema.limited_columns(tables, metadata), len(work.checks)))
    measures = {t: dict(m) for t, m in work.rows.items()}
    for i, (table, field) in wanted.items():
        measures.setdefault(table, {})[i] = row.longest(field)
    found = {t: row.row_evidence(tables[t], m, settings.footers) for t, m in measures.items()}
    checked = [found[t].where(f"check_id < {len(work.checks)}") for t in work.rows]
    if not wanted:
        return checked, None
    sized = dict.fromkeys(t for t, _ in wanted.values())
    lengths = union_all([found[t].where(f"check_id >= {len(work.checks)} and denominator >= 0") for t in sized])
    return checked, schema.named_lengths(lengths, wanted)


def _grains(tables: Tables, work: Workload, valuesets: DataFrame | None, settings: Settings) -> DataFrame | None:
    """Evidence of everything counted by value."""
    members: list[Member] = []
    uses: list[Use] = []
    allowed = None

    def number(member: Member) -> int:
        if member not in members:
            members.append(member)
        return members.index(member)

    if work.values:
        if valuesets is None:
            raise ValueError("value-set checks (DC 1.06) need value sets")
        fields = {number(values.field_values(t, f)): (t, f) for t, f in work.values.values()}
        uses += [Use(i, number(values.field_values(t, f)), "set") for i, (t, f) in work.values.items()]
        allowed = values.allowed_values(fields, valuesets).withColumnRenamed("check_id", "member")
    for i, (table, field, by_type) in work.latency.items():
        uses.append(Use(i, number(recency.months(table, field, by_type)), "month"))
    enc_types = sorted({t for ids in work.events.values() for t in ids.values()})
    for (table, type_field, known), ids in work.events.items():
        sides = [(number(groups.events(table, type_field, known, enc_types)), "numerator"),
                 (number(groups.encounters("ENCOUNTER", enc_types)), "denominator")]
        uses += [Use(i, member, role, t) for i, t in ids.items() for member, role in sides]
    if not uses:
        return None
    return grains.evidence(tables, dict(enumerate(members)), uses, allowed, settings.unlisted, settings.include_empty)


def _keys(tables: Tables, work: Workload) -> DataFrame | None:
    """Evidence of everything asked of keys."""
    one = Pass(tables)
    for i, (table, fields) in work.primary_keys.items():
        one.primary_key(i, table, keys.columns(fields))
    for i, (link, parents) in work.links.items():
        links.ask(one, i, link, parents)
    for i, (table, field, unit) in work.duplicates.items():
        one.duplicated(i, table, field, unit)
    return one.evidence() if one.asked else None


def _evidence(
    tables: Tables, work: Workload, measured: list[DataFrame], manifest: DataFrame, valuesets: DataFrame | None,
    as_of: datetime.date | None, settings: Settings,
) -> DataFrame | None:
    parts = [*measured, _keys(tables, work), _grains(tables, work, valuesets, settings)]
    parts += [
        replication.replication_evidence(tables, parent, "ENCOUNTERID", copies)
        for parent, copies in work.copies.items()
    ]
    parts += [
        age.extreme_age_evidence(tables[t], tables["DEATH"], i, as_of, settings.age_unit, settings.death_sources)
        for i, t in work.ages.items()
    ]
    if work.unavailable:
        parts.append(evidence_rows(manifest.sparkSession, [(i, None, None) for i in work.unavailable]))
    found = [p for p in parts if p is not None]
    if not found:
        return None
    return union_all([p.select("check_id", "numerator", "denominator") for p in found])


def _schema_results(
    tables: Tables, work: Workload, lengths: DataFrame | None, manifest: DataFrame, metadata: DataFrame | None,
    version: str, settings: Settings,
) -> list[DataFrame]:
    out = []
    for test in work.schema_tests:
        if test == "DC 1.01":
            release = version.split("_")[0]
            if release not in model.REQUIRED_TABLES:
                raise ValueError(f"no list of required tables for version {version}")
            names = model.REQUIRED_TABLES[release]
            out.append(schema.required_tables(tables, manifest_frame(
                manifest.sparkSession, [(n, None, test) for n in names]).select("table"), test))
            continue
        if metadata is None:
            raise ValueError(f"{test} needs the schema specification")
        if test == "DC 1.03":
            failures = schema.required_fields(tables, metadata, test)
            text = "All required fields are present."
        else:
            failures = schema.field_conformance(tables, metadata, test, settings.lengths, lengths)
            text = "All fields conform to the specification."
        out.append(schema.pass_when_empty(failures, test, text))
    return out
