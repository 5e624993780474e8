"""Command line: run a manifest, or profile tables.

    spark-submit … -m assayer checks  --tables ROOT --manifest M.csv --out OUT [options]
    spark-submit … -m assayer profile --tables ROOT --out OUT [options]

Tables are files ``ROOT/<NAME><suffix>``, tables of a session database with ``--database``,
or tables of a database server with ``--jdbc-url``.
"""

from __future__ import annotations

import argparse
import datetime
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from assayer import model
from assayer.model import union_all
from assayer.operators import sketches, values
from assayer.operators.profile import profile, profile_tables, report
from assayer.plans.manifest import Settings
from assayer.plans.run import run_checks
from assayer.sources import control, database, sinks
from assayer.sources.registry import Tables, open_database, open_directory


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="assayer", description=__doc__.splitlines()[0])
    parser.add_argument("action", choices=["checks", "profile"])
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--tables", help="folder holding one file or folder per table")
    source.add_argument("--database", help="database of the session catalog")
    source.add_argument("--jdbc-url", help="address of a database server")
    parser.add_argument("--jdbc-schema")
    parser.add_argument("--jdbc-property", nargs="*", default=[], metavar="KEY=VALUE", help="driver, user and the like")
    parser.add_argument("--jdbc-password-env", help="environment variable that holds the password")
    parser.add_argument("--jdbc-catalog", help="read through a catalog of this name, aggregates pushed to the server")
    parser.add_argument("--split", nargs="*", default=[], metavar="TABLE=COLUMN", help="read these tables in parts by a column;"
                        " default: the primary key of the specification")
    parser.add_argument("--rows-per-part", type=int, default=database.ROWS_PER_PART)
    parser.add_argument("--most-parts", type=int, default=database.MOST_PARTS, help="connections to the server at a time")
    parser.add_argument("--footers", action="store_true", help="take row and NULL counts of Parquet tables from their footers")
    parser.add_argument("--suffix", default=".parquet")
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--names", nargs="*", help="tables to open; default: those the specification knows")
    parser.add_argument("--out", required=True)
    parser.add_argument("--out-format", default="csv")
    parser.add_argument("--manifest")
    parser.add_argument("--metadata", help="schema specification CSV")
    parser.add_argument("--dialect", default="Oracle", help="type names of the specification to use")
    parser.add_argument("--valuesets", help="value-set CSV")
    parser.add_argument("--reference-table", help="value sets as a table of the session catalog")
    parser.add_argument("--units", help="CSV of known units")
    parser.add_argument("--unit-grammar", action="store_true", help="judge units by the grammar of unit codes too")
    parser.add_argument("--version", default="5.1")
    parser.add_argument("--as-of", type=datetime.date.fromisoformat)
    parser.add_argument("--min-flags", type=int, default=1)
    parser.add_argument("--lengths", choices=["auto", "declared", "observed"], default="auto")
    parser.add_argument("--include-empty", action="store_true", help="report encounter types without events")
    parser.add_argument("--age-unit", choices=["days", "years"], default="days")
    parser.add_argument("--death-sources", nargs="+", help="values of DEATH_SOURCE, best first: one death a person counts")
    parser.add_argument("--union-parents", action="store_true")
    parser.add_argument("--approximate", action="store_true", help="profile by sketches, stored and merged over run dates")
    parser.add_argument("--only", nargs=2, metavar=("FIELD", "VALUE"), help="profile only these rows")
    return parser.parse_args(argv)


def _server_tables(spark: SparkSession, args: argparse.Namespace, names: list[str]) -> Tables:
    properties = dict(p.split("=", 1) for p in args.jdbc_property)
    if args.jdbc_password_env:
        properties["password"] = os.environ[args.jdbc_password_env]
    server = database.Server(spark, args.jdbc_url, args.jdbc_schema, properties)
    names = server.present(names)
    if args.jdbc_catalog:
        return server.open_catalog(names, args.jdbc_catalog)
    columns = {t.upper(): c for t, c in (s.split("=", 1) for s in args.split)}
    if args.metadata:
        spec = control.read_metadata(spark, args.metadata, args.dialect).where("primary = 'P'").orderBy("table", "ordinal")
        for r in spec.collect():
            columns.setdefault(r["table"], r["field"])
    return server.open(names, server.plan({t: c for t, c in columns.items() if t in names}, args.rows_per_part, args.most_parts))


def _tables(spark: SparkSession, args: argparse.Namespace) -> Tables:
    names = args.names or model.REQUIRED_TABLES["5.1"]
    if args.version.endswith("_STG") and not args.names:
        names = names + [f"{n}_STG" for n in names]
    if args.jdbc_url:
        return _server_tables(spark, args, names)
    if args.database:
        live = {t.name.upper() for t in spark.catalog.listTables(args.database)}
        return open_database(spark, [n for n in names if n in live], args.database)
    found = {}
    for name in names:
        try:
            found |= open_directory(spark, args.tables, [name], args.suffix, args.format, footers=args.footers)
        except Exception as error:  # an absent table is a finding of the run, not its end
            if "PATH_NOT_FOUND" not in str(error):
                raise
    return found


def _columns(df) -> set[str]:
    return {c.upper() for c in df.columns}


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName("assayer").getOrCreate()
    tables = _tables(spark, args)
    metadata = control.read_metadata(spark, args.metadata, args.dialect) if args.metadata else None
    if args.action == "profile":
        if args.only:
            field, value = args.only
            for name in args.names or list(tables):
                if name in tables and field.upper() in _columns(tables[name]):
                    rows = report(profile(tables[name], name, metadata, (field, value)))
                    sinks.write_profile(rows, f"{args.out}/profile_filtered", (field, value), args.out_format)
        elif args.approximate:
            made = union_all([sketches.sketches(tables[n], n) for n in args.names or tables if n in tables])
            sinks.write_sketches(made, f"{args.out}/sketches", datetime.date.today())
            merged = sketches.merge(sinks.read_published(spark, f"{args.out}/sketches"))
            sinks.write_profile(sketches.estimates(merged), f"{args.out}/profile_approximate", fmt=args.out_format)
        else:
            rows = report(profile_tables(tables, args.names, metadata))
            sinks.write_profile(rows, f"{args.out}/profile", fmt=args.out_format)
        return
    if not args.manifest:
        raise SystemExit("checks need --manifest")
    manifest = control.read_manifest(spark, args.manifest)
    sets, unlisted = None, "valid"
    if args.reference_table:
        sets, unlisted = control.reference_valuesets(spark.table(args.reference_table)), "invalid"
    elif args.valuesets:
        sets = control.read_valuesets(spark, args.valuesets)
    settings = Settings(union_parents=args.union_parents, min_flags=args.min_flags,
                        unlisted=unlisted, lengths=args.lengths,
                        include_empty=args.include_empty, age_unit=args.age_unit,
                        footers=args.footers,
                        death_sources=tuple(args.death_sources) if args.death_sources else None)
    today = datetime.date.today()
    results = run_checks(tables, manifest, metadata, sets, args.version, args.as_of or today, settings)
    sinks.write_results(results, f"{args.out}/results", today, args.out_format)
    if sets is None:
        return
    asked = [
        (r["table"], r["field"]) for r in manifest.where("test = 'DC 1.06'").distinct().collect()
        if r["table"] in tables and (r["field"] or "").upper() in _columns(tables[r["table"]])
    ]
    if asked:
        invalid = values.invalid_values(tables, asked, sets, unlisted)
        sinks.write_invalid_values(invalid, f"{args.out}/invalid_values", args.out_format, today)
        if args.units or args.unit_grammar:
            # The listing is read back: values are not counted again.
            listed = sinks.read_published(spark, f"{args.out}/invalid_values").where(F.col("run_date") == today)
            units = listed.where(F.upper("field").isin(model.UNIT_FIELDS)).drop("run_date")
            known = control.read_units(spark, args.units) if args.units else None
            found = values.unit_validity(units, known, grammar=args.unit_grammar)
            sinks.write_unit_validity(found, f"{args.out}/unit_validity", args.out_format, today)


if __name__ == "__main__":
    main()
