"""Command line for submitted jobs.

    spark-submit --py-files tidemark.zip tidemark/__main__.py COMMAND ...

    ingest devolucoes raw/returns.csv lake/bronze/devolucoes --rejects lake/rejects/monday
    daily devolucoes raw/daily lake/bronze/devolucoes lake/state/devolucoes
    profile raw/returns.csv --count motivo_devolucao --out lake/profile
    refine lake/bronze lake/silver lake/gold

Master, object-store endpoint, keys and packages come from the submitting environment.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from tidemark.operators import column_info, describe, head, null_counts, overwrite, value_counts_multi
from tidemark.plans import Field, ingest, shop, with_load_columns
from tidemark.plans.increment import (
    REFINED, last_refined, new_since, read_silver, rebuild_silver, refresh_fact, refresh_silver,
)
from tidemark.plans.marks import read_mark, write_mark
from tidemark.sources import read_csv, read_csv_loose, stream_csv
from tidemark.streaming import ingest_available
from tidemark.tables import RETURNS, SALES, STOCK, TableSpec
from tidemark.workspace import fresh_dir

TABLES = {spec.name: spec for spec in (SALES, STOCK, RETURNS)}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark")
    commands = parser.add_subparsers(dest="command", required=True)
    loading = commands.add_parser("ingest", help="append the rows of CSV files that are not stored yet")
    loading.add_argument("table", choices=sorted(TABLES))
    loading.add_argument("source")
    loading.add_argument("target")
    loading.add_argument("--rejects", help="where this batch's malformed lines and rows without a key go")
    loading.add_argument("--schema", help="column types as DDL, for tables whose columns are not fixed")
    loading.add_argument("--batch-id", help="store the load history with each row under this name")
    profiling = commands.add_parser("profile", help="print what CSV files hold")
    profiling.add_argument("source")
    profiling.add_argument("--count", nargs="*", default=[], metavar="COLUMN", help="columns to count values of")
    profiling.add_argument("--out", help="write each report there as a whole")
    profiling.add_argument("--rows", type=int, default=200, help="rows of each report to print (200)")
    profiling.add_argument("--line-breaks", action="store_true", help="values hold quoted line breaks")
    daily = commands.add_parser("daily", help="ingest the CSV files that arrived in a directory since the last run")
    daily.add_argument("table", choices=sorted(TABLES))
    daily.add_argument("directory")
    daily.add_argument("target")
    daily.add_argument("checkpoint", help="where the run notes which files it has seen")
    daily.add_argument("--rejects", help="where malformed lines and rows without a key go, by run and micro-batch")
    daily.add_argument("--batch-id", help="store the load history with each row under this name")
    daily.add_argument("--schema", help="column types as DDL, for tables whose columns are not fixed")
    refining = commands.add_parser("refine", help="bring the cleaned and the star-schema tables up to date")
    refining.add_argument("bronze")
    refining.add_argument("silver")
    refining.add_argument("gold")
    refining.add_argument("--rebuild", action="store_true", help="clean all stored rows anew, not only new ones")
    refining.add_argument("--schema", help="types of the sales columns as DDL; sales are then cleaned too")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"tidemark {args.command}").getOrCreate()
    if args.command == "ingest":
        spec = typed(TABLES[args.table], args.schema)
        declared = spec.schema is not None
        batch = read_csv(spark, args.source, spec.schema, infer=not declared, keep_malformed=declared)
        if args.batch_id:
            batch, spec = with_load_columns(batch, args.batch_id), spec.with_load_columns()
        print(ingest(spark, batch, spec, args.target, rejects_uri=args.rejects, read_once=True))
    elif args.command == "daily":
        spec = typed(TABLES[args.table], args.schema)
        if spec.schema is None:
            parser.error(f"{spec.name} has no fixed columns: --schema is needed")
        files = stream_csv(spark, args.directory, spec.schema, keep_malformed=True)
        if args.batch_id:
            spec = spec.with_load_columns()
        results = ingest_available(
            files, spec, args.target, args.checkpoint, rejects_uri=args.rejects, batch_id=args.batch_id
        )
        for result in results:
            print(result)
    elif args.command == "profile":
        profile(spark, args.source, args.count, args.out, args.rows, multiLine=args.line_breaks)
    else:
        refine(spark, args.bronze, args.silver, args.gold, rebuild=args.rebuild, sales_schema=args.schema)


def typed(spec: TableSpec, schema: str | None) -> TableSpec:
    """The table with the caller's column types, where it has no fixed ones."""
    return replace(spec, schema=schema) if schema and spec.schema is None else spec


def profile(
    spark: SparkSession, source: str, count: list[str], out: str | None = None, rows: int = 200, **options: str | bool
) -> None:
    """Print reports, the first ``rows`` rows of each; ``out`` gets them whole.

    The files are parsed and typed once: the reports read the typed rows from Parquet.
    """
    kept = fresh_dir(spark, "profile")
    read_csv_loose(spark, source, **options).write.parquet(kept)
    found = spark.read.parquet(kept)
    reports = {
        "head": head(found, [f"`{c}`" for c in found.columns]),
        "columns": column_info(found),
        "numbers": describe(found),
        "nulls": null_counts(found),
    }
    if count:
        reports["values"] = value_counts_multi(found, count)
    for name, report in reports.items():
        if out:
            report.write.mode("overwrite").parquet(f"{out}/{name}")
            report = spark.read.parquet(f"{out}/{name}")
        report.show(rows, truncate=False)


def refine(
    spark: SparkSession, bronze: str, silver: str, gold: str, *, rebuild: bool = False, sales_schema: str | None = None
) -> None:
    """Bring the cleaned tables and the star schema up to date with the rows that came since the last run.

    Stored rows never change, so only rows whose key is not cleaned yet are taken up, and only what they touch in the
    star schema is written; no table is ever empty meanwhile. ``rebuild`` replaces every table by all stored rows
    cleaned anew, which a changed rule needs; readers should wait for it.
    """
    fields = dict(shop.FIELDS)
    tables = [RETURNS, STOCK]
    if sales_schema:
        sales = replace(SALES, schema=sales_schema)
        columns = StructType.fromDDL(sales_schema)
        fields[SALES.name] = [Field(f.name, f.dataType.simpleString(), required=f.name in SALES.key) for f in columns]
        tables.append(sales)
    cleaned = {}
    for spec in tables:
        uri, rejects = f"{silver}/{spec.name}", f"{silver}/{spec.name}_rejects"
        refresh = rebuild_silver if rebuild else refresh_silver
        result = refresh(spark, f"{bronze}/{spec.name}", uri, spec, fields[spec.name], rejects_uri=rejects)
        if result is None:
            raise SystemExit(f"nothing was ingested into {bronze}/{spec.name}")
        print(result)
        cleaned[spec.name] = read_silver(spark, uri, spec, fields[spec.name])

    returns, stock = cleaned[RETURNS.name], cleaned[STOCK.name]
    high = {name: last_refined(rows) for name, rows in cleaned.items()}
    if rebuild:
        for name, rows in shop.star(returns.drop(REFINED), stock.drop(REFINED)).items():
            print(name, overwrite(rows, f"{gold}/{name}"))
        print("fato_devolucoes_mes", overwrite(shop.returns_per_month(returns), f"{gold}/fato_devolucoes_mes", ["mes"]))
        if high[RETURNS.name] is not None:
            write_mark(spark, f"{gold}/fato_devolucoes_mes", "refined", high[RETURNS.name])
    else:
        new = [
            new_since(rows, read_mark(spark, gold, spec.name), high[spec.name]).drop(REFINED)
            for spec, rows in ((RETURNS, returns), (STOCK, stock))
        ]
        for name, rows in shop.star(*new).items():
            print(ingest(spark, rows, TableSpec(name, shop.STAR_KEYS[name]), f"{gold}/{name}"))
        months = refresh_fact(spark, returns, shop.returns_per_month, f"{gold}/fato_devolucoes_mes", shop.month_directory())
        print("fato_devolucoes_mes", months)
    for spec in (RETURNS, STOCK):
        if high[spec.name] is not None:
            write_mark(spark, gold, spec.name, high[spec.name])


if __name__ == "__main__":
    main()
