"""Command line: ``python -m credara load|generate``, to be run with spark-submit on a cluster."""

import argparse

from pyspark.sql import SparkSession

from credara.plans import kpis, pipeline
from credara.session import size_shuffles
from credara.sources import csv_files, synthetic
from credara.sources.tables import Catalog
from credara.sources.workspace import Workspace


def _reports(ws: Workspace, tables: dict) -> dict:
    fact, tiempo, industria = (tables[f"marts.{t}"] for t in ("fact_originaciones", "dim_tiempo", "dim_industria"))
    return {
        "total_originado": kpis.total(fact), "top_industrias": kpis.top_industries(fact, industria),
        "ticket_por_segmento": kpis.ticket_by_segment(fact), "primer_pago": kpis.first_payment(fact),
        "indice_de_mora": kpis.late_index(fact, industria), "canales": kpis.channel_mix(fact),
        "plazo_por_industria": kpis.term_by_industry(fact, industria), "ticket_por_canal": kpis.channel_tickets(fact),
        "percentiles": kpis.percentiles(ws, fact, industria), "resumen_mensual": kpis.monthly(fact, tiempo),
    }


def main() -> None:
    parser = argparse.ArgumentParser(prog="credara")
    commands = parser.add_subparsers(dest="command", required=True)
    load = commands.add_parser("load", help="check a monthly file, load the star schema, write all KPIs")
    load.add_argument("file")
    load.add_argument("out", help="shared folder for tables, failure log and KPIs")
    load.add_argument("--gate", choices=pipeline.GATES, default="strict")
    load.add_argument("--enforce", action="store_true", help="publish nothing if a declared constraint is broken")
    make = commands.add_parser("generate", help="write synthetic credits with faults")
    make.add_argument("out")
    make.add_argument("--rows", type=int, default=5_000)
    make.add_argument("--seed", type=int, default=2025)
    args = parser.parse_args()

    spark = SparkSession.builder.appName("credara").getOrCreate()
    if args.command == "generate":
        csv_files.write_csv(synthetic.generate(spark, args.rows, args.seed), args.out)
        return
    size_shuffles(spark, args.file)
    ws = Workspace(spark)
    load = pipeline.load_month(ws, args.file, Catalog(spark, f"{args.out}/tables"), args.gate,
                               f"{args.out}/registros_fallidos", enforce=args.enforce)
    for name, (rows, seconds) in load.models.items():
        print(f"{name}: {rows} rows, {seconds:.1f} s")
    print(f"{load.loaded} rows loaded")
    for name, df in {"calidad": load.statistics, "restricciones": load.violations, **_reports(ws, load.tables)}.items():
        csv_files.write_csv(df, f"{args.out}/kpis/{name}")
    ws.clear()


if __name__ == "__main__":
    main()
