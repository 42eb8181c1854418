"""Command line: ``python -m funnelwright ingest|increment|model|report|history``, each on the folders of the step before."""

from __future__ import annotations

import argparse
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from funnelwright.plans import build_history, build_model, ingest_leads, ingest_reports, kpi_reports
from funnelwright.sources import merge_batches, write_table
from funnelwright.specs import SPECS, get_spec, specs_from_json
from funnelwright.streaming import increment_leads, increment_reports, invalid_values_of_increments


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="funnelwright", description=__doc__)
    step = parser.add_subparsers(dest="step", required=True)
    ingest = step.add_parser("ingest", help="raw leads and report snapshots -> conformed tables")
    increment = step.add_parser("increment", help="the raw files that are new since the last run -> added to conformed tables")
    for taken in (ingest, increment):
        # The environment variables and default folders of the raw files.
        taken.add_argument("--leads", default=os.getenv("LEADS_PREFIX", "leads"))
        taken.add_argument("--reports", default=os.getenv("REPORTS_PREFIX", "contractor_reports"))
        taken.add_argument("--out", default="step1")
        taken.add_argument("--specs", help="JSON file with table specifications 'leads' and 'reports'")
    increment.add_argument("--merge", action="store_true", help="write the batches of each table as one afterwards")
    model = step.add_parser("model", help="conformed tables -> dimensions and fact")
    model.add_argument("--conformed", default="step1")
    model.add_argument("--out", default="step2")
    history = step.add_parser("history", help="conformed tables -> latest states, changes, leads and reports without counterpart")
    history.add_argument("--conformed", default="step1")
    history.add_argument("--out", default="history")
    report = step.add_parser("report", help="dimensions and fact -> the five reports")
    report.add_argument("--model", default="step2")
    report.add_argument("--out", default="step3", help="folder that the complete reports are stored in")
    report.add_argument("--rows", type=int, default=1000, help="rows to print of each report; all are stored")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"funnelwright {args.step}").getOrCreate()
    specs = specs_from_json(Path(args.specs).read_text()) if getattr(args, "specs", None) else SPECS
    if args.step == "ingest":
        show(ingest_leads(spark, args.leads, args.out, get_spec("leads", specs)), 10)
        reports, rows = ingest_reports(spark, args.reports, args.out, get_spec("reports", specs))
        print(f"{rows} report rows")
        show(reports, 10)
    elif args.step == "increment":
        show(increment_leads(spark, args.leads, args.out, get_spec("leads", specs)), 10)
        show(increment_reports(spark, args.reports, args.out, get_spec("reports", specs)), 10)
        show(invalid_values_of_increments(spark, args.out), 1000)
        if args.merge:
            for name in ("leads", "reports"):
                merge_batches(spark, args.out, name)
    elif args.step == "history":
        for name, frame in build_history(spark, args.conformed, args.out).items():
            print(name)
            show(frame, 10)
    elif args.step == "model":
        show(build_model(spark, args.conformed, args.out), 10)
    else:
        for name, frame in kpi_reports(spark, args.model).items():
            write_table(frame, args.out, name)
            print(name)
            frame.show(args.rows, truncate=False)


def show(df: DataFrame, rows: int) -> None:
    df.printSchema()
    df.show(rows)


if __name__ == "__main__":
    main()
