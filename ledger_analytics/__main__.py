"""Command line: ``python -m ledger_analytics <command> ...``

* ``run``: archives -> normalised -> consolidated -> validated ->
  aggregated stages, then the typed star schema (Q9–Q15).
* ``resend``: account files of a run that were sent again; only what they
  change is netted and written anew.
* ``report``: the analytical and served queries (Q1–Q8) over a loaded
  star schema, printed or written as CSV.

Runs on the session ``spark-submit`` provides (or a local one).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans import analytics as A
from .plans.batch import publish_star_schema, registry_as_staging, run_batch
from .plans.corrections import resend_files
from .plans.views import star_tables
from .session import apply_plan_defaults, ensure_checkpoint_dir
from .sinks.files import export_csv
from .sources.files import read_registry


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("ledger-analytics").getOrCreate()
    apply_plan_defaults(spark)
    ensure_checkpoint_dir(spark)
    return spark


def cmd_run(args) -> None:
    spark = _session()
    res = run_batch(spark, args.raw, args.registry, args.out, archives_dir=args.archives,
                    on_unmatched=args.on_unmatched)
    clean = spark.read.parquet(res.paths["clean"])
    agg = spark.read.parquet(res.paths["aggregated"])
    tables = publish_star_schema(spark, registry_as_staging(read_registry(spark, args.registry)), clean, agg,
                                 f"{args.out.rstrip('/')}/db")
    for path, reason in res.skipped_files:
        print(f"skipped\t{path}\t{reason}")
    for name in sorted(k for k, v in res.written.items() if v):
        print(f"rejects\t{name}")
    for name, path in res.paths.items():
        print(f"{name}\t{path}")
    print(f"db\t{tables.root}\tversion {tables.current()}")


def cmd_resend(args) -> None:
    res = resend_files(_session(), args.file, args.registry, args.out, on_unmatched=args.on_unmatched)
    for path, reason in res.skipped_files:
        print(f"skipped\t{path}\t{reason}")
    for name in sorted(k for k, v in res.written.items() if v):
        print(f"rejects\t{name}")


def cmd_report(args) -> None:
    spark = _session()
    tables = star_tables(spark, args.db)
    ops, facts = tables["operadoras"], tables["despesas_consolidadas"]
    reports = {
        "top_growth": A.top_growth(facts, ops, args.year, args.first_quarter,
                                   last_quarter=args.last_quarter, k=args.k),
        "state_distribution": A.state_distribution(facts, ops, k=args.k),
        "above_mean_quarters": A.above_mean_quarters(facts, ops),
        "top_operators": A.top_operators(facts, ops, k=args.k),
    }
    if args.cnpj:
        reports["operator"] = A.operator_by_cnpj(ops, args.cnpj)
        reports["expense_history"] = A.expense_history(facts, ops, args.cnpj)
    for name, df in reports.items():
        if args.out:
            export_csv(df, f"{args.out.rstrip('/')}/{name}")
        else:
            print(f"== {name}")
            df.show(args.show, truncate=False)


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="ledger_analytics")
    sub = p.add_subparsers(dest="command", required=True)
    pp = sub.add_parser("run", help="run the batch stages and load the star schema")
    pp.add_argument("--raw", required=True, help="folder with quarterly account files (searched recursively)")
    pp.add_argument("--registry", required=True, help="operator registry file (';' separated)")
    pp.add_argument("--out", required=True, help="output folder for stages and tables")
    pp.add_argument("--archives", help="folder with .zip archives to extract into --raw first")
    pp.add_argument("--on-unmatched", choices=("drop", "keep"), default="drop")
    pp.set_defaults(func=cmd_run)
    ps = sub.add_parser("resend", help="take account files again that a run has read, at the same paths")
    ps.add_argument("--file", required=True, nargs="+", help="paths as the run read them; one that is gone counts as empty")
    ps.add_argument("--registry", required=True, help="operator registry file (';' separated)")
    ps.add_argument("--out", required=True, help="output folder of the run")
    ps.add_argument("--on-unmatched", choices=("drop", "keep"), default="drop")
    ps.set_defaults(func=cmd_resend)
    pr = sub.add_parser("report", help="analytical queries over a loaded star schema")
    pr.add_argument("--db", required=True, help="folder written by 'run' (<out>/db)")
    pr.add_argument("--year", type=int, required=True)
    pr.add_argument("--first-quarter", type=int, default=1)
    pr.add_argument("--last-quarter", type=int, default=3)
    pr.add_argument("-k", type=int, default=5)
    pr.add_argument("--cnpj", help="also look up this operator and its expense history")
    pr.add_argument("--out", help="write each report as CSV under this folder instead of printing")
    pr.add_argument("--show", type=int, default=20)
    pr.set_defaults(func=cmd_report)
    args = p.parse_args(argv)
    args.func(args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
