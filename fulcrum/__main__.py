"""Command line: ``python -m fulcrum build ...`` / ``python -m fulcrum validate ...``.

    build     raw CSV folder (or driver test tables) -> gate -> marts, fact and headline
              JSON, published under --out as one set; prints row counts and the formatted
              headline KPIs.
    validate  run the fact_orders quality suite on the published fact of --out, or on an exported one
              (--fact); prints the report and exits with status 1 if a critical rule fails.

Use through ``spark-submit`` on a cluster (the session comes from its configuration) or
directly with Python for a local run.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("fulcrum").getOrCreate()
    from fulcrum.session import checkpoint_dir

    checkpoint_dir(spark)
    return spark


def build(args) -> int:
    from fulcrum.plans import marts
    from fulcrum.plans.build import run_pipeline
    from fulcrum.sources import from_driver_tables, read_sources_csv

    spark = _session()
    src = from_driver_tables(spark, args.testdata) if args.testdata else read_sources_csv(spark, args.raw)
    result = run_pipeline(src, args.out, fmt=args.format)
    for name, rows in result["rows"].items():
        print(f"wrote {name:32s} ({rows:,} rows)")
    if result.get("manifest"):
        print(f"published as set {result['manifest']} of {args.out}")
    # a KPI without any row behind it is null: name the types instead of guessing them
    wide = spark.createDataFrame([result["headline"]], ", ".join(f"{k} double" for k in marts.KPI_NAMES))
    print("\n=== HEADLINE KPIs ===")
    for r in marts.kpi_exec_labels_from_wide(wide).collect():
        print(f"  {r['kpi']:30s} {r['label']}")
    return 0


def validate(args) -> int:
    from fulcrum.operators import quality
    from fulcrum.operators.star import FACT_ORDERS_DDL
    from fulcrum.sources.published import Published

    spark = _session()
    if args.out:
        fact = Published(spark, args.out).read("fact_orders")
    elif args.format == "csv":
        fact = spark.read.schema(FACT_ORDERS_DDL).option("header", True).csv(args.fact, enforceSchema=False)
    else:
        fact = spark.read.parquet(args.fact)
    report = quality.expect(fact, quality.FACT_ORDERS_RULES, with_rows=True)
    rows = report.collect()
    for r in rows:
        print(f"{r['expectation']:32s} {r['column']:14s} {r['critical']:3s} {r['result']:4s} {r['unexpected_pct']:8.3f}")
    summary = quality.summary(spark.createDataFrame(rows, report.schema)).first()
    print(f"\n{summary['rows']:,} rows · {summary['expectations']} expectations · {summary['passed']} passed, "
          f"{summary['failed']} failed ({summary['critical_failed']} critical)")
    return 1 if summary["critical_failed"] else 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="python -m fulcrum")
    sub = parser.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build", help="build the star, gate it and write the marts")
    src = b.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw", help="folder with the eight raw CSV files")
    src.add_argument("--testdata", help="folder with the driver's Parquet test tables")
    b.add_argument("--out", required=True, help="output folder")
    b.add_argument("--format", default="csv", choices=["csv", "parquet"])
    v = sub.add_parser("validate", help="run the quality suite on an exported fact")
    which = v.add_mutually_exclusive_group(required=True)
    which.add_argument("--fact", help="exported fact_orders folder")
    which.add_argument("--out", help="output folder of a build: its published fact_orders")
    v.add_argument("--format", default="parquet", choices=["csv", "parquet"])
    args = parser.parse_args(argv)
    return build(args) if args.command == "build" else validate(args)


if __name__ == "__main__":
    sys.exit(main())
