"""Job entry, ``python -m carelayers``: CSV folder in, layers out, row counts shown."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from carelayers.plans.checks import write_reports
from carelayers.plans.runner import PLANS, run_tables
from carelayers.sources.raw import PLAIN_CSV, RawFolder


def main() -> None:
    parser = argparse.ArgumentParser(prog="carelayers")
    parser.add_argument("--input", required=True, help="folder with the CSV tables")
    parser.add_argument("--output", required=True, help="folder for the layers")
    parser.add_argument("--tables", nargs="+", choices=list(PLANS), help="default: all")
    parser.add_argument("--sample", type=int, default=0, help="rows per table; 0 takes all")
    parser.add_argument("--whole", nargs="*", default=[], help="tables not to sample")
    parser.add_argument("--infer", action="store_true", help="infer types instead of declared ones")
    parser.add_argument("--partitions", type=int, help="files per table; default: Spark decides")
    parser.add_argument("--dictionary-partitions", type=int, help="files per dictionary")
    parser.add_argument("--plain", nargs="*", default=PLAIN_CSV, help="tables that are not gzip")
    parser.add_argument("--reports", action="store_true", help="write the reports as layers too")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("carelayers").getOrCreate()
    raw = RawFolder(
        spark, args.input, plain=tuple(args.plain), infer=args.infer, sample=args.sample,
        whole=tuple(args.whole),
    )
    counts = run_tables(
        spark, raw, args.output, args.tables, args.partitions, args.dictionary_partitions
    )
    counts.show(counts.count(), truncate=False)
    if args.reports:
        for name, rows in write_reports(spark, args.output, args.tables or PLANS).items():
            print(f"report_{name}: {rows} rows")
    spark.stop()


if __name__ == "__main__":
    main()
