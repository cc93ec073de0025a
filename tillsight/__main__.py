"""Command line: ``python -m tillsight {list,run,load} ...``.

    python -m tillsight list
    python -m tillsight run q04_customer_ltv --data /root/testdata/sf0.1 --show 20
    python -m tillsight run q11_rolling_revenue --warehouse /shared/wh --out /shared/out/q11
    python -m tillsight load --data /root/testdata/sf0.1 --warehouse /shared/wh --checks

With ``spark-submit`` the cluster's session is used; otherwise a local one.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from pyspark import SparkConf
    if SparkConf().contains("spark.master"):
        # launched by spark-submit: keep the cluster's master and settings
        from tillsight.session import ensure_checkpoint_dir
        spark = SparkSession.builder.appName("tillsight").getOrCreate()
        ensure_checkpoint_dir(spark)
        return spark
    from tillsight.session import local_session
    return local_session()


def main(argv: list[str] | None = None) -> int:
    from tillsight.plans.catalog import STAR_QUERIES, run_on

    parser = argparse.ArgumentParser(prog="tillsight")
    sub = parser.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list the registered queries")
    run = sub.add_parser("run", help="run one registered query")
    run.add_argument("name", choices=sorted(STAR_QUERIES))
    src = run.add_mutually_exclusive_group(required=True)
    src.add_argument("--data", help="folder of generated parquet tables")
    src.add_argument("--warehouse", help="folder written by `load`")
    run.add_argument("--out", help="write the result here instead of showing it")
    run.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    run.add_argument("--show", type=int, default=20, help="rows to show")
    load = sub.add_parser("load", help="load the generated tables into a warehouse")
    load.add_argument("--data", required=True)
    load.add_argument("--warehouse", required=True)
    load.add_argument("--checks", action="store_true", help="run C4/C8 checks after loading")
    args = parser.parse_args(argv)

    if args.cmd == "list":
        print("\n".join(sorted(STAR_QUERIES)))
        return 0
    spark = _session()
    from tillsight.session import apply_defaults
    apply_defaults(spark)
    from tillsight.sources import warehouse
    from tillsight.sources.model import Star
    if args.cmd == "load":
        checks = warehouse.load_star(Star(spark, args.data), args.warehouse,
                                     run_checks=args.checks)
        if checks is not None:
            checks.show(100, truncate=False)
        return 0
    star = Star(spark, args.data) if args.data else warehouse.WarehouseStar(spark, args.warehouse)
    df = run_on(star, args.name)
    if args.out:
        df.write.mode("overwrite").format(args.format).option("header", "true").save(args.out)
    else:
        df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
