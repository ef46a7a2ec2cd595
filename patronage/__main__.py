"""Run the jobs from the command line, usually through ``spark-submit``.

    python -m patronage ingest --source SOURCE --base BASE [--tables NAME ...] [--run RUN]
    python -m patronage ingest-catalog --database NAME --base BASE [--catalog CATALOG]
    python -m patronage ingest-jdbc --url URL --database NAME --base BASE [--tables NAME ...]
    python -m patronage customer-360 --base BASE --out PATH [--clean]
    python -m patronage customer-analytics --base BASE (--out PATH | --out-table NAME) --returns-mode MODE
    python -m patronage features --table PATH-OR-NAME --out PATH [--scratch FOLDER]
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from patronage.operators.lookups import BROADCAST_BUDGET
from patronage.plans.customer_360 import customer_360, customer_360_clean
from patronage.plans.customer_analytics import customer_analytics
from patronage.plans.feature_step import feature_step
from patronage.plans.ingest import ingest_catalog, ingest_jdbc, ingest_parquet
from patronage.plans.star import DIMENSIONS, FACTS, star_from_parquet
from patronage.session import file_system, run_folder
from patronage.sources.catalog import CatalogDatabase
from patronage.sources.feature_table import save_features, stored_features, write_features
from patronage.sources.jdbc import JdbcDatabase
from patronage.sources.parquet import data_path

SHUFFLED_PER_TASK = 128 * 1024 * 1024


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="patronage", description="Customer analytics jobs")
    jobs = parser.add_subparsers(dest="job", required=True)

    copy = jobs.add_parser("ingest", help="copy Parquet tables")
    copy.add_argument("--source", required=True, help="folder of the tables to copy")
    fetch = jobs.add_parser("ingest-jdbc", help="copy the tables of a database")
    fetch.add_argument("--url", required=True)
    fetch.add_argument("--database", required=True)
    fetch.add_argument("--user")
    fetch.add_argument("--password-variable", help="environment variable with the password")
    fetch.add_argument("--driver", help="JDBC driver class")
    fetch.add_argument("--keys", nargs="*", default=[], metavar="TABLE=COLUMN[,COLUMN]")
    fetch.add_argument("--hash", nargs="*", default=[], metavar="TABLE", help="split by hash")
    fetch.add_argument("--reads", type=int, help="reads per table; default: cores")
    fetch.add_argument("--type-policy", choices=("source", "widen"), default="source")
    listed = jobs.add_parser("ingest-catalog", help="copy the tables of a Spark catalog")
    listed.add_argument("--database", required=True)
    listed.add_argument("--catalog", help="default: the session's")
    for ingest in (copy, fetch, listed):
        ingest.add_argument("--base", required=True, help="folder or bucket to write to")
        ingest.add_argument("--tables", nargs="+", help="default: all")
        ingest.add_argument("--at-once", type=int, default=1, help="tables copied at a time")
        ingest.add_argument("--run", help="name of the run: called again with it, copy only what is missing")

    profile = jobs.add_parser("customer-360", help="one row per customer")
    profile.add_argument("--clean", action="store_true", help="complete rows, no personal data")
    analytics = jobs.add_parser("customer-analytics", help="one row per store customer")
    analytics.add_argument(
        "--returns-mode",
        choices=("joined", "per_channel"),
        required=True,
        help="joined: inflated by the join of all returns, as the original; per_channel: as returned",
    )
    for job in (profile, analytics):
        job.add_argument("--base", required=True, help="folder of the ingested tables")
        job.add_argument(
            "--broadcast-budget", type=int, default=BROADCAST_BUDGET, help="bytes of a dimension"
        )
    features = jobs.add_parser("features", help="scale and encode a feature table")
    features.add_argument("--table", required=True, help="stored customer analytics: a path, or the name of a catalog table")
    features.add_argument("--scratch", help="shared folder; default: spark.checkpoint.dir")
    profile.add_argument("--out", required=True, help="where to write the result")
    features.add_argument("--out", required=True, help="where to write the result")
    target = analytics.add_mutually_exclusive_group(required=True)
    target.add_argument("--out", help="where to write the result")
    target.add_argument("--out-table", help="catalog table to replace with the result")
    return parser


def set_shuffle_width(spark: SparkSession, inputs: Sequence[str]) -> None:
    """One shuffle partition per 128 MB of input, unless the session was started with a width.

    Adaptive execution merges partitions that turn out small, but never adds any.
    """
    if spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions"):
        return
    held = 0
    for path in inputs:
        system, hadoop_path = file_system(spark, path)
        held += system.getContentSummary(hadoop_path).getLength()
    width = max(200, spark.sparkContext.defaultParallelism, -(-held // SHUFFLED_PER_TASK))
    spark.conf.set("spark.sql.shuffle.partitions", str(width))


def _manifest(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.job == "ingest":
        return ingest_parquet(spark, args.source, args.base, args.tables, args.at_once, args.run)
    if args.job == "ingest-catalog":
        database = CatalogDatabase(spark, args.database, args.catalog)
        return ingest_catalog(database, args.base, args.tables, args.at_once, args.run)
    properties = {"user": args.user, "driver": args.driver}
    if args.password_variable:
        properties["password"] = os.environ[args.password_variable]
    given = {name: value for name, value in properties.items() if value is not None}
    database = JdbcDatabase(spark, args.url, args.database, given)
    keys = {table: names.split(",") for table, names in (pair.split("=", 1) for pair in args.keys)}
    return ingest_jdbc(
        database, args.base, args.tables, keys, args.type_policy, args.at_once, args.reads, args.hash, args.run
    )


def _write(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "features":
        rows = stored_features(spark, args.table)
        set_shuffle_width(spark, sorted({file.rsplit("/", 1)[0] for file in rows.inputFiles()}))
        with run_folder(spark, args.scratch) as scratch:
            result = feature_step(rows, scratch)
            result.write.mode("overwrite").parquet(args.out)
        return
    set_shuffle_width(spark, [data_path(spark, args.base, name) for name in (*DIMENSIONS, *FACTS)])
    star = star_from_parquet(spark, args.base, args.broadcast_budget)
    if args.job == "customer-360":
        result = customer_360_clean(star) if args.clean else customer_360(star)
        result.write.mode("overwrite").parquet(args.out)
    elif args.out_table:
        save_features(customer_analytics(star, args.returns_mode), args.out_table)
    else:
        write_features(customer_analytics(star, args.returns_mode), args.out)


def main(arguments: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"patronage {args.job}").getOrCreate()
    if args.job.startswith("ingest"):
        for row in _manifest(spark, args).collect():
            print(f"{row['table_name']}: {row['row_count']} rows in {row['path']}")
    else:
        _write(spark, args)


if __name__ == "__main__":
    main()
