"""Batch jobs: write the commerce tables, run a report into parquet.

    python -m souk.jobs materialize --sf-dir /root/testdata/sf0.1 --out /data/commerce
    python -m souk.jobs report --tables /data/commerce --name top_aov_per_state --out /data/out/aov
    python -m souk.jobs report --sf-dir /root/testdata/sf0.1 --name monthly_orders --out /tmp/x

``materialize`` writes each table as a parquet folder with the declared
schema.  Orders are range-partitioned and sorted by purchase time, so each
file and row group covers a narrow time range and the min/max statistics let
year filters (pushed down by ``in_year``) skip most of them.  Items are
sorted by ``order_id`` within files for the same reason on order lookups.

``report`` runs a registered report (with the registry's arguments when it
reads the stand-in data, with the function defaults otherwise) and writes
the result; the write is the job's only action.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from souk.plans import catalog
from souk.session import configure
from souk.sources import SCHEMAS, Tables, read_tables, standin_tables

# Sort keys applied before writing, per table.
CLUSTER_BY = {
    "orders": "order_purchase_timestamp",
    "order_items": "order_id",
    "order_payments": "order_id",
    "order_reviews": "review_creation_date",
}


def write_tables(t: Tables, root: str, files_per_table: int | None = None,
                 mode: str = "errorifexists") -> None:
    """Write every table of ``t`` to ``root/<table>`` as parquet."""
    for name in SCHEMAS:
        df: DataFrame = getattr(t, name)
        key = CLUSTER_BY.get(name)
        if key and files_per_table:
            df = df.repartitionByRange(files_per_table, key).sortWithinPartitions(key)
        elif key:
            df = df.sortWithinPartitions(key)
        df.write.mode(mode).parquet(f"{root}/{name}")


def run_report(spark: SparkSession, name: str, out: str, *, tables: str | None = None,
               sf_dir: str | None = None, mode: str = "errorifexists") -> None:
    """Run the report ``name`` and write its rows to ``out`` as parquet."""
    fn, _ = catalog.REGISTRY[name]
    if sf_dir:
        df = catalog.run(name, spark, sf_dir)
    elif tables:
        df = fn(read_tables(configure(spark), tables))
    else:
        raise ValueError("give tables (commerce parquet root) or sf_dir (supplied test tables)")
    df.write.mode(mode).parquet(out)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="python -m souk.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    m = sub.add_parser("materialize", help="write the stand-in tables as commerce parquet")
    m.add_argument("--sf-dir", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--files", type=int, default=None, help="files per clustered table")
    m.add_argument("--mode", default="errorifexists")
    r = sub.add_parser("report", help="run one report into parquet")
    r.add_argument("--name", required=True, choices=sorted(catalog.REGISTRY))
    r.add_argument("--out", required=True)
    r.add_argument("--tables")
    r.add_argument("--sf-dir")
    r.add_argument("--mode", default="errorifexists")
    args = ap.parse_args(argv)

    spark = configure(SparkSession.builder.appName(f"souk-{args.cmd}").getOrCreate())
    if args.cmd == "materialize":
        write_tables(standin_tables(spark, args.sf_dir), args.out, args.files, args.mode)
    else:
        run_report(spark, args.name, args.out, tables=args.tables, sf_dir=args.sf_dir, mode=args.mode)


if __name__ == "__main__":
    main()
