"""Command-line runs of the report families, on paths.

``daily``: order files -> by-name ingest -> collect (and merge with an older
collected fact) -> clean -> fact landed by month -> week comparisons (one
shared slice) -> movers, every result written under ``--out``.
``attainment``: a landed fact and a target table -> the department / platform /
operator report and the target-status sheet. ``export``: the fact and all
three status sheets side by side. ``compare``: the comparison by any entity.
``seed-targets``: target rows into a versioned target table.

The session comes from the environment (``spark-submit`` or the caller); the
cluster's ``spark.checkpoint.dir`` names the shared folder.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.cleaning import clean_orders
from .operators.dims import clean_store_dim
from .operators.quarantine import amount_error, is_text, quarantine
from .plans import attainment, compare, movers
from .plans.collect import collect_orders, merge_snapshots
from .schema import FILE_LABELS, MONEY, TARGET_KINDS
from .session import ship_package
from .sinks.files import write_fact, write_partitioned, write_report, write_tables
from .sinks.versioned import VersionedTable, seed
from .sources.files import read_fact, read_table
from .sources.order_files import read_named_orders


def run_daily(spark: SparkSession, orders: str, stores: str, goods: str, as_of: _dt.date, out: str, *,
              glob: str = "*.csv", labels: dict[str, str] | None = None, older: str | None = None, fmt: str = "parquet") -> dict[str, str]:
    """The daily flow; returns the written locations by name. ``labels`` are
    the labels that the files give the columns; ``older`` is a collected fact
    that the new one is merged with (R2): the merged fact and the store
    dimension are written beside each other, and the reports run on it.
    Amounts that are no numbers are listed under ``quarantine`` and counted
    as missing."""
    ship_package(spark)
    out = out.rstrip("/")
    store_dim = read_table(spark, stores, fmt=fmt)
    goods_dim = read_table(spark, goods, fmt=fmt)
    found = read_named_orders(spark, orders, glob=glob, labels=labels)
    collected = collect_orders(found.rows.drop("source_file"), store_dim)
    written = {"rejected_files": f"{out}/rejected_files", "collected": f"{out}/collected",
               "quarantine": f"{out}/quarantine", "fact": f"{out}/fact"}
    write_report(found.rejected(), written["rejected_files"])
    write_report(collected, written["collected"])
    current = read_table(spark, written["collected"])
    if older:
        written["merged"], written["department"] = f"{out}/merged", f"{out}/department"
        write_tables({"merged": merge_snapshots(read_table(spark, older, fmt=fmt), current),
                      "department": clean_store_dim(store_dim)}, out)
        current = read_table(spark, written["merged"])
    write_report(quarantine(current, MONEY, ["order_no", "product"]), written["quarantine"])
    write_fact(clean_orders(current.withColumns(numbers_only(current, MONEY)), store_dim, goods_dim), written["fact"])

    fact = read_fact(spark, written["fact"]).drop("order_month")
    reports = compare.week_reports(fact, as_of)
    try:
        write_tables({"store_compare": reports["store_week_compare"],
                      "product_compare": reports["product_week_compare"]}, out)
        write_partitioned(reports["store_dimension_week_compare"], f"{out}/store_dimension_compare",
                          ["store", "dimension"])
        stored = {name: read_table(spark, f"{out}/{name}") for name in ("store_compare", "product_compare")}
        write_tables({
            "store_movers_top": movers.store_movers(stored["store_compare"], store_dim, "top"),
            "store_movers_bottom": movers.store_movers(stored["store_compare"], store_dim, "bottom"),
            "product_movers_top": movers.product_movers(stored["product_compare"], goods_dim, "top"),
            "product_movers_bottom": movers.product_movers(stored["product_compare"], goods_dim, "bottom"),
        }, out)
    finally:
        reports["slice"].unpersist()
    for name in ("store_compare", "product_compare", "store_dimension_compare", "store_movers_top",
                 "store_movers_bottom", "product_movers_top", "product_movers_bottom"):
        written[name] = f"{out}/{name}"
    return written


def run_export(spark: SparkSession, fact: str, targets: dict[str, str], snapshot: int, out: str, *, fmt: str = "parquet") -> dict[str, str]:
    """The order fact and the status sheets of all kinds, four tables side by
    side; ``targets`` names the target table of each kind."""
    fact_df = read_fact(spark, fact)
    frames = {"orders": fact_df}
    for kind in TARGET_KINDS:
        target_df = read_table(spark, targets[kind], fmt=fmt).toDF("snapshot", "key", "target")
        frames[f"{kind}_status"] = attainment.target_status(fact_df, target_df, kind, snapshot)
    write_tables(frames, out.rstrip("/"))
    return {name: f"{out.rstrip('/')}/{name}" for name in frames}


def run_compare(spark: SparkSession, fact: str, entities: tuple[str, ...], as_of: _dt.date, out: str) -> str:
    """The per-value comparison of each store, platform or operator, a folder
    for each."""
    df = read_fact(spark, fact)
    write_partitioned(compare.entity_dimension_week_compare(df, as_of, entities=entities), out, ["entity", "key", "dimension"])
    return out


def run_seed(spark: SparkSession, rows: str, snapshot: int, table: str, *, fmt: str = "parquet") -> int:
    """Target rows (key, target) of a snapshot into a versioned table."""
    from .plans.collect import seed_targets
    return seed(VersionedTable(spark, table, "snapshot"), seed_targets(read_table(spark, rows, fmt=fmt).toDF("key", "target"), snapshot))


def numbers_only(df: DataFrame, columns: list[str]) -> dict[str, F.Column]:
    """Text amounts that parse stay, others become null (see the quarantine)."""
    return {c: F.when(amount_error(df, c).isNull(), F.col(c)) for c in columns if is_text(df, c)}


def run_attainment(spark: SparkSession, fact: str, targets: str, kind: str, snapshot: int, out: str, *, collected: str | None = None,
                   fmt: str = "parquet") -> dict[str, str]:
    """One attainment report and the target-status sheet for ``kind``."""
    fact_df: DataFrame = read_fact(spark, fact)
    target_df = read_table(spark, targets, fmt=fmt).toDF("snapshot", "key", "target")
    report = {"department": attainment.department_attainment, "platform": attainment.platform_attainment,
              "operator": attainment.operator_attainment}[kind]
    out = out.rstrip("/")
    # the report counts collected rows: cleaning fills profits and drops rows
    report_df = read_table(spark, collected) if collected else fact_df
    write_report(report(report_df, target_df, snapshot), f"{out}/{kind}_attainment")
    write_report(attainment.target_status(fact_df, target_df, kind, snapshot), f"{out}/{kind}_target_status")
    return {"attainment": f"{out}/{kind}_attainment", "target_status": f"{out}/{kind}_target_status"}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="salescope")
    sub = p.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily", help="collect, clean, land, week comparisons and movers")
    d.add_argument("--orders", required=True)
    d.add_argument("--stores", required=True)
    d.add_argument("--goods", required=True)
    d.add_argument("--as-of", required=True, type=_dt.date.fromisoformat)
    d.add_argument("--out", required=True)
    d.add_argument("--glob", default="*.csv")
    d.add_argument("--labels", help="'own' for the stores' own labels, or a JSON file {column: label}")
    d.add_argument("--older", help="collected fact to merge with")
    a = sub.add_parser("attainment", help="attainment report and target status for one kind")
    a.add_argument("--fact", required=True, help="cleaned fact, for the target status")
    a.add_argument("--collected", help="collected orders, for the attainment report (default: the fact)")
    a.add_argument("--targets", required=True)
    a.add_argument("--kind", required=True, choices=["department", "platform", "operator"])
    a.add_argument("--snapshot", required=True, type=int)
    a.add_argument("--out", required=True)
    e = sub.add_parser("export", help="the fact and the three status sheets")
    e.add_argument("--fact", required=True)
    for kind in TARGET_KINDS:
        e.add_argument(f"--{kind}-targets", required=True)
    e.add_argument("--snapshot", required=True, type=int)
    e.add_argument("--out", required=True)
    c = sub.add_parser("compare", help="week comparison by store, platform or operator")
    c.add_argument("--fact", required=True)
    c.add_argument("--entity", action="append", choices=compare.ENTITIES, help="may be given several times; default: all")
    c.add_argument("--as-of", required=True, type=_dt.date.fromisoformat)
    c.add_argument("--out", required=True)
    t = sub.add_parser("seed-targets", help="targets of a snapshot into a versioned table")
    t.add_argument("--rows", required=True)
    t.add_argument("--snapshot", required=True, type=int)
    t.add_argument("--table", required=True)
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"salescope-{args.cmd}").getOrCreate()
    if args.cmd == "daily":
        labels = FILE_LABELS if args.labels == "own" else json.load(open(args.labels, encoding="utf-8")) if args.labels else None
        print(run_daily(spark, args.orders, args.stores, args.goods, args.as_of, args.out, glob=args.glob, labels=labels, older=args.older))
    elif args.cmd == "export":
        print(run_export(spark, args.fact, {k: getattr(args, f"{k}_targets") for k in TARGET_KINDS}, args.snapshot, args.out))
    elif args.cmd == "compare":
        print(run_compare(spark, args.fact, tuple(args.entity or compare.ENTITIES), args.as_of, args.out))
    elif args.cmd == "seed-targets":
        print(run_seed(spark, args.rows, args.snapshot, args.table))
    else:
        print(run_attainment(spark, args.fact, args.targets, args.kind, args.snapshot, args.out, collected=args.collected))


if __name__ == "__main__":
    main()
