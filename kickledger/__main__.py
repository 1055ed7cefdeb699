"""Command line: ``python -m kickledger <step> ...`` (or the same via spark-submit).

Steps: ``run`` (everything), ``ingest``, ``split``, ``load``, ``static``,
``rollup`` (recompute a month range), ``report``, and ``stream`` (load new
valuation files from ``--source`` and refresh the months they touch; with
``--keep-running`` it stays up). Every step reads and writes the warehouse
folder, so any step can be re-run alone.
"""

from __future__ import annotations

import argparse

from kickledger.functions.coerce import KIND_CASTS
from kickledger.functions.months import CALENDAR_END, CALENDAR_START
from kickledger.plans import pipeline
from kickledger.session import build_session
from kickledger.sources.warehouse import Warehouse


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="kickledger")
    ap.add_argument("step", choices=["run", "ingest", "split", "load", "static", "rollup", "report", "stream"])
    ap.add_argument("--warehouse", required=True, help="shared folder holding the tables")
    ap.add_argument("--raw", help="folder with the six raw datasets")
    ap.add_argument("--raw-format", choices=["csv", "parquet"], default="csv")
    ap.add_argument("--date-format", help="layout of CSV dates (default: found from the data)")
    ap.add_argument("--layout-rule", choices=["first", "vote"], default="first",
                    help="which cells decide a layout that is found: the first, or most")
    ap.add_argument("--unknown-layout", choices=["raise", "null"], default="raise",
                    help="dates that no known layout reads")
    ap.add_argument("--multi-line", action="store_true", help="CSV cells may hold line breaks")
    ap.add_argument("--missing", action="append", help="a CSV cell that means missing (repeat; default: the usual markers)")
    ap.add_argument("--types", action="append", default=[], metavar="DATASET.COLUMN=KIND",
                    help="kind of a further column: long, double, boolean, date, timestamp or string (repeat)")
    ap.add_argument("--no-infer", action="store_true", help="CSV columns without a kind stay text")
    ap.add_argument("--start", default=CALENDAR_START)
    ap.add_argument("--end", default=CALENDAR_END)
    ap.add_argument("--cutoff", default="2025-01-01")
    ap.add_argument("--closed", action="store_true", help="closed month windows (the reference's split)")
    ap.add_argument("--nan-text", action="store_true", help="store missing text as 'nan'")
    ap.add_argument("--refresh", action="store_true", help="reload static tables")
    ap.add_argument("--changed-only", action="store_true", help="rollup: only months whose rows or clubs changed")
    ap.add_argument("--out", help="folder for report JSON files")
    ap.add_argument("--master", default=None, help="Spark master for local runs, e.g. local[8]")
    ap.add_argument("--source", help="stream: folder where new valuation Parquet files arrive")
    ap.add_argument("--checkpoint", help="stream: progress folder (shared storage)")
    ap.add_argument("--keep-running", action="store_true", help="stream: keep polling instead of one pass")
    a = ap.parse_args(argv)
    if a.step in ("run", "ingest") and not a.raw:
        ap.error(f"{a.step} needs --raw")
    if a.step == "stream" and not (a.source and a.checkpoint):
        ap.error("stream needs --source and --checkpoint")

    options = csv_options(a, ap)
    spark = build_session(a.master) if a.master else build_session_from_cluster()
    wh = Warehouse(spark, a.warehouse)
    nan = "nan" if a.nan_text else None
    if a.step == "run":
        pipeline.run(spark, a.raw, a.warehouse, a.start, a.end, a.cutoff, a.closed, nan, out_dir=a.out,
                     raw_format=a.raw_format, options=options)
    elif a.step == "ingest":
        pipeline.ingest_raw(spark, wh, a.raw, nan, a.raw_format, options)
    elif a.step == "split":
        pipeline.split_months(wh, a.closed)
    elif a.step == "load":
        pipeline.load_base_tables(wh, a.start, a.end, a.closed)
    elif a.step == "static":
        pipeline.load_static_tables(wh, a.refresh)
    elif a.step == "rollup":
        pipeline.rollup_months(wh, a.start, a.end, a.changed_only)
    elif a.step == "report":
        pipeline.build_reports(wh, a.cutoff, out_dir=a.out)
    elif a.step == "stream":
        from kickledger.streaming import month_stream

        schema = spark.read.parquet(a.source).schema
        query = month_stream.start_month_stream(spark, a.source, schema, wh, wh.read("clubs"), a.start, a.end,
                                                a.checkpoint, available_now=not a.keep_running,
                                                closed=a.closed)
        query.awaitTermination()


def csv_options(a: argparse.Namespace, ap: argparse.ArgumentParser) -> dict:
    """Keyword arguments of ``ingest.load_dataset`` from the command line."""
    types: dict[str, dict[str, str]] = {}
    for text in a.types:
        column, _, kind = text.partition("=")
        dataset, _, column = column.partition(".")
        if dataset not in pipeline.RAW_FILES or not column or kind not in KIND_CASTS:
            ap.error(f"--types {text}: expected DATASET.COLUMN=KIND")
        types.setdefault(dataset, {})[column] = kind
    options = {"types": types, "date_format": a.date_format, "multi_line": a.multi_line, "infer_types": not a.no_infer,
               "layout_rule": a.layout_rule, "on_unknown_layout": a.unknown_layout}
    return options | ({"missing": tuple(a.missing)} if a.missing else {})


def build_session_from_cluster():
    """The session spark-submit configured; only the checkpoint folder is checked."""
    from pyspark.sql import SparkSession

    from kickledger.session import ensure_checkpoint_dir

    spark = SparkSession.builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


if __name__ == "__main__":
    main()
