"""The whole pipeline, in dependency order, as a handful of Spark jobs.

Steps that need nothing of each other (the six raw datasets, the two month
splits, base and static tables, the two rollups) run side by side.

raw CSV files -> typed Parquet -> month folders -> base tables (month
replace) -> static tables (first load wins) -> league and club rollups (all
months of the range in one job each) -> reports. Every step hands over
through files in the warehouse folder, so any step can be re-run alone and
a lost executor only costs the tasks of the step that was running.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kickledger.functions.months import CALENDAR_END, CALENDAR_START, in_window, month_key, with_month
from kickledger.operators import pages as page_ops
from kickledger.operators import reports, rollup_state, rollups
from kickledger.session import together
from kickledger.sources import digests, ingest
from kickledger.sources.warehouse import Warehouse, whole_months

RAW_FILES = {
    "player_valuations": "player_valuations.csv",
    "competitions": "competitions.csv",
    "players": "players.csv",
    "appearances": "appearances.csv",
    "clubs": "clubs.csv",
    "games": "games.csv",
}
STATIC_TABLES = ("competitions", "players", "clubs", "games")


def rename_raw_valuations(df: DataFrame) -> DataFrame:
    """Raw valuation columns to the stored names."""
    return (df.withColumnRenamed("market_value_in_eur", "market_value")
            .withColumnRenamed("player_club_domestic_competition_id", "competition_id"))


def valuation_load_rows(valuations: DataFrame, start: str, end: str, closed: bool = False) -> DataFrame:
    """Base-table rows of the months in ``[start, end)``, keyed ``YYYY-MM``."""
    v = with_month(valuations.where(in_window("date", start, end)), "date", closed=closed)
    return v.select("player_id", F.col("date").cast("date").alias("date"), "market_value",
                    "current_club_id", "competition_id", "partition_date")


def appearance_load_rows(appearances: DataFrame, start: str, end: str, closed: bool = False) -> DataFrame:
    a = with_month(appearances.where(in_window("date", start, end)), "date", closed=closed)
    return a.withColumn("date", F.col("date").cast("date"))


def backfill_league_rollup(wh: Warehouse, valuations: DataFrame, clubs: DataFrame,
                           start: str, end: str) -> None:
    """Recompute the league rollup for every month of ``[start, end)`` in one job.

    Months without valuations keep their stored rows (the rollup's
    empty-month rule).
    """
    wh.create_table("league_valuation_evolution")
    whole_months(start, end)
    lve = rollups.league_valuation_evolution(valuations, clubs, start, end)
    wh.replace_months("league_valuation_evolution", lve, on_empty="keep", start=start, end=end, day_key=True)


def backfill_club_rollup(wh: Warehouse, valuations: DataFrame, clubs: DataFrame,
                         start: str, end: str) -> None:
    wh.create_table("club_valuation_evolution")
    whole_months(start, end)
    cve = rollups.club_valuation_evolution(valuations, clubs, start, end)
    wh.replace_months("club_valuation_evolution", cve, on_empty="keep", start=start, end=end, day_key=True)


def backfill_changed(wh: Warehouse, valuations: DataFrame, clubs: DataFrame, start: str, end: str) -> list[str]:
    """Recompute both rollups for the months of ``[start, end)`` whose valuations, or the clubs, have changed.

    One aggregate over the columns the rollups use gives each month's digest;
    months whose digest is the stored one are neither read again nor written.
    Months that lost all their rows keep their stored rollup, as in a full
    backfill. Returns the months recomputed (``YYYY-MM``).
    """
    whole_months(start, end)
    store = digests.MonthDigests(wh, "valuation_rollups")
    used = ["date", "market_value", "current_club_id", "competition_id"]
    rows = rollups.month_prune(valuations, start, end, "partition_date")
    months, now = store.changed(digests.month_digests(rows, "date", used, start, end), digests.table_digest(
        clubs, ["club_id", "name", "domestic_competition_id"]))
    if months:
        wanted = rows.where(month_key("date").isin(months))
        if "partition_date" in rows.columns:  # whole month folders are skipped
            wanted = wanted.where(F.substring("partition_date", 1, 7).isin(months))
        for name, build in (("league_valuation_evolution", rollups.league_valuation_evolution),
                            ("club_valuation_evolution", rollups.club_valuation_evolution)):
            wh.create_table(name)
            wh.replace_months(name, build(wanted, clubs, start, end), on_empty="keep")
    store.store(now, start, end)
    return months


def add_late_valuations(wh: Warehouse, late: DataFrame, clubs: DataFrame, batch: str, start: str, end: str) -> list[str]:
    """Late valuations of ``[start, end)`` join the stored rollups; returns the months they touch.

    Only the new rows and the stored state of their months are read
    (``rollup_state``); ``rollup_state.rebuild`` makes that state from rows
    loaded otherwise. A batch that is added again counts once.
    """
    months = rollup_state.add(wh, late, batch, *whole_months(start, end))
    rollup_state.refresh(wh, clubs, months)
    return months


@dataclass
class RunResult:
    warehouse: Warehouse
    first_league_total: DataFrame
    first_league_max: DataFrame
    player_top100: DataFrame
    pending_logos: DataFrame


# --- steps (each can run alone; each reads and writes the warehouse) -----------------
def ingest_raw(spark: SparkSession, wh: Warehouse, raw_dir: str, null_strings: str | None = None,
               raw_format: str = "csv", options: dict | None = None) -> None:
    """Raw files (``<dataset>.csv``, or ``<dataset>.parquet`` with
    ``raw_format="parquet"``) -> typed Parquet under ``<warehouse>/raw/<dataset>``.

    ``options`` are keyword arguments of ``ingest.load_dataset`` for all six
    files: ``date_format``, ``multi_line``, ``missing``, ``infer_types``,
    ``layout_rule``, ``on_unknown_layout``; ``types`` maps a dataset to the
    kinds of its further columns.
    """
    raw_dir = raw_dir.rstrip("/")
    options = dict(options or {})
    types = options.pop("types", {})

    def load(dataset: str, file_name: str) -> None:
        if raw_format == "parquet":
            file_name = file_name.rsplit(".", 1)[0] + ".parquet"
        df = ingest.load_dataset(spark, f"{raw_dir}/{file_name}", dataset, null_strings, fmt=raw_format,
                                 types=types.get(dataset), **options)
        ingest.write_parquet(df, wh.location(f"raw/{dataset}"))

    together(*[partial(load, *item) for item in RAW_FILES.items()])


def raw_table(wh: Warehouse, dataset: str) -> DataFrame:
    return wh.spark.read.parquet(wh.location(f"raw/{dataset}"))


def split_months(wh: Warehouse, closed: bool = False) -> None:
    """Month folders of the valuations and appearances (one job each)."""
    together(lambda: ingest.split_by_month(rename_raw_valuations(raw_table(wh, "player_valuations")), "date",
                                           wh.location("raw/valuation_partitions"), closed=closed),
             lambda: ingest.split_by_month(raw_table(wh, "appearances"), "date",
                                           wh.location("raw/appearance_partitions"), closed=closed))


def load_base_tables(wh: Warehouse, start: str, end: str, closed: bool = False) -> None:
    """Replace the months of ``[start, end)`` in both base tables from the month folders.

    The input is read from the month folders, so each scan task reads a
    split of one month's files (small files of neighbouring months may be
    packed together) and writes into one or a few month folders: no
    rebalance, and so no shuffle of the base table, is needed here.
    """
    spark = wh.spark
    whole_months(start, end)

    def load(name: str, folder: str, rows_of) -> None:
        wh.create_table(name)
        wh.replace_months(name, rows_of(ingest.read_months(spark, wh.location(folder)), start, end, closed),
                          on_empty="delete", start=start, end=end, cluster=False)

    together(partial(load, "player_valuations", "raw/valuation_partitions", valuation_load_rows),
             partial(load, "player_appearances", "raw/appearance_partitions", appearance_load_rows))


def load_static_tables(wh: Warehouse, refresh: bool = False) -> None:
    """Competitions, players, clubs, games: the first load wins unless ``refresh``."""
    together(*[lambda name=name: wh.ctas_if_absent(name, raw_table(wh, name), refresh=refresh) for name in STATIC_TABLES])


def rollup_months(wh: Warehouse, start: str, end: str, changed_only: bool = False) -> None:
    """League and club rollups for every month of ``[start, end)`` (one job each), or those with changed inputs."""
    valuations, clubs = wh.read("player_valuations"), wh.read("clubs")
    if changed_only:
        backfill_changed(wh, valuations, clubs, start, end)
        return
    together(lambda: backfill_league_rollup(wh, valuations, clubs, start, end),
             lambda: backfill_club_rollup(wh, valuations, clubs, start, end))


def build_reports(wh: Warehouse, cutoff: str = "2025-01-01", logo_ids: DataFrame | None = None,
                  out_dir: str | None = None) -> RunResult:
    """Reports from the stored tables; with ``out_dir`` also written as JSON lines."""
    spark = wh.spark
    lve, competitions = wh.read("league_valuation_evolution"), wh.read("competitions")
    both = reports.first_league_reports(lve, competitions, cutoff)
    total, most = both["total_valuation"], both["max_valuation"]
    top = reports.player_top100(wh.read("player_valuations"), wh.read("players"), wh.read("clubs"))
    targets = page_ops.distinct_urls(competitions)
    done = logo_ids if logo_ids is not None else spark.createDataFrame([], "competition_id string")
    pending = page_ops.logo_paths(page_ops.pending(targets, done))
    if out_dir:
        for name, df in (("first_league_total", total), ("first_league_max", most), ("player_top100", top)):
            df.write.mode("overwrite").json(f"{out_dir.rstrip('/')}/{name}")
    return RunResult(wh, total, most, top, pending)


def run(spark: SparkSession, raw_dir: str, warehouse_root: str, start: str = CALENDAR_START,
        end: str = CALENDAR_END, cutoff: str = "2025-01-01", closed: bool = False,
        null_strings: str | None = None, logo_ids: DataFrame | None = None,
        out_dir: str | None = None, raw_format: str = "csv", options: dict | None = None) -> RunResult:
    """Every step in dependency order, for the months in ``[start, end)``.

    ``closed=True`` uses the reference's month split (rows after 00:00 on a
    month's last day belong to no month); ``null_strings="nan"`` stores
    missing text as ``nan`` like the reference. ``logo_ids`` lists the
    competitions whose logo is stored already. With ``out_dir`` the reports
    are also written as JSON lines. ``options`` are those of ``ingest_raw``.
    """
    wh = Warehouse(spark, warehouse_root)
    ingest_raw(spark, wh, raw_dir, null_strings, raw_format, options)
    split_months(wh, closed)
    together(lambda: load_base_tables(wh, start, end, closed), lambda: load_static_tables(wh))
    rollup_months(wh, start, end)
    return build_reports(wh, cutoff, logo_ids, out_dir)
