"""Mergeable state of the valuation rollups: late rows add to a month without reading its rows again.

A state row holds, per (club id, league code of the valuation, month), the
three parts of the exact sum, minimum, maximum, count and first date. All of
these merge, so a month's state is the state of its old rows merged with
that of the new ones, and both rollups follow from it: the league rollup by
the club's league, the club rollup by the club's name and the code of its
earliest valuation. Club names and leagues are joined when a rollup is
taken from the state, so a changed club needs no new state either.

Rows are tagged with the batch they came from. Adding a batch replaces what
that batch added before, so a batch that is run again counts once.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kickledger.functions.coerce import nan_to_null
from kickledger.functions.months import in_window, month_key, month_start
from kickledger.operators import rollups
from kickledger.operators.joins import join_dimension
from kickledger.session import materialize
from kickledger.sources.warehouse import PARTITION_COLUMN, Warehouse, whole_months, write_months

STATE_TABLE = "valuation_state"
BATCH_COLUMN = "load_batch"
_PARTS = ("value_0", "value_1", "value_2")
_KEYS = ["current_club_id", "competition_id", BATCH_COLUMN, PARTITION_COLUMN]

STATE_SCHEMA = T.StructType([
    T.StructField("current_club_id", T.LongType()), T.StructField("competition_id", T.StringType()),
    *[T.StructField(p, T.LongType()) for p in _PARTS],
    T.StructField("lo", T.DoubleType()), T.StructField("hi", T.DoubleType()), T.StructField("n", T.LongType()),
    T.StructField("first_date", T.DateType()), T.StructField(BATCH_COLUMN, T.StringType()),
    T.StructField(PARTITION_COLUMN, T.StringType())])


def fold(valuations: DataFrame, start: str, end: str, batch: str | None = None) -> DataFrame:
    """State of the valuations dated in ``[start, end)``: one row per club id, league code and month.

    Rows without a date or a club id are in no rollup and leave no state.
    ``batch`` tags the rows; without it the valuations carry the tag.
    """
    v = rollups.month_prune(valuations, start, end, PARTITION_COLUMN).where(in_window("date", start, end))
    tag = F.lit(batch) if batch is not None else F.col(BATCH_COLUMN)
    v = v.where(F.col("current_club_id").isNotNull()).select(
        F.col("current_club_id").cast("long").alias("current_club_id"), "competition_id", "date",
        nan_to_null(F.col("market_value").cast("double")).alias("market_value"), tag.alias(BATCH_COLUMN))
    folded = v.groupBy("current_club_id", "competition_id", BATCH_COLUMN, month_start("date").alias("month")).agg(
        *rollups.part_sums("market_value", "value"), F.min("market_value").alias("lo"),
        F.max("market_value").alias("hi"), F.count("market_value").alias("n"),
        F.min(F.col("date").cast("date")).alias("first_date"))
    return folded.withColumn(PARTITION_COLUMN, month_key("month")).select([f.name for f in STATE_SCHEMA.fields])


def merge(state: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """State rows of equal keys (by default all, tag included) become one."""
    return state.groupBy(*(keys or _KEYS)).agg(
        *[F.sum(p).alias(p) for p in _PARTS], F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.sum("n").alias("n"), F.min("first_date").alias("first_date"))


def read_state(wh: Warehouse, table: str = STATE_TABLE) -> DataFrame:
    wh.create_table(table, STATE_SCHEMA)
    return wh.read(table)


def has_state(wh: Warehouse, table: str = STATE_TABLE) -> bool:
    try:
        wh.spark.read.schema(STATE_SCHEMA).parquet(wh.location(table))
    except AnalysisException:
        return False
    return True


def rebuild(wh: Warehouse, valuations: DataFrame, start: str, end: str, batch: str | None = "base",
            table: str = STATE_TABLE) -> None:
    """The state of the months of ``[start, end)`` taken anew from all their rows, in one job.

    Months without valuations have no state afterwards. ``batch=None``: the
    valuations carry their tags in ``load_batch``.
    """
    read_state(wh, table)
    wh.replace_months(table, fold(valuations, *whole_months(start, end), batch), on_empty="delete", start=start, end=end)


def add(wh: Warehouse, valuations: DataFrame, batch: str, start: str, end: str, table: str = STATE_TABLE,
        fold_earlier: str | None = None) -> list[str]:
    """Add a batch of valuations to the state; returns the months (``YYYY-MM``) it touches.

    Reads the new rows once and the stored state of the months they fall in,
    never those months' rows. What ``batch`` added before to these months is
    replaced. ``fold_earlier`` names a prefix of tags whose batches can't be
    run again: their rows become one per key, so the state doesn't grow with
    the number of batches.
    """
    stored = read_state(wh, table)
    new = materialize(fold(valuations, start, end, batch), "late-state")
    months = sorted(r[0] for r in new.select(PARTITION_COLUMN).distinct().collect())  # at most one per calendar month
    if not months:
        return []
    kept = stored.where(F.col(PARTITION_COLUMN).isin(months) & ~F.col(BATCH_COLUMN).eqNullSafe(F.lit(batch)))
    if fold_earlier is not None:
        kept = _folded(kept, fold_earlier)
    # Each tag has one row per key, and kept rows have other tags than the new ones: nothing is left to merge.
    rows = kept.unionByName(new)
    write_months(rows.select([f.name for f in STATE_SCHEMA.fields]), wh.location(table))
    return months


def _folded(kept: DataFrame, prefix: str) -> DataFrame:
    """The rows of the batches named by ``prefix`` under one tag, one per key; rows of other batches as they are."""
    tag = F.col(BATCH_COLUMN)
    earlier = F.coalesce(tag.startswith(prefix), F.lit(False))
    several = len(kept.where(earlier).select(BATCH_COLUMN).distinct().take(2)) > 1
    one_tag = kept.where(earlier).withColumn(BATCH_COLUMN, F.lit(f"{prefix}folded"))
    if several:
        one_tag = merge(one_tag).select(kept.columns)
    return kept.where(~earlier).unionByName(one_tag)


def _with_club(state: DataFrame, clubs: DataFrame) -> DataFrame:
    names = clubs.select(F.col("club_id").cast("long").alias("current_club_id"), F.col("name").alias("club_name"),
                         "domestic_competition_id")
    return join_dimension(state, names, "current_club_id")


def league_rollup(state: DataFrame, clubs: DataFrame) -> DataFrame:
    """``rollups.league_valuation_evolution`` of the rows the state was taken from.

    State rows of a league and month fold in the tasks that read them,
    whatever their club and tag, so only leagues and months are shuffled.
    """
    rows = _with_club(state, clubs).where(F.col("domestic_competition_id").isNotNull())
    return rows.groupBy("domestic_competition_id", PARTITION_COLUMN).agg(
        F.coalesce(rollups.merged_total("value"), F.lit(0.0)).alias("total_valuation"),
        F.min("lo").alias("min_valuation"), F.max("hi").alias("max_valuation"),
        F.sum("n").cast("int").alias("player_count")).withColumn(
        PARTITION_COLUMN, F.concat(PARTITION_COLUMN, F.lit("-01"))).select(*rollups.LEAGUE_COLUMNS)


def club_rollup(state: DataFrame, clubs: DataFrame) -> DataFrame:
    """``rollups.club_valuation_evolution`` of the rows the state was taken from."""
    untagged = merge(state, ["current_club_id", "competition_id", PARTITION_COLUMN])
    rows = _with_club(untagged, clubs).where(F.col("club_name").isNotNull())
    return rollups.club_totals(rows.withColumn("month", F.to_date(F.concat(PARTITION_COLUMN, F.lit("-01")))))


def refresh(wh: Warehouse, clubs: DataFrame, months: list[str], table: str = STATE_TABLE) -> None:
    """Both stored rollups of the given months (``YYYY-MM``), from their state alone."""
    if not months:
        return
    state = read_state(wh, table).where(F.col(PARTITION_COLUMN).isin(months))
    for name, build in (("league_valuation_evolution", league_rollup), ("club_valuation_evolution", club_rollup)):
        wh.create_table(name)
        wh.replace_months(name, build(state, clubs), on_empty="keep")
