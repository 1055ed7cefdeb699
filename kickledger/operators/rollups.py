"""Monthly valuation rollups per league and per club, all months in one job.

The reference runs one month at a time; here the month is a grouping key,
so a backfill of any range is a single scan, a single broadcast join and a
single partial/final hash aggregation (one shuffle of at most
``keys x months x tasks`` partial rows, never the raw rows). A hot league or
club only makes its partial rows bigger, not one task slower: the map-side
combine folds its rows before the shuffle.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kickledger.functions.coerce import nan_to_null
from kickledger.functions.months import in_window, month_key, month_start
from kickledger.operators.joins import join_dimension

LEAGUE_COLUMNS = ["domestic_competition_id", "total_valuation", "min_valuation",
                  "max_valuation", "player_count", "partition_date"]
CLUB_COLUMNS = ["club_name", "total_valuation", "min_valuation", "max_valuation",
                "squad_size", "domestic_competition_id", "partition_date"]


WIDE = 1 << 20
MICROS = 1_000_000


def money_parts(col) -> list[Column]:
    """A money value as three whole numbers: multiples of 2**20, the units beyond, and millionths.

    Each part adds up in a 64-bit sum (primitive in generated code), so a
    group's total may reach 9e24 over 8e12 rows, and six decimals of every
    value count.
    """
    c = (F.col(col) if isinstance(col, str) else col).cast("double")
    wide = F.floor(c / F.lit(float(WIDE)))
    rest = c - wide * F.lit(float(WIDE))
    units = F.floor(rest)
    return [wide, units, F.rint((rest - units) * F.lit(float(MICROS))).cast("bigint")]


def part_sums(col, prefix: str) -> list[Column]:
    return [F.sum(part).alias(f"{prefix}_{k}") for k, part in enumerate(money_parts(col))]


def total_of(sums: list[Column]) -> Column:
    """The exact total of summed parts, as the nearest double; NULL where nothing was added."""
    wide, units, micros = (s.cast("decimal(20,0)") for s in sums)
    return (wide * F.lit(WIDE).cast("decimal(7,0)") + units + micros * F.lit(Decimal("0.000001"))).cast("double")


def merged_total(prefix: str) -> Column:
    """Total over rows that carry ``part_sums``."""
    return total_of([F.sum(f"{prefix}_{k}") for k in range(3)])


def exact_sum(col) -> Column:
    """Sum of money values to six decimals, exact: it does not depend on how
    rows are split over tasks, as a double sum does. An empty or all-NULL
    group is 0; an infinite value fails."""
    return F.coalesce(total_of([F.sum(part) for part in money_parts(col)]), F.lit(0.0))


def month_prune(df: DataFrame, start: str, end: str, partition_col: str | None) -> DataFrame:
    """Add a filter on the month key column so whole month folders are skipped.

    The date filter alone cannot prune partition folders; this repeats it on
    the partition column (``YYYY-MM`` text sorts like the dates). The
    month of the last day before ``end`` is kept whole, and keys that carry a
    day, ``YYYY-MM-01``, compare by their month.
    """
    if not partition_col or partition_col not in df.columns:
        return df
    first = month_key(F.lit(start).cast("date"))
    last = month_key(F.date_sub(F.lit(end).cast("date"), 1))
    month = F.substring(F.col(partition_col), 1, 7)
    return df.where((month >= first) & (month <= last))


def valuation_rows(valuations: DataFrame, clubs: DataFrame, start: str, end: str,
                   partition_col: str | None = "partition_date") -> DataFrame:
    """Valuations dated in ``[start, end)`` joined to their current club."""
    v = month_prune(valuations, start, end, partition_col).where(in_window("date", start, end))
    v = v.select("player_id", "date", nan_to_null("market_value").alias("market_value"),
                 "current_club_id", "competition_id")
    c = clubs.select(F.col("club_id").alias("current_club_id"), F.col("name").alias("club_name"),
                     "domestic_competition_id")
    return join_dimension(v, c, "current_club_id")


def with_month_key(grouped: DataFrame) -> DataFrame:
    """``partition_date`` text (``YYYY-MM-01``) from the ``month`` date key.

    Grouping by the date and formatting afterwards formats one value per
    group instead of one per input row.
    """
    return grouped.withColumn("partition_date", F.date_format("month", "yyyy-MM-dd"))


def league_rollup(rows: DataFrame) -> DataFrame:
    """Sum, min, max and count of valuations per league and month.

    ``player_count`` counts valuation rows with a value (a player valued
    twice in a month counts twice). Rows without a league are dropped.
    """
    return with_month_key(
        rows.where(F.col("domestic_competition_id").isNotNull())
        .groupBy("domestic_competition_id", month_start("date").alias("month"))
        .agg(exact_sum("market_value").alias("total_valuation"),
             F.min("market_value").alias("min_valuation"),
             F.max("market_value").alias("max_valuation"),
             F.count("market_value").cast("int").alias("player_count"))).select(*LEAGUE_COLUMNS)


def _club_parts(rows: DataFrame, club_key: str) -> DataFrame:
    """Rows folded per (club key, month, league code) by a hash aggregation."""
    return (rows.where(F.col(club_key).isNotNull())
            .groupBy(club_key, month_start("date").alias("month"), "competition_id")
            .agg(*part_sums("market_value", "value"),
                 F.min("market_value").alias("lo"), F.max("market_value").alias("hi"),
                 F.count("market_value").alias("n"), F.min("date").alias("first_date")))


def club_totals(parts: DataFrame) -> DataFrame:
    """Combine the parts per (club name, month); the league is that of the
    earliest valuation (on the same day, the smaller code). Only this step
    needs a struct minimum (a sort-based aggregation), and it runs on the
    folded parts."""
    cid = F.col("competition_id")
    earliest = F.min(F.when(cid.isNotNull(), F.struct("first_date", "competition_id")))
    return with_month_key(
        parts.groupBy("club_name", "month")
        .agg(F.coalesce(merged_total("value"), F.lit(0.0)).alias("total_valuation"),
             F.min("lo").alias("min_valuation"), F.max("hi").alias("max_valuation"),
             F.sum("n").cast("int").alias("squad_size"),
             earliest.getField("competition_id").alias("domestic_competition_id"))).select(*CLUB_COLUMNS)


def club_rollup(rows: DataFrame) -> DataFrame:
    """Sum, min, max and count per club name and month, from valuation rows
    already joined to their club (``club_name``). Clubs that share a name
    merge."""
    return club_totals(_club_parts(rows, "club_name"))


def league_valuation_evolution(valuations: DataFrame, clubs: DataFrame, start: str, end: str) -> DataFrame:
    return league_rollup(valuation_rows(valuations, clubs, start, end))


def club_valuation_evolution(valuations: DataFrame, clubs: DataFrame, start: str, end: str) -> DataFrame:
    """Club rollup for ``[start, end)``, folded per club id before the join.

    The first shuffle is keyed by integers and the join to club names sees
    one row per (club id, month, league code) instead of one per valuation.
    Partials of a club id listed twice in ``clubs`` are counted twice, as a
    join of every valuation would count them.
    """
    v = month_prune(valuations, start, end, "partition_date").where(in_window("date", start, end))
    v = v.select("player_id", "date", nan_to_null("market_value").alias("market_value"),
                 "current_club_id", "competition_id")
    names = clubs.select(F.col("club_id").alias("current_club_id"), F.col("name").alias("club_name"))
    parts = join_dimension(_club_parts(v, "current_club_id"), names, "current_club_id")
    return club_totals(parts.where(F.col("club_name").isNotNull()))
