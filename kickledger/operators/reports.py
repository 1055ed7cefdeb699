"""Report queries over the rollup tables and the valuations.

All of them start from a large input and shrink it by aggregation before
anything is ordered or limited: the first-tier report works on the
``league x month`` rollup (a few thousand rows however big the valuations
are), the top-100 query pre-aggregates valuations per (player, club) before
any join. Single values (latest year, number of leagues, size of the top
set) are scalar subqueries, planned once and inlined; no cross join, no
collect. Windows without a partition key run only on frames whose size is
bounded by the report (top N + 1 labels, 100 players).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kickledger.functions.months import key_to_date
from kickledger.functions.coerce import nan_to_null
from kickledger.functions.text import fill_template, humanize, league_label, slug_title
from kickledger.operators.joins import drop_members, join_dimension, keep_members
from kickledger.operators.pages import LOGO_PATH_TEMPLATE
from kickledger.operators.rollups import merged_total, part_sums, total_of
from kickledger.session import materialize

ID = "domestic_competition_id"
OTHER = "Other"
REPORT_COLUMNS = [ID, "year", "total_valuation", "max_valuation", "competition_name",
                  "country_name", "league_label"]


# --- first-tier leagues -----------------------------------------------------
def first_tier_months(lve: DataFrame, competitions: DataFrame, sub_type: str = "first_tier") -> DataFrame:
    """Rollup rows of the leagues of one tier, with league name and country."""
    comp = (competitions.where(F.col("sub_type") == F.lit(sub_type))
            .select(F.col("competition_id").alias(ID), F.col("name").alias("competition_name"),
                    "country_name"))
    rows = lve.select(ID, "total_valuation", "max_valuation", "partition_date")
    return join_dimension(rows, comp, ID)


def before_cutoff(rows: DataFrame, cutoff: str) -> DataFrame:
    """Rows of months before ``cutoff`` (``YYYY-MM-DD``), with the year.

    The test compares month-key text (``YYYY-MM-01`` sorts like the date),
    so where Catalyst pushes it below the rollup's aggregation it costs one
    string comparison per input row, not a date parse.
    """
    first_day = F.concat(F.substring("partition_date", 1, 7), F.lit("-01"))
    return (rows.where(first_day < F.lit(cutoff))
            .withColumn("year", F.year(key_to_date("partition_date"))))


def report_base(lve: DataFrame, competitions: DataFrame, cutoff: str) -> DataFrame:
    return before_cutoff(first_tier_months(lve, competitions), cutoff)


def latest_year(base: DataFrame):
    """The latest year as a scalar subquery column."""
    return base.agg(F.max("year")).scalar()


def league_count(base: DataFrame):
    """Number of distinct leagues, as a scalar subquery column."""
    return base.agg(F.count_distinct(ID)).scalar()


def latest_year_slice(base: DataFrame) -> DataFrame:
    return base.where(F.col("year") == latest_year(base))


def top_leagues(base: DataFrame, stat: str, n: int) -> DataFrame:
    """The ``n`` leagues with the highest ``stat`` in the latest year.

    Ties go to the lower league id; a league whose statistic is missing
    comes last. Fewer than ``n`` leagues give fewer rows.
    """
    per_league = latest_year_slice(base).groupBy(ID).agg(F.max(stat).alias(stat))
    return per_league.orderBy(F.desc_nulls_last(stat), F.asc(ID)).limit(n)


def league_year_rollup(base: DataFrame) -> DataFrame:
    """Per league and year: the highest monthly total and maximum, and the
    league's display name and country (fixed by the league id)."""
    return (base.groupBy(ID, "year")
            .agg(F.max("total_valuation").alias("total_valuation"),
                 F.min("competition_name").alias("competition_name"),
                 F.min("country_name").alias("country_name"),
                 F.max("max_valuation").alias("max_valuation"))
            .withColumn("competition_name", slug_title("competition_name")))


def other_bucket(yearly: DataFrame, top: DataFrame, stat: str, leagues, other_agg: str = "max") -> DataFrame:
    """One "Other" row per year: the highest ``stat`` among leagues outside
    the top set (the reference's rule; ``other_agg="sum"`` adds them up
    instead). Its country text is the number of leagues left out."""
    if other_agg not in ("max", "sum"):
        raise ValueError("other_agg must be 'max' or 'sum'")
    top_ids = top.select(ID)
    left_out = F.lit(leagues) - top_ids.agg(F.count("*")).scalar()
    combine = F.max(stat) if other_agg == "max" else F.sum(stat)
    return (drop_members(yearly, top_ids, ID, bounded=True)
            .groupBy("year").agg(combine.alias(stat))
            .select(F.lit(OTHER).alias(ID), "year", stat, F.lit(OTHER).alias("competition_name"),
                    left_out.cast("string").alias("country_name")))


def with_label(df: DataFrame) -> DataFrame:
    return df.withColumn("league_label", league_label("competition_name", "country_name"))


def report_from_yearly(yearly: DataFrame, stat: str = "total_valuation", n: int = 5,
                       other_agg: str = "max") -> DataFrame:
    """The report from the league-year rollup of a first-tier base frame.

    The latest year's leagues are ranked once; every row is then flagged as
    of a top league or not, and one aggregation per (flag, series, year)
    passes the former through and folds the latter into "Other". A league's
    statistic in the latest year is its row of that year, so nothing but
    ``yearly`` is read. The broadcast holds at most ``n`` ids.
    """
    if other_agg not in ("max", "sum"):
        raise ValueError("other_agg must be 'max' or 'sum'")
    unused = "max_valuation" if stat == "total_valuation" else "total_valuation"
    top = (latest_year_slice(yearly).orderBy(F.desc_nulls_last(stat), F.asc(ID)).limit(n)
           .select(F.col(ID).alias("top_id")))
    left_out = league_count(yearly) - top.agg(F.count("*")).scalar()
    is_top = F.col("top_id").isNotNull()
    combine = F.max if other_agg == "max" else F.sum
    series = (yearly.join(F.broadcast(top), yearly[ID] == F.col("top_id"), "left")
              .groupBy(is_top.alias("is_top"), F.coalesce("top_id", F.lit(OTHER)).alias(ID), "year")
              .agg(combine(stat).alias(stat), F.max(F.when(is_top, F.col(unused))).alias(unused),
                   F.min("competition_name").alias("competition_name"),
                   F.min("country_name").alias("country_name")))
    named = (series.withColumn("competition_name", F.when(F.col("is_top"), F.col("competition_name")).otherwise(OTHER))
             .withColumn("country_name", F.when(F.col("is_top"), F.col("country_name"))
                         .otherwise(left_out.cast("string"))))
    return with_label(named).select(*REPORT_COLUMNS)


def report_from_base(base: DataFrame, stat: str = "total_valuation", n: int = 5,
                     other_agg: str = "max") -> DataFrame:
    """The report from a first-tier base frame (see ``report_base``)."""
    return report_from_yearly(league_year_rollup(base), stat, n, other_agg)


def first_league_report(lve: DataFrame, competitions: DataFrame, stat: str = "total_valuation",
                        n: int = 5, cutoff: str = "2025-01-01", materialized: bool = True,
                        other_agg: str = "max") -> DataFrame:
    """Yearly series of the top ``n`` first-tier leagues plus an "Other" row.

    ``stat="total_valuation", n=5`` is the total-value report;
    ``stat="max_valuation", n=7`` the most-valuable-player report. The
    "Other" rows carry only the chosen statistic (the other is NULL).

    The first-tier ``league x year`` frame feeds four parts of the plan
    (latest year, league count, top set, series); it is computed once and
    stored (``materialized=True``), so the rollup input is scanned once
    instead of once per part.
    """
    yearly = league_year_rollup(report_base(lve, competitions, cutoff))
    if materialized:
        yearly = materialize(yearly)
    return report_from_yearly(yearly, stat, n, other_agg)


def first_league_reports(lve: DataFrame, competitions: DataFrame, cutoff: str = "2025-01-01",
                         specs: tuple[tuple[str, int], ...] = (("total_valuation", 5), ("max_valuation", 7)),
                         other_agg: str = "max") -> dict[str, DataFrame]:
    """Several reports (statistic, N) from one stored league-year frame."""
    yearly = materialize(league_year_rollup(report_base(lve, competitions, cutoff)))
    return {stat: report_from_yearly(yearly, stat, n, other_agg) for stat, n in specs}


# --- chart frames -------------------------------------------------------------
def legend_order(report: DataFrame, stat: str) -> DataFrame:
    """Legend position of each series: by its highest ``stat``, then label.

    The input is a report (at most N + 1 series), so the single-partition
    window sorts a bounded number of rows.
    """
    series = (report.where(F.col("league_label").isNotNull())
              .groupBy("league_label", ID).agg(F.max(stat).alias(stat)))
    order = Window.orderBy(F.desc_nulls_last(stat), F.asc("league_label"), F.asc(ID))
    return series.withColumn("position", F.row_number().over(order).cast("int"))


def series_mean(report: DataFrame, stat: str) -> DataFrame:
    """Mean of ``stat`` per series and year (repeated x values are averaged)."""
    return (report.where(F.col("league_label").isNotNull())
            .groupBy("league_label", "year").agg(F.avg(stat).alias(stat)))


def axis_labels(report: DataFrame, stat: str, step: float) -> DataFrame:
    return report.select("league_label", "year", stat, humanize(stat, step).alias("axis_label"))


# --- top players ----------------------------------------------------------------
def player_valuation_stats(valuations: DataFrame, players: DataFrame, clubs: DataFrame) -> DataFrame:
    """Average, highest and lowest valuation per (player id, player name, club name).

    Valuations are first folded per (player id, club id): exact sum,
    count, max, min. That is the only wide shuffle, and it carries narrow
    integer keys; the joins to the player and club names (broadcast or
    shuffled, as the planner decides) see one row per pair instead of one
    per valuation. A pair whose club is the only one of its name, and whose
    player is listed once, is a group by itself and is finished where it is.
    Only the other pairs meet in a second, exact aggregation by name, which
    merges clubs or players that share one.
    """
    v = valuations.where(F.col("player_id").isNotNull() & F.col("current_club_id").isNotNull()) \
        .withColumn("market_value", nan_to_null("market_value"))
    folded = v.groupBy("player_id", "current_club_id").agg(
        *part_sums("market_value", "value"),
        F.count("market_value").alias("value_count"),
        F.max("market_value").alias("value_max"),
        F.min("market_value").alias("value_min"))
    p = players.select("player_id", "name").withColumn(
        "alone", F.count("*").over(Window.partitionBy("player_id", "name")) == 1)
    c = clubs.select(F.col("club_id").alias("current_club_id"), F.col("name").alias("club_name")).withColumn(
        "only", F.count("*").over(Window.partitionBy("club_name")) == 1)
    joined = join_dimension(join_dimension(folded, p, "player_id"), c, "current_club_id")
    key = ["player_id", "name", "club_name"]
    single = F.col("alone") & F.col("only")
    done = joined.where(single).select(
        *key, (total_of([F.col(f"value_{k}") for k in range(3)]) / F.col("value_count")).alias("avg_valuation"),
        F.col("value_max").alias("max_valuation"), F.col("value_min").alias("min_valuation"))
    merged = joined.where(~single).groupBy(*key).agg(
        (merged_total("value") / F.sum("value_count")).alias("avg_valuation"),
        F.max("value_max").alias("max_valuation"), F.min("value_min").alias("min_valuation"))
    return done.unionByName(merged).select("player_id", "name", "avg_valuation", "max_valuation", "min_valuation", "club_name")


def top_players(stats: DataFrame, n: int = 100) -> DataFrame:
    """Highest average first; ties by player id, name, club name."""
    return stats.orderBy(F.desc_nulls_last("avg_valuation"), F.asc("player_id"),
                         F.asc_nulls_last("name"), F.asc_nulls_last("club_name")).limit(n)


def player_top100(valuations: DataFrame, players: DataFrame, clubs: DataFrame, n: int = 100) -> DataFrame:
    return top_players(player_valuation_stats(valuations, players, clubs), n)


def club_ordinal(top: DataFrame) -> DataFrame:
    """Colour index per club: its rank by first appearance in the ranked list.

    ``top`` is bounded (the top-N list), so the unpartitioned windows are
    over at most N rows.
    """
    ranked = top.withColumn("position", F.row_number().over(Window.orderBy(
        F.desc_nulls_last("avg_valuation"), F.asc("player_id"), F.asc_nulls_last("name"),
        F.asc_nulls_last("club_name"))))
    firsts = ranked.groupBy("club_name").agg(F.min("position").cast("int").alias("first_position"))
    return firsts.withColumn("color_index", (F.row_number().over(Window.orderBy("first_position")) - 1).cast("int"))


def player_bars(top: DataFrame, step: float = 1_000_000) -> DataFrame:
    """Bar-chart frame of a top-N list: rank, bar slot, club colour, value label.

    Bars are drawn in reverse rank order, so ``bar_index`` 0 is the lowest
    of the list. ``top`` is bounded (the top-N list), so the unpartitioned
    windows sort at most N rows; the colour table has at most N rows and is
    broadcast.
    """
    order = Window.orderBy(F.desc_nulls_last("avg_valuation"), F.asc("player_id"), F.asc_nulls_last("name"),
                           F.asc_nulls_last("club_name"))
    ranked = (top.withColumn("position", F.row_number().over(order).cast("int"))
              .withColumn("bar_index", (F.count("*").over(Window.partitionBy()) - F.col("position")).cast("int")))
    colours = F.broadcast(club_ordinal(top).select(F.col("club_name").alias("colour_club"), "color_index"))
    return (ranked.join(colours, ranked["club_name"].eqNullSafe(colours["colour_club"]), "left")
            .select("player_id", "name", "club_name", "avg_valuation", "position", "bar_index", "color_index",
                    humanize("avg_valuation", step).alias("value_label")))


# Fixed value: the name of the fallback logo.
DEFAULT_LOGO = "default"


def legend_logos(legend: DataFrame, stored_ids: DataFrame, template: str = LOGO_PATH_TEMPLATE) -> DataFrame:
    """The logo file of each legend entry: the league's own when it is
    stored, else the default logo. ``stored_ids`` is a one-column frame of
    ids (``competition_id``) with a stored logo."""
    have = stored_ids.select(F.col("competition_id").alias(ID)).distinct().withColumn("has_logo", F.lit(True))
    joined = legend.join(have, ID, "left")
    own = fill_template(template, F.col(ID))
    fallback = F.lit(template.replace("{}", DEFAULT_LOGO))
    return joined.select(*legend.columns, F.when(F.col("has_logo"), own).otherwise(fallback).alias("logo_path"))


def to_pandas_bounded(df: DataFrame, max_rows: int = 1000):
    """A report frame as pandas for drawing, refusing anything larger than
    ``max_rows`` (reads at most ``max_rows + 1`` rows to find out)."""
    pdf = df.limit(max_rows + 1).toPandas()
    if len(pdf) > max_rows:
        raise ValueError(f"frame has more than {max_rows} rows; write it out instead of collecting it")
    return pdf
