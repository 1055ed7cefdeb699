"""The football tables as views over the given test tables.

The test data has no football in it, so each football table is a fixed
projection of one given table (the same mapping the SQL oracle uses):

- valuations   <- lineitem (part = player, supplier = club, return flag = league)
- clubs        <- supplier (nation = domestic league)
- competitions <- nation joined to region (nations below 20 are first tier)
- players      <- part
- appearances  <- events (timestamps with a time of day)
- pages        <- pages (stored web pages)

Only the columns a query uses survive column pruning, so each scan reads
just those parquet columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The month window and report cut-off of the test data
# (ship dates run from 1995-01-02 to 2001-11-04).
START = "1995-01-01"
END = "2002-01-01"
CUTOFF = "2001-01-01"
FIRST_TIER_BELOW = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def valuations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("player_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("market_value"),
        F.col("l_suppkey").alias("current_club_id"),
        F.col("l_returnflag").alias("competition_id"),
    )


def clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("club_id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("string").alias("domestic_competition_id"),
    )


def competitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("string").alias("competition_id"),
        F.lower(F.regexp_replace("n_name", "_", "-")).alias("name"),
        F.when(F.col("n_nationkey") < FIRST_TIER_BELOW, F.lit("first_tier"))
         .otherwise(F.lit("second_tier")).alias("sub_type"),
        F.col("r_name").alias("country_name"),
    )


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("player_id"), F.col("p_name").alias("name"))


def appearances(spark: SparkSession, sf_dir: str, shift_days: int = 2) -> DataFrame:
    """Events as appearances; times move by ``shift_days`` so some fall on the
    last day of a month after 00:00 (where closed and half-open windows differ)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("appearance_id"),
        F.col("event_id").alias("game_id"),
        F.col("user_id").alias("player_id"),
        F.col("user_id").alias("player_club_id"),
        F.col("user_id").alias("player_current_club_id"),
        (F.col("ts") + F.expr(f"INTERVAL {int(shift_days)} DAYS")).alias("date"),
        F.col("event_type").alias("player_name"),
        F.col("event_type").alias("competition_id"),
        F.col("value").cast("bigint").alias("yellow_cards"),
        F.lit(0).cast("bigint").alias("red_cards"),
        F.length("props").cast("bigint").alias("goals"),
        F.lit(0).cast("bigint").alias("assists"),
        F.round("value").cast("bigint").alias("minutes_played"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")
