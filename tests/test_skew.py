"""A club and a player holding a third of all valuations: results stay exact
whichever join strategy runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kickledger.operators import joins, reports, rollups

V_DDL = "player_id long, date date, market_value double, current_club_id long, competition_id string"


def skewed(spark, n=3000):
    rows = [(7 if i % 3 == 0 else i, dt.date(2020, 1 + i % 12, 1 + i % 28), float(i % 97) + 0.25,
             1 if i % 3 == 0 else 2 + i % 40, "A") for i in range(n)]
    return spark.createDataFrame(rows, V_DDL).repartition(6)


def test_hot_club_rollup_is_exact(spark):
    v = skewed(spark)
    clubs = spark.createDataFrame([(c, f"club{c}", "L" if c == 1 else "M") for c in range(1, 42)],
                                  "club_id long, name string, domestic_competition_id string")
    out = rollups.league_valuation_evolution(v, clubs, "2020-01-01", "2021-01-01")
    got = out.agg(F.sum("player_count").alias("n"), F.sum("total_valuation").alias("t")).first()
    want = v.agg(F.count("*").alias("n"), F.sum("market_value").alias("t")).first()
    assert got.n == want.n and abs(got.t - want.t) < 1e-6
    hot = out.where("domestic_competition_id = 'L'").agg(F.sum("player_count")).first()[0]
    assert hot == 1000


@pytest.fixture
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_player_top_stats_same_on_both_strategies(spark, request):
    v = skewed(spark)
    players = spark.createDataFrame([(p, f"p{p}") for p in range(0, 3000)], "player_id long, name string")
    clubs = spark.createDataFrame([(c, f"club{c}") for c in range(1, 42)], "club_id long, name string")
    fast = sorted(map(tuple, reports.player_valuation_stats(v, players, clubs).collect()))
    request.getfixturevalue("no_aqe")
    assert sorted(map(tuple, reports.player_valuation_stats(v, players, clubs).collect())) == fast
    assert {r[4] for r in fast if r[0] == 7 and r[5] == "club1"} and max(r[3] for r in fast if r[0] == 7) == 96.25


@pytest.mark.parametrize("max_hot_rows", [100, 0])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_equals_plain_join(spark, how, max_hot_rows):
    v = skewed(spark).union(spark.createDataFrame([(1, None, None, None, None)] * 3, V_DDL))
    clubs = spark.createDataFrame([(c, f"club{c}") for c in range(1, 42) if c != 5] + [(1, "club1-dup"), (None, "none")],
                                  "current_club_id long, club_name string")
    hot = joins.hot_keys(v, "current_club_id")
    assert 1 in {r.current_club_id for r in hot.collect()}  # the key with a third of all rows
    split = joins.split_join(v, clubs, "current_club_id", how, buckets=8, max_hot_rows=max_hot_rows)
    plain = v.join(clubs, "current_club_id", how)
    assert split.columns == plain.columns
    assert sorted(map(repr, map(tuple, split.collect()))) == sorted(map(repr, map(tuple, plain.collect())))


def test_hot_keys_need_no_sample_and_are_few(spark):
    rows = spark.range(100_000).selectExpr("CASE WHEN id % 10 < 3 THEN 'hot' WHEN id % 50 = 9 THEN 'warm' "
                                           "WHEN id % 7 = 0 THEN NULL ELSE concat('k', id) END AS k")
    assert sorted(r.k for r in joins.hot_keys(rows, "k").collect()) == ["hot", "warm"]
    assert joins.hot_keys(rows.limit(0), "k").count() == 0
    assert joins.hot_keys(spark.range(1000).selectExpr("id % 10 AS k"), "k").count() == 10


@pytest.mark.parametrize("max_hot_rows", [100, 0])
def test_alike_rows_of_a_hot_key_stay_in_many_tasks(spark, no_aqe, max_hot_rows):
    """200,000 equal rows: with AQE off neither way of joining them gathers them in one task."""
    alike = spark.range(0, 200_000, 1, 8).selectExpr(
        "7 + id div 1000000 AS player_id", "1 + id div 1000000 AS current_club_id")
    clubs = spark.createDataFrame([(1, "one"), (2, "two")], "current_club_id long, club_name string")
    out = joins.split_join(alike, clubs, "current_club_id", max_hot_rows=max_hot_rows)
    tasks = out.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in tasks) == 200_000 and len(tasks) >= 3
    assert max(r["count"] for r in tasks) < 150_000
    plain = alike.join(clubs, "current_club_id")
    assert plain.select(F.spark_partition_id()).distinct().count() == 1


def test_join_dimension_splits_when_aqe_is_off(spark, no_aqe):
    v = skewed(spark)
    clubs = spark.createDataFrame([(c, f"club{c}") for c in range(1, 42)], "current_club_id long, club_name string")
    out = joins.join_dimension(v, clubs, "current_club_id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan and out.count() == v.count()
