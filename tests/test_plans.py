"""Physical plan checks: pushdown, pruning, join strategy, no Python in the hot path."""

from pyspark.sql import functions as F

from kickledger.operators import pages, reports, rollups
from kickledger.sources import testdata as td
from tests.conftest import SF_SMOKE


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rollup_scan_pushes_date_filter_and_reads_three_columns(spark):
    df = rollups.league_valuation_evolution(td.valuations(spark, SF_SMOKE), td.clubs(spark, SF_SMOKE),
                                            td.START, td.END)
    plan = plan_of(df)
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "partial_sum" in plan  # map-side combine before the shuffle


def test_top_players_fold_then_join(spark):
    v, p, c = td.valuations(spark, SF_SMOKE), td.players(spark, SF_SMOKE), td.clubs(spark, SF_SMOKE)
    small = plan_of(reports.top_players(reports.player_valuation_stats(v, p, c)))
    assert "TakeOrderedAndProject" in small
    assert small.count("BroadcastHashJoin") == 4  # two for pairs that are groups by themselves, two for the others
    assert small.count("HashAggregate") >= 4  # folded per (player, club), then, where names repeat, by name
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # Spark's own size rule off, too
    try:
        large = plan_of(reports.player_valuation_stats(v, p, c))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in large and large.count("HashAggregate") >= 4


def test_only_repeated_names_meet_again(spark):
    """Pairs of unrepeated names pass the second shuffle by: it carries no row where no name repeats."""
    v = spark.range(2000).selectExpr("id % 50 AS player_id", "id % 7 AS current_club_id", "CAST(id AS DOUBLE) AS market_value")
    p = spark.range(50).selectExpr("id AS player_id", "concat('p', id % 49) AS name")
    for names, merged in (("concat('c', id)", 0), ("concat('c', id % 6)", 100)):
        c = spark.range(7).selectExpr("id AS club_id", f"{names} AS name")
        stats = reports.player_valuation_stats(v, p, c)
        want = v.join(p, "player_id").join(c.selectExpr("club_id AS current_club_id", "name AS club_name"), "current_club_id") \
            .groupBy("player_id", "name", "club_name").agg(F.avg("market_value"), F.max("market_value"), F.min("market_value"))
        got = stats.select("player_id", "name", "club_name", "avg_valuation", "max_valuation", "min_valuation")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        groups = got.groupBy("club_name").count().where("club_name = 'c0'").first()["count"]
        assert groups == 50 and got.count() == (350 if not merged else 300)


def test_no_python_outside_link_extraction(spark):
    from kickledger.plans import catalog
    for name in ("league_valuation_evolution", "club_valuation_evolution", "first_league_total",
                 "player_top100", "slug_title", "humanize", "coerce_numbers"):
        plan = plan_of(catalog.QUERIES[name](spark, SF_SMOKE))
        assert "Python" not in plan and "ArrowEval" not in plan, name
    links = plan_of(pages.extract_links(td.pages(spark, SF_SMOKE), "nav", None, "a", "href"))
    assert "MapInPandas" in links or "PythonMapInArrow" in links or "MapInArrow" in links


def test_report_reads_materialized_frame(spark):
    from kickledger.plans import catalog
    plan = plan_of(catalog.QUERIES["first_league_total"](spark, SF_SMOKE))
    assert "lineitem" not in plan  # the rollup was computed once and stored


def test_stream_refresh_prunes_to_touched_months(spark, scratch):
    import datetime as dt

    from pyspark.sql import functions as F

    from kickledger.plans.pipeline import valuation_load_rows
    from kickledger.sources.warehouse import Warehouse
    from kickledger.streaming import month_stream

    wh = Warehouse(spark, scratch)
    ddl = "player_id long, date date, market_value double, current_club_id long, competition_id string"
    rows = spark.createDataFrame([(i, dt.date(2020, m, 3), 1.0, 10, "A") for i in range(2) for m in (1, 2, 3)], ddl)
    (valuation_load_rows(rows, "2020-01-01", "2021-01-01").withColumn("load_batch", F.lit(0).cast("long"))
     .write.partitionBy("partition_date", "load_batch").parquet(wh.location(month_stream.STREAM_TABLE)))
    stored = month_stream.read_stream_rows(wh, rows.schema)
    touched = spark.createDataFrame([("2020-03",)], "partition_date string")
    clubs = spark.createDataFrame([(10, "c", "L")], "club_id long, name string, domestic_competition_id string")
    affected = stored.join(F.broadcast(touched), "partition_date", "left_semi")
    df = rollups.league_valuation_evolution(affected, clubs, "2020-01-01", "2021-01-01")
    assert [r.partition_date for r in df.collect()] == ["2020-03-01"]
    assert "dynamicpruning" in plan_of(df)
