"""Month replacement and link extraction on the cases that used to lose or multiply rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kickledger.operators import joins, pages, reports, rollups
from kickledger.plans import pipeline
from kickledger.sources import ingest
from kickledger.sources.warehouse import Warehouse


def _rows(spark, days):
    return spark.createDataFrame([(k, dt.date.fromisoformat(d), 10.0 * k, 1, "L1") for k, d in enumerate(days, 1)],
                                 "player_id int, date date, market_value double, current_club_id int, competition_id string")


def _loaded(spark, scratch, days):
    wh = Warehouse(spark, scratch)
    wh.create_table("player_valuations")
    wh.replace_months("player_valuations", pipeline.valuation_load_rows(_rows(spark, days), "2020-01-01", "2020-07-01"))
    return wh


def test_cut_ranges_are_refused(spark, scratch):
    wh = _loaded(spark, scratch, ["2020-01-05", "2020-02-05"])
    rows = pipeline.valuation_load_rows(_rows(spark, ["2020-01-20"]), "2020-01-15", "2020-02-15")
    with pytest.raises(ValueError, match="first day"):
        wh.replace_months("player_valuations", rows, "delete", "2020-01-15", "2020-02-15")
    with pytest.raises(ValueError, match="first day"):
        pipeline.load_base_tables(wh, "2020-01-15", "2020-03-01")
    with pytest.raises(ValueError, match="first day"):
        pipeline.backfill_league_rollup(wh, rows, rows, "2020-01-01", "2020-03-15")
    assert wh.read("player_valuations").count() == 2


def test_only_the_range_is_written_and_cleared(spark, scratch):
    wh = _loaded(spark, scratch, ["2020-01-05", "2020-02-05", "2020-05-05"])
    rows = pipeline.valuation_load_rows(_rows(spark, ["2020-01-09", "2020-05-09"]), "2020-01-01", "2020-07-01")
    wh.replace_months("player_valuations", rows, "delete", "2020-01-01", "2020-03-01")
    assert sorted(str(r.date) for r in wh.read("player_valuations").collect()) == ["2020-01-09", "2020-05-05"]


def test_month_replaced_from_itself_and_by_nothing(spark, scratch):
    wh = _loaded(spark, scratch, ["2020-01-05", "2020-02-05"])
    table = wh.read("player_valuations")
    wh.replace_month("player_valuations", table.union(table), "2020-02")
    assert wh.read("player_valuations").count() == 3
    wh.replace_month("player_valuations", wh.read("player_valuations").limit(0), "2020-02")
    assert [str(r.date) for r in wh.read("player_valuations").collect()] == ["2020-01-05"]


def test_split_empties_months_that_are_gone(spark, scratch):
    ingest.split_by_month(_rows(spark, ["2020-01-05", "2020-02-05"]), "date", scratch)
    ingest.split_by_month(_rows(spark, ["2020-01-07"]), "date", scratch)
    assert [str(r.date) for r in ingest.read_months(spark, scratch).collect()] == ["2020-01-07"]


@pytest.mark.parametrize("key", ["date_format(date, 'yyyy-MM')", "date_format(date, 'yyyy-MM-01')"])
def test_month_prune_drops_no_month_of_the_window(spark, key):
    rows = _rows(spark, ["2020-03-05", "2020-04-10", "2020-05-01"]).withColumn("partition_date", F.expr(key))
    assert rollups.month_prune(rows, "2020-03-01", "2020-04-15", "partition_date").count() == 2
    assert rollups.month_prune(rows, "2020-03-01", "2020-04-01", "partition_date").count() == 1


def test_shared_url_gives_one_row_per_competition(spark):
    targets = spark.createDataFrame([("A", "u"), ("B", "u"), ("C", "v")], "competition_id string, url string")
    stored = spark.createDataFrame([(1, "u", "<div class='x'><img src='s'></div>"), (2, "v", "<p>")],
                                   "page_id long, url string, html string")
    found = pages.pending_links(targets, targets.limit(0), stored, container="div", css_class="x", child="img", attr="src")
    assert sorted((r.competition_id, r.link, r.status) for r in found.collect()) == [
        ("A", "s", "ok"), ("B", "s", "ok"), ("C", None, "no_container")]


def test_quoted_cells(spark, tmp_path):
    (tmp_path / "p.csv").write_text('id,name,country\n1,"Ronaldo ""R9"", Jr",Brazil\n2,"a\nb",X\n')
    rows = ingest.read_csv_text(spark, f"file://{tmp_path}/p.csv", multi_line=True).collect()
    assert [tuple(r) for r in rows] == [("1", 'Ronaldo "R9", Jr', "Brazil"), ("2", "a\nb", "X")]


def test_nan_values_in_the_top_players(spark):
    v = _rows(spark, ["2020-01-05", "2020-01-06"]).withColumn(
        "market_value", F.when(F.col("player_id") == 1, F.lit(float("nan"))).otherwise(F.col("market_value")))
    players = spark.createDataFrame([(1, "a"), (2, "b")], "player_id int, name string")
    clubs = spark.createDataFrame([(1, "c")], "club_id int, name string")
    got = {r.name: r.avg_valuation for r in reports.player_valuation_stats(v, players, clubs).collect()}
    assert got == {"a": None, "b": 20.0}


def test_dimension_join_builds_without_a_job(spark):
    v = _rows(spark, ["2020-01-05"])
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    joined = joins.join_dimension(v, spark.createDataFrame([(1, "c")], "current_club_id int, name string"),
                                  "current_club_id", skew="aqe")
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == list(before)
    assert "SinglePartition" not in joined._jdf.queryExecution().executedPlan().toString()


def test_sums_keep_small_decimals_and_hold_large_totals(spark):
    rows = spark.range(1000).select(F.col("id").cast("int").alias("player_id"), F.lit("a").alias("g"),
                                    F.when(F.col("id") < 999, F.lit(0.004)).alias("v"))
    assert rows.groupBy("g").agg(rollups.exact_sum("v").alias("t")).first().t == 3.996
    large = spark.range(300).select(F.lit(1.5e17).alias("v"), F.lit(-0.25).alias("w"), F.lit(None).cast("double").alias("n"))
    got = large.agg(rollups.exact_sum("v").alias("v"), rollups.exact_sum("w").alias("w"), rollups.exact_sum("n").alias("n")).first()
    assert (got.v, got.w, got.n) == (4.5e19, -75.0, 0.0)


def test_date_layout_missing_markers_and_declared_types(spark, scratch):
    spark.createDataFrame([("1", "2020-01-05 10:00:00", "NA", "7"), ("2", "2020-01-06", "x", "1.5"), ("3", None, "null", None)],
                          "game_id string, date string, round string, goals string") \
        .write.option("header", True).csv(scratch)
    types = {"game_id": "long", "date": "timestamp", "goals": "double"}
    got = ingest.load_dataset(spark, scratch, "games", date_format="yyyy-MM-dd HH:mm:ss", types=types)
    assert dict(got.dtypes) == {"game_id": "bigint", "date": "timestamp_ntz", "round": "string", "goals": "double"}
    assert sorted(tuple(r) for r in got.collect()) == [(1, dt.datetime(2020, 1, 5, 10), None, 7.0), (2, None, "x", 1.5),
                                                       (3, None, None, None)]
