import datetime as dt

from kickledger.sources.warehouse import Warehouse
from kickledger.session import shared_path
from kickledger.streaming import month_stream

V_DDL = "player_id long, date date, market_value double, current_club_id long, competition_id string"


def totals(wh):
    return {(r.domestic_competition_id, r.partition_date): (r.total_valuation, r.player_count)
            for r in wh.read("league_valuation_evolution").collect()}


def test_restart_picks_up_new_files_and_late_rows(spark):
    source = shared_path(spark, "src")
    ckpt = shared_path(spark, "ckpt")
    wh = Warehouse(spark, shared_path(spark, "wh"))
    clubs = spark.createDataFrame([(10, "c10", "L1"), (20, "c20", "L2")],
                                  "club_id long, name string, domestic_competition_id string")
    spark.createDataFrame([(1, dt.date(2020, 1, 5), 1.0, 10, "A"), (2, dt.date(2020, 2, 5), 2.0, 20, "A")],
                          V_DDL).coalesce(1).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    month_stream.run_available(spark, source, schema, wh, clubs, "2020-01-01", "2021-01-01", ckpt)
    assert totals(wh) == {("L1", "2020-01-01"): (1.0, 1), ("L2", "2020-02-01"): (2.0, 1)}

    # A late valuation for January arrives after the first run.
    spark.createDataFrame([(3, dt.date(2020, 1, 20), 4.0, 10, "A")], V_DDL).coalesce(1) \
        .write.mode("append").parquet(source)
    month_stream.run_available(spark, source, schema, wh, clubs, "2020-01-01", "2021-01-01", ckpt)
    assert totals(wh) == {("L1", "2020-01-01"): (5.0, 2), ("L2", "2020-02-01"): (2.0, 1)}

    # Nothing new: a third run changes nothing.
    month_stream.run_available(spark, source, schema, wh, clubs, "2020-01-01", "2021-01-01", ckpt)
    assert totals(wh) == {("L1", "2020-01-01"): (5.0, 2), ("L2", "2020-02-01"): (2.0, 1)}
    assert wh.read("club_valuation_evolution").count() == 2


def test_stream_step_on_the_command_line(spark):
    from kickledger.__main__ import main

    source = shared_path(spark, "src")
    wh = Warehouse(spark, shared_path(spark, "wh"))
    wh.ctas_if_absent("clubs", spark.createDataFrame([(10, "c10", "L1")],
                                                     "club_id long, name string, domestic_competition_id string"))
    spark.createDataFrame([(1, dt.date(2020, 1, 5), 3.0, 10, "A")], V_DDL).write.parquet(source)
    main(["stream", "--warehouse", wh.root, "--source", source, "--checkpoint", shared_path(spark, "ck"),
          "--start", "2020-01-01", "--end", "2021-01-01"])
    assert totals(wh) == {("L1", "2020-01-01"): (3.0, 1)}


def test_two_streams_load_one_warehouse(spark):
    wh = Warehouse(spark, shared_path(spark, "wh"))
    clubs = spark.createDataFrame([(10, "c10", "L1")], "club_id long, name string, domestic_competition_id string")
    for player, value in ((1, 5.0), (2, 7.0)):
        source = shared_path(spark, "src")
        rows = spark.createDataFrame([(player, dt.date(2020, 1, 5), value, 10, "A")], V_DDL)
        rows.write.parquet(source)
        month_stream.run_available(spark, source, rows.schema, wh, clubs, "2020-01-01", "2021-01-01",
                                   shared_path(spark, "ckpt"))
    assert totals(wh) == {("L1", "2020-01-01"): (12.0, 2)}
