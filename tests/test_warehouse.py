import datetime as dt

from pyspark.sql import functions as F

from kickledger.sources.warehouse import Warehouse

PV_DDL = "player_id long, date date, market_value double, current_club_id long, competition_id string, " \
         "partition_date string"


def pv(spark, rows):
    return spark.createDataFrame(rows, PV_DDL)


def rows_of(df):
    return sorted((r.player_id, r.partition_date, r.market_value) for r in df.collect())


def base(spark):
    return pv(spark, [(1, dt.date(2020, 1, 5), 1.0, 1, "A", "2020-01"),
                      (2, dt.date(2020, 2, 5), 2.0, 1, "A", "2020-02"),
                      (3, dt.date(2020, 3, 5), 3.0, 1, "A", "2020-03")])


def test_base_replace_is_idempotent_and_empty_clears(spark, scratch):
    wh = Warehouse(spark, scratch)
    wh.create_table("player_valuations")
    assert wh.read("player_valuations").count() == 0
    wh.replace_months("player_valuations", base(spark), on_empty="delete", start="2020-01-01", end="2020-04-01")
    first = rows_of(wh.read("player_valuations"))
    wh.replace_month("player_valuations", base(spark), "2020-02")
    assert rows_of(wh.read("player_valuations")) == first
    wh.replace_month("player_valuations", base(spark).limit(0), "2020-02")
    assert rows_of(wh.read("player_valuations")) == [(1, "2020-01", 1.0), (3, "2020-03", 3.0)]


def test_backfill_with_delete_clears_absent_months_of_range(spark, scratch):
    wh = Warehouse(spark, scratch)
    wh.create_table("player_valuations")
    wh.replace_months("player_valuations", base(spark), on_empty="delete", start="2020-01-01", end="2020-04-01")
    fresh = base(spark).where(F.col("partition_date") != "2020-02")
    wh.replace_months("player_valuations", fresh, on_empty="delete", start="2020-02-01", end="2020-04-01")
    assert [r[1] for r in rows_of(wh.read("player_valuations"))] == ["2020-01", "2020-03"]


def test_rollup_replace_keeps_month_on_empty_input(spark, scratch):
    wh = Warehouse(spark, scratch)
    wh.create_table("league_valuation_evolution")
    lve = spark.createDataFrame([("L", 1.0, 1.0, 1.0, 1, "2020-01-01"), ("L", 2.0, 2.0, 2.0, 1, "2020-02-01")],
                                "domestic_competition_id string, total_valuation double, min_valuation double, "
                                "max_valuation double, player_count int, partition_date string")
    wh.replace_months("league_valuation_evolution", lve)
    wh.replace_month("league_valuation_evolution", lve.limit(0), "2020-01-01", on_empty="keep")
    assert wh.read("league_valuation_evolution").count() == 2
    changed = lve.where("partition_date = '2020-02-01'").withColumn("total_valuation", F.lit(9.0))
    wh.replace_months("league_valuation_evolution", changed)
    out = {r.partition_date: r.total_valuation for r in wh.read("league_valuation_evolution").collect()}
    assert out == {"2020-01-01": 1.0, "2020-02-01": 9.0}


def test_store_casts_to_32_bit_float(spark, scratch):
    wh = Warehouse(spark, scratch)
    wh.replace_months("player_valuations", pv(spark, [(1, dt.date(2020, 1, 1), 16777217.0, 1, "A", "2020-01")]))
    row = wh.read("player_valuations").first()
    assert row.market_value == 16777216.0
    assert wh.read("player_valuations").schema["partition_date"].dataType.typeName() == "string"


def test_static_table_first_load_wins(spark, scratch):
    wh = Warehouse(spark, scratch)
    a = spark.createDataFrame([(1, "A")], "club_id long, name string")
    b = spark.createDataFrame([(2, "B")], "club_id long, name string")
    wh.ctas_if_absent("clubs", a)
    assert [r.name for r in wh.ctas_if_absent("clubs", b).collect()] == ["A"]
    assert [r.name for r in wh.ctas_if_absent("clubs", b, refresh=True).collect()] == ["B"]


def test_month_filter_prunes_partitions(spark, scratch):
    wh = Warehouse(spark, scratch)
    wh.replace_months("player_valuations", base(spark))
    plan = wh.read("player_valuations").where("partition_date = '2020-02'")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_date" in plan


def test_day_keyed_delete_range(spark, scratch):
    wh = Warehouse(spark, scratch)
    ddl = ("domestic_competition_id string, total_valuation double, min_valuation double, max_valuation double, "
           "player_count int, partition_date string")
    rows = spark.createDataFrame([("L", float(m), 1.0, 1.0, 1, f"2020-0{m}-01") for m in (1, 2, 3)], ddl)
    wh.replace_months("league_valuation_evolution", rows)
    fresh = rows.where("partition_date <> '2020-02-01'")
    wh.replace_months("league_valuation_evolution", fresh, on_empty="delete", start="2020-01-01",
                      end="2020-04-01", day_key=True)
    assert sorted(r.partition_date for r in wh.read("league_valuation_evolution").collect()) == [
        "2020-01-01", "2020-03-01"]


def test_command_line_needs_raw_for_ingest():
    import pytest

    from kickledger.__main__ import main

    with pytest.raises(SystemExit):
        main(["ingest", "--warehouse", "/nowhere"])


def test_expire_clears_only_old_folders(spark, scratch):
    import os
    import time

    from kickledger.session import expire

    for name in ("old", "new"):
        spark.range(3).write.parquet(f"{scratch}/{name}")
    path = scratch.replace("file:", "")
    long_ago = time.time() - 50 * 3600
    os.utime(f"{path}/old", (long_ago, long_ago))
    assert expire(spark, 48, scratch) == ["old"] and os.listdir(path) == ["new"]
    assert expire(spark, 48, scratch) == [] and expire(spark, 1, scratch + "-absent") == []


def test_a_replace_that_stops_before_clearing_is_finished_by_the_next_write(spark, scratch, monkeypatch):
    import pytest

    from kickledger.sources import warehouse as module

    wh = Warehouse(spark, scratch)
    ddl = "domestic_competition_id string, total_valuation float, min_valuation float, max_valuation float, " \
          "player_count int, partition_date string"

    def rows(*months):
        return spark.createDataFrame([("L", 1.0, 1.0, 1.0, 1, m) for m in months], ddl)

    def stored():
        return sorted(r.partition_date for r in wh.read("league_valuation_evolution").collect())

    table = "league_valuation_evolution"
    wh.create_table(table)
    months = ["2020-01-01", "2020-02-01", "2020-03-01", "2020-04-01"]
    wh.replace_months(table, rows(*months))
    clear, calls = module.clear_month, []

    def stops(*args):
        if calls:
            raise RuntimeError("lost")
        calls.append(args)
        clear(*args)

    monkeypatch.setattr(module, "clear_month", stops)
    with pytest.raises(RuntimeError):
        wh.replace_months(table, rows("2020-01-01"), on_empty="delete", start="2020-01-01", end="2020-05-01", day_key=True)
    assert stored() == ["2020-01-01", "2020-03-01", "2020-04-01"]
    monkeypatch.setattr(module, "clear_month", clear)
    # Something else writes one of the months that were to go; the next replace clears the other, and only it.
    module.write_months(rows("2020-04-01"), wh.location(table))
    wh.replace_months(table, rows("2020-06-01"))
    assert stored() == ["2020-01-01", "2020-04-01", "2020-06-01"]
    assert wh.finish_pending(table) == []
