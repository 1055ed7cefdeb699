import datetime as dt

from pyspark.sql import functions as F

from kickledger.operators import rollups

V_DDL = "player_id long, date date, market_value double, current_club_id long, competition_id string"
C_DDL = "club_id long, name string, domestic_competition_id string"
D = dt.date(2020, 1, 10)


def lve(spark, vals, clubs):
    v = spark.createDataFrame(vals, V_DDL)
    c = spark.createDataFrame(clubs, C_DDL)
    return rollups.league_valuation_evolution(v, c, "2020-01-01", "2021-01-01")


def test_all_null_group_and_null_key(spark):
    out = lve(spark, [(1, D, None, 10, "A"), (2, D, 5.0, 20, "A")],
              [(10, "c10", "L1"), (20, "c20", None)]).collect()
    assert len(out) == 1  # the league-less club's rows drop
    r = out[0]
    assert (r.domestic_competition_id, r.total_valuation, r.min_valuation, r.max_valuation, r.player_count) == (
        "L1", 0.0, None, None, 0)
    assert r.partition_date == "2020-01-01"


def test_repeat_valuation_counts_twice_and_duplicate_club_multiplies(spark):
    out = lve(spark, [(1, D, 3.0, 10, "A"), (1, D, 3.0, 10, "A")],
              [(10, "c10", "L1"), (10, "c10b", "L1")]).first()
    assert out.player_count == 4 and out.total_valuation == 12.0


def test_sum_is_exact(spark):
    vals = [(i, D, 0.1, 10, "A") for i in range(1000)]
    assert lve(spark, vals, [(10, "c", "L")]).first().total_valuation == 100.0


def test_months_in_one_job(spark):
    vals = [(1, dt.date(2020, m, 3), float(m), 10, "A") for m in range(1, 13)]
    out = lve(spark, vals, [(10, "c", "L")])
    assert out.count() == 12
    assert sorted(r.partition_date for r in out.collect())[0] == "2020-01-01"


def test_club_rollup_merges_names_and_takes_earliest_league(spark):
    v = spark.createDataFrame([(2, dt.date(2020, 1, 9), 1.0, 10, "C"), (1, dt.date(2020, 1, 9), 2.0, 20, "B"),
                               (3, dt.date(2020, 1, 2), 4.0, 20, None), (4, dt.date(2020, 1, 20), 8.0, 10, "A")],
                              V_DDL)
    c = spark.createDataFrame([(10, "Same", "L1"), (20, "Same", "L2")], C_DDL)
    r = rollups.club_valuation_evolution(v, c, "2020-01-01", "2020-02-01").first()
    assert (r.club_name, r.total_valuation, r.squad_size, r.domestic_competition_id) == ("Same", 15.0, 4, "B")


def test_sum_invariant_over_testdata(spark):
    from kickledger.sources import testdata as td
    sf = "/root/testdata/sf0.001"
    rows = rollups.valuation_rows(td.valuations(spark, sf), td.clubs(spark, sf), td.START, td.END)
    total = rows.agg(rollups.exact_sum("market_value").alias("t")).first().t
    by_league = rollups.league_rollup(rows).agg(F.sum("total_valuation").alias("t")).first().t
    assert abs(total - by_league) < 1e-6 * max(1.0, total)


def test_backfill_in_one_job_equals_month_by_month(spark):
    from kickledger.plans import pipeline
    from kickledger.session import shared_path
    from kickledger.sources import testdata as td
    from kickledger.sources.warehouse import Warehouse

    sf = "/root/testdata/sf0.001"
    v, c = td.valuations(spark, sf), td.clubs(spark, sf)
    one = Warehouse(spark, shared_path(spark, "wh"))
    pipeline.backfill_league_rollup(one, v, c, "1996-01-01", "1996-04-01")
    many = Warehouse(spark, shared_path(spark, "wh"))
    for start, end in (("1996-01-01", "1996-02-01"), ("1996-02-01", "1996-03-01"), ("1996-03-01", "1996-04-01")):
        pipeline.backfill_league_rollup(many, v, c, start, end)

    def rows(wh):
        return sorted(tuple(r) for r in wh.read("league_valuation_evolution").collect())

    assert rows(one) == rows(many)
    assert {r[-1] for r in rows(one)} == {"1996-01-01", "1996-02-01", "1996-03-01"}
