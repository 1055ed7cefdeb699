from pyspark.sql import functions as F

from kickledger.operators import reports

LVE_DDL = "domestic_competition_id string, total_valuation double, max_valuation double, partition_date string"
COMP_DDL = "competition_id string, name string, sub_type string, country_name string"


def frames(spark, rows, n_leagues):
    lve = spark.createDataFrame(rows, LVE_DDL)
    comp = spark.createDataFrame([(f"L{i}", f"league-{i}", "first_tier", f"C{i}") for i in range(n_leagues)]
                                 + [("S", "second", "second_tier", "X")], COMP_DDL)
    return lve, comp


def test_other_is_max_not_sum(spark):
    rows = [("L0", 100.0, 1.0, "2020-01-01"), ("L1", 10.0, 1.0, "2020-01-01"), ("L2", 30.0, 1.0, "2020-01-01")]
    lve, comp = frames(spark, rows, 3)
    out = reports.first_league_report(lve, comp, "total_valuation", 1, "2025-01-01").collect()
    other = [r for r in out if r.domestic_competition_id == "Other"]
    assert len(other) == 1 and other[0].total_valuation == 30.0 and other[0].country_name == "2"
    assert other[0].league_label == "Other (2)" and other[0].max_valuation is None
    kept = [r for r in out if r.domestic_competition_id == "L0"][0]
    assert kept.competition_name == "League 0" and kept.league_label == "League 0 (C0)"


def test_other_can_sum(spark):
    rows = [("L0", 100.0, 1.0, "2020-01-01"), ("L1", 10.0, 1.0, "2020-01-01"), ("L2", 30.0, 1.0, "2020-01-01")]
    lve, comp = frames(spark, rows, 3)
    out = reports.first_league_report(lve, comp, "total_valuation", 1, "2025-01-01", other_agg="sum")
    assert out.where("domestic_competition_id = 'Other'").first().total_valuation == 40.0


def test_fewer_leagues_than_n_gives_no_other(spark):
    rows = [(f"L{i}", float(i), 1.0, "2020-01-01") for i in range(3)]
    lve, comp = frames(spark, rows, 3)
    out = reports.first_league_report(lve, comp, "total_valuation", 5, "2025-01-01").collect()
    assert len(out) == 3 and all(r.domestic_competition_id != "Other" for r in out)


def test_ties_go_to_lower_id_and_latest_year_decides(spark):
    rows = [("L1", 5.0, 1.0, "2021-03-01"), ("L0", 5.0, 1.0, "2021-03-01"), ("L2", 1.0, 1.0, "2021-03-01"),
            ("L2", 99.0, 1.0, "2020-03-01")]
    lve, comp = frames(spark, rows, 3)
    base = reports.report_base(lve, comp, "2025-01-01")
    top = [r.domestic_competition_id for r in reports.top_leagues(base, "total_valuation", 1).collect()]
    assert top == ["L0"]


def test_cutoff_and_at_most_n_plus_one_per_year(spark):
    rows = [(f"L{i}", float(i * m), float(i), f"20{y}-0{m}-01") for i in range(8) for y in (19, 20, 24, 25)
            for m in (1, 2)]
    lve, comp = frames(spark, rows, 8)
    out = reports.first_league_report(lve, comp, "max_valuation", 7, "2025-01-01")
    per_year = out.groupBy("year").count().collect()
    assert {r.year for r in per_year} == {2019, 2020, 2024}
    assert all(r["count"] <= 8 for r in per_year)


def test_legend_and_series(spark):
    rep = spark.createDataFrame([("a (x)", "A", 2020, 1.0), ("a (x)", "A", 2021, 3.0), ("b (y)", "B", 2020, 3.0),
                                 (None, "N", 2020, 9.0)],
                                "league_label string, domestic_competition_id string, year int, total_valuation double")
    order = {r.league_label: r.position for r in reports.legend_order(rep, "total_valuation").collect()}
    assert order == {"a (x)": 1, "b (y)": 2}
    mean = reports.series_mean(rep, "total_valuation").count()
    assert mean == 3


def test_top_players_preaggregation_matches_direct_group(spark):
    from kickledger.sources import testdata as td
    sf = "/root/testdata/sf0.001"
    v, p, c = td.valuations(spark, sf), td.players(spark, sf), td.clubs(spark, sf)
    fast = reports.player_valuation_stats(v, p, c)
    direct = (v.join(p, "player_id").join(c.withColumnRenamed("name", "club_name"),
                                           v.current_club_id == c.club_id)
              .groupBy("player_id", "name", "club_name").agg(F.avg("market_value").alias("a")))
    joined = fast.join(direct, ["player_id", "name", "club_name"], "full_outer")
    assert joined.where(F.abs(F.col("a") - F.col("avg_valuation")) > 1e-6).count() == 0
    assert joined.where(F.col("a").isNull() | F.col("avg_valuation").isNull()).count() == 0
    ranks = reports.club_ordinal(reports.top_players(fast, 100)).orderBy("color_index").collect()
    assert [r.color_index for r in ranks] == list(range(len(ranks)))
    assert [r.first_position for r in ranks] == sorted(r.first_position for r in ranks)


def test_to_pandas_bounded(spark):
    import pytest

    small = spark.range(5)
    assert len(reports.to_pandas_bounded(small, 10)) == 5
    with pytest.raises(ValueError):
        reports.to_pandas_bounded(spark.range(20), 10)


def test_axis_labels(spark):
    rep = spark.createDataFrame([("a (x)", 2020, 2_500_000_000.0), ("a (x)", 2021, 3_500_000.0)],
                                "league_label string, year int, total_valuation double")
    out = {r.year: r.axis_label for r in reports.axis_labels(rep, "total_valuation", 1_000_000).collect()}
    assert out == {2020: "2500M", 2021: "4M"}
