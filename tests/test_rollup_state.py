import datetime as dt
import os

import pytest

from kickledger.operators import rollup_state, rollups
from kickledger.plans import pipeline
from kickledger.sources import digests
from kickledger.sources.warehouse import Warehouse

START, END = "2020-01-01", "2021-01-01"
V_DDL = "player_id long, date date, market_value double, current_club_id long, competition_id string"
CLUBS_DDL = "club_id long, name string, domestic_competition_id string"


@pytest.fixture
def clubs(spark):
    return spark.createDataFrame([(10, "same", "L1"), (11, "same", "L2"), (20, "other", None), (30, None, "L1")], CLUBS_DDL)


def _rows(spark, rows):
    return spark.createDataFrame([(p, dt.date(2020, m, d) if m else None, v, c, k) for p, m, d, v, c, k in rows], V_DDL)


EARLY = [(1, 1, 5, 1.25, 10, "B"), (2, 1, 9, None, 10, "A"), (3, 2, 1, 7.0, 11, None), (4, 2, 2, float("nan"), 20, "X"),
         (5, 3, 3, 3.0, 30, "Y"), (6, 0, 0, 9.0, 10, "A"), (7, 3, 1, 2.0, None, "A"), (8, 1, 5, 0.1, 11, "C"), (9, 5, 5, None, 20, "Q")]
LATE = [(1, 1, 2, 100.0, 10, "Z"), (1, 1, 2, 100.0, 10, "Z"), (2, 2, 28, -4.0, 20, None), (3, 4, 4, 6.0, 99, "A"), (4, 3, 9, 0.2, 11, "Y")]


def _both(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("parts", [[EARLY], [EARLY, LATE], [LATE, EARLY], [EARLY, [], LATE]])
def test_rollups_of_the_state_are_those_of_the_rows(spark, scratch, clubs, parts):
    wh = Warehouse(spark, scratch)
    for k, part in enumerate(parts):
        rollup_state.add(wh, _rows(spark, part), f"b{k}", START, END)
    rows = _rows(spark, [r for part in parts for r in part])
    state = rollup_state.read_state(wh)
    assert _both(rollup_state.league_rollup(state, clubs)) == _both(
        rollups.league_valuation_evolution(rows, clubs, START, END))
    assert _both(rollup_state.club_rollup(state, clubs)) == _both(rollups.club_valuation_evolution(rows, clubs, START, END))


def test_a_batch_run_again_counts_once_and_only_its_months_change(spark, scratch, clubs):
    wh = Warehouse(spark, scratch)
    rollup_state.rebuild(wh, _rows(spark, EARLY), START, END)
    rollup_state.refresh(wh, clubs, ["2020-01", "2020-02", "2020-03", "2020-05"])
    path = scratch.replace("file:", "") + "/league_valuation_evolution/partition_date="
    before = {m: sorted(os.listdir(path + m)) for m in ("2020-02-01", "2020-03-01")}
    late = _rows(spark, [r for r in LATE if r[1] == 1])
    for _ in range(3):
        assert pipeline.add_late_valuations(wh, late, clubs, "x", START, END) == ["2020-01"]
    assert {m: sorted(os.listdir(path + m)) for m in before} == before
    full = rollups.league_valuation_evolution(_rows(spark, EARLY).unionByName(late), clubs, START, END)
    cast = full.selectExpr("domestic_competition_id", "CAST(total_valuation AS FLOAT)", "player_count", "partition_date")
    stored = wh.read("league_valuation_evolution").select("domestic_competition_id", "total_valuation", "player_count",
                                                          "partition_date")
    assert _both(stored) == _both(cast)
    assert pipeline.add_late_valuations(wh, late.limit(0), clubs, "y", START, END) == []
    with pytest.raises(ValueError):
        pipeline.add_late_valuations(wh, late, clubs, "z", "2020-01-05", END)


def test_late_rows_read_no_stored_valuations(spark, scratch, clubs):
    """The state is all that is read of a month: the base rows may be gone."""
    wh = Warehouse(spark, scratch)
    rollup_state.rebuild(wh, _rows(spark, EARLY), START, END)
    files = rollup_state.league_rollup(rollup_state.read_state(wh), clubs).inputFiles()
    assert files and all("/valuation_state/" in f for f in files)


def test_folding_earlier_batches_of_a_stream(spark, scratch, clubs):
    wh = Warehouse(spark, scratch)
    for k in range(4):
        rollup_state.add(wh, _rows(spark, LATE), f"s-{k}", START, END, fold_earlier="s-")
    rollup_state.add(wh, _rows(spark, LATE), "s-3", START, END, fold_earlier="s-")  # the last batch, run again
    rollup_state.add(wh, _rows(spark, LATE), "t-0", START, END, fold_earlier="t-")
    state = rollup_state.read_state(wh)
    assert {r.load_batch for r in state.select("load_batch").distinct().collect()} == {"s-folded", "s-3", "t-0"}
    five = _rows(spark, LATE * 5)
    assert _both(rollup_state.league_rollup(state, clubs)) == _both(
        rollups.league_valuation_evolution(five, clubs, START, END))


def test_digest_sees_every_change_and_no_order(spark):
    used = ["market_value", "current_club_id", "competition_id", "date"]

    def digest(rows):
        return [tuple(r) for r in digests.month_digests(_rows(spark, rows), "date", used, START, END)
                .orderBy("partition_date").collect()]

    base = digest(EARLY)
    assert digest(EARLY[::-1]) == base and [r[0] for r in base] == ["2020-01", "2020-02", "2020-03", "2020-05"]
    for changed in (EARLY + EARLY[:1], EARLY[1:], [(1, 1, 5, 1.5, 10, "B")] + EARLY[1:],
                    [(1, 1, 5, 1.25, 10, None)] + EARLY[1:], [(1, 1, 6, 1.25, 10, "B")] + EARLY[1:]):
        assert digest(changed)[0] != base[0] and digest(changed)[1:] == base[1:]
    one = spark.createDataFrame([(None, 5), (5, None)], "a long, b long").selectExpr("*", "xxhash64(a, b) AS h")
    assert one.select("h").distinct().count() == 1  # a plain hash does not see which cell is missing
    assert one.select(digests.row_hash(["a", "b"]).alias("h")).distinct().count() == 2


def test_backfill_of_changed_months_leaves_other_files_alone(spark, scratch, clubs):
    wh = Warehouse(spark, scratch)
    base = _rows(spark, EARLY)
    assert pipeline.backfill_changed(wh, base, clubs, START, END) == ["2020-01", "2020-02", "2020-03", "2020-05"]

    def files():
        found = {}
        for table in ("league_valuation_evolution", "club_valuation_evolution"):
            root = f"{scratch.replace('file:', '')}/{table}"
            for month in os.listdir(root):
                if month.startswith("partition_date="):
                    found[table, month[-10:-3]] = sorted(os.listdir(f"{root}/{month}"))
        return found

    before = files()
    assert pipeline.backfill_changed(wh, base.repartition(7), clubs, START, END) == [] and files() == before
    more = base.unionByName(_rows(spark, [(9, 2, 3, 5.0, 10, "A")]))
    assert pipeline.backfill_changed(wh, more, clubs, START, END) == ["2020-02"]
    after = files()
    assert {k for k in after if after[k] != before.get(k)} == {(t, "2020-02") for t, _ in after}
    full = rollups.league_valuation_evolution(more, clubs, START, END).select("domestic_competition_id", "player_count", "partition_date")
    assert _both(wh.read("league_valuation_evolution").select(*full.columns)) == _both(full)
    # A changed club changes every month; a part of the range leaves the digests of the rest alone.
    renamed = spark.createDataFrame([(10, "same", "L9"), (11, "same", "L2")], CLUBS_DDL)
    assert pipeline.backfill_changed(wh, more, renamed, "2020-02-01", "2020-03-01") == ["2020-02"]
    assert pipeline.backfill_changed(wh, more, clubs, "2020-03-01", END) == []
    assert pipeline.backfill_changed(wh, more, renamed, START, END) == ["2020-01", "2020-03", "2020-05"]
    with pytest.raises(ValueError):
        pipeline.backfill_changed(wh, more, clubs, "2020-01-02", END)


def test_league_rollup_shuffles_no_state_rows_and_adding_merges_none(spark, scratch, clubs, monkeypatch):
    """One shuffle, by league and month; a batch under a tag of its own is added without a merge of all state rows."""
    wh = Warehouse(spark, scratch)
    rows = spark.createDataFrame([(1, dt.date(2020, 1, 3), 5.0, 10, "A"), (2, dt.date(2020, 1, 4), 7.0, 20, None)],
                                 "player_id long, date date, market_value double, current_club_id long, competition_id string")
    merges = []
    plain = rollup_state.merge
    monkeypatch.setattr(rollup_state, "merge", lambda *a, **k: merges.append(1) or plain(*a, **k))
    for batch in ("a", "b", "b"):
        rollup_state.add(wh, rows, batch, "2020-01-01", "2020-02-01")
    assert not merges and rollup_state.read_state(wh).count() == 4
    for k in range(4):
        rollup_state.add(wh, rows, f"s-{k}", "2020-01-01", "2020-02-01", fold_earlier="s-")
    state = rollup_state.read_state(wh)
    assert {(r.load_batch, r["count"]) for r in state.groupBy("load_batch").count().collect()} == {
        ("a", 2), ("b", 2), ("s-folded", 2), ("s-3", 2)}
    assert sum(r.n for r in state.collect()) == 2 * (1 + 1 + 4)
    plan = rollup_state.league_rollup(state, clubs)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("HashAggregate") == 2 and "current_club_id" not in plan.split("HashAggregate")[1]
