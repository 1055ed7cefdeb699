import os

import pytest
from pyspark.sql import functions as F

from kickledger.plans import catalog, pipeline
from kickledger.session import shared_path
from kickledger.sources import ingest
from kickledger.sources import testdata as td
from tests.conftest import SF_SMOKE


def test_pipeline_with_reference_options(spark):
    raw = shared_path(spark, "raw")
    catalog.write_raw_csvs(spark, SF_SMOKE, raw)
    logos = shared_path(spark, "logos").replace("file:", "")
    os.makedirs(logos)
    open(os.path.join(logos, "0.png"), "wb").write(b"png")
    out = shared_path(spark, "out")
    result = pipeline.run(spark, raw, shared_path(spark, "wh"), td.START, td.END, td.CUTOFF, closed=True,
                          null_strings="nan", logo_ids=ingest.stored_ids(spark, logos), out_dir=out)
    wh = result.warehouse
    assert wh.read("player_valuations").count() == td.valuations(spark, SF_SMOKE).count()
    assert wh.read("league_valuation_evolution").count() > 0
    assert wh.read("club_valuation_evolution").count() > 0
    assert wh.read("player_appearances").count() == 0  # events lie outside the valuation window
    total = result.first_league_total.collect()
    assert {r.year for r in total} == set(range(1995, 2001))
    assert sum(r.domestic_competition_id == "Other" for r in total) == 6
    assert result.player_top100.count() == 100
    pending = {r.competition_id for r in result.pending_logos.collect()}
    assert "0" not in pending and "1" in pending
    assert spark.read.json(f"{out}/first_league_total").count() == len(total)
    # Static tables keep their first load on a second run.
    again = pipeline.run(spark, raw, wh.root, td.START, td.END, td.CUTOFF)
    assert again.warehouse.read("clubs").where(F.col("name") == "nan").count() == \
        wh.read("clubs").where(F.col("name") == "nan").count()
    assert again.first_league_total.count() == len(total)


def test_command_line_steps(spark):
    from kickledger.__main__ import main
    from kickledger.sources.warehouse import Warehouse

    raw = shared_path(spark, "raw")
    catalog.write_raw_csvs(spark, SF_SMOKE, raw)
    wh_root = shared_path(spark, "wh")
    out = shared_path(spark, "out")
    common = ["--warehouse", wh_root, "--start", td.START, "--end", td.END, "--cutoff", td.CUTOFF]
    for step in ("ingest", "split", "load", "static", "rollup", "report"):
        main([step, "--raw", raw, "--out", out, *common])
    assert Warehouse(spark, wh_root).read("league_valuation_evolution").count() > 0
    assert spark.read.json(f"{out}/player_top100").count() == 100
    # Re-running one month range of the rollup leaves the table the same.
    before = Warehouse(spark, wh_root).read("league_valuation_evolution").count()
    main(["rollup", "--warehouse", wh_root, "--start", "1998-01-01", "--end", "1998-04-01"])
    assert Warehouse(spark, wh_root).read("league_valuation_evolution").count() == before


def test_pipeline_from_parquet_raw_files(spark):
    csv_dir = shared_path(spark, "raw")
    catalog.write_raw_csvs(spark, SF_SMOKE, csv_dir)
    pq_dir = shared_path(spark, "rawpq")
    for dataset, file_name in pipeline.RAW_FILES.items():
        typed = ingest.load_dataset(spark, f"{csv_dir}/{file_name}", dataset)
        typed.write.parquet(f"{pq_dir}/{dataset}.parquet")
    a = pipeline.run(spark, csv_dir, shared_path(spark, "wh"), td.START, td.END, td.CUTOFF)
    b = pipeline.run(spark, pq_dir, shared_path(spark, "wh"), td.START, td.END, td.CUTOFF, raw_format="parquet")
    assert sorted(map(tuple, a.first_league_total.collect())) == sorted(map(tuple, b.first_league_total.collect()))


def test_no_pipeline_run_is_kept_for_another_query(spark, monkeypatch):
    from kickledger.plans import catalog

    ran = []
    monkeypatch.setattr(catalog, "write_raw_csvs", lambda *_: None)
    monkeypatch.setattr(catalog.pipeline, "run", lambda *_: ran.append(1) or pipeline.RunResult(None, 1, 2, 3, 4))
    for name in ("pipeline_first_league_total", "pipeline_first_league_max", "pipeline_top100"):
        catalog.QUERIES[name](spark, "/none")
    assert len(ran) == 3


def test_steps_together_overlap_and_raise_their_error():
    import threading

    from kickledger.session import together

    met = threading.Barrier(2, timeout=20)
    assert sorted(together(met.wait, met.wait)) == [0, 1]
    ended = []

    def failing():
        raise ValueError("first")

    with pytest.raises(ValueError, match="first"):
        together(failing, lambda: ended.append(1))
    assert ended == [1]
