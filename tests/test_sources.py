import os

import pytest
from pyspark.sql import functions as F

from kickledger.functions import text
from kickledger.operators import pages
from kickledger.sources import ingest
from kickledger.sources.warehouse import Warehouse


def test_binary_files_and_stored_ids(spark, scratch):
    folder = scratch.replace("file:", "")
    os.makedirs(folder)
    for name, data in (("GB1.png", b"\x89PNG-a"), ("ES1.png", b"\x89PNG-b"), ("notes.txt", b"x")):
        with open(os.path.join(folder, name), "wb") as f:
            f.write(data)
    ids = sorted(r.competition_id for r in ingest.stored_ids(spark, scratch).collect())
    assert ids == ["ES1", "GB1"]
    files = ingest.read_binary_files(spark, scratch, "*.png")
    md = files.where(F.col("path").endswith("GB1.png")).select(
        text.data_uri_markdown(spark, F.col("content")).alias("m")).first().m
    assert md == "![Image](data:image/jpeg;base64,iVBORy1h)"
    targets = spark.createDataFrame([("GB1", "u1"), ("IT1", "u2")], "competition_id string, url string")
    assert [r.competition_id for r in pages.pending(targets, ingest.stored_ids(spark, scratch)).collect()] == ["IT1"]


def test_csv_ingest_types_and_passes_extra_columns(spark, scratch):
    raw = spark.createDataFrame([("1", "2020-01-02", "1e3", "7", None, "extra"),
                                 ("x", "2020-02-30", "1,000", "8", "GB1", "more")],
                                "player_id string, date string, market_value_in_eur string, "
                                "current_club_id string, player_club_domestic_competition_id string, note string")
    raw.write.option("header", True).csv(scratch)
    typed = ingest.load_dataset(spark, scratch, "player_valuations").orderBy("current_club_id").collect()
    assert (typed[0].player_id, typed[0].market_value_in_eur, str(typed[0].date), typed[0].note) == (
        1, 1000, "2020-01-02 00:00:00", "extra")
    assert (typed[1].player_id, typed[1].date, typed[1].market_value_in_eur) == (None, None, None)
    compat = ingest.load_dataset(spark, scratch, "player_valuations", null_strings="nan").orderBy(
        "current_club_id").first()
    assert compat.player_club_domestic_competition_id == "nan"


def test_sql_views_and_frame_view(spark, scratch):
    wh = Warehouse(spark, scratch)
    wh.ctas_if_absent("clubs", spark.createDataFrame([(1, "A"), (2, "B")], "club_id long, name string"))
    assert wh.sql("SELECT count(*) AS n FROM clubs", tables=["clubs"]).first().n == 2
    lve = spark.createDataFrame([("L", 1.0, 1.0, 1.0, 1, "2020-01-01")],
                                "domestic_competition_id string, total_valuation double, min_valuation double, "
                                "max_valuation double, player_count int, partition_date string")
    with wh.frame_view(lve) as view:
        wh.insert_select("league_valuation_evolution", f"SELECT * FROM {view}")
        assert spark.catalog.tableExists(view)
    assert not spark.catalog.tableExists(view)
    assert wh.read("league_valuation_evolution").count() == 1


def test_parquet_raw_input_is_typed_directly(spark, scratch):
    import datetime as dt

    raw = spark.createDataFrame(
        [(1, dt.datetime(2020, 1, 2, 0, 0), 1000.0, 7.0, "GB1"), (2, dt.datetime(2020, 2, 3, 0, 0), 12.5, None, None),
         (3, None, float("nan"), 9.0, "ES1")],
        "player_id long, date timestamp_ntz, market_value_in_eur double, current_club_id double, "
        "player_club_domestic_competition_id string")
    path = scratch + "/player_valuations.parquet"
    raw.write.parquet(path)
    typed = ingest.load_dataset(spark, path, "player_valuations").orderBy("player_id").collect()
    assert [(r.market_value_in_eur, r.current_club_id) for r in typed] == [(1000, 7), (None, None), (None, 9)]
    assert str(typed[0].date) == "2020-01-02 00:00:00" and typed[2].date is None


def test_written_files_are_whole_and_alike_however_often_written(spark, scratch):
    rows = [("a.txt", b"x"), ("b.txt", b"\x00\xff\n\x01"), ("é b%20.txt", b"y" * 70000)]
    df = spark.createDataFrame(rows, "name string, content binary").repartition(3)
    for _ in range(2):
        assert ingest.write_files(df, "name", "content", scratch) == scratch
    files = ingest.read_binary_files(spark, scratch, "*.txt").select("length", "content").collect()
    assert sorted(bytes(f.content) for f in files) == sorted(content for _, content in rows)
    assert all(f.length == len(f.content) for f in files)


def test_a_file_needs_a_name_of_its_own_folder(spark, scratch):
    with pytest.raises(Exception, match="no file name"):
        ingest.write_files(spark.createDataFrame([("../x", b"")], "name string, content binary"), "name", "content", scratch)


def test_pages_without_text_or_with_one_id_keep_their_files(spark, scratch):
    from kickledger.plans import catalog

    spark.createDataFrame([(7, "one"), (7, "two"), (None, "three"), (-8, ""), (9, None)], "page_id long, html string") \
        .coalesce(1).write.parquet(f"{scratch}/pages.parquet")
    got = sorted(((r.page_id, r.length) for r in catalog.QUERIES["binary_files"](spark, scratch).collect()), key=str)
    assert got == [(-8, 0), (7, 3), (7, 3), (9, 0), (None, 5)]


def test_many_small_files_are_read_by_few_tasks(spark, scratch):
    df = spark.range(200).selectExpr("concat(id, '.txt') AS name", "CAST(CAST(id AS STRING) AS BINARY) AS content")
    files = ingest.read_binary_files(spark, ingest.write_files(df, "name", "content", scratch), "*.txt", tasks=3)
    assert files.rdd.getNumPartitions() <= 3
    assert sorted(int(f.content) for f in files.select("content").collect()) == list(range(200))
