import warnings

import pytest
from pyspark.sql import functions as F

from kickledger.sources import infer, ingest
from kickledger.sources.infer import BOOLEAN, DOUBLE, LONG, MISSING, TEXT, WIDE


def _classes(spark, cells):
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    return infer.profile(df, ["c"]).classes["c"]


@pytest.mark.parametrize("cells, kind", [
    (["1", "-2", " 3 "], "long"), (["1", None], "double"), (["1", "N/A"], "double"), (["1", "2.5"], "double"),
    (["1e3"], "double"), (["inf", "-Infinity", "1"], "double"), ([None, "nan", ""], "double"), ([], "string"),
    (["true", "FALSE"], "boolean"), (["true", None], "string"), (["true", "1"], "string"), (["1", "x"], "string"),
    (["1d"], "string"), (["1,000"], "string"), (["9223372036854775807"], "long"), (["9223372036854775808"], "string"),
    (["-9223372036854775808", "1"], "long"), (["yes"], "string"), (["2020-01-02"], "string")])
def test_kind_of_a_column(spark, cells, kind):
    assert infer.kind_of(_classes(spark, cells)) == kind


def test_states_merge_in_any_order(spark):
    cells = ["1", None, "2.5", "x", "True", "99999999999999999999"]
    states = [_classes(spark, [c]) for c in cells]
    assert states == [LONG, MISSING, DOUBLE, TEXT, BOOLEAN, WIDE]
    whole = _classes(spark, cells)
    for order in (states, states[::-1]):
        merged = 0
        for state in order:
            merged |= state
        assert merged == whole


def _dates(spark, path, *files):
    for k, cells in enumerate(files):
        spark.createDataFrame([(c, k) for c in cells], "date string, n int").coalesce(1).write.mode("append") \
            .option("header", True).csv(f"{path}")
    return ingest.profile_dataset(ingest.read_csv_text(spark, path), "competitions")


@pytest.mark.parametrize("cells, rule, layout", [
    (["02/01/2020", "13/01/2020"], "first", "M/d/yyyy"), (["02/01/2020", "13/01/2020"], "vote", "d/M/yyyy"),
    (["13/01/2020", "02/01/2020"], "first", "d/M/yyyy"), (["Jan 2, 2020"], "first", "MMM d, yyyy"),
    (["2020-01-02T10:00:00", "2020-01-03"], "first", "yyyy-MM-dd'T'HH:mm:ss"), (["N/A", "20200102"], "first", "yyyyMMdd"),
    (["junk", "2020-01-02"], "first", "yyyy-MM-dd"), (["2020-02-30", "2.1.2020"], "first", "M.d.yyyy"),
    ([None, "N/A"], "first", "yyyy-MM-dd")])
def test_layout_of_a_column(spark, scratch, cells, rule, layout):
    found = _dates(spark, scratch, cells)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert found.layouts(rule)["date"] == layout


def test_first_cell_is_the_first_of_the_first_file_however_tasks_fall(spark, scratch):
    cells = ["13/01/2020"] + ["02/01/2020"] * 5000
    spark.createDataFrame([(c,) for c in cells], "date string").coalesce(1).write.option("header", True).csv(scratch)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        raw = ingest.read_csv_text(spark, scratch)
        assert raw.rdd.getNumPartitions() > 3
        date = infer.profile(raw, [], ["date"]).dates["date"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert date.first[3] == "13/01/2020" and date.chosen() == "d/M/yyyy" and date.cells == 5001
    assert date.votes["M/d/yyyy"] == 5000 and date.votes["d/M/yyyy"] == 5001


def test_no_file_turns_to_null_in_silence(spark, scratch):
    found = _dates(spark, scratch, ["week 7", "week 8"])
    with pytest.raises(ValueError, match="no known date layout"):
        found.layouts()
    with pytest.warns(UserWarning, match="2 cells"):
        assert found.layouts(on_unknown="null")["date"] == "yyyy-MM-dd"
    mixed = _dates(spark, scratch + "-mixed", ["2020-01-02"] + ["2020-01-02 10:00:00"] * 2)
    with pytest.warns(UserWarning, match="1 of 3"):
        assert mixed.layouts()["date"] == "yyyy-MM-dd"


def test_profiles_of_two_loads_merge_to_that_of_both(spark, scratch):
    a = _dates(spark, scratch + "-a", ["13/01/2020"])
    b = _dates(spark, scratch + "-b", ["02/01/2020", None])
    both = a.merge(b)
    assert both.classes == {"n": LONG} and both.dates["date"].cells == 2
    assert both.dates["date"].chosen() == "d/M/yyyy" and b.merge(a).dates["date"].chosen() == "d/M/yyyy"


def test_games_and_extra_columns_get_types(spark, scratch):
    spark.createDataFrame([("1", "2.5", "true", "x"), ("2", "inf", "False", None)],
                          "game_id string, rate string, played string, note string") \
        .write.option("header", True).csv(scratch)
    games = ingest.load_dataset(spark, scratch, "games")
    assert games.dtypes == [("game_id", "bigint"), ("rate", "double"), ("played", "boolean"), ("note", "string")]
    assert sorted(tuple(r) for r in games.collect()) == [(1, 2.5, True, "x"), (2, float("inf"), False, None)]
    assert [t for _, t in ingest.load_dataset(spark, scratch, "games", infer_types=False).dtypes] == ["string"] * 4
    declared = ingest.load_dataset(spark, scratch, "games", types={"game_id": "string"})
    assert dict(declared.dtypes)["game_id"] == "string"


def test_columns_named_like_helpers(spark):
    df = spark.createDataFrame([("1", "2020-01-02", "x")], "row string, file string, c0 string")
    found = infer.profile(df, ["row", "c0"], ["file"])
    assert found.kinds() == {"row": "long", "c0": "string"} and found.layouts() == {"file": "yyyy-MM-dd"}


def test_command_line_options_reach_the_loader(spark, scratch):
    from kickledger import __main__ as cli

    raw, root = scratch + "/raw", scratch + "/wh"
    for name, text in (("player_valuations", "player_id,date,market_value_in_eur,current_club_id,note\n1,31.12.2019,5,7,-\n"),
                       ("competitions", "competition_id,name\nGB1,x\n"), ("players", "player_id,name\n1,a\n"),
                       ("appearances", "appearance_id,date\nz,01.02.2020\n"), ("clubs", "club_id,name\n7,b\n"),
                       ("games", "game_id,code\n1,007\n2,008\n")):
        spark.createDataFrame([(text.rstrip("\n"),)], "value string").coalesce(1).write.text(f"{raw}/{name}.csv")
    cli.main(["ingest", "--raw", raw, "--warehouse", root, "--master", "local[4]", "--missing", "-",
              "--types", "games.code=string"])
    read = lambda name: spark.read.parquet(f"{root}/raw/{name}")
    row = read("player_valuations").first()
    assert str(row.date) == "2019-12-31 00:00:00" and row.note is None
    assert sorted(tuple(r) for r in read("games").collect()) == [(1, "007"), (2, "008")]
    assert str(read("appearances").first().date) == "2020-01-02 00:00:00"  # month first, as its only cell allows
    with pytest.raises(SystemExit):
        cli.main(["ingest", "--raw", raw, "--warehouse", root, "--types", "games.code=number"])


def test_layouts_fold_by_number_and_read_as_their_parser(spark):
    """No minimum of structs over the rows (a sort aggregate); bits equal those of trying every layout on every cell."""
    from pyspark.sql import functions as F

    from kickledger.functions.coerce import to_timestamp_or_null

    cells = ["1/2/2020", "13/2/2020", "2/13/2020", "13/13/2020", "31/2/2020", "0/1/2020", "1/0/2020", "00/01/2020", "29/2/2019",
             "12/12/2020 10:00:00", "13/12/2020 24:00:00", "1.2.2020", "31.12.2020 23:59:59", "1-2-2020", "31-1-2020", "2020/1/2",
             "20200102", "20201301", "Jan 2, 2020", "2 Jan 2020", "2020-01-02T10:00:00", "2020-01-02 10:00", "2020-02-30", "2020-01-02",
             "x", "1/2/20200", "12 /1/2020", "٣/1/2020"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    names = list(infer.LAYOUTS)
    iso = names.index("yyyy-MM-dd")
    tried = [F.coalesce(F.when(F.col("c").rlike(infer.LAYOUTS[n]), to_timestamp_or_null("c", n).isNotNull()), F.lit(False))
             for n in names]
    rows = df.select("c", infer._layout_bits(F.col("c")).alias("bits"), *[t.alias(f"t{j}") for j, t in enumerate(tried)]).collect()
    for r in rows:
        assert r.bits == (1 << iso if r[f"t{iso}"] else sum(1 << j for j in range(len(names)) if r[f"t{j}"])), r.c
    date = infer.profile(df, [], ["c"]).dates["c"]
    assert date.cells == len(cells) and date.first[3:] == (cells[0], rows[0].bits)
    assert date.votes == {n: sum(r.bits >> j & 1 for r in rows) for j, n in enumerate(names)}


def test_cells_without_a_pattern_have_the_class_and_the_date_the_patterns_give(spark):
    cells = ["12", " 12", "12 ", "+12", "012345678901234567", "9223372036854775807", "9223372036854775808", "1.5", "5.", "1e5",
             "1d", "12\x01", "12\t", "1-URGENT", "1é", "inf", "Iceland", "True", "tRue", "False", "abc", "é", "", "nan", "1.#IND",
             "2020-01-01", "2020-01-1 ", "2020-01-1T", "2020-1-1  ", "\t020-01-01", "+202-01-01", "2015-02-30", "2020-01-0１"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    rows = df.select("c", infer.cell_class(F.col("c"), ()).alias("got"),
                     infer._class_by_pattern(F.col("c")).alias("pattern"),
                     infer._layout_bits(F.col("c")).alias("bits")).collect()
    assert [r.got for r in rows] == [r.pattern for r in rows]
    assert [r.c for r in rows if r.bits] == ["2020-01-01"]
