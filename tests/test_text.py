from pyspark.sql import functions as F

from kickledger.functions import text


def test_slug_title(spark):
    values = ["premier-league", "super league-FOO", "a--b", "-x", "nan", None]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    out = [r.t for r in df.select(text.slug_title("s").alias("t")).collect()]
    assert out == ["Premier League", "Super league Foo", "A  B", " X", "Nan", None]


def test_humanize_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0.5e9,), (1.5e9,), (2.5e9,), (None,)], "x double")
    out = [r.h for r in df.select(text.humanize("x", 1_000_000_000).alias("h")).collect()]
    assert out == ["0B", "2B", "2B", None]
    assert text.axis_unit(1_000_000) == "M" and text.axis_unit(1_000) == "K"


def test_league_label_is_null_safe_concat(spark):
    df = spark.createDataFrame([("Premier League", "England"), ("X", None)], "n string, c string")
    assert [r.l for r in df.select(text.league_label("n", "c").alias("l")).collect()] == [
        "Premier League (England)", None]


def test_base64_has_no_line_breaks(spark):
    df = spark.createDataFrame([("x" * 500,)], "s string")
    out = df.select(text.data_uri_markdown(spark, F.col("s").cast("binary")).alias("m")).first().m
    assert "\r" not in out and "\n" not in out
    assert out.startswith("![Image](data:image/jpeg;base64,eHh4") and out.endswith(")")


def test_fill_template(spark):
    df = spark.createDataFrame([("GB1",)], "k string")
    assert df.select(text.fill_template("data/logos/{}.png", "k").alias("p")).first().p == "data/logos/GB1.png"
