import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from kickledger.functions import coerce


def one_column(spark, values, ddl="s string"):
    return spark.createDataFrame([(v,) for v in values], ddl)


def test_bad_dates_become_null(spark):
    values = ["2015-01-01", "bad", "2015-02-30", "2015-01-01 10:00:00", None, "2015-1-01", "2015-01-1 ",
              "2015/01/01", "2015-01", "20150-1-01", "2024-02-29", "2023-02-29"]
    out = one_column(spark, values).select(coerce.to_date_or_null("s").cast("string").alias("d")).collect()
    assert [r.d for r in out] == ["2015-01-01", None, None, None, None, None, None, None, None, None,
                                  "2024-02-29", None]
    other = one_column(spark, ["01.02.2015", "2015-01-01"]).select(
        coerce.to_date_or_null("s", "dd.MM.yyyy").cast("string").alias("d")).collect()
    assert [r.d for r in other] == ["2015-02-01", None]


def test_bad_numbers_become_null(spark):
    values = ["1", "x", " 7 ", "1e3", "1d", "1,000", "", "+5", "5.", ".5e1", None]
    out = one_column(spark, values).select(coerce.to_long_or_null("s").alias("n")).collect()
    assert [r.n for r in out] == [1, None, 7, 1000, None, None, None, 5, 5, 5, None]


def test_fraction_is_null_or_raises(spark):
    df = one_column(spark, ["1.5"])
    assert df.select(coerce.to_long_or_null("s").alias("n")).first().n is None
    with pytest.raises(PySparkException):
        df.select(coerce.to_long_or_null("s", on_fraction="raise").alias("n")).collect()


def test_large_integer_text_is_exact(spark):
    out = one_column(spark, ["9007199254740993"]).select(coerce.to_long_or_null("s").alias("n")).first()
    assert out.n == 9007199254740993


def test_doubles(spark):
    values = ["1.25", "1d", "nan", "inf", " -2 "]
    out = one_column(spark, values).select(coerce.to_double_or_null("s").alias("x")).collect()
    assert [r.x for r in out] == [1.25, None, None, None, -2.0]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r.x for r in df.select(coerce.nan_to_null("x").alias("x")).collect()] == [None, 1.0]


def test_stringify_text_columns_only(spark):
    df = spark.createDataFrame([(None, None, 1), ("a", 2, None)], "s string, n int, m int")
    out = coerce.stringify_text_columns(df).collect()
    assert out[0].s == "nan" and out[0].n is None and out[1].s == "a"
    assert coerce.stringify_text_columns(df, columns=["n"]).collect()[0].n == "nan"


def test_coerce_columns_skips_absent(spark):
    df = spark.createDataFrame([("2020-01-02", "x")], "date string, other string")
    out = coerce.coerce_columns(df, {"date": "timestamp", "url": "string"})
    assert out.columns == ["date", "other"]
    assert str(out.first().date) == "2020-01-02 00:00:00"
    assert out.schema["date"].dataType.typeName() == "timestamp_ntz"
    assert out.select(F.col("other")).first().other == "x"
