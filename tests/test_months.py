import datetime as dt

from pyspark.sql import functions as F

from kickledger.functions import months
from kickledger.sources.warehouse import month_keys


def ts_frame(spark, values):
    return spark.createDataFrame([(dt.datetime.fromisoformat(v) if v else None,) for v in values],
                                 "ts timestamp_ntz")


def keys(df):
    return sorted((str(r.ts), r.partition_date) for r in df.collect())


def test_closed_and_half_open_windows(spark):
    df = ts_frame(spark, ["2024-01-31 00:00:00", "2024-01-31 10:00:00", "2024-02-01 00:00:00", None])
    closed = keys(months.with_month(df, "ts", closed=True))
    half = keys(months.with_month(df, "ts", closed=False))
    assert closed == [("2024-01-31 00:00:00", "2024-01"), ("2024-02-01 00:00:00", "2024-02")]
    assert half == [("2024-01-31 00:00:00", "2024-01"), ("2024-01-31 10:00:00", "2024-01"),
                    ("2024-02-01 00:00:00", "2024-02")]
    assert set(closed) <= set(half)


def test_leap_day_and_day_keys(spark):
    df = ts_frame(spark, ["2024-02-29 00:00:00"])
    assert keys(months.with_month(df, "ts")) == [("2024-02-29 00:00:00", "2024-02")]
    assert months.with_month(df, "ts", key="day").first().partition_date == "2024-02-01"


def test_window_excludes_outside_calendar(spark):
    df = spark.createDataFrame([(dt.date(2014, 12, 31),), (dt.date(2015, 1, 1),), (dt.date(2026, 1, 1),)], "d date")
    inside = df.where(months.in_window("d", months.CALENDAR_START, months.CALENDAR_END)).collect()
    assert [r.d for r in inside] == [dt.date(2015, 1, 1)]


def test_calendar_has_132_months(spark):
    cal = months.calendar(spark).orderBy("month").collect()
    assert len(cal) == 132
    assert (cal[0].month_key, cal[0].partition_key) == ("2015-01", "2015-01-01")
    assert cal[-1].month_key == "2025-12"
    assert len(month_keys(months.CALENDAR_START, months.CALENDAR_END)) == 132


def test_calendar_of_data_and_missing_months(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 5),), (dt.date(2020, 4, 1),), (None,)], "d date")
    cal = months.calendar_of(df, "d")
    assert [r.month_key for r in cal.orderBy("month").collect()] == ["2020-01", "2020-02", "2020-03", "2020-04"]
    gaps = months.missing_months(cal, df, "d").orderBy("month").collect()
    assert [r.month_key for r in gaps] == ["2020-02", "2020-03"]


def test_key_to_date_accepts_both_forms(spark):
    df = spark.createDataFrame([("2020-03",), ("2020-03-01",)], "k string")
    assert {r.d for r in df.select(months.key_to_date("k").alias("d")).collect()} == {dt.date(2020, 3, 1)}


def test_month_end_and_next(spark):
    row = spark.range(1).select(months.month_end(F.lit("2024-02-10")).alias("e"),
                                months.next_month(F.lit("2024-01-31")).alias("n")).first()
    assert row.e == dt.date(2024, 2, 29) and row.n == dt.date(2024, 2, 29)


def test_half_open_and_closed_month_predicates(spark):
    df = ts_frame(spark, ["2024-01-31 10:00:00", "2024-02-01 00:00:00"])
    m = F.lit("2024-01-01")
    out = df.select(months.half_open_month("ts", m).alias("h"), months.closed_month("ts", m).alias("c")).collect()
    assert [(r.h, r.c) for r in out] == [(True, False), (False, False)]


def test_month_key_is_the_formatters_for_every_year(spark):
    days = spark.range(-800000, 3700000, 2999).select(
        F.date_add(F.lit("1970-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    assert days.where(~F.date_format("d", "yyyy-MM").eqNullSafe(months.month_key("d"))).count() == 0
