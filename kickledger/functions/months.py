"""Month keys, month windows and the month calendar.

Two key formats are visible in the warehouse: base tables key a month as
``YYYY-MM``, rollup tables as ``YYYY-MM-01``. Both are text.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The monthly calendar (start inclusive, end exclusive).
CALENDAR_START = "2015-01-01"
CALENDAR_END = "2026-01-01"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_start(col) -> Column:
    """First day of the month of a date or timestamp, as a date."""
    return F.trunc(_c(col).cast("date"), "month")


def month_key(col) -> Column:
    """``YYYY-MM`` (the base-table key), put together from two numbers; a formatter, which costs each row several
    times as much, takes the years that have no four digits."""
    year, month = F.year(_c(col)), F.month(_c(col))
    text = F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))
    return F.when(year.between(1, 9999), text).otherwise(F.date_format(_c(col), "yyyy-MM"))


def month_start_key(col) -> Column:
    """``YYYY-MM-01`` (the rollup-table key)."""
    return F.date_format(month_start(col), "yyyy-MM-dd")


def key_to_date(col) -> Column:
    """Strict parse of a ``YYYY-MM-DD`` or ``YYYY-MM`` key to the month's first day."""
    c = _c(col)
    return F.to_date(F.when(F.length(c) == 7, F.concat(c, F.lit("-01"))).otherwise(c), "yyyy-MM-dd")


def next_month(col) -> Column:
    return F.add_months(_c(col).cast("date"), 1)


def month_end(col) -> Column:
    return F.last_day(_c(col).cast("date"))


def half_open_month(ts, month_first_day) -> Column:
    """``month <= ts < month + 1 month``."""
    m = _c(month_first_day).cast("date")
    t = _c(ts)
    return (t >= m.cast("timestamp_ntz")) & (t < next_month(m).cast("timestamp_ntz"))


def closed_month(ts, month_first_day) -> Column:
    """``month <= ts <= last day of month at 00:00`` (later times on the last
    day fall in no month)."""
    m = _c(month_first_day).cast("date")
    t = _c(ts)
    return (t >= m.cast("timestamp_ntz")) & (t <= month_end(m).cast("timestamp_ntz"))


def in_window(col, start: str, end: str) -> Column:
    """``start <= col < end`` with ``start``/``end`` as ``YYYY-MM-DD`` text."""
    c = _c(col)
    return (c >= F.lit(start).cast("date")) & (c < F.lit(end).cast("date"))


def with_month(df: DataFrame, ts_col: str, closed: bool = False,
               key: str = "month", name: str = "partition_date") -> DataFrame:
    """Tag each row with the month it is loaded into, in one pass over all months.

    With ``closed=True`` rows later than 00:00 on the last day of their month
    belong to no month and are dropped; NULL times always drop.
    """
    ts = F.col(ts_col)
    first = month_start(ts)
    keep = ts.isNotNull()
    if closed:
        keep = keep & closed_month(ts, first)
    key_col = month_key(first) if key == "month" else month_start_key(first)
    return df.where(keep).withColumn(name, key_col)


def calendar(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per month from ``start`` to ``end`` (exclusive), both key forms.

    A helper for the pipeline; data queries derive their window with
    ``calendar_of``.
    """
    s = _dt.date.fromisoformat(start)
    e = _dt.date.fromisoformat(end)
    if e <= s:
        return spark.createDataFrame([], "month date, month_key string, partition_key string")
    return _expand(spark.range(1).select(F.lit(start).cast("date").alias("lo"),
                                         F.add_months(F.lit(end).cast("date"), -1).alias("hi")))


def calendar_of(df: DataFrame, date_col: str) -> DataFrame:
    """Months from the first to the last month that ``date_col`` reaches."""
    bounds = df.agg(month_start(F.min(date_col)).alias("lo"), month_start(F.max(date_col)).alias("hi"))
    return _expand(bounds.where(F.col("lo").isNotNull()))


def _expand(bounds: DataFrame) -> DataFrame:
    months = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month"))
    return months.select("month", month_key("month").alias("month_key"),
                         F.date_format("month", "yyyy-MM-dd").alias("partition_key"))


def missing_months(months: DataFrame, data: DataFrame, date_col: str) -> DataFrame:
    """Calendar months that hold no row of ``data`` (which keys still need a load)."""
    present = data.where(F.col(date_col).isNotNull()).select(month_start(date_col).alias("month")).distinct()
    return months.join(present, "month", "left_anti")
