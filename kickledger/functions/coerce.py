"""Tolerant typing of raw text cells: a bad cell becomes NULL, not a failed job.

All expressions are built-in Spark SQL functions, so they stay inside
whole-stage codegen. ANSI mode is on by default in Spark 4, where a plain
``cast`` or ``to_date`` would raise on bad input; the ``try_`` forms return
NULL instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The accepted shape of a number (optional sign, digits with an
# optional dot or a leading dot, optional exponent, surrounding blanks).
# '1d' and '1,000' are rejected, which Spark's own cast would not do for '1d'.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
DATE_FORMAT = "yyyy-MM-dd"
MISSING_TEXT = "nan"

# Cells that stand for a missing value.
MISSING_MARKERS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                   "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

_TWO_63 = 9223372036854775808.0


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def apart(cell: Column, of) -> Column:
    """``of(cell)``, for expressions of very many branches, and for those that few cells need.

    Inlined into the loop that reads the rows, such a one makes a method too
    large for the JVM to compile, and every row is interpreted. The body of a
    lambda stays out of that loop.
    """
    return F.get(F.transform(F.array(cell), of), 0)


def _iso_date_or_null(text: Column) -> Column:
    """``yyyy-MM-dd`` text to a date without a formatter: the exact shape is
    checked with string functions (ten characters, dashes at 5 and 8, a digit
    at the end), the rest by the cast (2015-02-30 is NULL). The cast takes
    nothing but digits before and between such dashes, but a blank or a 'T'
    after a day of one digit, so the last character is looked at."""
    shaped = ((F.length(text) == 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
              & F.substring(text, 10, 1).between("0", "9"))
    return F.when(shaped, text.try_cast("date"))


def to_date_or_null(col, fmt: str = DATE_FORMAT) -> Column:
    """Parse text with one explicit format; anything else (impossible dates
    such as 2015-02-30, other layouts, a time of day, junk) is NULL."""
    text = _c(col).cast("string")
    if fmt == DATE_FORMAT:
        return _iso_date_or_null(text)
    return F.try_to_timestamp(text, F.lit(fmt)).cast(T.DateType())


def to_timestamp_or_null(col, fmt: str = DATE_FORMAT) -> Column:
    text = _c(col).cast("string")
    if fmt == DATE_FORMAT:
        return _iso_date_or_null(text).cast(T.TimestampNTZType())
    return F.try_to_timestamp(text, F.lit(fmt)).cast(T.TimestampNTZType())


def _numeric_text(col) -> Column:
    """The trimmed text when it looks like a number, else NULL."""
    text = F.trim(_c(col).cast("string"))
    return F.when(text.rlike(NUMBER_PATTERN), text)


def to_double_or_null(col) -> Column:
    return _numeric_text(col).try_cast("double")


def to_long_or_null(col, on_fraction: str = "null") -> Column:
    """Whole numbers to 64-bit integers.

    Integer text converts directly (exact for large values); other accepted
    shapes ('1e3', '5.') go through double. A fractional value is NULL, or
    raises a task error with ``on_fraction="raise"``.
    """
    if on_fraction not in ("null", "raise"):
        raise ValueError(f"on_fraction must be 'null' or 'raise', not {on_fraction!r}")

    def by_pattern(text: Column) -> Column:
        as_double = text.try_cast("double")
        whole = (as_double == F.floor(as_double)) & (as_double >= -_TWO_63) & (as_double < _TWO_63)
        fallback = F.when(whole, as_double.cast("bigint"))
        if on_fraction == "raise":
            fallback = fallback.when(as_double.isNotNull(),
                                     F.raise_error(F.lit("fractional value for an integer column")))
        return F.when(text.rlike(NUMBER_PATTERN), fallback)

    text = F.trim(_c(col).cast("string"))
    return F.coalesce(text.try_cast("bigint"), apart(text, by_pattern))      # clean cells need no pattern


def to_loader_double(col) -> Column:
    """Numbers, and ``inf`` with or without a sign, as the loader reads them."""
    text = F.trim(_c(col).cast("string"))
    return F.when(F.lower(text).rlike("^[+-]?inf(inity)?$"), F.when(text.startswith("-"), F.lit(float("-inf")))
                  .otherwise(F.lit(float("inf")))).otherwise(to_double_or_null(col))


def to_boolean_or_null(col) -> Column:
    """``true`` and ``false`` in any of the loader's three spellings; anything else is NULL."""
    text = _c(col).cast("string")
    return F.when(text.isin("True", "TRUE", "true"), F.lit(True)).when(text.isin("False", "FALSE", "false"), F.lit(False))


def nan_to_null(col) -> Column:
    """Spark keeps NaN as a value (the largest one in max); make it missing."""
    c = _c(col)
    return F.when(~F.isnan(c), c)


def stringify(col, missing: str = MISSING_TEXT) -> Column:
    """Text form of a value; a missing value becomes the literal ``missing``."""
    return F.coalesce(_c(col).cast("string"), F.lit(missing))


def stringify_text_columns(df: DataFrame, missing: str = MISSING_TEXT,
                           columns: list[str] | None = None) -> DataFrame:
    """Apply ``stringify`` to every text column (or to ``columns``) in one select."""
    chosen = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select([stringify(F.col(f"`{n}`"), missing).alias(n) if n in chosen else F.col(f"`{n}`")
                      for n in df.columns])


KIND_CASTS = {
    "timestamp": to_timestamp_or_null,
    "date": to_date_or_null,
    "long": to_long_or_null,
    "double": to_double_or_null,
    "loader_double": to_loader_double,
    "boolean": to_boolean_or_null,
    "string": lambda c: _c(c).cast("string"),
}


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _typed_cast(col: Column, dtype: T.DataType, kind: str) -> Column:
    """Kind cast for a column that is already typed (a Parquet source):
    numbers and times convert directly; a fraction or NaN headed for an
    integer column, or a NaN headed for a double column, becomes NULL."""
    if kind in ("timestamp", "date") and isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col.cast(T.TimestampNTZType() if kind == "timestamp" else T.DateType())
    if kind == "long" and isinstance(dtype, _NUMERIC):
        if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
            d = col.cast("double")
            whole = ~F.isnan(d) & (d == F.floor(d)) & (d >= -_TWO_63) & (d < _TWO_63)
            return F.when(whole, d.cast("bigint"))
        return col.cast("bigint")
    if kind == "double" and isinstance(dtype, _NUMERIC):
        return nan_to_null(col.cast("double"))
    return KIND_CASTS[kind](col)


def coerce_columns(df: DataFrame, kinds: dict[str, str], date_format: str | dict[str, str] = DATE_FORMAT,
                   missing: tuple[str, ...] = ()) -> DataFrame:
    """Type the named columns by kind in one projection; others pass through.

    Text columns go through the tolerant parsers; columns that already carry
    a number or time type convert directly. Named columns that the input
    lacks are skipped, so an optional column (such as the competitions
    ``date``) is coerced only when present. Text dates follow
    ``date_format``, one layout or one per column; text equal to one of
    ``missing`` becomes NULL.
    """
    exprs = []
    layouts = date_format if isinstance(date_format, dict) else {}
    usual = DATE_FORMAT if isinstance(date_format, dict) else date_format
    for field in df.schema.fields:
        kind = kinds.get(field.name)
        col = F.col(f"`{field.name}`")
        is_text = isinstance(field.dataType, T.StringType)
        if is_text and missing and kind in (None, "string"):
            exprs.append(F.when(~col.isin(*missing), col).alias(field.name))
        elif not kind:
            exprs.append(col)
        elif is_text and kind in ("timestamp", "date"):
            exprs.append(KIND_CASTS[kind](col, layouts.get(field.name, usual)).alias(field.name))
        elif is_text or kind == "string":
            exprs.append(KIND_CASTS[kind](col).alias(field.name))
        else:
            exprs.append(_typed_cast(col, field.dataType, kind).alias(field.name))
    return df.select(exprs)
