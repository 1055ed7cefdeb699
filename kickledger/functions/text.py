"""Text helpers of the reports, all as built-in expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Axis units by step size, and the Markdown image wrapper.
UNIT_BILLION, UNIT_MILLION, UNIT_THOUSAND = "B", "M", "K"
DATA_URI_PREFIX = "![Image](data:image/jpeg;base64,"
DATA_URI_SUFFIX = ")"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def slug_title(col) -> Column:
    """``premier-league`` -> ``Premier League``.

    Split on every ``-``, upper-case the first character of each part and
    lower-case the rest, join with one space. Unlike ``initcap`` a space
    inside a part is not a word break: ``super league-FOO`` -> ``Super league Foo``.
    """
    parts = F.split(_c(col), "-", -1)
    titled = F.transform(parts, lambda s: F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 1 << 30))))
    return F.array_join(titled, " ")


def league_label(name, country) -> Column:
    """``name (country)``; NULL when either part is NULL."""
    return F.concat(_c(name), F.lit(" ("), _c(country), F.lit(")"))


def axis_unit(step: float) -> str:
    return UNIT_BILLION if step >= 1_000_000_000 else UNIT_MILLION if step >= 1_000_000 else UNIT_THOUSAND


def humanize(col, step: float = 1_000_000_000) -> Column:
    """Axis label: ``x / step`` rounded half to even, then the unit letter."""
    scaled = F.bround(_c(col) / F.lit(float(step)), 0)
    return F.concat(scaled.cast("bigint").cast("string"), F.lit(axis_unit(step)))


def base64_text(spark: SparkSession, col) -> Column:
    """Base64 of bytes as one line.

    Spark can break the output into 76-character lines; the line breaks are
    removed unless the session already turns that off.
    """
    encoded = F.base64(_c(col))
    chunked = spark.conf.get("spark.sql.legacy.chunkBase64String.enabled", "true").lower() != "false"
    return F.regexp_replace(encoded, "\r\n", "") if chunked else encoded


def data_uri_markdown(spark: SparkSession, col) -> Column:
    """Markdown image with the bytes inlined as a data URI."""
    return F.concat(F.lit(DATA_URI_PREFIX), base64_text(spark, col), F.lit(DATA_URI_SUFFIX))


def fill_template(template: str, col) -> Column:
    """``'data/{}.png'`` with ``{}`` replaced by the column value."""
    return F.format_string(template.replace("%", "%%").replace("{}", "%s"), _c(col))
