"""Spark expressions against plain-Python statements of the same rules, on generated text."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kickledger.functions import coerce, text

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
SLUG_CHARS = st.sampled_from(list("abcXYZ-- é0"))
NUMBER_CHARS = st.sampled_from(list("0123456789+-.eE dx,"))


def titled(s: str) -> str:
    """Each '-'-separated part: first character upper case, the rest lower case."""
    return " ".join(part[:1].upper() + part[1:].lower() for part in s.split("-"))


@SETTINGS
@given(st.lists(st.text(SLUG_CHARS, max_size=12), min_size=1, max_size=60))
def test_slug_title_matches_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r.t for r in df.select(text.slug_title("s").alias("t")).collect()]
    assert got == [titled(v) for v in values]


def pandas_whole_number(s: str):
    """What pandas makes of a cell headed for a nullable integer column (fractions -> missing)."""
    x = pd.to_numeric(pd.Series([s], dtype=object), errors="coerce").iloc[0]
    if x is None or (isinstance(x, float) and (math.isnan(x) or math.isinf(x) or x != math.floor(x))):
        return None
    return int(x)


@SETTINGS
@given(st.lists(st.text(NUMBER_CHARS, max_size=8), min_size=1, max_size=60))
def test_whole_numbers_match_pandas(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r.n for r in df.select(coerce.to_long_or_null("s").alias("n")).collect()]
    want = [pandas_whole_number(v) for v in values]
    # pandas reads '' as missing and strips blanks; so do we. Large exponents overflow both ways.
    assert [g for g, w in zip(got, want) if g != w and not (w is not None and abs(w) >= 2**63)] == []
