"""Exact deduplication by a tree merge of digest runs, in DataFrame operations only.

Every row becomes a digest entry: a 64-bit digest to sort and exchange by,
and what verifies it (SHA-256 and byte length). Rows are dealt over R runs
by a hash of their id. A run lies in digest ranges, each range sorted in one
task: equal entries stand side by side and fold into one (the id that stays,
the number of rows) as they are read. Runs merge in rounds: in round k the
runs whose numbers agree after dropping k base-F digits exchange range by
range and merge in digest order into one, F at a time, so log_F(R) rounds
leave one run with one entry per text, still in ranges. Every level compares
digest AND verification, so a collision of the short digest never joins
different texts.

A text with a third of all rows sends at most one entry per run and level,
so no task receives its rows; the answer returns to the rows by a join on
(run, digest), where the hot text is spread over all runs again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import common

FAN_IN = 8
RANGE_BITS = 16   # leading digest bits that name a range: how far a run, the last one too, spreads over tasks
_ENTRY = ["digest", "text_sha256", "n_bytes"]


def runs_for(spark: SparkSession, fan_in: int = FAN_IN) -> int:
    """A power of the fan-in, at least the number of shuffle partitions."""
    return fan_in ** max(1, math.ceil(math.log(max(2, common.shuffle_width(spark)), fan_in)))


def digests(docs: DataFrame, runs: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document; ``row`` tells repeated rows of one id apart."""
    rows = common.ids_and_texts(docs, id_col, text_col)
    text = F.col("text")
    return rows.select(
        "doc_id", F.monotonically_increasing_id().alias("row"),
        F.xxhash64(text).alias("digest"), common.sha256_hex(text).alias("text_sha256"),
        F.octet_length(text).cast("long").alias("n_bytes")
    ).withColumn("run", F.pmod(F.xxhash64("doc_id", "row"), F.lit(runs)).cast("int"))


def _merged(entries: DataFrame, keep: str) -> DataFrame:
    """Entries of one run number meet, range by range, sorted by digest; equal neighbours fold.

    The aggregation takes over the partitioning and the order: no further
    exchange, no hash table, one pass over sorted entries.
    """
    best = F.max if keep == "largest" else F.min
    key = ["run", "range", *_ENTRY]
    sorted_runs = entries.withColumn("range", F.shiftrightunsigned("digest", 64 - RANGE_BITS)) \
        .repartition("run", "range").sortWithinPartitions(*key)
    return sorted_runs.groupBy(*key).agg(best("stays").alias("stays"), F.sum("n").alias("n")).drop("range")


def tree_merge(rows: DataFrame, runs: int, fan_in: int, keep: str) -> DataFrame:
    """One entry per distinct text: (digest, text_sha256, n_bytes, stays, n).

    ``stays`` is struct(doc_id, row). Null ids order below all others, so
    with ``largest`` a row with an id wins over rows without one.
    """
    entries = _merged(rows.select("run", *_ENTRY, F.struct("doc_id", "row").alias("stays"),
                                  F.lit(1).cast("long").alias("n")), keep)
    while runs > 1:
        entries = _merged(entries.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")), keep)
        runs = max(1, runs // fan_in)
    return entries.drop("run")


def dedup(docs: DataFrame, keep: str = "largest", id_col: str = "doc_id", text_col: str = "text",
          fan_in: int = FAN_IN) -> DataFrame:
    """One row per input row: (doc_id, keep_id, group_size, kept, text_sha256).

    Texts are compared unchanged; a null text counts as empty, so null and
    empty texts form one group. Of equal texts the row with the largest id
    (``keep="smallest"``: smallest) stays; of repeated rows of that id
    exactly one is marked kept. An empty table gives no rows.
    """
    spark = docs.sparkSession
    runs = runs_for(spark, fan_in)
    rows = materialize(digests(docs, runs, id_col, text_col), "digests")
    merged = tree_merge(rows, runs, fan_in, keep)
    groups = merged.filter("n > 1").withColumnRenamed("n", "group_size")
    # The way back down: entries of the runs first, then rows, so the hot text's rows stay spread over the runs.
    back = rows.select("run", *_ENTRY).groupBy("run", *_ENTRY).agg(F.lit(1).alias("one")).drop("one") \
        .join(groups, _ENTRY)
    joined = rows.join(back, ["run", *_ENTRY], "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("stays.row") == F.col("row"))).alias("kept"), "text_sha256")


def same_text(text_col: str = "text") -> Column:
    """The SHA-256 that ``dedup`` reports for a row's text."""
    return common.sha256_hex(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(common.table(spark, sf_dir, "documents"))


OP5_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.body) AS text_sha256
FROM t JOIN g ON t.body = g.body
"""
