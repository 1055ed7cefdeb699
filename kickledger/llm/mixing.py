"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Every source wants its share, by weight, of a word budget. A source that
would be read more than ``max_epochs`` times is clamped there, and what it
can't take is shared again by weight among the others, until none is above
its cap. A source's target is then met by whole repetitions of all its
documents, a further one of those first in a seeded order, and a part of
the one document where that order meets the target.

Sizes are integers and the share of an open source is one fraction, so the
clamping decides in exact integers. Sources are numbered and clamped as
DataFrames of one row per source; rounds collect three sums. The meeting
point is found in two steps: sums over blocks of the seeded order, then the
rows of a single block; so no task receives a source's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from . import common

WEIGHTS = (5, 2, 1)
BUDGET = (3, 2)          # the mix holds 3 / 2 of all words
MAX_EPOCHS = 2
SEED = 20
ROWS_PER_BLOCK = 1024    # at least; a source of n rows has blocks of about sqrt(n), as many as rows in one
COPIES_A_ROW = 1 << 16   # rows alike leave one entry in this many pieces before they are written out again
_WIDE = "decimal(38,0)"


def words_of(text: Column) -> Column:
    """Number of words: maximal runs without a blank, tab, line feed, vertical tab, form feed or carriage return."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def numbered(sources: DataFrame) -> DataFrame:
    """The sources with ``place``: 0, 1, ... in code point order, a null source last.

    Ranges of names are numbered each for itself and shifted by the counts of
    the ranges before, so one task never holds all names.
    """
    ranged = sources.withColumn("unnamed", F.col("source").isNull()).repartitionByRange("unnamed", "source")
    ranged = materialize(ranged.withColumn("range", F.spark_partition_id()), "mix-sources")
    inside = W.partitionBy("range").orderBy("unnamed", "source")
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    firsts = ranged.groupBy("range").agg(F.count("*").alias("n")).select(
        "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return ranged.withColumn("inside", F.row_number().over(inside) - 1).join(firsts, "range") \
        .withColumn("place", F.col("first") + F.col("inside")).drop("range", "first", "inside", "unnamed")


def water_fill(sources: DataFrame, budget: tuple[int, int] = BUDGET, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, weight, ...) with ``target`` (double) and ``wanted`` (long, the target's whole words).

    A round clamps every open source whose share passes ``max_epochs`` times
    its size; the shares that are left grow, so a clamped source never opens
    again and the rounds end when none is above. Shares are compared as
    integers: weight * rest > cap * open weight.
    """
    part, whole = budget
    stored = materialize(sources.withColumn("cap", F.col("source_size") * max_epochs), "mix-shares")
    total = int(stored.agg(F.sum("source_size")).first()[0] or 0)
    if part > max_epochs * whole:
        raise ValueError("the budget is more than max_epochs times all words")
    rest, open_weight = total * part, int(stored.agg(F.sum("weight")).first()[0] or 1)
    clamped = 0

    def above(rest: int, open_weight: int) -> Column:
        return F.col("weight").cast(_WIDE) * F.lit(rest).cast(_WIDE) > \
            F.col("cap").cast(_WIDE) * F.lit(open_weight * whole).cast(_WIDE)

    while True:
        n, caps, weights = stored.filter(above(rest, open_weight)).agg(
            F.count("*"), F.sum("cap"), F.sum("weight")).first()
        if n == clamped:
            break
        clamped = n
        rest = total * part - int(caps) * whole
        open_weight = max(1, int(stored.agg(F.sum("weight")).first()[0]) - int(weights))
    share, below = F.col("weight") * F.lit(rest), F.lit(open_weight * whole)
    filled = stored.withColumn("capped", above(rest, open_weight)).withColumn("share", share.cast("long"))
    return filled.select(
        *sources.columns,
        F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
            F.col("share").cast("double") / below.cast("double")).alias("target"),
        F.when(F.col("capped"), F.col("cap")).otherwise(
            F.expr(f"share div {open_weight * whole}L")).cast("long").alias("wanted"))


def _further(left: Column, size: Column) -> Column:
    """What a row takes beyond its whole repetitions, where ``left`` words are wanted from it on."""
    return F.least(size, F.greatest(F.lit(0).cast("long"), left))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: tuple[int, int] = BUDGET,
        max_epochs: int = MAX_EPOCHS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """One row per document: (doc_id, source, size, source_size, target, taken); size and taken in words.

    ``taken`` is the size times the document's whole repetitions, and for the
    one document of a source where the seeded order meets the target a part
    of a further one, so a source's taken words are its target's whole words.
    The order depends on seed, doc_id and size alone; reruns agree.

    A null text has size 0; documents of size 0 take nothing. Rows without a
    source are a source of their own, the last. Rows alike in source, id and
    size can't be told apart: each keeps a row, and as many of them are
    repeated as the target asks for. Where all sizes are 0 every target is
    0. An empty table gives no rows. Other columns are not read.
    """
    mark = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                                      F.lit(":"), F.col("size").cast("string"))), 1, 16)
    sizes = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[source_col].cast("string").alias("source"),
                        words_of(docs[text_col].cast("string")).alias("size")).withColumn("mark", mark)
    sizes = materialize(sizes, "mix-sizes")
    sources = numbered(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows")))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    filled = water_fill(sources.withColumn("weight", weight.cast("long")).drop("place"), budget, max_epochs)
    some = F.greatest(F.col("source_size"), F.lit(1))
    filled = filled.withColumn("some", some).withColumn("whole", F.expr("wanted div some")).select(
        "source", "source_size", "target", "whole", (F.col("wanted") - F.col("whole") * F.col("some")).alias("extra"),
        F.expr(f"1 + n_rows div greatest({rows_per_block}L, CAST(sqrt(n_rows) AS BIGINT))").alias("blocks"))
    filled = materialize(filled, "mix-targets")

    spot = F.conv(F.substring("mark", 1, 8), 16, 10).cast("long")
    block = F.shiftright(spot * F.col("blocks"), 32)

    def with_source(rows: DataFrame, of: DataFrame, *more: str) -> DataFrame:
        """rows with the columns of ``of``, one row per source; null meets null."""
        right = of.withColumnRenamed("source", "of_source")
        met = rows["source"].eqNullSafe(right["of_source"])
        for name in more:
            right = right.withColumnRenamed(name, f"of_{name}")
            met = met & (rows[name] == right[f"of_{name}"])
        return rows.join(right, met).drop("of_source", *[f"of_{name}" for name in more])

    placed = with_source(sizes, filled).withColumn("block", block)
    in_order = W.partitionBy("source").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = placed.filter("size > 0").groupBy("source", "block").agg(
        F.sum("size").alias("words"), F.first("extra").alias("extra"))
    met_in = blocks.withColumn("before", F.coalesce(F.sum("words").over(in_order), F.lit(0))).filter(
        "before <= extra AND extra < before + words").select("source", "block", "before")
    met_in = materialize(met_in, "mix-blocks")
    by_mark = W.partitionBy("source").orderBy("mark", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(
        W.unboundedPreceding, -1)
    alike = ["source", "block", "mark", "doc_id", "size"]
    entries = with_source(placed.filter("size > 0"), met_in, "block").groupBy(*alike).agg(
        F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("extra", "before", "whole", "source_size", "target")])
    first = F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("copies")).over(by_mark), F.lit(0))
    cut = materialize(entries.withColumn("first", first).filter(
        "first <= extra AND extra < first + size * copies"), "mix-cut")

    at = cut.select("source", *[F.col(c).alias(f"cut_{c}") for c in alike[1:]])
    right = at.withColumnRenamed("source", "of_source")
    rows = placed.join(right, placed["source"].eqNullSafe(right["of_source"]), "left").drop("of_source")
    place = [F.struct(F.col(p + "block"), F.col(p + "mark"), F.col(p + "doc_id").isNull(),
                      F.coalesce(F.col(p + "doc_id"), F.lit(0).cast("long")), F.col(p + "size")) for p in ("", "cut_")]
    ahead = F.coalesce(F.col("cut_mark").isNotNull() & (place[0] < place[1]), F.lit(False))
    here = F.coalesce(F.col("cut_mark").isNotNull() & (place[0] == place[1]), F.lit(False))
    result = ["doc_id", "source", "size", "source_size", "target"]
    apart = rows.filter(~here).select(
        *result, (F.col("size") * (F.col("whole") + ahead.cast("long"))).alias("taken"))
    pieces = cut.withColumn("piece", F.explode(F.sequence(
        F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES_A_ROW}L")))).repartition("source", "piece")
    last = F.least(F.lit(COPIES_A_ROW), F.col("copies") - F.col("piece") * COPIES_A_ROW) - 1
    copies = pieces.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    left = F.col("extra") - F.col("first") - F.col("size") * (F.col("piece") * COPIES_A_ROW + F.col("copy"))
    met = copies.select(*result, (F.col("size") * F.col("whole") + _further(left, F.col("size"))).alias("taken"))
    return apart.unionByName(met)


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP13_SQL = """
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
    FROM documents),
s AS (
    SELECT source, sum(size)::HUGEINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM d GROUP BY source),
w AS (SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::HUGEINT AS weight FROM s),
c AS (
    SELECT *, 2 * source_size AS cap, row_number() OVER o AS k,
        3 * sum(source_size) OVER () - 2 * coalesce(sum(2 * source_size) OVER b, 0) AS rest,
        sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS open_weight
    FROM w
    WINDOW o AS (ORDER BY 20 * source_size // weight, place),
        b AS (ORDER BY 20 * source_size // weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (
    SELECT k AS first_open, rest::HUGEINT AS rest, open_weight::HUGEINT AS open_weight FROM c
    WHERE weight * rest <= cap * 2 * open_weight ORDER BY k LIMIT 1),
t AS (
    SELECT c.source, c.source_size,
        CASE WHEN k < first_open THEN cap::DOUBLE
            ELSE (weight * f.rest)::DOUBLE / (2 * f.open_weight)::DOUBLE END AS target,
        CASE WHEN k < first_open THEN cap::HUGEINT
            ELSE (weight * f.rest) // (2 * f.open_weight) END AS wanted
    FROM c, f),
r AS (
    SELECT d.doc_id, d.size, t.source_size, t.target,
        wanted // greatest(t.source_size, 1) AS whole, wanted % greatest(t.source_size, 1) AS extra,
        coalesce(sum(d.size) OVER (
            PARTITION BY d.source
            ORDER BY md5('20:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || d.size::VARCHAR)[1:16],
                d.doc_id NULLS LAST, d.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
    (whole * size + least(size, greatest(0, extra - before)))::BIGINT AS taken
FROM r
"""
