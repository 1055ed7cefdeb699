"""Sharding by jump consistent hashing, in built-in expressions only.

``shard_of(key, n)`` computes the shard of a 64-bit key without a ring
table: a linear congruential sequence seeded by the key names the shard
counts at which the key moves; the last one below ``n`` is its shard. When
shards are appended, a key either stays or moves to a new shard, and only
the fraction new / total moves.

The sequence multiplies modulo 2**64. Signed 64-bit multiplication raises
an overflow error in ANSI mode, so the state is kept as two 32-bit words and
every product is formed from parts that stay below 2**63.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from . import common

SHARDS = 24
ROWS_PER_SLOT_BLOCK = 2048

# Fixed values of the published generator: the multiplier, as two 32-bit words.
MULTIPLIER = 2862933555777941757
_M_HI, _M_LO = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
_WORD = 0xFFFFFFFF


def _next_state(hi: Column, lo: Column) -> tuple[Column, Column]:
    """(hi, lo) * MULTIPLIER + 1 modulo 2**64."""
    word, half = F.lit(_WORD), F.lit(0xFFFF)
    m_lo, m_hi = F.lit(_M_LO), F.lit(_M_HI)
    low = lo.bitwiseAND(half) * m_lo
    mid = F.shiftright(lo, 16) * m_lo
    total = low + F.shiftleft(mid.bitwiseAND(half), 16) + F.lit(1)
    carry = F.shiftright(total, 32) + F.shiftright(mid, 16)
    high = F.shiftleft((F.shiftright(hi, 16) * m_lo).bitwiseAND(half), 16) + hi.bitwiseAND(half) * m_lo
    return ((high.bitwiseAND(word) + (lo * m_hi).bitwiseAND(word) + carry.bitwiseAND(word)).bitwiseAND(word),
            total.bitwiseAND(word))


def shard_of(key: Column, shards: int) -> Column:
    """Jump consistent hash of a 64-bit key: an int in [0, shards).

    The fold runs ``shards`` times, the longest any key can need, and leaves
    its state alone once the next jump falls outside.
    """
    start = F.struct(F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(_WORD)).alias("lo"),
                     F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("next"))

    def step(s: Column, _: Column) -> Column:
        hi, lo = _next_state(s["hi"], s["lo"])
        jump = F.floor((s["next"] + 1).cast("double")
                       * (F.lit(float(1 << 31)) / (F.shiftright(hi, 1) + 1).cast("double"))).cast("long")
        moved = F.struct(hi.alias("hi"), lo.alias("lo"), s["next"].alias("at"), jump.alias("next"))
        return F.when(s["next"] < F.lit(shards), moved).otherwise(s)

    return F.aggregate(F.sequence(F.lit(0), F.lit(shards)), start, step, lambda s: s["at"].cast("int"))


def key_of(*cols: Column) -> Column:
    """A stable, well-mixed 64-bit key of any columns (null columns are skipped by the hash)."""
    return F.xxhash64(*cols)


def parts_of_copies(stored: DataFrame, rows_per_block: int) -> DataFrame:
    """The stored rows with ``copies`` and ``part``: 0 and 0, but where over ``rows_per_block`` rows are alike, their hash
    and one of as many parts as keep to that number. Parts of one hash follow each other, so which row gets which
    part changes no result."""
    alike = ["doc_id", "text_crc32", "size"]
    common_rows = materialize(stored.groupBy(*alike).agg(F.count("*").alias("n")).filter(F.col("n") > rows_per_block).select(
        *[F.col(c).alias(f"of_{c}") for c in alike], F.xxhash64(*alike).alias("copies"),
        F.ceil(F.col("n") / rows_per_block).cast("long").alias("parts")), "shards-copies")
    same = functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in alike])
    part = F.pmod(F.xxhash64("row"), F.col("parts"))
    return stored.join(common_rows, same, "left").select(
        *alike, "shard", "grown_shard", "block", F.coalesce("copies", F.lit(0)).alias("copies"),
        F.coalesce(part, F.lit(0)).alias("part"))


def assign(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
           rows_per_block: int = ROWS_PER_SLOT_BLOCK) -> DataFrame:
    """One row per document: its shard, a gapless slot in the shard, and its shard once one is appended.

    Law: ``key``. The shard depends on doc_id and the shard count alone, so
    rows with a null id share one shard and rows with equal ids stay together.
    A null text has size 8 and the checksum of the empty text (0). Repeated
    rows keep a row and a slot each. An empty table gives no rows.

    Slots are numbered in two levels, because a shard holds rows / shards
    rows, too many for one task: ids and text checksums hash to blocks of
    about ``rows_per_block`` rows, so a common id spreads over the blocks of
    its shard; rows are numbered inside (shard, block), and the counts of a
    shard's blocks, summed in block order, give each block's first slot. Rows
    alike in id, checksum and size can't be told apart: more of them than a
    block holds are dealt by stored row number to parts of their own. Only
    narrow rows are shuffled, never texts.
    """
    rows = common.ids_and_texts(docs, id_col, text_col)
    blocks = max(1, rows.count() // (rows_per_block * shards) + 1)
    key = key_of(F.col("doc_id"))
    crc = F.crc32(F.col("text").cast("binary"))
    block = F.pmod(F.xxhash64(key, crc, F.lit("slot")), F.lit(blocks)).cast("int")
    placed = rows.select(
        "doc_id", (F.octet_length("text") + 8).cast("long").alias("size"), crc.alias("text_crc32"),
        shard_of(key, shards).alias("shard"), shard_of(key, shards + 1).alias("grown_shard"), block.alias("block"),
        F.monotonically_increasing_id().alias("row"))
    parted = parts_of_copies(materialize(placed, "shards"), rows_per_block)
    cell = ["shard", "block", "copies", "part"]
    in_order = W.partitionBy("shard").orderBy(*cell[1:]).rowsBetween(W.unboundedPreceding, W.currentRow)
    firsts = parted.groupBy(*cell).agg(F.count("*").alias("n")).select(
        *cell, (F.sum("n").over(in_order) - F.col("n")).alias("first_slot"))
    place = F.row_number().over(W.partitionBy(*cell).orderBy("doc_id", "text_crc32", "size")) - 1
    return parted.withColumn("place", place).join(firsts, cell).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("first_slot") + F.col("place")).cast("long").alias("slot"), "grown_shard")


def op1_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(common.table(spark, sf_dir, "documents"))
