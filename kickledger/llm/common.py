"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id long, text string, null as ''): other columns, whatever their names, are left behind."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``: the fixed train / held-out split."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % F.lit(modulus), F.lit(0))


def few(rows: DataFrame, limit: int, *keys: str) -> DataFrame:
    """At most ``limit`` rows, those with the smallest hashes of their first key, in an order fixed by the keys.

    A bound on the hash, set from the row count, leaves about half as many
    rows again as are wanted, so the sort gets a bounded number of rows
    however many tasks read the table.
    """
    total = rows.count()
    bound = min(1 << 31, ((3 * limit // 2 + 100) << 31) // max(1, total))
    mixed = F.xxhash64(keys[0])
    return rows.filter(F.pmod(mixed, F.lit(1 << 31)) < F.lit(bound)) \
        .orderBy(F.pmod(mixed, F.lit(1 << 31)), *keys).limit(limit)


def worker_cache(name: str) -> dict:
    """A dict that lives as long as its Python worker, across the tasks it serves. Callers bound its size."""
    import sys
    import types

    holder = sys.modules.setdefault("_kickledger_worker_cache", types.ModuleType("_kickledger_worker_cache"))
    return holder.__dict__.setdefault(name, {})
