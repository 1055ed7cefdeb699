"""Which months of a table have changed: an order-free digest per month.

A month's digest is its row count and the sum of its rows' 64-bit hashes (as
a decimal, so it can't overflow): sums merge over tasks in any order, rows
that move between files change nothing, and a row added, dropped or altered
does. Two rows that swap a value differ in their hashes, and a missing value
hashes unlike the value beside it, since the places of missing values are
hashed too. Equal digests mean equal rows but for a chance of about 2**-64
per month compared.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kickledger.functions.months import in_window, month_key, month_start
from kickledger.sources.warehouse import PARTITION_COLUMN, Warehouse, month_keys

DIGEST_SCHEMA = f"{PARTITION_COLUMN} string, n long, hash_sum decimal(38,0), inputs string"


def row_hash(columns: list[str]) -> Column:
    cells = [F.col(f"`{c}`") for c in columns]
    missing = F.concat(*[c.isNull().cast("int").cast("string") for c in cells])
    return F.xxhash64(missing, *cells)


def _digest(columns: list[str]) -> list[Column]:
    return [F.count("*").alias("n"), F.sum(row_hash(columns).cast("decimal(20,0)")).cast("decimal(38,0)").alias("hash_sum")]


def month_digests(df: DataFrame, date_col: str, columns: list[str], start: str, end: str) -> DataFrame:
    """(partition_date ``YYYY-MM``, n, hash_sum) of the months in ``[start, end)``, over ``columns``."""
    rows = df.where(in_window(date_col, start, end))
    return rows.groupBy(month_start(date_col).alias("month")).agg(*_digest(columns)).select(
        month_key("month").alias(PARTITION_COLUMN), "n", "hash_sum")


def table_digest(df: DataFrame, columns: list[str]) -> str:
    """The digest of a whole table, as text: a dimension that every month depends on."""
    row = df.agg(*_digest(columns)).first()
    return f"{row.n}:{row.hash_sum}"


class MonthDigests:
    """Stored digests of the months that a derived table was computed from.

    They are written after the derived months, so a run that stops between
    the two computes those months again, never too few. The rows are one per
    calendar month; losing the stored file only means computing all months.
    """

    def __init__(self, wh: Warehouse, name: str):
        self.wh = wh
        self.path = wh.location(f"{name}_digests")

    def stored(self) -> dict[str, tuple]:
        try:
            rows = self.wh.spark.read.schema(DIGEST_SCHEMA).parquet(self.path).collect()
        except AnalysisException:
            return {}
        return {r[0]: (r.n, r.hash_sum, r.inputs) for r in rows}

    def changed(self, digests: DataFrame, inputs: str) -> tuple[list[str], dict[str, tuple]]:
        """Months whose digest, or whose other ``inputs``, differ from those stored, and all digests as they are now."""
        now = {r[PARTITION_COLUMN]: (r.n, r.hash_sum, inputs) for r in digests.collect()}
        before = self.stored()
        return sorted(m for m, digest in now.items() if before.get(m) != digest), now

    def store(self, now: dict[str, tuple], start: str, end: str) -> None:
        """Keep ``now`` for the months of ``[start, end)``; other months' digests stay as they are."""
        in_range = set(month_keys(start, end))
        rows = {m: d for m, d in self.stored().items() if m not in in_range} | now
        self.wh.spark.createDataFrame([(m, *d) for m, d in sorted(rows.items())], DIGEST_SCHEMA).coalesce(1) \
            .write.mode("overwrite").parquet(self.path)
