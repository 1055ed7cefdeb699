"""The warehouse: month-partitioned Parquet tables under one shared folder.

Tables are folders (``<root>/<table>/partition_date=<key>/``), written and
read with the DataFrame API, so they need no catalog state and survive a
new session. Each table can be exposed to SQL as a temporary view.

Month replacement comes in the reference's two flavours:

- ``on_empty="delete"`` (base tables): the month's folder is overwritten
  with exactly the new rows, so an empty input clears the month.
- ``on_empty="keep"`` (rollup tables): a dynamic partition overwrite, which
  replaces only the months present in the input; an empty input changes
  nothing.

Either way other months are untouched, and all months of a backfill are
written by one job.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kickledger.schemas import TABLE_SCHEMAS

PARTITION_COLUMN = "partition_date"


def _month_keys(start: str, end: str, day_key: bool) -> list[str]:
    """Month keys of ``[start, end)``, computed from the two dates alone."""
    d = _dt.date.fromisoformat(start).replace(day=1)
    e = _dt.date.fromisoformat(end)
    keys = []
    while d < e:
        keys.append(d.strftime("%Y-%m-01" if day_key else "%Y-%m"))
        d = (d.replace(day=28) + _dt.timedelta(days=4)).replace(day=1)
    return keys


def cluster_by_month(df: DataFrame, column: str = PARTITION_COLUMN, enabled: bool = True) -> DataFrame:
    """Gather each month's rows into few tasks before a partitioned write.

    A rebalance, not a plain hash repartition: rows of one month land in
    the same shuffle partition (one file per month instead of one per
    task and month), and AQE splits a partition that grows past the
    advisory size, so a month holding a third of all rows is written by
    many tasks rather than one. It costs one shuffle of the rows; input
    that already arrives in time order (each task holding one or two
    months) can skip it with ``enabled=False``.
    """
    return df.hint("rebalance", column) if enabled else df


def whole_months(start: str, end: str) -> tuple[str, str]:
    """``start`` and ``end`` as given, if both are the first of a month; a range that cuts a month is an error.

    Months are replaced whole, so a cut range would drop the stored rows of
    its first or last month that lie outside it.
    """
    for day in (start, end):
        if _dt.date.fromisoformat(str(day)).day != 1:
            raise ValueError(f"{day} is not the first day of a month; month tables change by whole months")
    return start, end


def month_files(spark: SparkSession, path: str) -> dict[str, frozenset[str]]:
    """Month keys of the folders under ``path`` with the names of their files: one listing, no job."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/{PARTITION_COLUMN}=*/*")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []
    names: dict[str, set[str]] = {}
    for status in found:
        file = status.getPath()
        names.setdefault(file.getParent().getName().split("=", 1)[1], set()).add(file.getName())
    return {month: frozenset(files) for month, files in names.items()}


def month_folders(spark: SparkSession, path: str) -> set[str]:
    """Month keys of the folders under ``path``; at most one per calendar month."""
    return set(month_files(spark, path))


def write_months(rows: DataFrame, path: str, cluster: bool = True) -> set[str]:
    """Write month folders, replacing those present in ``rows``; returns their keys.

    They are the months whose files are others than before: every write names
    its files anew, so nothing has to be counted while rows are written.
    """
    before = month_files(rows.sparkSession, path)
    (cluster_by_month(rows, enabled=cluster).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION_COLUMN).parquet(path))
    return {month for month, files in month_files(rows.sparkSession, path).items() if files != before.get(month)}


def clear_month(spark: SparkSession, path: str, schema: T.StructType, month: str) -> None:
    """Leave a month's folder without rows."""
    kept = T.StructType([f for f in schema.fields if f.name != PARTITION_COLUMN])
    spark.createDataFrame([], kept).write.mode("overwrite").parquet(f"{path}/{PARTITION_COLUMN}={month}")


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = dict(TABLE_SCHEMAS if schemas is None else schemas)

    def location(self, name: str) -> str:
        return f"{self.root}/{name}"

    def schema(self, name: str) -> T.StructType | None:
        return self.schemas.get(name)

    # --- create -----------------------------------------------------------
    def create_table(self, name: str, schema: T.StructType | None = None,
                     partitioned: bool = True) -> None:
        """Create an empty typed table unless one exists (no-op otherwise)."""
        schema = schema or self.schemas[name]
        self.schemas[name] = schema
        writer = self.spark.createDataFrame([], schema).write.mode("ignore")
        if partitioned:
            writer = writer.partitionBy(PARTITION_COLUMN)
        writer.parquet(self.location(name))

    def ctas_if_absent(self, name: str, df: DataFrame, refresh: bool = False) -> DataFrame:
        """Store ``df`` as table ``name`` unless it exists: the first load wins.

        ``refresh=True`` replaces the stored rows instead.
        """
        df.write.mode("overwrite" if refresh else "ignore").parquet(self.location(name))
        return self.read(name)

    # --- read -------------------------------------------------------------
    def read(self, name: str) -> DataFrame:
        """Read a table; a known schema keeps month keys as text."""
        schema = self.schemas.get(name)
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return reader.parquet(self.location(name))

    def register(self, name: str, view: str | None = None) -> DataFrame:
        df = self.read(name)
        df.createOrReplaceTempView(view or name)
        return df

    def sql(self, query: str, tables: list[str] | None = None) -> DataFrame:
        """Run Spark SQL with warehouse tables visible under their own names.

        The views stay registered for the session (the returned DataFrame
        resolves them when it runs).
        """
        for name in tables if tables is not None else list(self.schemas):
            with contextlib.suppress(AnalysisException):
                self.register(name)
        return self.spark.sql(query)

    @contextlib.contextmanager
    def frame_view(self, df: DataFrame, prefix: str = "frame"):
        """Register ``df`` as a uniquely named temporary view for the block,
        then drop it (register, insert from it, unregister)."""
        view = f"{prefix}_{uuid.uuid4().hex[:12]}"
        df.createOrReplaceTempView(view)
        try:
            yield view
        finally:
            self.spark.catalog.dropTempView(view)

    def insert_select(self, name: str, select_sql: str, on_empty: str = "keep",
                      start: str | None = None, end: str | None = None) -> None:
        """Replace the months that a SQL ``SELECT`` yields (columns matched by name)."""
        self.replace_months(name, self.spark.sql(select_sql), on_empty=on_empty, start=start, end=end)

    # --- write ------------------------------------------------------------
    def conform(self, name: str, df: DataFrame) -> DataFrame:
        """Select the table's columns by name and cast to the stored types.

        The casts are ANSI casts: a value out of range for the stored type
        fails the write rather than being stored wrong.
        """
        schema = self.schemas[name]
        return df.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])

    def stored_months(self, name: str) -> set[str]:
        """Month keys that have a folder: one listing of the table's folder, no job and no file paths."""
        return month_folders(self.spark, self.location(name))

    def replace_months(self, name: str, df: DataFrame, on_empty: str = "keep",
                       start: str | None = None, end: str | None = None,
                       day_key: bool = False, cluster: bool = True) -> None:
        """Replace every month present in ``df`` in one job.

        A range ``[start, end)`` of whole months limits what is written as
        well as what is cleared: rows of other months are left out. With
        ``on_empty="delete"`` months of the range that ``df`` does not hold
        are cleared, so the range ends up holding exactly ``df``'s rows of
        it. ``day_key`` says the table keys months as ``YYYY-MM-01`` rather
        than ``YYYY-MM``. The months written are read off the table's files;
        ``df`` is computed once, and may read this very table, since the new
        files take the old ones' place only when the job commits.
        """
        if on_empty not in ("delete", "keep"):
            raise ValueError(f"on_empty must be 'delete' or 'keep', not {on_empty!r}")
        if on_empty == "delete" and (start is None or end is None):
            raise ValueError("on_empty='delete' needs the month range start and end")
        rows = self.conform(name, df) if name in self.schemas else df
        in_range: list[str] = []
        if start is not None and end is not None:
            in_range = _month_keys(*whole_months(start, end), day_key)
            key = F.col(PARTITION_COLUMN)
            rows = rows.where((key >= F.lit(in_range[0])) & (key <= F.lit(in_range[-1])) if in_range else F.lit(False))
        self.finish_pending(name)
        candidates = self.stored_months(name) & set(in_range) if on_empty == "delete" else set()
        written = write_months(rows, self.location(name), cluster)
        self._clear_months(name, candidates - written)

    def replace_month(self, name: str, df: DataFrame, month: str, on_empty: str = "delete") -> None:
        """Replace one month with the rows of ``df`` that belong to it."""
        rows = self.conform(name, df) if name in self.schemas else df
        rows = rows.where(F.col(PARTITION_COLUMN) == F.lit(month))
        if on_empty not in ("delete", "keep"):
            raise ValueError(f"on_empty must be 'delete' or 'keep', not {on_empty!r}")
        self.finish_pending(name)
        written = write_months(rows, self.location(name), cluster=False)
        if on_empty == "delete" and not written and month in self.stored_months(name):
            self._clear_months(name, {month})

    # Months are cleared after the new rows are committed. What is to be cleared is recorded first, with the files
    # the months hold, so that a run that stops between the two is finished by the table's next write.
    def _pending(self, name: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/_pending/{name}.json")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _clear_months(self, name: str, months: set[str]) -> None:
        if not months:
            return
        files = month_files(self.spark, self.location(name))
        fs, path = self._pending(name)
        out = fs.create(path, True)
        out.write(bytearray(json.dumps({m: sorted(files.get(m, ())) for m in sorted(months)}).encode()))
        out.close()
        self.finish_pending(name)

    def finish_pending(self, name: str) -> list[str]:
        """Clear the months that an earlier replace left to be cleared; returns them.

        A month whose files are no longer those recorded was written since
        and stays. Called by every replace of the table.
        """
        fs, path = self._pending(name)
        if not fs.exists(path):
            return []
        text = "".join(r[0] for r in self.spark.read.option("wholetext", True).text(path.toString()).collect())
        stored, cleared = month_files(self.spark, self.location(name)), []
        for month, files in (json.loads(text) if text else {}).items():  # no text: it stopped while the record was made
            if stored.get(month) == frozenset(files):
                clear_month(self.spark, self.location(name), self.read(name).schema, month)
                cleared.append(month)
        fs.delete(path, False)
        return cleared


def month_keys(start: str, end: str, day_key: bool = False) -> list[str]:
    return _month_keys(start, end, day_key)
