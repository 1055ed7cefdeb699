"""Raw files in, typed Parquet out.

The six raw datasets arrive as CSV files with a header. Every column is
read as text, then typed with try-casts in one projection. The columns the
pipeline uses have fixed types; the types of other columns and the layout of
dates are taken from the data (``sources.infer``: one aggregate over just
these columns) unless they are given.
"""

from __future__ import annotations

import uuid
import zlib

from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kickledger.functions.coerce import DATE_FORMAT, MISSING_MARKERS, coerce_columns, stringify_text_columns
from kickledger.functions.months import with_month
from kickledger.schemas import RAW_TYPES
from kickledger.sources import infer
from kickledger.sources.warehouse import clear_month, month_folders, write_months

DATASETS = tuple(RAW_TYPES)


def read_csv_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A CSV file or folder with a header, every column as text.

    A quote inside a quoted cell is written twice. ``multi_line`` allows line
    breaks inside quoted cells; each file is then read by one task. Empty
    cells are NULL. Malformed lines are kept with NULLs in the cells
    that could not be read (PERMISSIVE mode).
    """
    return (spark.read.option("header", True).option("inferSchema", False)
            .option("mode", "PERMISSIVE").option("escape", '"').option("multiLine", multi_line).csv(path))


def type_dataset(df: DataFrame, dataset: str, null_strings: str | None = None,
                 date_format: str | dict[str, str] = DATE_FORMAT, missing: tuple[str, ...] = (),
                 types: dict[str, str] | None = None) -> DataFrame:
    """Type the columns ``dataset`` names; optionally write missing text as
    ``null_strings`` (``"nan"`` gives the reference's stored text).

    ``date_format`` is the layout of text dates (one, or one per column),
    ``missing`` the cells that stand for a missing value, ``types`` the kinds
    of further columns (those of ``games``, say); a column without a kind
    stays as it is.
    """
    typed = coerce_columns(df, RAW_TYPES[dataset] | (types or {}), date_format, missing)
    if null_strings is not None:
        typed = stringify_text_columns(typed, null_strings)
    return typed


def profile_dataset(raw: DataFrame, dataset: str, date_format: str | dict[str, str] | None = None,
                    missing: tuple[str, ...] = MISSING_MARKERS, types: dict[str, str] | None = None,
                    infer_types: bool = True) -> infer.Profile:
    """What the data says of the columns without a given type, and of the dates without a given layout."""
    kinds = RAW_TYPES[dataset] | (types or {})
    given = date_format if isinstance(date_format, dict) else {}
    open_dates = [] if isinstance(date_format, str) else [
        n for n in raw.columns if kinds.get(n) in ("timestamp", "date") and n not in given]
    untyped = [n for n in raw.columns if n not in kinds] if infer_types else []
    return infer.profile(raw, untyped, open_dates, missing)


def load_dataset(spark: SparkSession, path: str, dataset: str, null_strings: str | None = None,
                 fmt: str | None = None, multi_line: bool = False,
                 date_format: str | dict[str, str] | None = None, missing: tuple[str, ...] = MISSING_MARKERS,
                 types: dict[str, str] | None = None, infer_types: bool = True, layout_rule: str = "first",
                 on_unknown_layout: str = "raise") -> DataFrame:
    """Read and type one raw dataset. ``fmt`` is ``"csv"`` or ``"parquet"``;
    by default a path ending in ``.parquet`` is Parquet, anything else CSV.

    For CSV, columns without a fixed or given type get the loader's type for
    their cells (``infer_types=False``: text), and date columns without a
    given layout the one of their first cell (``layout_rule="vote"``: the one
    that reads most cells); see ``infer.Profile.layouts`` for cells that no
    layout reads. Both come from one pass over these columns; where there
    are none, no pass is made. ``missing`` applies to CSV cells only.
    """
    fmt = fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    if fmt == "parquet":
        return type_dataset(spark.read.parquet(path), dataset, null_strings, date_format or DATE_FORMAT, (), types)
    raw = read_csv_text(spark, path, multi_line)
    found = profile_dataset(raw, dataset, date_format, missing, types, infer_types)
    kinds = {n: "loader_double" if kind == "double" else kind for n, kind in found.kinds().items()}
    if not isinstance(date_format, str):
        date_format = found.layouts(layout_rule, on_unknown_layout) | (date_format or {})
    return type_dataset(raw, dataset, null_strings, date_format, missing, kinds | (types or {}))


def write_parquet(df: DataFrame, path: str) -> str:
    """Whole-table Parquet sink; a re-run replaces the previous output."""
    df.write.mode("overwrite").parquet(path)
    return path


def split_by_month(df: DataFrame, ts_col: str, path: str, closed: bool = False, cluster: bool = True) -> str:
    """Write one Parquet folder per month (``partition_date=YYYY-MM``) in one pass.

    ``closed=True`` repeats the reference's month filter (up to 00:00 on the
    last day); ``closed=False`` is the half-open month. Rows are rebalanced
    by month first (see ``cluster_by_month``: few files per month, and a
    hot month is split over several tasks; ``cluster=False`` skips that
    shuffle for input already in time order). ``df`` is the whole dataset: a
    month it has no rows for gets no folder, and a folder that an earlier
    split left for such a month is emptied.
    """
    spark = df.sparkSession
    before = month_folders(spark, path)
    tagged = with_month(df, ts_col, closed=closed).where(F.col("partition_date").isNotNull())
    written = write_months(tagged, path, cluster)
    for month in sorted(before - written):
        clear_month(spark, path, tagged.schema, month)
    return path


def read_months(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read a month-split folder; the month key stays text."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return df.withColumn("partition_date", F.col("partition_date").cast("string"))


SHELVES = 256  # folders that written files are dealt to by their names, so that none holds all and tasks list them


def write_files(df: DataFrame, name_col: str, content_col: str, path: str) -> str:
    """One file per row, ``<path>/shelf=<n>/<name>`` with the bytes of the content column.

    Each task writes the rows it has, row by row. A table writer with a
    partition per file would make a folder and two files for each, and its
    commit would move them one after the other. A file takes its name when
    it is whole, so a task that runs again, or twice at once, leaves the
    same files. Names must differ; files without a byte are not listed by
    Spark's readers.
    """
    def write(rows) -> None:
        store, root = arrow_fs.FileSystem.from_uri(path)
        made: set[str] = set()
        for name, content in rows:
            if not name or "/" in name:
                raise ValueError(f"no file name: {name!r}")
            whole = f"{root}/shelf={zlib.crc32(name.encode()) % SHELVES}/{name}"
            folder, _, last = whole.rpartition("/")
            started = f"{folder}/.{last}.{uuid.uuid4().hex}"  # readers pass over names that begin with a dot
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            with store.open_output_stream(started) as out:
                out.write(content)
            store.move(started, whole)

    df.select(name_col, content_col).foreachPartition(write)
    return path


def read_binary_files(spark: SparkSession, path: str, glob: str | None = None, tasks: int | None = None) -> DataFrame:
    """Files as rows (``path``, ``modificationTime``, ``length``, ``content``).

    File content is read only when the ``content`` column is used, so a
    listing (which logos exist) costs no data reads. Spark counts 4 MB for
    opening a file, so a task reads a few small ones; with ``tasks`` no more
    tasks than that share the files, without a shuffle.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path)
    return files.coalesce(tasks) if tasks else files


def stored_ids(spark: SparkSession, folder: str, suffix: str = ".png") -> DataFrame:
    """Ids of the files ``<folder>/<id><suffix>`` that exist (e.g. stored logos)."""
    files = read_binary_files(spark, folder, f"*{suffix}").select("path")
    pattern = r"([^/]+)" + suffix.replace(".", r"\.") + "$"
    return files.select(F.regexp_extract("path", pattern, 1).alias("competition_id")).distinct()
