"""Incremental month loads: new valuation files in, touched months recomputed.

The batch pipeline re-runs a month when its data changes. As a stream,
Structured Streaming picks up new files in a folder and, per micro-batch:

1. writes the batch's rows under ``partition_date=<month>/load_batch=<stream>-<id>``
   with a dynamic partition overwrite. A micro-batch that is retried after
   a failure (``foreachBatch`` is at-least-once) overwrites its own folders
   instead of adding its rows twice, and streams with checkpoints of their own
   never share a folder;
2. adds the batch to the stored rollup state of the months it touches
   (``rollup_state``: sums, minimum, maximum, count and first date per club
   and code) and takes both rollups of just these months from that state.
   Late rows for an old month therefore update that month at the cost of the
   new rows and the month's state; rows stored before are not read again.

Progress (which files were read) lives in the checkpoint location, so a
restarted query continues where it stopped. There is no watermark: a
watermark would drop rows that arrive too late, while the state of a
month takes every late row, whenever it comes.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kickledger.operators import rollup_state
from kickledger.plans.pipeline import valuation_load_rows
from kickledger.sources.warehouse import PARTITION_COLUMN, Warehouse, cluster_by_month

STREAM_TABLE = "player_valuations_stream"
STREAM_STATE = "player_valuations_stream_state"
MAX_FILES = 1000
BATCH_COLUMN = "load_batch"


def stream_rows_schema(valuation_schema: T.StructType) -> T.StructType:
    """Stored row schema: the source columns (``date`` as a date), month key, stream and batch id."""
    fields = [T.StructField(f.name, T.DateType() if f.name == "date" else f.dataType)
              for f in valuation_schema.fields if f.name not in (PARTITION_COLUMN, BATCH_COLUMN)]
    fields += [T.StructField(PARTITION_COLUMN, T.StringType()), T.StructField(BATCH_COLUMN, T.StringType())]
    return T.StructType(fields)


def read_stream_rows(wh: Warehouse, valuation_schema: T.StructType) -> DataFrame:
    return wh.spark.read.schema(stream_rows_schema(valuation_schema)).parquet(wh.location(STREAM_TABLE))


def ensure_state(wh: Warehouse, valuation_schema: T.StructType, start: str, end: str) -> None:
    """Where rows were streamed before there was a state, make it from them, once, each row under its batch."""
    if rollup_state.has_state(wh, STREAM_STATE):
        return
    try:
        rows = read_stream_rows(wh, valuation_schema)
    except AnalysisException:  # nothing streamed yet
        return
    rollup_state.rebuild(wh, rows, start, end, batch=None, table=STREAM_STATE)


def start_month_stream(spark: SparkSession, source_dir: str, valuation_schema: T.StructType, wh: Warehouse,
                       clubs: DataFrame, start: str, end: str, checkpoint_location: str,
                       available_now: bool = True, max_files_per_trigger: int | None = MAX_FILES,
                       processing_time: str = "1 minute", closed: bool = False) -> StreamingQuery:
    """Start the stream over Parquet files of valuations (columns
    ``player_id, date, market_value, current_club_id, competition_id``).

    ``available_now=True`` processes what is there and stops (a scheduled
    run); otherwise the query keeps running with ``processing_time``. A batch
    takes ``max_files_per_trigger`` files at most (None: all there are), so a
    backlog is worked off in bounded batches.
    """
    reader = spark.readStream.schema(valuation_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    source = reader.parquet(source_dir)
    clubs_dim = clubs.select("club_id", "name", "domestic_competition_id")

    stream_id = hashlib.sha256(checkpoint_location.rstrip("/").encode()).hexdigest()[:16]

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        batch_tag = f"{stream_id}-{batch_id}"
        tagged = valuation_load_rows(batch, start, end, closed).withColumn(BATCH_COLUMN, F.lit(batch_tag))
        (cluster_by_month(tagged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(PARTITION_COLUMN, BATCH_COLUMN).parquet(wh.location(STREAM_TABLE)))
        # Only the batch that runs can be run again; what this stream added before is folded.
        months = rollup_state.add(wh, valuation_load_rows(batch, start, end, closed), batch_tag, start, end,
                                  STREAM_STATE, fold_earlier=f"{stream_id}-")
        rollup_state.refresh(wh, clubs_dim, months, STREAM_STATE)

    ensure_state(wh, valuation_schema, start, end)
    writer = source.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def run_available(spark: SparkSession, source_dir: str, valuation_schema: T.StructType, wh: Warehouse,
                  clubs: DataFrame, start: str, end: str, checkpoint_location: str,
                  max_files_per_trigger: int | None = MAX_FILES, closed: bool = False) -> None:
    """Process every file present now, then stop."""
    query = start_month_stream(spark, source_dir, valuation_schema, wh, clubs, start, end, checkpoint_location,
                               available_now=True, max_files_per_trigger=max_files_per_trigger, closed=closed)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
