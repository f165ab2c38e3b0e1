"""Bronze ingest: incremental CSV files -> append-only parquet table.

Structured Streaming's file source remembers every file it has read in the
query checkpoint, so each file is ingested exactly once; the parquet file
sink commits through its own metadata log, so a retried micro-batch never
duplicates rows. ``trigger(availableNow=True)`` processes whatever has
landed and stops, which is how a scheduled job runs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrina.session import TABLE_OPTIONS
from vitrina.sources.feeds import read_feed_stream

# Size of a bronze file's row groups: readers can't split a row group, and a micro-batch
# of few files is to be cleaned by more tasks than it has files.
ROW_GROUP, ROW_GROUP_BYTES = "parquet.block.size", 4 << 20


def ingest_to_bronze(spark: SparkSession, landing_dir: str, feed: str, bronze_dir: str,
                     checkpoint_dir: str, max_files_per_trigger: int | None = None) -> dict:
    """Append every new file of ``feed`` to ``bronze_dir``; returns the number
    of batches that the table has been fed so far."""
    src = read_feed_stream(spark, landing_dir, feed, max_files_per_trigger=max_files_per_trigger)
    # the sink takes this setting from the session, as it is when the query starts
    before = spark.conf.get(ROW_GROUP, None)
    spark.conf.set(ROW_GROUP, str(ROW_GROUP_BYTES))
    try:
        q = (src.writeStream
             .format("parquet")
             .options(path=bronze_dir, **TABLE_OPTIONS)
             .option("checkpointLocation", checkpoint_dir)
             .outputMode("append")
             .trigger(availableNow=True)
             .start())
    finally:
        spark.conf.unset(ROW_GROUP) if before is None else spark.conf.set(ROW_GROUP, before)
    q.awaitTermination()
    return {"batches": int((q.lastProgress or {}).get("batchId", -1)) + 1}


def is_path(table: str) -> bool:
    """A table is named by its folder, or by its name in the catalog."""
    return "/" in table


def read_bronze(spark: SparkSession, table: str) -> DataFrame:
    """Batch read of an append table, by folder (only committed files, via
    the sink log) or by table name."""
    return spark.read.parquet(table) if is_path(table) else spark.read.table(table)


def read_bronze_stream(spark: SparkSession, table: str,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental read of an append table, by folder (committed files
    only) or by table name."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.schema(read_bronze(spark, table).schema).parquet(table) if is_path(table) else reader.table(table)
