"""Land raw feeds as CSV files, the way an upstream system drops them.

Each feed is written by Spark (one task per partition, in parallel) into a
staging folder, one folder per landing batch (``_lote``). Landing a batch
renames its folder to ``<family>_<lote>.csv`` in the landing folder: one
rename whatever the number of files, and atomic, so a file stream never sees a
half-written file. The ingest globs take the files of a folder they match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from vitrina.sources import files

# CSV writer options: keep padded blanks and tell NULL from empty text. Files come
# compressed: readers know them by their names.
CSV_WRITE_OPTIONS = {
    "header": "true",
    "sep": ",",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "compression": "gzip",
}


def stage_feed(spark: SparkSession, feed_df: DataFrame, feed_columns: list[str], stage_dir: str) -> None:
    """Write a raw feed once, as CSV parts under ``stage_dir/_lote=<n>/``."""
    (feed_df.select(*feed_columns, "_lote")
     .write.mode("overwrite").partitionBy("_lote").options(**CSV_WRITE_OPTIONS).csv(stage_dir))


def land_staged(spark: SparkSession, stage_dir: str, lote: int, landing_dir: str, family: str) -> None:
    """Move the staged files of one landing batch to ``<family>_<lote>.csv/``
    (one rename: no data is read or rewritten). A batch without rows lands
    nothing."""
    src = f"{stage_dir.rstrip('/')}/_lote={lote}"
    files.mkdirs(spark, landing_dir)
    if files.exists(spark, src):
        files.rename(spark, src, f"{landing_dir.rstrip('/')}/{family}_{lote}.csv")
