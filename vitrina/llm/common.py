"""Helpers the operators share: word patterns, shared-folder tables, keys."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of characters other than blank, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; on a local master without that
    setting a scratch folder. A cluster without the setting is an error: its
    executors could not see a folder of the driver's."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="vitrina-llm-"))
    return sc.getCheckpointDir().rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back:
    the lineage ends there and a lost executor costs a reread, no recomputation."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/vitrina-llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def n_words(text: Column) -> Column:
    """Number of words of a whole text; a null text has none."""
    return F.when(text.isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


def null_key(c: Column) -> Column:
    """A never-null string key that keeps null apart from every text."""
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), c.cast("string")))


def text_hash(text: Column) -> Column:
    """64-bit hash of a text; with the doc_id it names a document in joins.
    Rows equal in both are repeated rows and always share their result."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once per row: it comes out of a generator,
    into which the optimizer neither merges later expressions nor pushes filters."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def blocks_for(rows: int, per_block: int) -> int:
    return max(1, math.ceil(rows / per_block))
