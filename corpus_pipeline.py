"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and read again as the next one's input.

1. quality: documents that the pairwise quality model rejects go. The model
   learns from the labelled documents of its input.
2. lines: later repeated runs of lines are deleted from texts; all rows stay.
3. near_duplicates: of each SimHash group (4-word shingles, at most 4 differing
   bits) the document with the smallest doc_id stays.
4. decontamination: documents that hold a window of a benchmark item go.
5. mix: what is left is packed into blocks and mixed to the source weights; the
   result is the parts of documents that fill each output slot.

Defined results: an empty input gives empty results at every stage; null texts
pass through and have no words to mix; extra columns pass through stages 1-4.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from vitrina.llm import decontaminate, linededup, mixing, quality, simhash
from vitrina.llm.common import shared_folder, table


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_quality(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def stage_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.line_dedup(docs)


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs, shingle=4, max_bits=4)


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), window=10)


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.Mix(docs).packed()


STAGES = [
    ("quality", stage_quality),
    ("lines", stage_lines),
    ("near_duplicates", stage_near_duplicates),
    ("decontamination", stage_decontamination),
    ("mix", stage_mix),
]

# The model, the fingerprints and the pseudorandom draws have no SQL form; the
# stages are tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last."""
    base = f"{shared_folder(spark)}/vitrina-llm/pipeline-{uuid.uuid4().hex[:12]}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{base}/{i}-{name}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
