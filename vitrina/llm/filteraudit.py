"""Filter interaction audit (operator 13), by incremental retraction streaming.

Five filters judge whole texts: A (few words), B (few distinct words), C (many capitals),
D (markup characters) and E (the same text stands at a smaller doc_id). A document's
*mask* holds the filters it fails; all figures of the audit follow from the counts of
documents per (part, mask, quality, toxic).

A to D depend on the row alone. E depends on rows that may come later, so the counts are
kept by two Structured Streaming queries that take all files as available-now
micro-batches:

1. ``masks``: each micro-batch of documents is masked and joined to the labels, and counted
   by part as if E held for nobody. Beside that it is reduced to one row per (text, part,
   labels): the smallest doc_id, how many rows have it, and how many there are. Both
   aggregates start in the tasks that read the rows, so a text that a third of all rows
   share leaves a task as one row. Texts are known by their SHA-256.
2. ``minima``: keyed state holds for each text the smallest doc_id so far and how many rows
   of which part have it. A batch moves rows that have a larger id from their mask to the
   mask with E; when a smaller id arrives, the rows counted before for the older one are
   retracted in the same way. Texts whose digests agree in some bits share a state entry,
   since each entry costs a call: the number of entries follows the number of documents at
   the first call and stays, and the digests spread texts evenly over them.

The counters are the sum of all moves. Each micro-batch writes its own partition, which a
retry overwrites, and state lives in the query's checkpoint in the shared folder, in the
session's state store (on a cluster whose executors' memory is small beside some 200 bytes
a text, set ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider). The
number of state partitions follows the size of the files at the first call.
``Audit.advance`` takes whatever files are new since the last call; ``Audit.report`` reads
the counters.

Defined results: a null text is empty, an empty text has no words (fails A alone of A to D);
a null lang is the part ''. A null doc_id is neither smaller nor larger than any other, so
its row never fails E and makes no other row fail it. Rows that repeat a doc_id with the
same text don't fail E by each other. A document is good (toxic) if any of its label rows
says so when its file is taken. An empty table has no parts and gives no row. Extra columns are not read.
"""

from __future__ import annotations

import itertools
import pickle
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, shared_folder

FILTERS = "ABCDE"
E_BIT = 16
FEW_WORDS = 200
# Bytes of files in a micro-batch, per core of the cluster.
BATCH_BYTES_PER_CORE = 32 << 20
# Texts that share one entry of the keyed state, as of the first call.
TEXTS_PER_ENTRY = 1024
# Bytes of files behind one partition of the state, beyond one partition per core.
BYTES_PER_STATE = 1 << 30

COUNTER = ["part", "mask", "good", "toxic"]
MOVES = "part string, mask int, good boolean, toxic boolean, n long"
ROWS = "text_key binary, doc_id long, part string, mask int, good boolean, toxic boolean"
TEXTS = "text_key binary, part string, mask int, good boolean, toxic boolean, doc_id long, n_first long, n long"
STATE = "texts binary"


def own_mask(text: Column) -> Column:
    """The bits of A to D of a text that is not null."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    n, distinct, capitals, size = (c.cast("long") for c in (
        F.size(words), F.size(F.array_distinct(words)), F.regexp_count(text, F.lit("[A-Z]")), F.char_length(text)))
    fails = [n < FEW_WORDS, 100 * distinct < 50 * n, 100 * capitals > 3 * size, text.rlike("[#$%&*|]")]
    out = F.lit(0)
    for i, failed in enumerate(fails):
        out = out + F.when(failed, F.lit(1 << i)).otherwise(F.lit(0))
    return out


def label_marks(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic) of the documents that are one or the other."""
    return labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).where("good or toxic")


def masked(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(text_key, doc_id, part, mask, good, toxic) of every document."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("text_key"), own_mask(text).alias("mask"))
    no = F.lit(False)
    return rows.join(marks, "doc_id", "left").select(
        "text_key", "doc_id", "part", "mask", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))


def reduced(rows: DataFrame) -> DataFrame:
    """One row per text, part and labels: the smallest doc_id, its rows (``n_first``), and all
    rows that have an id. Rows without doc_id are left out: E never holds for them."""
    group = ["text_key", "part", "mask", "good", "toxic"]
    per_id = rows.where("doc_id is not null").groupBy(*group, "doc_id").agg(F.count("*").alias("n"))
    return per_id.groupBy(*group).agg(F.min(F.struct("doc_id", "n")).alias("first"), F.sum("n").alias("n")).select(
        *group, F.col("first.doc_id").alias("doc_id"), F.col("first.n").alias("n_first"), "n")


def moves(state: tuple | None, rows: list[tuple]) -> tuple[tuple, list[tuple]]:
    """The new state of a text, and the counter moves: ``rows`` are (doc_id, part, good, toxic,
    n_first, n). A state is (doc_id, {(part, good, toxic): rows that have it})."""
    least = min(r[0] for r in rows)
    out: list[tuple] = []
    if state is not None and state[0] <= least:
        least, kept = state[0], dict(state[1])
    else:
        kept = {}
        if state is not None:  # a smaller id has come: what was counted before now fails E
            out += [(*key, n) for key, n in state[1].items()]
    for doc_id, part, good, toxic, n_first, n in rows:
        stays = n_first if doc_id == least else 0
        if stays:
            kept[part, good, toxic] = kept.get((part, good, toxic), 0) + stays
        if n > stays:
            out.append((part, good, toxic, n - stays))
    return (least, kept), out


def _keyed(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """One micro-batch of a group of texts: new minima into the state, moves out."""
    texts: dict[bytes, tuple] = pickle.loads(state.get[0]) if state.exists else {}
    out: dict[tuple, int] = {}
    for b in batches:
        mine: dict[bytes, list[tuple]] = {}
        masks = {}
        columns = [b[c].tolist() for c in ("text_key", "mask", "doc_id", "part", "good", "toxic", "n_first", "n")]
        for text, mask, *row in zip(*columns):
            mine.setdefault(text, []).append(tuple(row))
            masks[text] = mask  # the same for all rows of a text
        for text, rows in mine.items():
            texts[text], moved = moves(texts.get(text), rows)
            for part, good, toxic, n in moved:
                for mask, change in ((masks[text], -n), (masks[text] + E_BIT, n)):
                    out[part, mask, good, toxic] = out.get((part, mask, good, toxic), 0) + change
    state.update((pickle.dumps(texts, pickle.HIGHEST_PROTOCOL),))
    if out:
        yield pd.DataFrame([(*k, n) for k, n in out.items()], columns=["part", "mask", "good", "toxic", "n"])


class Audit:
    """The audit of a growing folder of documents; ``root`` keeps its tables and checkpoints."""

    def __init__(self, spark: SparkSession, documents: str, labels: DataFrame, root: str | None = None, files_per_batch: int | None = None):
        self.spark, self.documents, self.labels, self.files_per_batch = spark, documents, labels, files_per_batch
        self.root = (root or f"{shared_folder(spark)}/vitrina-llm/filter-audit-{uuid.uuid4().hex[:12]}").rstrip("/")
        # a session of its own: its settings reach no other query
        self.session = spark.newSession()

    def _write(self, df: DataFrame, name: str, batch: int) -> None:
        (df.withColumn("batch", F.lit(batch).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(f"{self.root}/{name}"))

    def _masks(self, batch: DataFrame, batch_id: int) -> None:
        # thin rows, stored: counted and reduced from one reading of the texts
        self._write(masked(batch, batch.sparkSession.read.parquet(f"{self.root}/labels")), "rows", batch_id)
        rows = batch.sparkSession.read.schema(ROWS + ", batch long").parquet(f"{self.root}/rows").where(F.col("batch") == batch_id).drop("batch")
        self._write(rows.groupBy(*COUNTER).agg(F.count("*").alias("n")), "counts", batch_id)
        self._write(reduced(rows), "texts", batch_id)

    def advance(self) -> None:
        """Count all files that have come since the last call."""
        s = self.session
        # the folders are there even if no file comes
        for name, ddl in (("rows", ROWS), ("counts", MOVES), ("texts", TEXTS), ("moves", MOVES), ("entries", "n long")):
            s.createDataFrame([], ddl + ", batch long").write.mode("append").partitionBy("batch").parquet(f"{self.root}/{name}")
        label_marks(self.labels).write.mode("overwrite").parquet(f"{self.root}/labels")
        files = s.read.parquet(self.documents)
        total = files.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()[0] or 0
        if not s.read.schema("n long").parquet(f"{self.root}/entries").take(1):  # kept for the life of the state
            entries = max(s.sparkContext.defaultParallelism, files.count() // TEXTS_PER_ENTRY)
            self._write(s.createDataFrame([(entries,)], "n long"), "entries", 0)
        entries = s.read.schema("n long").parquet(f"{self.root}/entries").first()["n"]
        s.conf.set("spark.sql.shuffle.partitions", str(max(s.sparkContext.defaultParallelism, total // BYTES_PER_STATE)))
        size = ("maxFilesPerTrigger", self.files_per_batch) if self.files_per_batch else (
            "maxBytesPerTrigger", BATCH_BYTES_PER_CORE * s.sparkContext.defaultParallelism)
        reader = s.readStream.schema(files.select("doc_id", "text", "lang").schema).option(*map(str, size))
        # as a glob the path may also name a single file
        folder, _, name = self.documents.rstrip("/").rpartition("/")
        (reader.parquet(f"{folder}/{{{name}}}").writeStream.foreachBatch(self._masks)
         .option("checkpointLocation", f"{self.root}/_masks").trigger(availableNow=True).start().awaitTermination())
        keyed = s.readStream.schema(TEXTS).option("recursiveFileLookup", "true").option(*map(str, size)).parquet(f"{self.root}/texts").withColumn(
            "entry", F.pmod(F.xxhash64("text_key"), F.lit(entries))).groupBy("entry").applyInPandasWithState(
            _keyed, MOVES, STATE, "append", "NoTimeout")
        (keyed.writeStream.foreachBatch(lambda df, i: self._write(df.groupBy(*COUNTER).agg(F.sum("n").alias("n")), "moves", i))
         .outputMode("append").option("checkpointLocation", f"{self.root}/_minima").trigger(availableNow=True).start().awaitTermination())

    def counters(self) -> DataFrame:
        """Documents per (part, mask, good, toxic)."""
        read = self.spark.read.schema(MOVES)
        parts = read.parquet(f"{self.root}/counts").unionByName(read.parquet(f"{self.root}/moves"))
        return parts.groupBy(*COUNTER).agg(F.sum("n").alias("n")).where("n <> 0")

    def report(self) -> DataFrame:
        return report(self.counters())


def report(counters: DataFrame) -> DataFrame:
    """Per part, filter order and step: what the step's filter removes there, and its Shapley
    share: the sum of what it removes over all orders. A document that fails k filters is removed
    by each of them in 1/k of the orders."""
    orders = ["".join(p) for p in itertools.permutations(FILTERS)]
    masks = range(1 << len(FILTERS))

    def by_mask(n: Column) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, n)), F.lit(0)) for m in masks])

    n, none = F.col("n"), F.lit(0)
    per_part = counters.groupBy("part").agg(
        by_mask(n).alias("n_by"), by_mask(F.when(F.col("good"), n).otherwise(none)).alias("good_by"), by_mask(F.when(F.col("toxic"), n).otherwise(none)).alias("toxic_by"))
    # one row per order and step, with the bits of the step's filter and of those before it
    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(i + 1).alias("step"), F.lit(1 << FILTERS.index(f)).alias("bit"),
                               F.lit(sum(1 << FILTERS.index(x) for x in o[:i])).alias("before")) for o in orders for i, f in enumerate(o)])
    rows = per_part.select("part", "n_by", "good_by", "toxic_by", F.explode(steps).alias("s")).select("part", "n_by", "good_by", "toxic_by", "s.*")
    bit, before = F.col("bit"), F.col("before")

    def total(values: str, holds) -> Column:
        picked = F.transform(F.col(values), lambda v, m: F.when(holds(m), v).otherwise(F.lit(0)))
        return F.aggregate(picked, F.lit(0).cast("long"), lambda a, v: a + v)

    def fails(m: Column) -> Column:
        return m.bitwiseAND(bit) != 0

    def earlier(m: Column) -> Column:
        return m.bitwiseAND(before) != 0

    share = F.transform("n_by", lambda v, m: F.when(fails(m), v * (F.lit(len(orders)) / F.greatest(F.bit_count(m), F.lit(1))).cast("long")).otherwise(F.lit(0)))
    return rows.select(
        "part", "filter_order", "step",
        total("n_by", lambda m: m.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total("n_by", lambda m: fails(m) & ~earlier(m)).alias("removed"),
        total("n_by", lambda m: fails(m) & earlier(m)).alias("redundant"),
        total("n_by", lambda m: m == bit).alias("unique_fails"),
        total("good_by", lambda m: fails(m) & ~earlier(m)).alias("good_lost"),
        total("toxic_by", lambda m: fails(m) & ~earlier(m)).alias("toxic_lost"),
        F.aggregate(share, F.lit(0).cast("long"), lambda a, v: a + v).alias("shapley"))


def audit(spark: SparkSession, documents: str, labels: DataFrame, files_per_batch: int | None = None) -> DataFrame:
    """The audit of all files that there are at the path ``documents``."""
    a = Audit(spark, documents, labels, files_per_batch=files_per_batch)
    a.advance()
    return a.report()
