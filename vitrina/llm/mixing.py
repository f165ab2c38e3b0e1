"""Mixing sources to target weights.

The words of each source are packed into blocks of ``block`` words: documents
follow each other in an order given by hash, and a block may hold the end of
one document and the start of the next. A source's target decides how many
slots its blocks fill: whole passes over all its blocks, then a part of one
more, the last slot cut to the words still missing. Per output shard the number
of slots of each source is a multinomial draw; a slot is mapped to a block by a
pseudorandom permutation of the block numbers, another one for each pass, so
every block is used once per pass and no list of blocks is ever shuffled as a
whole. Blocks and slots meet in a join by source and block number.

Targets: sources in code point order (null last) weigh as the given weights,
repeating, and share ``share`` of all words; a target stops at ``most`` times
its source's words and the excess goes to the others by weight.

Defined results: texts that are null or without words take no part in blocks
and are taken 0 times; a null source is a source; repeated rows are documents
of their own. With no words at all every target is 0. Reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import blocks_for, n_words, null_key, shuffle_partitions, text_hash, written

BLOCK = 128
SHARD_SLOTS = 4096
SEED = 20


def targets(sizes: DataFrame, weights: tuple = (1, 2, 3), share: float = 1.0, most: float = 3.0) -> DataFrame:
    """(skey, source, source_size, target) from one row (source, skey,
    source_size) per source.

    The level at which targets stop growing is the largest of (total - caps of
    the first k) / (weights of the rest), sources sorted by cap per weight: each
    such line bounds the sum of targets from above, and the true one is among
    them."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("i") % len(weights) + 1)
    ranked = (sizes.withColumn("i", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
              .withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most))))
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(F.col("cap") / F.col("weight"), "i").rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    return (ranked.withColumn("l", level).withColumn("level", F.max("l").over(whole))
            .select("skey", "source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target")))


def permuted(i: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of range(n) for each key, applied to i: four
    Feistel rounds on the smallest even number of bits that holds n, repeated
    while the result is out of range."""
    half = np.array([max(1, (int(x - 1).bit_length() + 1) // 2) for x in n], dtype=np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = i.astype(np.uint64), np.arange(len(i))
    while len(todo):
        left, right = out[todo] >> half[todo], out[todo] & mask[todo]
        for r in range(4):
            f = (right + key[todo] + np.uint64(r)) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            f ^= f >> np.uint64(32)
            left, right = right, left ^ (f & mask[todo])
        out[todo] = (left << half[todo]) | right
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def _draws(shards: int):
    """Slots of each source in each shard: (skey, shard, first, n)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for x in f.itertuples():
                rng = np.random.default_rng([SEED, x.seed & (2**63 - 1)])
                n = rng.multinomial(x.slots, np.full(shards, 1 / shards))
                first = np.cumsum(n) - n
                at = np.flatnonzero(n)
                for i in range(0, len(at), 10_000):
                    part = at[i:i + 10_000]
                    yield pd.DataFrame({"skey": x.skey, "shard": part, "first": first[part], "n": n[part], "blocks": x.blocks, "slots": x.slots, "last": x.last, "seed": x.seed})
    return run


def _blocks_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Maps slot numbers to blocks."""
    for f in frames:
        if len(f):
            passes = (f["slot"] // f["blocks"]).to_numpy()
            key = f["seed"].to_numpy().view(np.uint64) + (passes * 7919).astype(np.uint64)
            block = permuted((f["slot"] % f["blocks"]).to_numpy(), f["blocks"].to_numpy(), key)
            words = np.where(f["slot"] == f["slots"] - 1, f["last"], f["width"])
            yield pd.DataFrame({"skey": f["skey"], "shard": f["shard"], "slot": f["slot"], "block": block, "words": words})


class Mix:
    """The mix of ``docs``: ``targets``, ``placed`` (documents with their place
    in their source), ``slots`` and what they take."""

    def __init__(self, docs: DataFrame, weights: tuple = (1, 2, 3), share: float = 1.0, most: float = 3.0,
                 block: int = BLOCK, shard_slots: int = SHARD_SLOTS, per_bucket: int = 20_000):
        self.docs, self.block = docs, block
        sized = docs.select("doc_id", "text", "source", n_words(F.col("text")).alias("_size"), null_key(F.col("source")).alias("_skey"))
        sizes = written(sized.groupBy(F.col("_skey").alias("skey")).agg(
            F.first("source").alias("source"), F.sum("_size").alias("source_size"), F.count("*").alias("rows")), "sizes")
        total = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("rows"), F.lit(0))).first()
        self.targets = written(targets(sizes, weights, share, most), "targets")
        self.shards = blocks_for(int(total[0] * share), block * shard_slots)
        self.buckets = blocks_for(total[1], per_bucket)
        self.sized = sized

    def placed(self, *columns: str) -> DataFrame:
        """Documents with ``start``, the number of words before them in their
        source. Sums run inside buckets of a source, and over the buckets'
        totals, so a source of any size is spread over many tasks."""
        order = F.xxhash64("_skey", "doc_id", text_hash(F.col("text")), F.lit(SEED))
        rows = self.sized.select("_skey", F.col("doc_id").cast("long").alias("doc_id"), F.col("_size").alias("size"), order.alias("_h"), *columns).withColumn(
            "bucket", F.pmod("_h", F.lit(self.buckets)).cast("int"))
        sums = rows.groupBy("_skey", "bucket").agg(F.sum("size").alias("n"))
        over = Window.partitionBy("_skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        base = sums.select("_skey", "bucket", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("base"))
        inside = Window.partitionBy("_skey", "bucket").orderBy("_h", "doc_id", "size")
        before = inside.rowsBetween(Window.unboundedPreceding, -1)
        return (rows.withColumn("rank", F.row_number().over(inside)).withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0)))
                .join(base, ["_skey", "bucket"])
                .select(F.col("_skey").alias("skey"), "bucket", "rank", "doc_id", "size", (F.col("base") + F.col("offset")).alias("start"), *columns))

    def slots(self) -> DataFrame:
        """(skey, shard, slot, block, words): which block each slot holds, and
        how many of its words. Made from the few rows of ``targets``, so the
        planner takes it for small; it is as large as the mix, and joins of it
        are sort-merge joins by hint, never broadcasts."""
        b = self.block
        t = self.targets.where("source_size > 0").withColumn("blocks", F.ceil(F.col("source_size") / b))
        t = t.withColumn("passes", F.floor(F.col("target") / F.col("source_size"))).withColumn(
            "rest", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long"))
        t = t.withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / b)).withColumn(
            "last", F.when(F.col("rest") > 0, F.pmod(F.col("rest") - 1, F.lit(b)) + 1).otherwise(F.lit(b)))
        seeded = t.where("slots > 0").select("skey", "slots", "blocks", F.col("last").cast("long"), F.xxhash64("skey", F.lit(SEED)).alias("seed"))
        drawn = seeded.mapInPandas(_draws(self.shards), "skey string, shard long, first long, n long, blocks long, slots long, last long, seed long")
        spread = drawn.repartition(shuffle_partitions(self.docs.sparkSession), "skey", "shard")
        each = spread.select("skey", "shard", F.explode(F.expr("sequence(first, first + n - 1)")).alias("slot"), "blocks", "slots", "last", "seed", F.lit(b).alias("width"))
        return each.mapInPandas(_blocks_of, "skey string, shard long, slot long, block long, words long")

    def pieces(self, placed: DataFrame, *columns: str, text: bool = False) -> DataFrame:
        """One row per document and block that holds a part of it: at (where
        the part starts in the block), n and, if asked for, its text."""
        b = self.block
        first, last = f"floor(start / {b})", f"floor((start + size - 1) / {b})"
        part = f"""struct(k as block, greatest(start, k * {b}) - k * {b} as at,
                          least(start + size, (k + 1) * {b}) - greatest(start, k * {b}) as n,
                          greatest(start, k * {b}) - start as skip {", array_join(slice(w, int(greatest(start, k * %d) - start + 1), int(least(start + size, (k + 1) * %d) - greatest(start, k * %d))), ' ') as text" % (b, b, b) if text else ""})"""
        rows = placed.where("size > 0")
        if text:
            rows = rows.withColumn("w", F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"))
        each = rows.select("skey", *columns, F.explode(F.expr(f"transform(sequence({first}, {last}), k -> {part})")).alias("p"))
        return each.select("skey", *columns, "p.*")

    def taken(self) -> DataFrame:
        """Per document: doc_id, size, source, source_size, target, taken (the
        words the mix takes of it, repeats counted)."""
        placed = written(self.placed(), "placed")
        uses = self.slots().groupBy("skey", "block", "words").agg(F.count("*").alias("times"))
        # a block used whole and cut has two rows
        got = self.pieces(placed, "bucket", "rank").join(uses.hint("merge"), ["skey", "block"]).groupBy("skey", "bucket", "rank").agg(
            F.sum(F.col("times") * F.greatest(F.lit(0), F.least(F.col("n"), F.col("words") - F.col("at")))).alias("taken"))
        return (placed.join(got, ["skey", "bucket", "rank"], "left").join(self.targets, "skey")
                .select("doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))

    def packed(self) -> DataFrame:
        """The mix itself: (shard, slot, source, block, at, doc_id, n_words,
        text), the parts of documents that fill each slot in order of at."""
        pieces = self.pieces(self.placed("text", "source"), "doc_id", "source", text=True)
        cut = F.least(F.col("n"), F.col("words") - F.col("at"))
        return (pieces.join(self.slots().hint("merge"), ["skey", "block"]).where("at < words").withColumn("n_words", cut.cast("long"))
                .select("shard", "slot", "source", "block", "at", "doc_id", "n_words",
                        F.when(F.col("n_words") == F.col("n"), F.col("text")).otherwise(F.expr("substring_index(text, ' ', int(n_words))")).alias("text")))
