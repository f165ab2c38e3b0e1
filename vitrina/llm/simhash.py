"""SimHash near-duplicate detection.

Fingerprints of documents are linked when they differ in at most ``max_bits``
bits. Candidates come from pigeonhole blocks: the 64 bits are cut into
``blocks`` blocks, and two fingerprints within the distance agree on at least
``blocks - max_bits`` of them, so they share the key of one combination of that
many blocks. Every candidate is verified by its Hamming distance.

Only distinct fingerprints enter the search. A bucket of one key emits the
edges of a spanning forest, never all its pairs. A bucket larger than
``bucket_limit`` is linked another exact way: each member lists the bit
patterns within half the distance, and members that meet in a pattern are
linked through it, so a group of any size is spread over the cluster.

Defined results: a null or wordless text has fingerprint 0 and links like any
other; repeated rows share fingerprint and component; documents without doc_id
take part, and a component's id is its smallest doc_id (null if it has none).
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, text_hash, written

SEED = 42
BITS = 64


def fingerprint(text: bytes | None, shingle: int) -> int:
    """SimHash of the ``shingle``-word shingles of one text (UTF-8 bytes)."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, 8192):  # bounded memory for very long texts
        part = hashes[i:i + 8192].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, th, fp): one row per document, fp the fingerprint as a long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in b.column("text").to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array(fps.view(np.int64))], ["doc_id", "th", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), text_hash(F.col("text")).alias("th"), F.col("text").cast("binary"))
    return rows.mapInArrow(run, "doc_id long, th long, fp long")


def block_masks(blocks: int) -> list[int]:
    """Bit masks of ``blocks`` blocks that cut the fingerprint evenly."""
    at = [BITS * i // blocks for i in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(at, at[1:])]


def key_masks(blocks: int, max_bits: int) -> list[int]:
    """A mask for each combination of blocks of which two fingerprints within
    the distance must agree on at least one."""
    return [sum(c) for c in itertools.combinations(block_masks(blocks), blocks - max_bits)]


def patterns(bits: list[int], distance: int) -> np.ndarray:
    """All words that set at most ``distance`` of the given bits."""
    out = [0]
    for d in range(1, distance + 1):
        out += [sum(1 << b for b in c) for c in itertools.combinations(bits, d)]
    return np.array(out, dtype=np.uint64)


def forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the graph that links the distinct
    fingerprints within the distance, found by breadth-first search."""
    left, a, b = np.arange(len(fps)), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(fps[left] ^ fps[x]) <= max_bits
            found, left = left[near], left[~near]
            a += [x] * len(found)
            b += found.tolist()
            queue += found.tolist()
    return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


def _bucket_links(max_bits: int, limit: int):
    """For sorted (k, key, fp) rows: the edges of each bucket's forest, and the
    members of buckets over the limit as rows of kind 'big'."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, big = None, [], False  # the bucket still open and, up to the limit, its members

        def members(k: int, fps: np.ndarray) -> pd.DataFrame:
            return pd.DataFrame({"kind": "big", "k": k, "a": fps.view(np.int64), "b": 0})

        def close() -> Iterator[pd.DataFrame]:
            if not big and sum(map(len, held)) > 1:
                fps = np.concatenate(held)
                a, b = forest(fps, max_bits)
                if len(a):
                    yield pd.DataFrame({"kind": "edge", "k": 0, "a": fps[a].view(np.int64), "b": fps[b].view(np.int64)})

        for f in frames:
            if not len(f):
                continue
            k, key, fp = f["k"].to_numpy(), f["key"].to_numpy(), f["fp"].to_numpy().view(np.uint64)
            cut = np.flatnonzero((k[1:] != k[:-1]) | (key[1:] != key[:-1])) + 1
            starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(k)]))
            shared = ends - starts > 1
            shared[0] |= (k[0], key[0]) == at
            shared[-1] = True  # may go on in the next frame
            for s, e in zip(starts[shared], ends[shared]):
                if (k[s], key[s]) != at:
                    yield from close()
                    at, held, big = (k[s], key[s]), [], False
                held.append(fp[s:e].copy())
                if big or sum(map(len, held)) > limit:
                    big = True
                    for h in held:
                        yield members(int(k[s]), h)
                    held = []
        yield from close()
    return run


def _meeting_points(masks: list[int], max_bits: int):
    """(k, hub, fp): every bit pattern within half the distance of a member,
    on the bits that its bucket leaves free."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for k, g in f.groupby("k"):
                p = patterns([b for b in range(BITS) if not masks[k] >> b & 1], (max_bits + 1) // 2)
                fps = g["a"].to_numpy().view(np.uint64)
                for i in range(0, len(fps), 128):
                    part = fps[i:i + 128]
                    yield pd.DataFrame({"k": k, "hub": (part[:, None] ^ p).ravel().view(np.int64), "fp": np.repeat(part, len(p)).view(np.int64)})
    return run


def links(fps: DataFrame, max_bits: int = 4, blocks: int = 7, bucket_limit: int = 65536) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that keep every component
    of the graph of all links whole."""
    masks = key_masks(blocks, max_bits)
    keys = F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(np.uint64(m).view(np.int64).item())).alias("key")) for i, m in enumerate(masks)])
    spread = fps.select("fp").distinct().select("fp", F.explode(keys).alias("x")).select("x.k", "x.key", "fp")
    out = written(
        spread.repartition("k", "key").sortWithinPartitions("k", "key", "fp")
        .mapInPandas(_bucket_links(max_bits, bucket_limit), "kind string, k int, a long, b long"), "simhash-links")
    edges = out.where("kind = 'edge'").select("a", "b").distinct()
    # members of one large bucket that meet in a pattern are linked to the least of them
    big = out.where("kind = 'big'").select("k", "a").repartition(shuffle_partitions(fps.sparkSession), "k", "a")
    hubs = big.mapInPandas(_meeting_points(masks, max_bits), "k int, hub long, fp long")
    least = hubs.groupBy("k", "hub").agg(F.min("fp").alias("least"))
    star = hubs.join(least, ["k", "hub"]).where("fp <> least").select(F.col("least").alias("a"), F.col("fp").alias("b")).distinct()
    return edges.unionByName(star)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component of an edge list, by
    alternating large-star and small-star rounds. Every round is one grouping
    and one join, written to the shared folder; what is compared on the driver is one row."""
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    seen = None
    while True:
        # large star: every larger neighbour is linked to the least one
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: the smaller neighbours and the node itself are linked to the least
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, blocks: int = 7,
                    bucket_limit: int = 65536) -> DataFrame:
    """(doc_id, th, root, fingerprint, component_id) of every document: two
    documents share a component when a chain of fingerprints, each within
    ``max_bits`` of the next, joins them. th is the hash of the text, root the
    least fingerprint of the component."""
    fps = written(fingerprints(docs, shingle), "simhash-fp")
    roots = components(links(fps, max_bits, blocks, bucket_limit))
    # one row per distinct fingerprint: groups of copies are gathered before any join
    reps = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = reps.join(roots, reps.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named.select("fp", "root").join(ids, "root")
    return fps.join(by_fp, "fp").select("doc_id", "th", "root", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, shingle: int = 4, max_bits: int = 4, blocks: int = 7) -> DataFrame:
    """One document of each component, all columns kept: the one with the
    smallest doc_id (of several, the smallest text hash; null ids last)."""
    found = near_duplicates(docs, shingle, max_bits, blocks)
    least = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("x"))
    keep = least.select(F.col("x.doc_id").alias("_keep_id"), F.col("x.th").alias("_keep_th"))
    keyed = docs.select(F.struct(*docs.columns).alias("d")).select("d", F.col("d.doc_id").cast("long").alias("id"), text_hash(F.col("d.text")).alias("h"))
    kept = keyed.join(keep, F.col("id").eqNullSafe(F.col("_keep_id")) & (F.col("h") == F.col("_keep_th")), "left_semi")
    return kept.dropDuplicates(["id", "h"]).select("d.*")
