"""URL filters on a sorted digest array.

Rules (verdict, host, path) are kept as an array of sorted 64-bit xxhash keys of
host + path, memory-mapped by every task, with the full strings in the same
order. A url is probed with one key for each parent domain of its host and
each length that a rule's path has; the keys of a batch are looked up by one
vectorised binary search, and a hit counts only if the stored string equals the
probe, so digests that collide do no harm. The longest rule that fits wins (of
equally long ones that with the longer host). A url without a rule is judged by
the block list, a second array of whole host + path strings: block if it is
listed, else allow.

Host: after the first "://" up to "/", "?", "#" or the end, A-Z lower-cased;
path: from there up to "?", "#" or the end. A rule fits its host and all
subdomains of it if the path starts with the rule's path.

Defined results: a null url and a url without "://" have empty host and path
and fit no rule; repeated rows get equal results; other columns are ignored.
More than ``max_rules`` rules or listed strings are an error.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(s: bytes) -> int:
    return xxhash.xxh64_intdigest(s)


class DigestArray:
    """Sorted keys and the strings behind them. The bytes go to the executors
    as one broadcast, bounded by ``max_rules`` strings; a task writes them to an
    unnamed temporary file and maps that file into memory."""

    def __init__(self, spark: SparkSession, strings: Iterable[str], max_rules: int):
        rows = sorted((digest(s.encode()), s.encode(), i) for i, s in enumerate(strings))
        if len(rows) > max_rules:
            raise ValueError(f"{len(rows)} strings; the digest array is bounded by max_rules={max_rules}")
        self.n, self.order = len(rows), [i for _, _, i in rows]
        ends = np.cumsum([len(s) for _, s, _ in rows], dtype=np.int64)
        self.data = spark.sparkContext.broadcast(np.array([k for k, _, _ in rows], np.uint64).tobytes() + ends.astype(np.int64).tobytes() + b"".join(s for _, s, _ in rows))

    def __getstate__(self) -> dict:
        return {"n": self.n, "order": self.order, "data": self.data}

    def open(self) -> MappedArray:
        return MappedArray(self.data.value, self.n)


class MappedArray:
    def __init__(self, data: bytes, n: int):
        self.n = n
        if n:
            with tempfile.TemporaryFile() as f:
                f.write(data)
                f.flush()
                mapped = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
            self.keys = np.frombuffer(mapped, np.uint64, n)
            self.ends = np.frombuffer(mapped, np.int64, n, offset=8 * n)
            self.strings = np.frombuffer(mapped, np.uint8, offset=16 * n)

    def string(self, i: int) -> bytes:
        return self.strings[self.ends[i - 1] if i else 0:self.ends[i]].tobytes()

    def find(self, probes: list[bytes]) -> np.ndarray:
        """For each probe the index of the equal stored string, or -1."""
        out = np.full(len(probes), -1, np.int64)
        if not self.n or not probes:
            return out
        keys = np.fromiter((digest(p) for p in probes), np.uint64, len(probes))
        at = np.searchsorted(self.keys, keys)
        for j in np.flatnonzero(self.keys[np.minimum(at, self.n - 1)] == keys):
            i = at[j]
            while i < self.n and self.keys[i] == keys[j]:
                if self.string(i) == probes[j]:
                    out[j] = i
                    break
                i += 1
        return out


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], blocked: Iterable[str] = (), max_rules: int = 10_000_000) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page. ``rules`` are
    (verdict, host, path); ``blocked`` are host + path strings."""
    spark = pages.sparkSession
    array = DigestArray(spark, [h + p for _, h, p in rules], max_rules)
    block = DigestArray(spark, sorted(set(blocked)), max_rules)
    lengths = sorted({len(p) for _, _, p in rules})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, blocklist = array.open(), block.open()
        for b in batches:
            hosts, paths = b.column("host").to_pylist(), b.column("path").to_pylist()
            probes, rows = [], []
            for r, (host, path) in enumerate(zip(hosts, paths)):
                while host:
                    for n in lengths:
                        if n <= len(path):
                            probes.append((host + path[:n]).encode())
                            rows.append((r, n, len(host)))
                    host = host.partition(".")[2]
            best: list[tuple[int, int, int]] = [(-1, -1, -1)] * len(hosts)
            for (r, n, h), i in zip(rows, index.find(probes).tolist()):
                # the string alone does not say where the host ends
                if i >= 0 and len(rules[array.order[i]][1]) == h:
                    best[r] = max(best[r], (n + h, h, array.order[i]))
            blocks = blocklist.find([(h + p).encode() for h, p in zip(hosts, paths)])
            rule = [rules[x[2]][1] + rules[x[2]][2] if x[2] >= 0 else None for x in best]
            verdict = [rules[x[2]][0] if x[2] >= 0 else "block" if i >= 0 else "allow" for x, i in zip(best, blocks.tolist())]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("host"), b.column("path"), pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                                             ["page_id", "host", "path", "rule", "verdict"])

    url = F.col("url").cast("string")
    parts = pages.select(F.col("page_id").cast("long"), host_of(url).alias("host"), path_of(url).alias("path"))
    return parts.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
