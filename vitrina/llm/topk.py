"""Exact top-k search by integer inner product on a bit-sliced index.

Vectors are quantised to floor(scale * x) per component. A block of candidates
is indexed by bit slices: for each component and bit a bitmap over the block's
rows. A query's scores are computed for the whole block by bitmap arithmetic:
the slices of a component are added once for each set bit of the query's
component, shifted by that bit, with carry-save full adders (a negative query
component adds the complements). From the slices of the sum the top rows are
selected from the most significant slice downward; rows that tie at the k-th
place are resolved by the smaller id. The blocks' winners are then ranked
together, so the result is exact.

Queries and candidates meet block by block: every block of queries with every
block of candidates, keyed by the pair of block numbers.

Defined results: vectors that are null or hold a null or non-finite component
take no part; every other row does, with or without vec_id. A query is a row: rows
that repeat an id are queries and candidates of their own, and only a query's own
row is not among its results. Equal scores go to the smaller vec_id, null last.
Missing components of a shorter vector are zero. Other columns are ignored.
Scores beyond 62 bits are an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import blocks_for, written


def quantised(vectors: DataFrame, scale: float = 64.0) -> DataFrame:
    """(row, vec_id, v): the usable rows, numbered, v the integer components. To be written
    before it is read twice, as the numbers depend on the partitions."""
    usable = vectors.where("embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < cast('infinity' as double))")
    # beyond what a product of 62 bits allows; the search refuses it
    limit = F.lit(float(2**61))
    v = F.transform("embedding", lambda x: F.floor(F.greatest(-limit, F.least(limit, x.cast("double") * F.lit(float(scale))))).cast("long"))
    return usable.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), v.alias("v"))


class BitSlices:
    """The index of one block: x holds its rows, sorted by id and row number."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, x: np.ndarray):
        order = np.lexsort((rows, ids))
        self.ids, self.row, self.x = ids[order], rows[order], x[order]
        n, d = self.x.shape
        self.words = (n + 63) // 64
        self.low = self.x.min(axis=0)
        shifted = self.x - self.low
        self.width = [int(m).bit_length() for m in shifted.max(axis=0)]
        self.slices = [[self.bitmap((shifted[:, j] >> b) & 1) for b in range(self.width[j])] for j in range(d)]
        self.complements = [[~s for s in col] for col in self.slices]
        self.all = self.bitmap(np.ones(n, np.uint8))

    def bitmap(self, bits: np.ndarray) -> np.ndarray:
        out = np.zeros(self.words * 8, np.uint8)
        packed = np.packbits(bits.astype(np.uint8), bitorder="little")
        out[:len(packed)] = packed
        return out.view(np.uint64)

    def score_slices(self, q: np.ndarray) -> list[np.ndarray]:
        """Bit slices of the scores, less a constant that all rows share."""
        heap: list[list[np.ndarray]] = []

        def put(weight: int, m: np.ndarray) -> None:
            while len(heap) <= weight:
                heap.append([])
            heap[weight].append(m)

        for j, c in enumerate(q.tolist()):
            column, c = (self.slices[j], c) if c > 0 else (self.complements[j], -c)
            i = 0
            while c >> i:
                if c >> i & 1:
                    for b, m in enumerate(column):
                        put(i + b, m)
                i += 1
        out, w = [], 0
        while w < len(heap):
            level = heap[w]
            while len(level) > 2:
                a, b, c = level.pop(), level.pop(), level.pop()
                t = a ^ b
                level.insert(0, t ^ c)
                put(w + 1, (a & b) | (t & c))
            if len(level) == 2:
                a, b = level
                level[:] = [a ^ b]
                put(w + 1, a & b)
            out.append(level[0] if level else np.zeros(self.words, np.uint64))
            w += 1
        return out

    def top(self, query_row: int, q: np.ndarray, k: int) -> np.ndarray:
        """Places of the k best scores, ties to the smaller id; the query's own row is left out."""
        own = self.row == query_row
        open_rows = self.all & ~self.bitmap(own) if own.any() else self.all
        sure = np.zeros(self.words, np.uint64)
        for s in reversed(self.score_slices(q)):
            ones = open_rows & s
            n = int(np.bitwise_count(sure | ones).sum())
            if n > k:
                open_rows = ones
            else:
                sure, open_rows = sure | ones, open_rows & ~s
                if n == k:
                    break
        rows = self.rows(sure)
        return rows if len(rows) >= k else np.concatenate((rows, self.rows(open_rows)[:k - len(rows)]))

    def rows(self, bitmap: np.ndarray) -> np.ndarray:
        words = np.flatnonzero(bitmap)
        bits = np.unpackbits(bitmap[words].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        r, c = np.nonzero(bits)
        return words[r] * 64 + c


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


# Stands for a null id: after all others.
NO_ID = np.iinfo(np.int64).max


def _search(k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(rows):
            width = max(1, max(map(len, queries["v"])), max(map(len, rows["v"])))
            q, x = _matrix(queries["v"], width), _matrix(rows["v"], width)
            if float(np.abs(q.astype(float)).max()) * float(np.abs(x.astype(float)).max()) * width >= 2.0**62:
                raise OverflowError("scores beyond 62 bits")
            index = BitSlices(rows["id"].to_numpy(), rows["row"].to_numpy(), x)
            for i, row in enumerate(queries["row"]):
                best = index.top(row, q[i], k)
                found.append(pd.DataFrame({"query_row": row, "row": index.row[best], "id": index.ids[best], "score": index.x[best] @ q[i]}))
        return pd.concat(found) if found else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_row", "row", "id", "score")})
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, query_block: int = 512, block: int = 32_768) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` (vec_id, embedding) for which
    ``is_query`` holds, its k best other rows by inner product of the quantised vectors."""
    known = written(quantised(vectors, scale), "vectors")
    rows = known.select("row", F.coalesce("vec_id", F.lit(int(NO_ID))).alias("id"), "v")
    wanted = known.where(is_query).select("row", F.col("vec_id").alias("query_id"), "v")
    n_rows, n_queries = blocks_for(rows.count(), block), blocks_for(wanted.count(), query_block)

    def part(n: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = wanted.select("row", "v").withColumn("qb", part(n_queries)).withColumn("cb", every(n_rows))
    right = rows.withColumn("cb", part(n_rows)).withColumn("qb", every(n_queries))
    found = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInPandas(_search(k), "query_row long, row long, id long, score long")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "id", "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = wanted.select(F.col("row").alias("query_row"), "query_id")
    return ranked.join(names, "query_row").select("query_id", F.col("rank").cast("int"), F.nullif("id", F.lit(int(NO_ID))).alias("vec_id"), "score")
