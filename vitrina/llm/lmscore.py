"""Language-model scores by stupid backoff over word n-grams, computed relationally.

A word is a run of bytes other than ASCII blanks; an n-gram of words is known by a 64-bit
hash. The score of a word is c(context + word) / c(context) if that n-gram was counted, else
``alpha`` times its score with a context one word shorter; with no context it is its share of
all words, one added to both counts. A document's score is the sum of the logarithms (base 2)
of its words' scores.

Counts cover all documents. No text supports itself: its own n-grams, and those of all rows
with the same text, are taken out of every count before it is scored.

Plan: a block is a bounded run of rows of one file, so that a row's block is the same whenever
the file is read. Where the rows are read, each block lists its distinct n-grams with their
counts, and its texts' hashes as n-grams of order 0, so that the number of equal texts comes the
same way. The lists are cut by ranges of the hash: the n-gram table's partitions. A partition adds
up its lists and answers each block with the counts of its n-grams over the whole corpus, in
their order. Blocks are joined to their answers and sum their documents' scores. Lists travel as
packed sorted hashes, some 6 bytes an n-gram, answers as some 1 byte, and an n-gram that every
document holds costs one entry per block.

Defined results: null, empty and blank texts have no words, log2_prob 0 and a null mean; repeated
rows score alike; a text all of whose words stand nowhere else is scored as unseen words.
Other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, blocks_for, text_hash, written

ORDER = 2
ALPHA = 0.4
# Average bytes of text in a block, and words of the corpus behind a table partition.
BLOCK_BYTES = 8 << 20
PART_WORDS = 2_000_000
PART_BYTES = 4 << 20
# Odd 64-bit constants that mix a context's hash with the next word's.
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class Words(dict):
    """64-bit code of a word, worked out once."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = xxhash.xxh64_intdigest(word)
        return code


def parts(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with a bounded number of bytes, or one text."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        if i > start and total + len(t) > PART_BYTES:
            yield start, i
            start, total = i, 0
        total += len(t)
    if len(texts) > start:
        yield start, len(texts)


def grams(texts: list[bytes], order: int, words: Words) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each order the code of the n-gram that ends at each word; how many
    words of its text precede each word; and the texts' numbers of words."""
    split = [t.split() for t in texts]
    size = np.array([len(w) for w in split], np.int64)
    code = np.fromiter((words[w] for own in split for w in own), np.uint64, int(size.sum()))
    before = np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)
    out = [code]
    for _ in range(1, order):
        longer = np.zeros(len(code), np.uint64)
        # context of one word less, ending at the word before
        longer[1:] = (out[-1][:-1] * MIX[0] + code[1:]) * MIX[1]
        out.append(longer ^ (longer >> np.uint64(29)))
    return out, before, size


def _summed_counts(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, n = (np.concatenate(x) for x in zip(*pairs))
    codes, at = np.unique(codes, return_inverse=True)
    return codes, np.bincount(at, n).astype(np.int64)


def pack(codes: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted distinct codes with their counts: differences in as few bytes as the largest needs,
    and the counts other than 1."""
    steps = np.diff(codes, prepend=codes[:1])
    width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    many = np.flatnonzero(n != 1)
    small = np.ascontiguousarray(steps.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]
    head = struct.pack("<IBIQ", len(codes), width, len(many), int(codes[0]) if len(codes) else 0)
    return b"".join((head, small.tobytes(), many.astype("<u4").tobytes(), n[many].astype("<i8").tobytes()))


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    size, width, m, first = struct.unpack_from("<IBIQ", data)
    at = struct.calcsize("<IBIQ")
    wide = np.zeros((size, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8, size * width, at).reshape(size, width)
    steps = wide.view("<u8").ravel()
    at += size * width
    many, n = np.frombuffer(data, "<u4", m, at), np.ones(size, np.int64)
    n[many] = np.frombuffer(data, "<i8", m, at + 4 * m)
    return np.cumsum(steps, dtype=np.uint64) + np.uint64(first), n


def _listed(order: int, bits: int):
    """The packed lists of every block, cut by the first ``bits`` bits of the codes."""
    def lists(block: int, rows: list[pd.DataFrame]) -> Iterator[tuple]:
        words, found = Words(), [[] for _ in range(order + 1)]
        texts = [t or b"" for b in rows for t in b["text"]]
        found[0].append(np.unique(np.concatenate([b["th"].to_numpy(np.int64) for b in rows]).view(np.uint64), return_counts=True))
        for a, b in parts(texts):
            codes, before, _ = grams(texts[a:b], order, words)
            for k in range(1, order + 1):
                found[k].append(np.unique(codes[k - 1][before >= k - 1], return_counts=True))
        for k, pairs in enumerate(found):
            if not pairs:
                continue
            codes, n = (np.concatenate(x) for x in zip(*pairs))
            codes, at = np.unique(codes, return_inverse=True)
            n = np.bincount(at, n, len(codes)).astype(np.int64)
            part = (codes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(codes), np.int64)
            starts = np.flatnonzero(np.diff(part, prepend=-1))
            for i, j in zip(starts, [*starts[1:], len(codes)]):
                yield block, k, int(part[i]), pack(codes[i:j], n[i:j])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, rows = None, []
        names = ["block", "k", "part", "list"]
        for b in batches:
            for value, own in b.groupby("block", sort=False):
                if value != block and rows:
                    yield pd.DataFrame(lists(block, rows), columns=names)
                    rows = []
                block = value
                rows.append(own)
        if rows:
            yield pd.DataFrame(lists(block, rows), columns=names)
    return run


def pack_counts(n: np.ndarray) -> bytes:
    """Counts in one byte each, those of 255 and more beside them."""
    return b"".join((struct.pack("<I", len(n)), np.minimum(n, 255).astype(np.uint8).tobytes(), n[n >= 255].astype("<i8").tobytes()))


def unpack_counts(data: bytes) -> np.ndarray:
    size, = struct.unpack_from("<I", data)
    n = np.frombuffer(data, np.uint8, size, 4).astype(np.int64)
    n[n == 255] = np.frombuffer(data, "<i8", -1, 4 + size)
    return n


def _answered(lists: pd.DataFrame) -> pd.DataFrame:
    """To each block the counts over all blocks of its n-grams of one partition, in their order;
    the block knows the n-grams. A block that two tasks read has two lists and one answer."""
    got = [unpack(x) for x in lists["list"]]
    codes, at = np.unique(np.concatenate([c for c, _ in got]), return_inverse=True)
    total = np.bincount(at, np.concatenate([n for _, n in got]), len(codes)).astype(np.int64)
    places = np.split(at, np.cumsum([len(c) for c, _ in got])[:-1])
    out = []
    for block, which in lists.groupby("block").indices.items():
        mine = places[which[0]] if len(which) == 1 else np.unique(np.concatenate([places[i] for i in which]))
        out.append((block, lists["k"].iloc[0], lists["part"].iloc[0], pack_counts(total[mine])))
    return pd.DataFrame(out, columns=["block", "k", "part", "counts"])


def score_text(codes: list[np.ndarray], counts: list[np.ndarray], before: np.ndarray, copies: int, total: int, alpha: float) -> float:
    """The sum of log2 scores of one text's words. ``counts`` are the corpus counts of ``codes``;
    the text's own n-grams, times its copies, are taken out."""
    n = len(codes[0])
    left = []
    for k, (code, count) in enumerate(zip(codes, counts)):
        # n-grams that lie in the text; those before its first words count for nothing
        inside = before >= k
        _, at, own = np.unique(code[inside], return_inverse=True, return_counts=True)
        others = np.zeros(n, np.int64)
        others[inside] = count[inside] - copies * own[at]
        left.append(others)
    score = np.log2((left[0] + 1) / (total - copies * n + 1))
    for k in range(1, len(codes)):
        # the context is the n-gram of one word less that ends at the word before
        context = np.zeros(n, np.int64)
        context[1:] = left[k - 1][:-1]
        seen = (left[k] > 0) & (context > 0)
        longer = np.where(seen, np.log2(np.where(seen, left[k], 1) / np.where(seen, context, 1)), score + np.log2(alpha))
        score = np.where(before >= k, longer, score)
    return float(score.sum())


def _scored(order: int, alpha: float, total: int):
    """Scores of a block's documents from the counts of its n-grams."""
    def run(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"doc_id": [], "n_words": [], "log2_prob": []})
        texts, words = [t or b"" for t in rows["text"]], Words()
        th = rows["th"].to_numpy(np.int64).view(np.uint64)
        pieces = [(a, *grams(texts[a:b], order, words)) for a, b in parts(texts)]
        answers = answers.sort_values(["k", "part"])
        tables = []
        for k in range(order + 1):
            own = np.unique(np.concatenate([codes[k - 1][before >= k - 1] for _, codes, before, _ in pieces]) if k else th)
            got = [unpack_counts(x) for x in answers["counts"][answers["k"] == k]]
            tables.append((own, np.concatenate(got) if got else np.zeros(0, np.int64)))

        def counted(k: int, codes: np.ndarray) -> np.ndarray:
            """The corpus counts of n-grams of this block; others, across the start of a text, are not used."""
            own, n = tables[k]
            return n[np.minimum(np.searchsorted(own, codes), len(own) - 1)] if len(own) else np.zeros(len(codes), np.int64)

        copies, sizes, sums = counted(0, th), [], []
        for a, codes, before, size in pieces:
            found = [counted(k + 1, c) for k, c in enumerate(codes)]
            ends = np.cumsum(size)
            for i, (end, m) in enumerate(zip(ends.tolist(), size.tolist())):
                own = slice(end - m, end)
                sizes.append(m)
                sums.append(score_text([c[own] for c in codes], [c[own] for c in found], before[own], int(copies[a + i]), total, alpha) if m else 0.0)
        return pd.DataFrame({"doc_id": rows["doc_id"], "n_words": sizes, "log2_prob": sums})
    return run


def blocked(docs: DataFrame, rows_per_block: int) -> DataFrame:
    """(doc_id, text, th, block): a block is a run of rows of one file."""
    at = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("i")]
    try:
        rows = docs.select("doc_id", "text", *at)
    except AnalysisException:  # not read from files: written first, so that rows have a place
        rows = written(docs.select("doc_id", "text"), "lm-rows").select("doc_id", "text", *at)
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), text_hash(F.coalesce("text", F.lit(""))).alias("th"),
                       F.xxhash64("file", F.floor(F.col("i") / rows_per_block)).alias("block"))


def lm_scores(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, block_bytes: int = BLOCK_BYTES, part_words: int = PART_WORDS) -> DataFrame:
    """(doc_id, n_words, log2_prob, mean_log2) of every document."""
    if order < 1:
        raise ValueError("an n-gram has at least one word")
    docs = docs.select("doc_id", "text") if "_metadata" in docs.columns else docs
    stats = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"),
                     F.coalesce(F.sum(F.regexp_count("text", F.lit(WORD))), F.lit(0)).alias("words")).first()
    rows = blocked(docs, max(1, stats["n"] * block_bytes // max(1, stats["bytes"])))
    bits = (blocks_for(stats["words"], part_words) - 1).bit_length()
    lists = rows.select("block", "text", "th").mapInPandas(_listed(order, bits), "block long, k int, part long, list binary")
    answers = lists.groupBy("k", "part").applyInPandas(_answered, "block long, k int, part long, counts binary")
    out = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_scored(order, alpha, stats["words"]), "doc_id long, n_words long, log2_prob double")
    return out.withColumn("mean_log2", F.when(F.col("n_words") > 0, F.col("log2_prob") / F.col("n_words")))
