"""Substring dedup by recompression.

A word is deleted when it lies in a window of ``window`` consecutive words whose
word sequence starts at some other place too, in the same document or another.

Every document is parsed bottom-up in rounds: first runs of equal words, then,
round after round, pairs of neighbouring symbols get a new name. A name is a
hash of what it stands for, and whether two neighbours form a pair depends on
their names alone, so the naming is global without any exchange: equal
substrings get the same symbols, except near their ends. Each symbol carries
the range of words that decided it. A window is *anchored* at a symbol of a high
round whose deciding range lies inside the window (of several the one with the
largest hash, of equal ones the last); equal windows therefore have the same
anchor name at the same place. Neighbouring windows of one symbol form a unit,
named by the symbol and the words that all windows there share.

A name that occurs once clears all windows of its unit. If all units of a name
have equal words, all their windows repeat: long repeats are settled by one row
per unit. The rest - units of one name whose surroundings differ, and
windows inside long runs of a word - are compared window by window, by 128-bit digests.
All groupings pre-aggregate, and nothing is gathered but the findings of one
document.

Defined results: null and wordless texts have no words; a text of fewer words
than the window loses none; repeated rows are places of their own, so their
windows repeat. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_hash, written

# Rounds whose symbols serve as anchors, the preferred ones first.
ROUNDS = ((3, 4), (2,), (1,))
STEP = 18
FAR = 1 << 40
SLICE_BYTES = 4 << 20
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a bounded amount of text, or one document."""
    size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(size.tolist()):
        if i > start and total + n > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if batch.num_rows > start:
        yield batch.slice(start)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and where each text's words begin (one more
    entry than texts)."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, at = split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    return flat.filter(pa.array(real)), np.concatenate(([0], np.cumsum(real)))[at]


def word_hashes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each word."""
    coded = words.dictionary_encode()
    both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()), np.uint64).reshape(-1, 2)
    index = coded.indices.to_numpy()
    return both[index, 0], both[index, 1]


class Rolling:
    """Hashes of spans of words, from prefix sums of a polynomial mod 2^64."""

    def __init__(self, hashes: np.ndarray, odd: np.uint64):
        n = len(hashes) + 1
        power = np.full(n, odd)
        power[0] = 1
        inverse = np.full(n, np.uint64(pow(int(odd), -1, 1 << 64)))
        inverse[0] = 1
        power, self.inverse = np.multiply.accumulate(power), np.multiply.accumulate(inverse)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes) * power[:-1], dtype=np.uint64)))

    def span(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * self.inverse[a])


def parse(names: np.ndarray, doc: np.ndarray, rounds: int) -> list[tuple[np.ndarray, ...]]:
    """(name, start, from, to) of the symbols that each round makes: from and to
    bound the words that decide that the symbol stands there."""
    n = len(names)
    # runs of equal words; what decides a run are the words beside it
    s = np.flatnonzero(np.concatenate(([True], (names[1:] != names[:-1]) | (doc[1:] != doc[:-1]))))
    e, d = np.append(s[1:], n), doc[s]
    name = mix(names[s] + (e - s).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    joined = d[1:] == d[:-1]  # a neighbour in the same document
    ds = np.where(np.concatenate(([False], joined)), s - 1, -FAR)
    de = np.where(np.append(joined, False), e + 1, FAR)
    made = []
    for level in range(1, rounds + 1):
        right = mix(name + np.uint64(level)) >> np.uint64(63) == 1
        joined = d[1:] == d[:-1]
        pair = np.append(~right[:-1] & right[1:] & joined, False)
        before = np.where(np.concatenate(([False], joined)), np.concatenate(([0], ds[:-1])), -FAR)
        behind = np.where(np.append(joined, False), np.append(de[1:], 0), FAR)
        # a pair depends on its two symbols alone; a left symbol without partner
        # on the next one too, a right one on the one before
        ds = np.where(right, np.minimum(ds, before), ds)
        de = np.where(pair | ~right, np.maximum(de, behind), de)
        name = np.where(pair, mix(name * np.uint64(0xE7037ED1A0B428DB) + mix(np.append(name[1:], np.uint64(0))) + np.uint64(level)), name)
        stay = np.concatenate(([True], ~pair[:-1]))
        made.append((name[pair], s[pair], ds[pair], de[pair]))
        name, s, ds, de, d = name[stay], s[stay], ds[stay], de[stay], d[stay]
    return made


def anchors(names: np.ndarray, doc: np.ndarray, valid: np.ndarray, window: int, rounds: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(name, start) of the anchor of the window that begins at each word; start
    is -1 where no symbol serves. valid tells which words begin a window; rounds
    are groups of rounds, the preferred first."""
    n = len(names)
    out_name, out_start, todo = np.zeros(n, np.uint64), np.full(n, -1, np.int64), valid.copy()
    best, words = np.empty(n, np.int64), np.arange(n)
    made = parse(names, doc, max(map(max, rounds)))
    for group in rounds:
        name, s, ds, de = (np.concatenate([made[r - 1][i] for r in group]) for i in range(4))
        low, high = np.maximum(de - window, 0), np.minimum(ds, n - 1) + 1
        open_ = np.concatenate(([0], np.cumsum(todo)))
        use = np.flatnonzero(low < high)
        use = use[open_[high[use]] > open_[low[use]]]
        if not len(use):
            continue
        # of several symbols the largest hash serves, of equal ones the last
        use = use[np.lexsort((s[use], mix(name[use])))]
        length = (high - low)[use]
        at = np.repeat(low[use] - (np.cumsum(length) - length), length)
        at += np.arange(len(at))
        best[:] = -1
        best[at] = np.repeat(use, length)
        got = words[todo & (best >= 0)]
        out_name[got], out_start[got], todo[got] = name[best[got]], s[best[got]], False
    return out_name, out_start


def parsed(batch: pa.RecordBatch, window: int, rounds: tuple) -> pa.RecordBatch | None:
    """The units of a batch's documents: (doc_id, th, name, u, lo, hi) with the
    first and the end of the starts of their windows; name is null where windows
    have no anchor."""
    words, begin = words_of(batch.column("text"))
    sizes = np.diff(begin)
    if not len(words) or sizes.max() < window:
        return None
    h1, h2 = word_hashes(words)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    valid = np.arange(len(words)) + window <= begin[doc + 1]
    name, start = anchors(h1 ^ mix(h2), doc, valid, window, rounds)
    # windows whose offsets from their symbol fall into one step share a core of
    # window - STEP + 1 words; only units with equal cores can hold equal windows
    step = np.where(start < 0, 0, (start - np.arange(len(words))) // STEP)
    fresh = np.concatenate(([True], (name[1:] != name[:-1]) | (start[1:] != start[:-1]) | (step[1:] != step[:-1]) | (doc[1:] != doc[:-1])))
    lo = np.flatnonzero(fresh & valid)
    edge = np.append(np.flatnonzero(fresh | ~valid), len(words))
    hi = edge[np.searchsorted(edge, lo, "right")]
    rolling, at = Rolling(h1 + mix(h2), _ODD[0]), start[lo] - step[lo] * STEP
    core = rolling.span(np.where(start[lo] < 0, lo, at), np.where(start[lo] < 0, lo, at + window - STEP + 1))
    name = mix(name[lo] + core * _ODD[1] + step[lo].astype(np.uint64))
    u = mix(rolling.span(lo, hi + window - 1) + (start[lo] - lo).astype(np.uint64) * _ODD[1] + (hi - lo).astype(np.uint64))
    of = doc[lo]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(pa.array(of)), batch.column("th").take(pa.array(of)),
         pa.array(name.view(np.int64), mask=start[lo] < 0), pa.array(u.view(np.int64)),
         pa.array((lo - begin[of]).astype(np.int32)), pa.array((hi - begin[of]).astype(np.int32))],
        ["doc_id", "th", "name", "u", "lo", "hi"])


def _units(window: int, rounds: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                if (out := parsed(part, window, rounds)) is not None:
                    yield out
    return run


def _open_windows(window: int):
    """(doc_id, th, p, h1, h2) of every window of the intervals given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                words, begin = words_of(part.column("text"))
                if not len(words):
                    continue
                h1, h2 = word_hashes(words)
                r1, r2 = Rolling(h1, _ODD[0]), Rolling(h2, _ODD[1])
                spans = part.column("open")
                flat, at = spans.flatten(), spans.offsets.to_numpy()
                of = np.repeat(np.arange(part.num_rows), np.diff(at))
                lo, hi = flat.field("lo").to_numpy(), flat.field("hi").to_numpy()
                length = hi - lo
                row = np.repeat(of, length)
                p = np.repeat(lo - (np.cumsum(length) - length), length) + np.arange(length.sum())
                for i in range(0, len(p), 1 << 18):
                    r, x = row[i:i + (1 << 18)], p[i:i + (1 << 18)]
                    a = begin[r] + x
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(pa.array(r)), part.column("th").take(pa.array(r)), pa.array(x.astype(np.int32)),
                         pa.array(r1.span(a, a + window).view(np.int64)), pa.array(r2.span(a, a + window).view(np.int64))],
                        ["doc_id", "th", "p", "h1", "h2"])
    return run


def _kept(window: int):
    """(doc_id, n_words, n_removed, text) of documents with the starts of their
    repeated windows, as intervals ``whole`` and single starts ``p``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                words, begin = words_of(part.column("text"))
                step = np.zeros(len(words) + 1, np.int64)
                spans, ps = part.column("whole"), part.column("p")
                of = np.repeat(begin[:-1], pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False))
                flat = spans.flatten()
                np.add.at(step, of + flat.field("lo").to_numpy(), 1)
                np.add.at(step, of + flat.field("hi").to_numpy() + window - 1, -1)
                of = np.repeat(begin[:-1], pc.fill_null(pc.list_value_length(ps), 0).to_numpy(zero_copy_only=False)) + ps.flatten().to_numpy()
                np.add.at(step, of, 1)
                np.add.at(step, of + window, -1)
                keep = np.cumsum(step)[:-1] == 0
                left = np.concatenate(([0], np.cumsum(keep)))[begin]
                text = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), words.filter(pa.array(keep))), " ")
                n = np.diff(begin)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), pa.array(n - np.diff(left)), text], ["doc_id", "n_words", "n_removed", "text"])
    return run


def remove_repeats(docs: DataFrame, window: int = 35, rounds: tuple = ROUNDS) -> DataFrame:
    """(doc_id, n_words, n_removed, text) of every document: its words without
    those of repeated windows, joined by one blank."""
    texts = docs.select(F.col("doc_id").cast("long"), text_hash(F.col("text")).alias("th"), F.col("text").cast("string"))
    units = written(texts.mapInArrow(_units(window, rounds), "doc_id long, th long, name long, u long, lo int, hi int"), "units")
    # one row per symbol name: how often it occurs, and whether its units are all alike
    names = units.where("name is not null").groupBy("name").agg(F.count("*").alias("n"), F.min("u").alias("a"), F.max("u").alias("b"))
    shared = names.where("n > 1").select("name", (F.col("a") == F.col("b")).alias("alike"))
    found = units.join(shared, "name").select("doc_id", "th", "lo", "hi", "alike").unionByName(
        units.where("name is null").select("doc_id", "th", "lo", "hi", F.lit(False).alias("alike")))
    span = F.struct("lo", "hi")
    # rows that repeat a document repeat its findings; sets keep them once
    spans = written(found.groupBy("doc_id", "th").agg(
        F.collect_set(F.when(F.col("alike"), span)).alias("whole"), F.collect_set(F.when(~F.col("alike"), span)).alias("open")), "spans")

    def beside(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        r = right.withColumnRenamed("doc_id", "_id").withColumnRenamed("th", "_th")
        return left.join(r, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), how).drop("_id", "_th")

    held = beside(texts, spans, "left")
    unsettled = held.where(F.size("open") > 0).select("doc_id", "th", "text", "open")
    windows = written(unsettled.mapInArrow(_open_windows(window), "doc_id long, th long, p int, h1 long, h2 long"), "windows")
    # written, so that the join has an exchange of its own on either side and a digest that very many
    # documents share is split over tasks
    twice = written(windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2"), "repeated-windows")
    starts = windows.join(twice, ["h1", "h2"], "left_semi").groupBy("doc_id", "th").agg(F.collect_set("p").alias("p"))
    none = F.expr("cast(array() as array<struct<lo:int,hi:int>>)")
    marked = beside(held.select("doc_id", "th", "text", F.coalesce("whole", none).alias("whole")), starts, "left")
    out = marked.select("doc_id", "text", "whole", F.coalesce("p", F.expr("cast(array() as array<int>)")).alias("p"))
    return out.mapInArrow(_kept(window), "doc_id long, n_words long, n_removed long, text string")
