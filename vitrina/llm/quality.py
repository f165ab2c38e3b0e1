"""Document quality by Bradley-Terry pairwise ranking.

A document's strength is a linear score of features of its text. For a pair of
labelled documents of which one is preferred (label 1 over label 0), the model
gives the preference the logistic probability of the difference of their
strengths; the weights minimise that loss over pairs. The decision is a quantile
of the strengths: the share of label 0 among all labelled documents decides at
which quantile of their strengths the threshold lies.

Only features of the text are inputs. The weights are fitted on at most
``max_rows`` labelled documents per label (those with the smallest hash, so a
rerun learns the same); threshold and scale cover all labelled documents, and
every document is scored.

Defined results: a null, empty or blank text has the features of an empty text
and is scored like any other; labels that are null or neither 0 nor 1, and
labelled ids without a document, teach nothing; rows with equal doc_id and text
are one document when learning and get equal scores;
with no usable pair every score is 0.5. Columns besides doc_id and text are
ignored.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_hash, written

FEATURES = ["repeat", "distinct", "symbol", "upper", "digit", "stop", "line_repeat", "size", "word_length",
            "repeat_any", "symbol_any", "upper_any"]
# bytes, fixed classes
_SPACE = b" \t\n\r\x0b\x0c"
_SYMBOLS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b not in b".,")
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))


def text_features(text: bytes | None) -> list[float]:
    """Features of one whole text; shares lie between 0 and 1."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(FEATURES)
    k, n = len(words), len(text)

    def share(chars: bytes) -> float:
        return (n - len(text.translate(None, chars))) / n

    repeat = sum(map(operator.eq, words, words[1:])) / k
    lines = [x for x in text.split(b"\n") if x.strip()]
    symbol, upper = share(_SYMBOLS), share(_UPPER)
    # distinct words shrink with the length of a text; the ratio of logarithms shrinks less
    distinct = np.log1p(len(set(words))) / np.log1p(k)
    return [repeat, distinct, symbol, upper, share(_DIGITS), share(b".,"), 1 - len(set(lines)) / len(lines),
            np.log1p(k) / 10, min(n / k, 30) / 30, min(1.0, 10 * repeat), min(1.0, 20 * symbol), min(1.0, 5 * upper)]


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, th, x): text hash and feature vector of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array([text_features(t) for t in b.column("text").to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), x], ["doc_id", "th", "x"])

    return docs.select(F.col("doc_id").cast("long"), text_hash(F.col("text")).alias("th"), F.col("text").cast("binary")).mapInArrow(
        run, "doc_id long, th long, x array<double>")


@dataclass
class BradleyTerry:
    """score = sigmoid((weights . x - threshold) / scale)."""

    weights: list[float]
    threshold: float
    scale: float

    def strength(self, x: Column) -> Column:
        return F.aggregate(F.zip_with(x, F.array(*[F.lit(float(w)) for w in self.weights]), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)

    def score(self, x: Column) -> Column:
        z = (self.strength(x) - F.lit(self.threshold)) / F.lit(self.scale)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))


def fit_pairs(x: np.ndarray, y: np.ndarray, pairs: int = 40_000, l2: float = 1e-4, steps: int = 60, seed: int = 7) -> list[float]:
    """Fit the weights by Newton steps on random pairs of preferred and other
    rows."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    rng = np.random.default_rng(seed)
    d = x[rng.choice(good, pairs)] - x[rng.choice(bad, pairs)]
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        grad = d.T @ (p - 1) / pairs + l2 * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / pairs + l2 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w.tolist()


def ranked(values: DataFrame, rank: int, bins: int = 1024) -> float:
    """The value of column s with ``rank`` smaller or equal ones before it in
    sorted order, by histograms that narrow down to one value; at most ``bins``
    rows reach the driver at a time."""
    low, high = values.agg(F.min("s"), F.max("s")).first()
    while low < high:
        width = (high - low) / bins
        at = F.least(F.floor((F.col("s") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)) if width > 0 else (F.col("s") > F.lit(low)).cast("long")
        inside = values.where(F.col("s").between(F.lit(low), F.lit(high)))
        for r in inside.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.min("s").alias("a"), F.max("s").alias("b")).orderBy("bin").collect():
            if rank < r.n:
                low, high = r.a, r.b
                break
            rank -= r.n
    return low


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, th, x, quality): a row per labelled document, however often its
    row repeats, and label. Vectors are exchanged, no texts."""
    usable = labels.where("quality in (0, 1)").select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).dropDuplicates()
    single = features(docs).groupBy("doc_id", "th").agg(F.first("x").alias("x"))
    return single.join(usable, "doc_id").select("doc_id", "th", "x", "quality")


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = 10_000, **how) -> BradleyTerry:
    """Fit the weights on at most ``max_rows`` documents of each label, which
    reach the driver as feature vectors; set the threshold by all of them."""
    rows = written(labelled(docs, labels), "labelled")
    n = {r.quality: r.n for r in rows.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return BradleyTerry([0.0] * len(FEATURES), 0.0, 1.0)
    got = []
    # 52 bits of a hash, exact as a double
    hashed = rows.withColumn("s", F.shiftrightunsigned(F.xxhash64("doc_id", "th"), 12).cast("double"))
    for value in (0, 1):
        mine = hashed.where(F.col("quality") == value)
        # the cut-off is found by histograms: what reaches the driver is what is used, however many partitions there are
        last = ranked(mine, min(max_rows, n[value]) - 1)
        got += sorted(mine.where(F.col("s") <= last).select("s", "doc_id", "th", "x", "quality").collect(), key=lambda r: (r.s, r.doc_id, r.th))[:max_rows]
    # sorted, so that the pairs drawn do not depend on the partitions
    got.sort(key=lambda r: (r.quality, r.x))
    model = BradleyTerry(fit_pairs(np.array([r.x for r in got]), np.array([r.quality for r in got]), **how), 0.0, 1.0)
    strengths = written(rows.select(model.strength(F.col("x")).alias("s")), "strengths")
    # between the two strengths around the quantile, so that ties fall on one side
    below = ranked(strengths, n[0] - 1)
    r = strengths.agg(F.count(F.when(F.col("s") <= below, 1)).alias("n"), F.min(F.when(F.col("s") > below, F.col("s"))).alias("next"),
                      F.stddev_pop("s").alias("std")).first()
    above = below if r.n > n[0] else r.next
    # rounded, as the last digits of the deviation depend on the order of rows
    return BradleyTerry(model.weights, float((below + above) / 2), float(f"{max(1e-6, r.std / 4):.6g}"))


def held_out(doc_id: Column) -> Column:
    """The fold that labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def scored(docs: DataFrame, model: BradleyTerry) -> DataFrame:
    """(doc_id, score, predicted) of every document."""
    out = features(docs).select("doc_id", model.score(F.col("x")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_quality(docs: DataFrame, model: BradleyTerry) -> DataFrame:
    """The documents with a score of 0.5 or more, all columns and rows kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.array(model.weights)
        for b in batches:
            s = np.array([np.dot(w, text_features(t and t.encode())) for t in b.column("text").to_pylist()])
            yield b.filter(pa.array(s >= model.threshold))

    return docs.mapInArrow(run, docs.schema)
