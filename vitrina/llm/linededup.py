"""Line dedup by winnowing over line hashes (DataFrame functions only).

The non-blank lines of a document form a sequence. Fingerprints are chosen so that every
repeat that counts has one: of the hashes of a single line the line itself, if it has
``min_words`` words or more (a window of one line, whose minimum it is); and in stretches of
shorter lines each window of ``window`` lines, known by the digest of its lines and placed at
its least line hash. For each fingerprint the earliest place is found - in the document with the
smallest doc_id, and highest up in it - and every other place is joined to it. From the joined
positions the match is extended both ways over the shorter lines around it, as long as they equal
those around the earliest place; longer lines there have fingerprints of their own. Whole
matches at the later places are deleted. Matches are judged on the input.

So a line of ``min_words`` words stays once; a shorter one goes only with a longer repeated
neighbour or in a repeated stretch of ``window`` lines.

Plan: a fingerprint's row carries its place, a 128-bit digest and the hashes of the shorter
lines around it, no text. The earliest place of each is an aggregate, partial in every task, so a
line that a third of all documents hold meets one row, and no pairs of places are made.

Defined results: a null text has no lines and stays null; blank lines are never
matched nor deleted; rows with equal doc_id and text are one document and share
its result; a null doc_id counts as the largest; ties between equal ids go by
text hash. A document may lose all its lines and stays as a row with an empty
text. Other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, once, text_hash, written

# The place of a fingerprint, in the order that makes one occurrence the earlier.
PLACE = "struct(doc_id is null as no_id, doc_id, th, pos)"
MIN_WORDS, WINDOW = 5, 5


def fingerprints(docs: DataFrame, min_words: int, window: int) -> DataFrame:
    """(doc_id, th, pos, len, digest, before, after): pos counts the non-blank lines from 0; before
    and after are the hashes of the shorter lines next to a line, nearest first."""
    word = WORD.replace(chr(92), chr(92) * 2)
    lines = docs.select(F.col("doc_id").cast("long"), text_hash(F.col("text")).alias("th"), F.split("text", "\n").alias("lines"))
    lines = lines.select("doc_id", "th", F.expr(f"""
        filter(transform(lines, x -> struct(x as line, xxhash64(x) as h, regexp_count(x, '{word}') as n)), x -> x.n > 0)""").alias("found"))
    lines = once(lines.select("doc_id", "th", "found"), "l", F.col("found")).drop("found")
    # the positions of the longer lines, with an end on either side
    lines = once(lines, "long", F.expr(f"concat(array(-1), filter(sequence(0, size(l)), (x, i) -> i < size(l) and l[i].n >= {min_words}), array(size(l)))"))
    single = F.expr("""
        transform(filter(long, (x, i) -> i > 0 and i < size(long) - 1), (p, i) -> struct(
            p as pos, 1 as len, unhex(md5(cast(l[p].line as binary))) as digest,
            reverse(transform(slice(l, long[i] + 2, p - long[i] - 1), x -> x.h)) as before,
            transform(slice(l, p + 2, long[i + 2] - p - 1), x -> x.h) as after))""")
    # windows of shorter lines lie between two longer ones
    starts = f"filter(transform(long, (p, i) -> struct(p + 1 as a, get(long, i + 1) - {window} as b)), x -> x.b is not null and x.b >= x.a)"
    windows = F.expr(f"""
        flatten(transform({starts}, s -> transform(sequence(s.a, s.b), j -> struct(
            j as pos, {window} as len,
            unhex(md5(cast(array_join(transform(slice(l, j + 1, {window}), x -> x.line), '\\n') as binary))) as digest,
            cast(array() as array<bigint>) as before, cast(array() as array<bigint>) as after))))""")
    return lines.select("doc_id", "th", F.explode(F.concat(single, windows)).alias("f")).select("doc_id", "th", "f.*")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, window: int = WINDOW) -> DataFrame:
    """(doc_id, th, gone): for each document with later repeated lines the
    indexes, among its non-blank lines, of the lines to delete."""
    rows = written(fingerprints(docs, min_words, window), "line-fingerprints")
    # rows that repeat a document are one place
    first = rows.groupBy("len", "digest").agg(
        F.min(F.struct(F.expr(PLACE).alias("at"), "before", "after")).alias("first"),
        (F.min(F.expr(PLACE)) < F.max(F.expr(PLACE))).alias("twice")).where("twice")
    later = rows.join(first.select("len", "digest", "first"), ["len", "digest"]).where(F.expr(f"{PLACE} > first.at"))

    def alike(side: str) -> str:
        """How many lines on one side equal those at the earliest place."""
        both = f"zip_with({side}, first.{side}, (a, b) -> coalesce(a = b, false))"
        return f"if(array_contains({both}, false), array_position({both}, false) - 1, size({side}))"

    matched = F.expr(f"sequence(pos - cast({alike('before')} as int), pos + len - 1 + cast({alike('after')} as int))")
    return (later.select("doc_id", "th", F.explode(matched).alias("i"))
            .groupBy("doc_id", "th").agg(F.collect_set("i").alias("gone")))


def _edited(docs: DataFrame, min_words: int, window: int) -> DataFrame:
    """(d, kept, n_lines, n_removed): each document as a struct, its text
    without the later repeated runs, its non-blank lines and how many of them
    are deleted."""
    gone = repeated_lines(docs.select("doc_id", "text"), min_words, window)
    keyed = docs.select(F.struct(*docs.columns).alias("d")).select("d", F.col("d.doc_id").cast("long").alias("id"), text_hash(F.col("d.text")).alias("h"))
    both = keyed.join(gone, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("th")), "left").select(
        "d", "gone", F.split("d.text", "\n").alias("lines"))
    full = both.withColumn("full", F.expr(r"filter(transform(lines, (x, i) -> if(x rlike '[^\\x20\\x09-\\x0D]', i, -1)), x -> x >= 0)"))
    left = F.expr("array_except(sequence(0, size(lines) - 1), transform(gone, x -> element_at(full, x + 1)))")
    text = F.array_join(F.transform(left, lambda i: F.element_at("lines", i + 1)), "\n")
    return full.select("d", F.when(F.col("gone").isNull(), F.col("d.text")).otherwise(text).alias("kept"),
                       F.when(F.col("d.text").isNull(), 0).otherwise(F.size("full")).cast("long").alias("n_lines"),
                       F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"))


def line_report(docs: DataFrame, min_words: int = MIN_WORDS, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed and the text that is left."""
    return _edited(docs, min_words, window).select("d.doc_id", "n_lines", "n_removed", F.col("kept").alias("text"))


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS, window: int = WINDOW) -> DataFrame:
    """All rows and columns of ``docs`` with the text that is left; n_chars,
    if there, follows the text."""
    types = dict(docs.dtypes)

    def column(c: str):
        if c == "text":
            return F.col("kept").alias(c)
        if c == "n_chars":
            return F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("d.n_chars")).cast(types[c]).alias(c)
        return F.col(f"d.`{c}`")

    return _edited(docs, min_words, window).select(*[column(c) for c in docs.columns])
