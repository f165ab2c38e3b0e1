"""Benchmark decontamination with a distributed positional inverted index
(DataFrame functions only).

Words are runs of ASCII letters and digits and of characters beyond ASCII, A-Z
lower-cased. The index stores a posting (term, document, position) for every
occurrence in the training documents of a word that the benchmark uses. A
benchmark item is searched by its windows of ``window`` consecutive words (an
item of fewer words is one window). For each window the posting lists are
intersected from its rarest term: the list of the rarest gives candidate
starts, the list of the next rarest, adjusted by the offset between the two,
thins them, and the remaining terms are compared at the places that are left.
The results are exact phrase matches; ``proximity`` gives the places where the
two rarest terms stand near each other instead.

Defined results: null texts and texts without words have no words and no hits;
items without words, and null items, match nothing; equal texts of several
items all count; repeated documents are each reported. The words of
items without an id are hit, but such items are neither counted nor listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ascii_lower, once, text_hash, written

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A vocabulary or window table of up to this many rows is sent to all executors;
# a larger one is joined by a shuffle.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    """The words of a text in order, an empty array for null."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def phrase_id(terms: Column) -> Column:
    """128-bit digest of a sequence of words."""
    return F.md5(F.array_join(terms, " ").cast("binary"))


def same_place(a: str, b: str, start: str) -> Column:
    return (F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.th") == F.col(f"{b}.th"))
            & (F.col(f"{a}.wid") == F.col(f"{b}.wid")) & (F.col(f"{a}.{start}") == F.col(f"{b}.start")))


def sized(df: DataFrame) -> DataFrame:
    """The broadcast hint, for tables counted to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def windows(items: DataFrame, window: int) -> DataFrame:
    """(wid, item, item_id, terms): the distinct rows of all windows."""
    w = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w")).where("size(w) > 0")
    starts = F.expr(f"sequence(0, greatest(size(w) - {window}, 0))")
    rows = w.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, window))).alias("terms"))
    # a window's id is its digest, so that equal windows are searched once
    return rows.select(phrase_id(F.col("terms")).alias("wid"), "item_id", "terms").distinct()


def postings(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(doc_id, th, pos, term): the index, term a number of the vocabulary."""
    tokens = docs.select(F.col("doc_id").cast("long"), text_hash(F.col("text")).alias("th"), F.posexplode(words(F.col("text"))).alias("pos", "word"))
    return tokens.join(vocabulary, "word").select("doc_id", "th", "pos", "term")


class Index:
    """The inverted index of ``docs`` for the words of ``items``, with the
    windows of the items in the order of their terms' rarity."""

    def __init__(self, docs: DataFrame, items: DataFrame, window: int):
        found = written(windows(items, window), "windows")
        vocabulary = written(found.select(F.explode("terms").alias("word")).distinct().select("word", F.xxhash64("word").alias("term")), "vocabulary")
        self.docs, self.windows = docs, found
        self.postings = written(postings(docs, sized(vocabulary)), "postings")
        # terms that no document has make their windows impossible
        frequency = self.postings.groupBy("term").agg(F.count("*").alias("n"))
        terms = found.select("wid", "terms").distinct().select("wid", F.size("terms").alias("len"), F.posexplode("terms").alias("at", "word"))
        ranked = terms.join(vocabulary, "word").join(frequency, "term").withColumn(
            "rank", F.row_number().over(Window.partitionBy("wid").orderBy("n", "term", "at"))).withColumn(
            "present", F.count("*").over(Window.partitionBy("wid")))
        self.ranked = written(ranked.where("present = len").select("wid", "term", "at", "len", "rank"), "ranked")

    def candidates(self, rank: int) -> DataFrame:
        """(doc_id, th, start, wid, len): window starts that the posting list of
        the term of this rarity allows."""
        lists = sized(self.ranked.where(F.col("rank") == rank).select("term", "at", "wid", "len"))
        return self.postings.join(lists, "term").select("doc_id", "th", (F.col("pos") - F.col("at")).alias("start"), "wid", "len")

    def starts(self) -> DataFrame:
        """Starts at which the two rarest terms of a window agree."""
        first = self.candidates(1).where("start >= 0").distinct()
        pairs = first.where("len > 1").alias("a").join(self.candidates(2).alias("b"), same_place("a", "b", "start"), "left_semi")
        return pairs.unionByName(first.where("len = 1"))

    def marked(self) -> DataFrame:
        """(d, doc_id, th, n_words, n_hit, wids) of every document: the document
        as a struct, the words inside exact occurrences of windows, and the
        windows that occur."""
        places = self.starts().groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "wid", "len")).alias("p"))
        places = places.select(F.col("doc_id").alias("p_id"), F.col("th").alias("p_th"), "p")
        keyed = self.docs.select(F.struct(*self.docs.columns).alias("d")).select("d", F.col("d.doc_id").cast("long").alias("doc_id"), text_hash(F.col("d.text")).alias("th"))
        both = keyed.join(places, F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("th") == F.col("p_th")), "left")
        # the remaining terms are compared at the places that are left
        found = once(once(both, "w", words(F.col("d.text"))), "m", F.filter(
            "p", lambda p: phrase_id(F.slice("w", p["start"] + 1, p["len"])) == p["wid"]))
        hit = F.array_distinct(F.flatten(F.transform("m", lambda p: F.sequence(p["start"], p["start"] + p["len"] - 1))))
        return found.select("d", "doc_id", "th", F.size("w").cast("long").alias("n_words"),
                            F.when(F.col("m").isNull(), 0).otherwise(F.size(hit)).cast("long").alias("n_hit"),
                            F.array_distinct(F.transform("m", lambda p: p["wid"])).alias("wids"))

    def proximity(self, slop: int) -> DataFrame:
        """(doc_id, th, wid, start): places where the two rarest terms of a
        window stand at most ``slop`` words off the distance they have in it."""
        near = self.candidates(1).withColumn("shifted", F.explode(F.sequence(F.col("start") - slop, F.col("start") + slop)))
        return near.alias("a").join(self.candidates(2).alias("b"), same_place("a", "b", "shifted"), "left_semi").select("doc_id", "th", "wid", "start").distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items (ids of the items
    with occurring windows, sorted as strings), contaminated."""
    index = Index(docs.select("doc_id", "text"), items, window)
    marked = written(index.marked().select("doc_id", "th", "n_words", "n_hit", "wids"), "marked")
    hits = marked.where("n_hit > 0").select("doc_id", "th", F.explode("wids").alias("wid")).distinct()
    named = hits.join(index.windows.select("wid", "item_id").distinct(), "wid").groupBy("doc_id", "th").agg(
        F.sort_array(F.collect_set("item_id")).alias("items"))
    named = named.select(F.col("doc_id").alias("_id"), F.col("th").alias("_h"), "items")
    out = marked.join(named, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_h")), "left")
    out = out.withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """The documents that contain no window of an item, all columns kept."""
    return Index(docs, items, window).marked().where("n_hit = 0").select("d.*")
