"""The registered queries of the operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import convtrie, decontaminate, filteraudit, licenses, linededup, lmscore, mixing, pii, quality, simhash, substring, topk, urlfilter
from .common import table

URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(table(spark, sf_dir, "documents")).taken().select("doc_id", "size", "source", "source_size", "target", "taken")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_report(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents"), 35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), 4, 4).select("doc_id", "fingerprint", "component_id")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lmscore.lm_scores(table(spark, sf_dir, "documents"))
    # sums of logarithms, rounded to what any order of adding gives
    return scores.select("doc_id", "n_words", F.round("log2_prob", 3).alias("log2_prob"), F.round("mean_log2", 6).alias("mean_log2"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.train(docs))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.learn(docs, labels.where(~quality.held_out(F.col("doc_id"))))
    return quality.scored(docs, model).select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convtrie.prefix_trie(table(spark, sf_dir, "conversations"), rebuilt=True)


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find_pii(table(spark, sf_dir, "documents")))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


QUERIES = {q.__name__: q for q in (op1_mix_sources, op2_exact_topk, op3_line_dedup, op4_substring_dedup, op5_decontaminate, op6_simhash,
                                op7_lm_score, op8_url_filter, op9_license_scan, op10_quality, op11_prefix_trie, op12_pii,
                                op13_filter_audit)}
