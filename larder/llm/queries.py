"""The registered queries of the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import (backoff_lm, best_fit, chunk_dedup, circulant_minhash, cross_polytope, jaccard_join, line_dedup,
                        orc_tokens, piece_codec, pipelined_search, quality_ratio, token_counts, whitening)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ratio.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_lm.backoff_scores(table(spark, sf_dir, "documents"))


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode_digests(table(spark, sf_dir, "documents"))


def jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"))


def substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunk_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chunks", "n_dropped_chunks", "n_dropped_words", "dropped",
                        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = orc_tokens.new_folder(spark, "tokens-orc")
    orc_tokens.write_tokens(table(spark, sf_dir, "documents"), folder)
    return orc_tokens.read_back(spark, folder)


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelined_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": quality,
    "op2_lm_scoring": lm,
    "op3_sentencepiece_codec": sentencepiece,
    "op4_ngram_jaccard_join": jaccard,
    "op5_token_counts": counts,
    "op6_best_fit_packing": packing,
    "op7_substring_dedup": substrings,
    "op8_line_dedup": lines,
    "op9_token_ids_orc": orc,
    "op10_nearest_neighbours": neighbours,
    "op11_embedding_whitening": whitened,
    "op12_minhash_near_dedup": minhash,
    "op13_ranked_search": search,
}

