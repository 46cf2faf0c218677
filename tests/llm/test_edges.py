"""Nulls, empty and very long texts, ties, repeated rows, empty tables and
clashing columns, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from helpers import EDGES, by_id, frame
from larder.llm import (backoff_lm, best_fit, chunk_dedup, cross_polytope, jaccard_join, line_dedup, orc_tokens,
                        piece_codec, quality_ratio, token_counts)


def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (7, 1, None), (None, 1, 0)], "doc_id long, quality int, toxic int")


def orc(docs):
    folder = orc_tokens.new_folder(docs.sparkSession, "edge-orc")
    return orc_tokens.read_back(docs.sparkSession, orc_tokens.write_tokens(docs, folder))


OPERATORS = {
    "quality": lambda d: quality_ratio.quality_verdicts(d, labels(d.sparkSession)),
    "lm": backoff_lm.backoff_scores,
    "pieces": piece_codec.encode_documents,
    "digests": piece_codec.encode_digests,
    "jaccard": jaccard_join.jaccard_join,
    "counts": token_counts.count_tokens,
    "packing": best_fit.pack,
    "substrings": chunk_dedup.dedup_substrings,
    "lines": line_dedup.dedup_lines,
    "orc": orc,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_edge_rows_and_clashing_columns(spark, name):
    docs = frame(spark, EDGES)
    for c in ("n_words", "block", "rep", "path", "bucket", "t", "line", "length", "chunk", "within", "part", "ids",
              "trusted", "low", "size", "__id"):
        docs = docs.withColumn(c, F.lit("x"))
    rows = OPERATORS[name](docs).collect()
    n_null = sum(i is None for i, _ in EDGES)
    ids = [r["doc_id"] for r in rows]
    assert set(ids) == {i for i, _ in EDGES}
    if name not in ("packing", "jaccard"):
        assert len(rows) == len(EDGES) and ids.count(None) == n_null and ids.count(6) == 2


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](frame(spark, [])).collect() == []


def test_edge_values(spark):
    docs = frame(spark, EDGES)
    counts = {r["doc_id"]: r for r in token_counts.count_tokens(docs).collect()}
    assert (counts[0]["n_bytes"], counts[0]["n_tokens"], counts[4]["n_bytes"]) == (0, 0, 300_000)
    classes = {r["doc_id"]: r for r in jaccard_join.jaccard_join(docs).collect()}
    assert (classes[6]["class_id"], classes[6]["n_links"], classes[5]["n_links"]) == (5, 1, 1)
    assert classes[None]["class_id"] is None and classes[1]["class_id"] == 1
    lines = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
    assert (lines[8]["text"], lines[8]["n_dropped"], lines[7]["n_dropped"]) == ("c", 1, 0)
    assert (lines[0]["text"], lines[0]["n_lines"]) == ("", 1)
    verdicts = {r["doc_id"]: r for r in quality_ratio.quality_verdicts(docs, labels(spark)).collect()}
    assert verdicts[0]["base_failed"] and not verdicts[0]["kept"] and verdicts[4]["word_chars"] == 300_000


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i), 1.0, 2.0]) for i in range(1, 30)] + [(i, [5.0, 5.0, 5.0]) for i in range(100, 160)] + [
        (200, None), (201, [0.0, 0.0, 0.0]), (202, [nan, 1.0, 1.0]), (203, [inf, 1.0, 1.0]), (204, [None, 1.0, 1.0]),
        (205, [1.0]), (None, [1.0, 1.0, 1.0]), (101, [5.0, 5.0, 5.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("vector", F.lit("x"))
    got = cross_polytope.nearest(vectors, F.col("vec_id") % 100 == 0).collect()
    assert {r["query_id"] for r in got} == {100}
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [
        (k, 100 + k, 0.0) for k in range(1, 11)]
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [2.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r["rank"], r["vec_id"]) for r in cross_polytope.nearest(few, F.col("vec_id") == 0).orderBy("rank").collect()
            ] == [(1, 1), (2, 2)]
    assert cross_polytope.nearest(few.limit(0), F.col("vec_id") == 0).collect() == []


def test_pipeline_edges(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(1, text, 1), (2, text, 2), (2, text, 2), (None, text, 3), (3, None, 4), (4, "", 5), (5, "x " * 40_000, 6)]
    for name, given in (("some", rows), ("none", [])):
        docs = spark.createDataFrame(given, "doc_id long, text string, __text int")
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
        spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(
            str(tmp_path / name / "labels.parquet"))
        columns = docs.columns
        for stage, apply in corpus_pipeline.STAGES:
            out = str(tmp_path / name / stage)
            apply(spark, docs, str(tmp_path / name)).write.parquet(out)
            docs = spark.read.parquet(out)
            if stage != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == columns
        ids = [r["doc_id"] for r in docs.collect()]
        assert sorted(ids, key=str) == ([1, None] if given else [])


def test_every_trusted_document_is_fitted_on(spark):
    """However many labels there are, the target is counted on all of them."""
    docs = frame(spark, [(i, f"w{i % 7} w{i % 5} w{i} " * 20) for i in range(60)])
    few = spark.range(60).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    many = spark.range(400_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    got = [by_id(quality_ratio.quality_verdicts(docs, x)) for x in (few, many)]
    assert got[0] == got[1] and any(r["log_ratio_millionths"] for r in got[0])
