"""A corpus pipeline of five stages, each by one operator of ``larder.llm``.

Every stage takes the documents that the one before it kept and returns the
columns of documents; the last returns the packed pieces.  Between stages the
documents are written as Parquet in the session's checkpoint folder and read
again.

A row with a null id is judged by the quality rules like any other (all such
rows stay if one of them does); the stages that compare documents pass it on
unchanged.  A document of which line or substring dedup leaves less than half
of its text, and less than 300 code points, is judged again with what is left
and goes: such remainders are mostly those of copies.  One that loses its last
word goes in any case.  Rows that share an id stay or go
together in the other stages.  A text of any length is read whole; columns are
told from an operator's by name, so a column of the documents may be called
like one of them; an empty table passes every stage as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import best_fit, chunk_dedup, jaccard_join, line_dedup, quality_ratio
from larder.llm.frames import stage


#: Least code points of a document that lost more than half of them: about the
#: 50 words that the quality rules ask for.
LEAST_CHARS = 300
#: A column that carries a text's length through an operator.
CHARS = "__chars_before"


def counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn(CHARS, F.length("text"))


def with_texts(docs: DataFrame, found: DataFrame, dropped: str) -> DataFrame:
    """The columns of ``docs`` from an operator's rows (doc_id, text, rest) of
    :func:`counted` documents: the text is the operator's, ``n_chars`` its
    length, the rest as it was.  Remainders go."""
    new = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    left, had = (F.coalesce(n, F.lit(0)) for n in (F.length("text"), F.col("rest").getField(CHARS)))
    remainder = (left < LEAST_CHARS) & (2 * left < had)
    gone = (F.col(dropped) > 0) & (remainder | ~F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return found.where(~gone).select(*(new.get(c, F.col("rest").getField(c)).alias(c) for c in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the ratio keep."""
    verdicts = quality_ratio.quality_verdicts(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    kept = verdicts.where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def line_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document holds."""
    return with_texts(docs, line_dedup.dedup_lines(counted(docs), carry=True), "n_dropped")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id."""
    classes = jaccard_join.jaccard_join(docs)
    gone = classes.where("doc_id <> class_id").select(F.col("doc_id").alias("gone_id"))
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document holds."""
    return with_texts(docs, chunk_dedup.dedup_substrings(counted(docs), carry=True), "n_dropped_chunks")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return best_fit.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_duplicates),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Packing and encoding have no SQL; tests/llm hold every stage against a
#: brute-force version.
ORACLE_SQL = None
