"""Line dedup, in DataFrame functions only.

Every text is split at ``\\n``; a line's key is the line with ASCII white
space stripped at both ends and A-Z lower-cased.  Keys are hashed to 128 bits,
documents are counted per hash with map-side partial aggregation (a line that
a third of all documents hold is one row per map task), and only lines whose
key repeats meet the documents again, as a list of positions to leave out.

Defined cases: a null or empty text is one empty line; a row with a null id is
not counted and loses nothing; rows that share an id count as one document;
extra columns are ignored, or with ``carry`` kept as a struct; a text of any
length is split whole; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.frames import id_and_text, stage

#: The characters stripped from a line's ends.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def keyed_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, t, pos, h1, h2) of the lines long enough to be judged."""
    lines = rows.where(F.col("doc_id").isNotNull()).select(
        "doc_id", "t", F.posexplode(F.split(F.col("text"), "\n")).alias("pos", "line"))
    return (lines.select("doc_id", "t", "pos", line_key(F.col("line")).alias("key"))
            .where(F.length("key") >= min_chars)
            .select("doc_id", "t", "pos", F.xxhash64("key").alias("h1"),
                    F.xxhash64(F.lit("second"), F.col("key")).alias("h2")))


def repeated_keys(lines: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, first_doc) of the keys that at least ``min_docs`` documents hold.

    Two documents hold a key when its smallest and largest id differ, which
    needs no distinct count; a larger threshold counts distinct ids."""
    found = [F.min("doc_id").alias("first_doc")]
    if min_docs <= 2:
        found.append(F.max("doc_id").alias("last_doc"))
        held = F.col("first_doc") < F.col("last_doc") if min_docs == 2 else F.lit(True)
    else:
        lines = lines.select("h1", "h2", "doc_id").distinct()
        found.append(F.count("doc_id").alias("n_docs"))
        held = F.col("n_docs") >= min_docs
    return lines.groupBy("h1", "h2").agg(*found).where(held).select("h1", "h2", "first_doc")


def dedup_lines(docs: DataFrame, min_docs: int = 2, min_chars: int = 10,
                id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) for every row of ``docs``; ``text``
    is what stays, joined by ``\\n``.  A key of at least ``min_chars`` code
    points in at least ``min_docs`` documents stays only in the document with
    the smallest id.  ``carry`` adds the other columns as a struct."""
    rows = id_and_text(docs, id_col, text_col, carry).withColumn(
        "text", F.coalesce("text", F.lit(""))).withColumn("t", F.xxhash64("text"))
    rest = ["rest"] if carry else []
    lines = keyed_lines(rows, min_chars)
    # written once: a join of two plain exchanges is one that Spark can split
    # where a key is very frequent
    repeated = stage(repeated_keys(lines, min_docs), "repeated")
    dropped = (lines.join(repeated, ["h1", "h2"])
               .where(F.col("doc_id") != F.col("first_doc"))
               .groupBy("doc_id", "t").agg(F.collect_set("pos").alias("gone")))
    parts = F.split(F.col("text"), "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone"))
    return (rows.join(dropped, ["doc_id", "t"], "left")
            .select("doc_id", "text", "gone", parts.alias("parts"), stay.alias("stay"), *rest)
            .select("doc_id",
                    F.when(F.col("gone").isNull(), F.col("text"))
                    .otherwise(F.array_join(F.transform("stay", lambda i: F.get(F.col("parts"), i)),
                                            "\n")).alias("text"),
                    F.size("parts").cast("long").alias("n_lines"),
                    F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone"))
                    .cast("long").alias("n_dropped"), *rest))
