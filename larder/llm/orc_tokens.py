"""Token ids in ORC files, in ascending document order.

Texts are dealt by ranges of the document id (one shuffle of the text, which
is smaller than its ids), sorted, encoded and written as one ORC file per
range.  ORC stores the id lists as run-length encoded integers, keeps a row
index every ``row_stride`` rows and a Bloom filter on the document id, so a
reader takes stripes in parallel and skips those without the ids it wants
(:func:`lookup`).  :func:`read_back` reads the files, and adds each
document's place in the whole stream: sums per file meet in a table of one
row per file, never per document.

Defined cases: a null text is empty (its end id alone); rows that share an id
are written each, by text hash; rows with a null id are written first; extra
columns are not written; a text of any length is written whole; an empty table is
read back without rows.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.frames import id_and_text, slices, tokenizer_path
from larder.llm.token_ids import encoder
from larder.session import ensure_checkpoint_dir


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def encode_ids(rows: DataFrame, vocabulary: str, end_id: int | None) -> DataFrame:
    """(doc_id, ids array<int>, within) in the order of ``rows``; ``within``
    is the number of ids before the document in its partition."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = encoder(tokenizer_path(vocabulary))
        end = np.array([] if end_id is None else [end_id], dtype="<u4")
        done = 0
        for ids, texts in slices(batches):
            lists = [np.concatenate([to_ids(t or ""), end]) for t in texts]
            ends = np.cumsum([0, *map(len, lists)])
            flat = np.concatenate(lists).view("<i4")
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
                 pa.array(ends[:-1] + done, pa.int64())],
                ["doc_id", "ids", "within"])
            done += int(ends[-1])

    return rows.mapInArrow(encode, "doc_id long, ids array<int>, within long")


def write_tokens(docs: DataFrame, folder: str, vocabulary: str = "byte_bpe_50k.json",
                 end_id: int | None = 0, row_stride: int = 1000, stripe_bytes: int = 16 << 20,
                 bloom_fpp: float = 0.01, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the ORC files of ``docs`` into ``folder`` and return it."""
    rows = id_and_text(docs, id_col, text_col)
    by = [F.col("doc_id"), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    (encode_ids(dealt, vocabulary, end_id)
     .withColumn("part", F.spark_partition_id())
     .write.mode("overwrite")
     .option("orc.compress", "ZSTD").option("orc.stripe.size", str(stripe_bytes))
     .option("orc.create.index", "true").option("orc.row.index.stride", str(row_stride))
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", str(bloom_fpp))
     .orc(folder))
    return folder


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, ids, within, part): part numbers ascend with the document ids."""
    return spark.read.schema("doc_id long, ids array<int>, within long, part int").orc(folder)


def lookup(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """The ids of some documents: the filter reaches the stripes' Bloom
    filters and the row index, so only matching row groups are read."""
    return read_tokens(spark, folder).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")


def read_back(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the files."""

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            at = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            crc = [zlib.crc32(flat[x:y].tobytes()) for x, y in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), b.column(3), pa.array(np.diff(at), pa.int64()),
                 pa.array(crc, pa.int64())],
                ["doc_id", "within", "part", "n_tokens", "ids_crc32"])

    rows = read_tokens(spark, folder).select("doc_id", "ids", "within", "part").mapInArrow(
        digest, "doc_id long, within long, part int, n_tokens long, ids_crc32 long")
    # one row per file: the only table that is put in one order
    totals = (read_tokens(spark, folder).groupBy("part")
              .agg(F.max(F.col("within") + F.size("ids")).alias("tokens")))
    before = totals.select("part", F.coalesce(F.sum("tokens").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return rows.join(before, "part").select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
