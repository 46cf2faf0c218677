"""Small helpers that the operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.sources.io import stage  # noqa: F401  (re-exported for the operators)

#: Bytes of text that an Arrow function works on at a time.
SLICE_BYTES = 4 << 20


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                carry: bool = False) -> DataFrame:
    """Only the two columns an operator reads, so nothing else reaches Python
    and no other column's name can clash with what the operator adds.  With
    ``carry`` the other columns come along as one struct, ``rest``."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"),
                       *([F.struct(*(rest or [F.lit(0).alias("none")])).alias("rest")] if carry else []))


def slices(batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES
           ) -> Iterator[tuple[list, list[str | None]]]:
    """(ids, texts) of at most about ``limit`` bytes of text each: batches
    are balanced by bytes, not by rows, so that a run of very long texts
    doesn't make a batch that is larger than the others."""
    ids: list = []
    texts: list[str | None] = []
    size = 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            t = t.as_py()
            ids.append(i)
            texts.append(t)
            size += len(t) if t else 0
            if size >= limit or len(ids) >= 8192:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def tokenizer_path(name: str) -> str:
    """The place of a public vocabulary file on this machine; an absolute
    path is taken as it is."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


class WordNumbers(dict):
    """Numbers of words by a hash function; the ones seen lately are
    remembered, at most ``most`` of them besides one text's own."""

    def __init__(self, number: Callable[[bytes], int], most: int = 400_000):
        super().__init__()
        self.number, self.most = number, most

    def __missing__(self, word: bytes) -> int:
        n = self[word] = self.number(word)
        return n

    def of(self, words: list[bytes], kind: type = np.uint64) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), kind, len(words))
