"""Quality rules: base counts, and a log-likelihood ratio of hashed n-grams.

Words and word n-grams of every text are hashed into buckets.  Two multinomials
over the buckets are counted on whole texts: the raw corpus (every document)
and the trusted target (all documents with a trusted label).  A document's score is
the sum of ln(target / raw) over its n-grams, divided by their number, and is
held against one threshold: the score that all but ``LOST`` of held-out trusted
documents reach.  The target isn't counted on those (ids that leave
``FOLDS`` - 1 when divided by ``FOLDS``), so the threshold allows for what a
document loses by not being in the target, which in a small corpus is much.  A bucket's log ratio is kept as a whole number of
millionths, so a score is a sum of integers: the verdict is the same whatever
the order of rows, tasks or machines.

Counting is one row per bucket and task before the shuffle, so a word that a
third of the corpus is made of costs no more than any other.  The trusted ids
meet the texts in a sort-merge join, the same plan whatever the input's size:
only texts of the folds that a join is about take part in it, so no text is
moved twice.

Defined cases: a null text has no words; a text without words fails the base
rules; null ids and repeated rows are judged row by row; other columns are
ignored.  Without trusted documents both multinomials are flat where nothing
was counted and every score is at most the smoothing's: the base rules then
decide alone.  Without held-out documents the threshold is ``THRESHOLD``.  A text
of any length is judged whole; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.frames import WordNumbers, id_and_text, slices, stage

#: Production parameters.
BUCKETS, ORDER, SMOOTHING, THRESHOLD = 1 << 16, 2, 1.0, -0.12
LOST, FOLDS = 0.001, 4
#: SHIFT multiplies the hash of an n-gram before the next word's is added; both
#: are kept to HASH_BITS.
SHIFT, HASH_BITS, SCALE = 1_000_003, 31, 1_000_000
#: Characters counted as symbols.
SYMBOLS = re.compile(r"[#*$%&|<>]")


def word_hash(word: bytes) -> int:
    """The low 31 bits of an MD5 digest's first half."""
    return int.from_bytes(hashlib.md5(word, usedforsecurity=False).digest()[:4], "little") & 0x7FFFFFFF


def grams(hashes: np.ndarray, order: int, buckets: int) -> np.ndarray:
    """Buckets of the n-grams of 1 to ``order`` words."""
    out, run = [hashes], hashes
    for n in range(2, order + 1):
        if len(hashes) < n:
            break
        run = (run[:-1] * SHIFT + hashes[n - 1:]) & ((1 << HASH_BITS) - 1)
        out.append(run)
    return np.concatenate(out) % buckets


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """(bucket, raw, target) over rows (text, trusted)."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordNumbers(word_hash)
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for trusted, texts in slices(batches):
            for yes, t in zip(trusted, texts):
                if t and (words := t.encode().split()):
                    got = np.bincount(grams(hashed.of(words, np.int64), order, buckets), minlength=buckets)
                    raw += got
                    if yes:
                        target += got
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])],
                                         ["bucket", "raw", "target"])

    return (docs.select("trusted", "text").mapInArrow(count, "bucket long, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))


def log_ratios(counts: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> np.ndarray:
    """Millionths of ln(target / raw) per bucket, from at most ``buckets``
    rows."""
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for r in counts.collect():                       # bounded: one row per bucket
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not target.any():
        return np.zeros(buckets, np.int64)
    raw, target = raw + smoothing, target + smoothing
    return np.rint((np.log(target / target.sum()) - np.log(raw / raw.sum())) * SCALE).astype(np.int64)


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words in a window that the text has twice or more, first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    key = ids[:n]
    for k in range(1, window):
        if int(key.max()) >= (1 << 62) // (len(seen) + 1):
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(seen) + ids[k:n + k]
    _, where, times = np.unique(key, return_inverse=True, return_counts=True)
    again = times[where] >= 2
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k:n + k] |= again
    return int(covered.sum())


def base_counts(text: str, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    spaces = sum(map(text.count, " \t\n\v\f\r"))
    lines = [x for x in text.encode().split(b"\n") if x.strip()]
    return (len(text) - spaces, len(SYMBOLS.findall(text)), len(lines) - len(set(lines)),
            repeated_words(words))


def score(docs: DataFrame, ratios: np.ndarray, order: int, limit: int, min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """Base counts, score and verdict of rows (doc_id, text); ``limit`` is the
    threshold in millionths."""

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordNumbers(word_hash)
        for ids, texts in slices(batches):
            rows = []
            for t in texts:
                t = t or ""
                words = t.encode().split()
                n = len(words)
                base = base_counts(t, words)
                got = ratios[grams(hashed.of(words, np.int64), order, len(ratios))] if n else ratios[:0]
                failed = n < min_words or 100 * base[3] > max_repeat_percent * n
                rows.append((n, *base, failed, not failed and int(got.sum()) >= limit * len(got),
                             len(got), int(got.sum())))
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                 "base_failed", "kept", "n_grams", "log_ratio_millionths"])

    return docs.select("doc_id", "text").mapInArrow(
        judge, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
               "n_repeat_words long, base_failed boolean, kept boolean, n_grams long, "
               "log_ratio_millionths long")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of all labelled documents that are trusted."""
    return (labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0))
            .select(F.col("doc_id").cast("long").alias("doc_id")).distinct())


def held_out_limit(rows: DataFrame, held: DataFrame, ratios: np.ndarray, order: int, lost: float,
                   otherwise: float) -> int:
    """The threshold in millionths, from the held-out documents' scores."""
    scored = score(rows.join(held.hint("merge"), "doc_id"), ratios, order, 0)
    means = stage(scored.where(~F.col("base_failed")).select(
        F.floor(F.col("log_ratio_millionths") / F.col("n_grams")).alias("mean")), "held-out")
    n = means.count()
    if not n:
        return round(otherwise * SCALE)
    lowest = means.orderBy("mean").limit(int(lost * (n - 1)) + 1)
    return lowest.agg(F.max("mean").alias("limit")).first()["limit"]


def quality_verdicts(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, order: int = ORDER,
                     threshold: float = THRESHOLD, lost: float = LOST, smoothing: float = SMOOTHING,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base counts, base_failed, kept, n_grams and the summed log
    ratio in millionths, for every row of ``docs``."""
    rows = id_and_text(docs, id_col, text_col)
    trusted = trusted_ids(labels)
    last = F.pmod(F.col("doc_id"), F.lit(FOLDS)) == FOLDS - 1
    fitted = trusted.where(~last).withColumn("trusted", F.lit(1))
    # rows of the held-out fold and rows without an id are in no target: they don't meet the join
    marked = (rows.where(~last).join(fitted.hint("merge"), "doc_id", "left").select(F.coalesce("trusted", F.lit(0)).alias("trusted"), "text")
              .unionByName(rows.where(F.coalesce(last, F.lit(True))).select(F.lit(0).alias("trusted"), "text")))
    ratios = log_ratios(bucket_counts(marked, buckets, order), buckets, smoothing)
    limit = held_out_limit(rows.where(last), trusted.where(last), ratios, order, lost, threshold)
    return score(rows, ratios, order, limit)
