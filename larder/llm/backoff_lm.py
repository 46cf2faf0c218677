"""Language-model scores by stupid backoff.

Words and word n-grams of the whole corpus are counted in tables partitioned
by hash: every block of documents sends its distinct n-grams with their counts
to the n-grams' buckets, where they are summed.  The sums are joined back to
the n-grams of each block, and scores are summed per document:

    S(w | context) = count(context w) / count(context)   if the n-gram was kept
                     0.4 * S(w | shorter context)        otherwise
    S(w)           = count(w) / all words

N-grams of two words and more are kept if they occur ``min_count`` times in
the corpus.  A position's score is ln S in whole millionths, so a document's
sum doesn't depend on the order of anything.

Defined cases: a null or empty text has no words and score 0; null ids and
repeated rows are scored row by row, and each row counts in the corpus; other
columns are ignored; texts of any length are scored whole; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from larder.llm import blocks as B
from larder.llm.frames import WordNumbers, id_and_text

#: Production parameters.
ORDER, MIN_COUNT, BACKOFF, SCALE = 2, 2, 0.4, 1_000_000
#: Bytes of a key within its bucket and of a count.
KEY_BYTES, COUNT_BYTES = 6, 5
LOW = np.uint64((1 << 48) - 1)
TOTAL = np.uint64(0)
SCHEMA = "doc_id long, n_words long, n_backed_off long, score_millionths long"


def gram_keys(words: np.ndarray, order: int) -> list[np.ndarray]:
    """64-bit keys of the n-grams of 1 to ``order`` words, by last word."""
    out = [words]
    for n in range(2, order + 1):
        prior = out[-1][:-1] if len(out[-1]) else out[-1]
        mixed = (prior ^ (prior >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
        mixed ^= mixed >> np.uint64(29)
        out.append(mixed * np.uint64(0xBF58476D1CE4E5B9) ^ words[n - 1:])
    return out


def block_grams(table: pa.Table, order: int) -> list[list[np.ndarray]]:
    """Per document, its keys by order."""
    keys = WordNumbers(xxhash.xxh3_64_intdigest)
    return [gram_keys(keys.of((t.as_py() or "").encode().split()), order) for t in table.column("text")]


def distinct(docs: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of a block with their counts; key 0 counts all words."""
    flat = [k for d in docs for k in d]
    keys, counts = np.unique(np.concatenate(flat), return_counts=True) if flat else (np.zeros(0, np.uint64),) * 2
    keys, counts = (keys[1:], counts[1:]) if len(keys) and keys[0] == TOTAL else (keys, counts)
    words = sum(len(d[0]) for d in docs)
    return np.concatenate([[TOTAL], keys]), np.concatenate([[words], counts]).astype(np.uint64)


def summed(table: pa.Table) -> pa.Table:
    """For the cells of a key bucket: the corpus count of each of their keys."""
    cells = [B.unpacked(k.as_py(), KEY_BYTES) for k in table.column("keys")]
    counts = np.concatenate([B.unpacked(p.as_py(), COUNT_BYTES) for p in table.column("payload")])
    keys = np.concatenate(cells)
    order = np.argsort(keys, kind="stable")
    new = np.append(True, keys[order][1:] != keys[order][:-1])[:len(keys)]
    sums = np.add.reduceat(counts[order], np.flatnonzero(new)) if len(keys) else counts
    total = np.empty_like(counts)
    total[order] = sums[np.cumsum(new) - 1]
    ends = np.cumsum([0, *map(len, cells)])
    return pa.table([table.column("block").combine_chunks(), table.column("bucket").combine_chunks(),
                     pa.array([b""] * len(cells), pa.binary()),
                     pa.array([B.packed(total[a:b], COUNT_BYTES) for a, b in zip(ends[:-1], ends[1:])], pa.binary())],
                    schema=B.REQUEST_ARROW)


def document_score(keys: list[np.ndarray], count, words: int, min_count: int, backoff: float
                   ) -> tuple[int, int]:
    """(positions scored by a shorter context than they have, summed score)."""
    n = len(keys[0])
    if not n:
        return 0, 0
    own = [count(k).astype(np.float64) for k in keys]
    log = np.log(own[0]) - np.log(words)
    used = np.ones(n, np.int64)
    have = np.minimum(np.arange(1, n + 1), len(keys))
    for k in range(2, len(keys) + 1):
        if n < k:
            break
        kept = np.flatnonzero(own[k - 1] >= min_count)
        at = kept + k - 1
        log[at] = np.log(own[k - 1][kept]) - np.log(own[k - 2][kept])
        used[at] = k
    log += (have - used) * np.log(backoff)
    return int((used < have).sum()), int(np.rint(log * SCALE).astype(np.int64).sum())


def backoff_scores(docs: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, backoff: float = BACKOFF,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_backed_off, score_millionths) for every row, under
    the counts of all rows."""
    rows = id_and_text(docs, id_col, text_col)
    n_blocks, n_buckets = B.sizes(rows)

    def ask(table: pa.Table) -> pa.Table:
        keys, counts = distinct(block_grams(table, order))
        return B.requests(table.column("block")[0].as_py(), keys, counts, n_buckets, KEY_BYTES, COUNT_BYTES)

    def settle(left: pa.Table, right: pa.Table) -> pa.Table:
        grams = block_grams(left, order)
        keys, counts = distinct(grams)
        which = B.buckets_of(keys, n_buckets)
        for b, p in zip(right.column("bucket").to_pylist(), right.column("payload")):
            a, z = np.searchsorted(which, [b, b + 1])
            counts[a:z] = B.unpacked(p.as_py(), COUNT_BYTES)
        count = lambda k: counts[np.searchsorted(keys, k)]
        got = [document_score(g, count, int(counts[0]), min_count, backoff) for g in grams]
        return pa.table([left.column("doc_id").combine_chunks(), pa.array([len(g[0]) for g in grams], pa.int64()),
                         pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64())],
                        names=["doc_id", "n_words", "n_backed_off", "score_millionths"])

    return B.exchanged(B.dealt(rows, n_blocks), ask, summed, settle, SCHEMA)
