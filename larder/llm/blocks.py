"""Look-ups of hashed keys for blocks of documents.

Documents are dealt by a hash of their id and text into blocks of a few
megabytes of text, so rows that share an id don't share a block.  A block asks about each of its distinct keys once, in one cell per key
bucket; the cells of a bucket meet in one group, which answers every block;
and the answers meet their block's documents again.  So a key that a third of
the corpus holds is one entry per block, no row ever stands for a single
occurrence, and the number of buckets grows with the input, which bounds the
group of a bucket.

Both passes over the documents read the same exchange of texts.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.frames import shuffle_partitions

#: Bytes of text of a block and per key bucket; a block isn't made smaller
#: than LEAST_BYTES to give every task one.
BLOCK_BYTES, BUCKET_BYTES, LEAST_BYTES = 8 << 20, 24 << 20, 1 << 20
REQUEST = "block long, bucket long, keys binary, payload binary"
REQUEST_ARROW = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary()),
                           ("payload", pa.binary())])


def sizes(rows: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[int, int]:
    """(blocks, buckets) for rows with a text, from their bytes."""
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = shuffle_partitions(rows.sparkSession)
    blocks = max(1, -(-total // block_bytes), min(parts, total // LEAST_BYTES))
    return blocks, max(parts, -(-total // BUCKET_BYTES))


def dealt(rows: DataFrame, blocks: int) -> DataFrame:
    return rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))


def buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Key buckets from a key's high 24 bits: ascending in sorted keys."""
    return ((keys >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)


def packed(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of 64-bit values, or of rows of two of them, byte
    by byte of all values: planes of sorted keys and of small counts compress
    in the shuffle."""
    whole = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8 * values[:1].size or 8)
    return np.ascontiguousarray(whole[:, :width].T).tobytes()


def unpacked(data: bytes, width: int) -> np.ndarray:
    """The values that :func:`packed` wrote; rows of two beyond eight bytes."""
    out = np.zeros((len(data) // width, 8 if width <= 8 else 16), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.view("<u8").ravel() if width <= 8 else out.view("<u8")


def requests(block: int, keys: np.ndarray, payload: np.ndarray, buckets: int, key_width: int,
             payload_width: int) -> pa.Table:
    """One row per key bucket of a block's sorted distinct keys, of 64 bits or
    rows of two such halves."""
    which = buckets_of(keys if keys.ndim == 1 else keys[:, 0], buckets)
    cuts = np.flatnonzero(np.diff(which, prepend=which[:1] + np.uint64(1))) if len(keys) else []
    ends = [*cuts[1:], len(keys)]
    return pa.table([pa.array([block] * len(cuts), pa.int64()),
                     pa.array([int(which[c]) for c in cuts], pa.int64()),
                     pa.array([packed(keys[a:b], key_width) for a, b in zip(cuts, ends)], pa.binary()),
                     pa.array([packed(payload[a:b], payload_width) for a, b in zip(cuts, ends)], pa.binary())],
                    schema=REQUEST_ARROW)


def exchanged(rows: DataFrame, ask: Callable, answer: Callable, settle: Callable, schema: str) -> DataFrame:
    """``ask`` (a block's documents -> requests), ``answer`` (a bucket's
    requests -> answers in the same columns), ``settle`` (a block's documents
    and its answers -> result rows), all on Arrow tables."""
    own = rows.groupBy("block")
    answers = own.applyInArrow(ask, REQUEST).groupBy("bucket").applyInArrow(answer, REQUEST)
    return own.cogroup(answers.groupBy("block")).applyInArrow(settle, schema)
