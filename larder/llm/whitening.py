"""Embedding whitening with exact cross-products from bit planes.

An entry c becomes the whole number y = floor(64 c) (x of the contract is
y + ``OFFSET``; covariances don't depend on the offset, and every sum below is
of y).  A task takes its rows in blocks.  In a block every dimension is shifted
to start at zero and cut into bit planes; a plane of all rows is packed into
64-bit words, so the sum of products of two dimensions is a weighted sum of
popcounts of ANDed words: a whole number without rounding.  Blocks and tasks
add up as whole numbers in two parts (high and low 40 bits), and the covariance
is centred as ``n * cross - sum * sum`` in Python's whole numbers before it is
divided once and given to ``eigh``.  The driver holds dims x dims numbers,
whatever the number of rows.

Two further passes project the rows: one adds up the covariance of the
projections, the other returns them.

Defined cases: a vector that is null, empty, or holds null or non-finite
entries takes no part.  If vectors differ in length, those of the most frequent
length (of two equally frequent ones, the shorter) are the table and the others
take no part.  A null id is an id like any other; rows that share an id, and
rows with the same vector, each count and each come back.  A component whose
eigenvalue is zero but for rounding (fewer rows than dimensions, a constant
dimension) has ``whitened`` null and takes no part in ``identity_error``, which
is null if no component is left; ``explained`` is null if all rows are the
same.  Entries beyond the range of long are taken as its end.  A ``deviation``
beyond long is null, and ``deviation_text`` always has it in full.  An empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Production parameters: components returned, scale and offset of an entry.
COMPONENTS, SCALE, OFFSET = 32, 64.0, 1_000_000
#: Rows of a block of bit planes, and 64-bit words ANDed at a time.
BLOCK_ROWS, AT_ONCE = 8192, 1 << 21
#: Sums are carried as high * 2^LOW_BITS + low.
LOW_BITS = 40
#: Whole numbers that a long entry can stand for, the offset taken off.
MOST = 2 ** 62
#: Share of the largest eigenvalue below which one counts as zero.
ZERO = 1e-12


def finite_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part, as doubles."""
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    whole = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.coalesce(whole, F.lit(False)) & (F.size("vector") > 0))
    lengths = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), "d").first()
    return rows.where(F.size("vector") == (usual["d"] if usual else 0))


def matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of whole numbers of a batch of vectors of one length."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    y = np.floor(flat * SCALE)
    return np.clip(y, -MOST, MOST).astype(np.int64).reshape(len(vectors), -1)


def bit_planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(planes, words of 64 rows, for each dimension and bit; the least value
    of each dimension) of a block of rows."""
    least = y.min(axis=0)
    up = (y - least).T.astype(np.uint64)
    bits = max(1, int(up.max()).bit_length())
    rows = up.shape[1]
    padded = -(-rows // 64) * 8
    planes = np.zeros((len(up), bits, padded), np.uint8)
    for b in range(bits):
        packed = np.packbits(((up >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), axis=1)
        planes[:, b, :packed.shape[1]] = packed
    return planes.reshape(len(up) * bits, padded).view(np.uint64), least


def block_products(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, cross-products) of a block as exact whole numbers (objects)."""
    planes, least = bit_planes(y)
    n, d = y.shape
    bits = len(planes) // d
    counts = np.zeros((len(planes), len(planes)), np.int64)
    step = max(1, AT_ONCE // planes.size)
    for a in range(0, len(planes), step):
        both = planes[a:a + step, None, :] & planes[None, a:, :]
        counts[a:a + step, a:] = np.bitwise_count(both).sum(axis=2, dtype=np.int64)
    counts = np.triu(counts) + np.triu(counts, 1).T
    weight = np.array([1 << b for b in range(bits)], object)
    kind = np.int64 if 2 * bits + n.bit_length() < 62 else object
    weight = weight.astype(kind)
    of_pairs = counts.reshape(d, bits, d, bits).astype(kind)
    up = np.tensordot(np.tensordot(of_pairs, weight, (3, 0)), weight, (1, 0)).astype(object)
    alone = np.diagonal(counts).reshape(d, bits).astype(kind) @ weight
    alone, least = alone.astype(object), least.astype(object)
    cross = up + np.outer(least, alone) + np.outer(alone, least) + n * np.outer(least, least)
    return alone + n * least, cross


PARTS = "i int, j int, high decimal(38,0), low decimal(38,0)"
PARTS_ARROW = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("high", pa.decimal128(38, 0)),
                         ("low", pa.decimal128(38, 0))])


def scatter(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's count (-1, -1), sums (-1, j) and cross-products (i, j), i <= j."""
    n, sums, cross = 0, None, None
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            y = matrix(batch.column("vector").slice(at, BLOCK_ROWS))
            s, c = block_products(y)
            n, sums, cross = n + len(y), s if sums is None else sums + s, c if cross is None else cross + c
    if not n:
        return
    rows = [(-1, -1, n), *((-1, j, int(s)) for j, s in enumerate(sums)),
            *((i, j, int(cross[i, j])) for i in range(len(sums)) for j in range(i, len(sums)))]
    for at in range(0, len(rows), BLOCK_ROWS):
        part = rows[at:at + BLOCK_ROWS]
        split = [divmod(v, 1 << LOW_BITS) for _, _, v in part]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.int32()),
             pa.array([h for h, _ in split], pa.decimal128(38, 0)),
             pa.array([lo for _, lo in split], pa.decimal128(38, 0))], schema=PARTS_ARROW)


@dataclass(frozen=True)
class Whitening:
    """What a fit found: rows, sums of y, unit components (columns) by falling
    eigenvalue, and which of them have one that isn't zero."""
    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    usable: np.ndarray

    @property
    def projection(self) -> np.ndarray:
        return self.components[:, self.usable] / np.sqrt(self.values[self.usable])

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n)) for s in self.sums])


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all ``vectors`` (vec_id, vector); None without rows."""
    parts = vectors.select("vector").mapInArrow(scatter, PARTS)
    # one row per pair of dimensions, however many rows the table has
    found = {(r["i"], r["j"]): (int(r["high"]) << LOW_BITS) + int(r["low"]) for r in parts.groupBy("i", "j").agg(
        F.sum("high").cast("decimal(38,0)").alias("high"), F.sum("low").cast("decimal(38,0)").alias("low")).collect()}
    if not found:
        return None
    n = found[-1, -1]
    d = max(j for i, j in found if i < 0) + 1
    sums = [found[-1, j] for j in range(d)]
    centred = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            centred[i, j] = centred[j, i] = (n * found[i, j] - sums[i] * sums[j]) / (n * n)
    trace = float(Fraction(sum(n * found[i, i] - sums[i] ** 2 for i in range(d)), n * n))
    values, axes = np.linalg.eigh(centred)
    order = np.argsort(-values, kind="stable")[:components]
    axes, values = axes[:, order], values[order]
    heavy = np.abs(axes).argmax(axis=0)
    axes = axes * np.sign(axes[heavy, range(len(order))])
    return Whitening(n, sums, axes, values, trace, values > max(values[0], 0) * ZERO)


def deviations(y: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over the dimensions of (n y - S)^2 for every row, exactly."""
    most = max(1, int(np.abs(y).max()))
    if y.shape[1] * most * max(1, *(abs(s) for s in sums)) >= 2 ** 62 or y.shape[1] * most * most >= 2 ** 62:
        y = y.astype(object)
        s = np.array(sums, object)
    else:
        s = np.array(sums, np.int64)
    squares, mixed = (y * y).sum(axis=1), y @ s
    own = sum(v * v for v in sums)
    return [n * n * int(a) - 2 * n * int(b) + own for a, b in zip(squares, mixed)]


def identity_error(vectors: DataFrame, fitted: Whitening) -> float | None:
    """Largest absolute entry of the projections' covariance minus the
    identity, from one pass over the rows."""
    project, mean, k = fitted.projection, fitted.mean, int(fitted.usable.sum())
    if not k:
        return None

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            if batch.num_rows:
                z = (matrix(batch.column("vector")) - mean) @ project
                total += np.vstack([z.T @ z, z.sum(axis=0)])
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())],
            ["i", "j", "value"])

    rows = (vectors.select("vector").mapInArrow(add, "i int, j int, value double").groupBy("i", "j")
            .agg(F.sum("value").alias("value")).collect())
    total = np.zeros((k + 1, k))
    for r in rows:
        total[r["i"], r["j"]] = r["value"]
    means = total[k] / fitted.n
    covariance = total[:k] / fitted.n - np.outer(means, means)
    return float(np.abs(covariance - np.eye(k)).max())


RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double, deviation_text string")


def whiten(table: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error,
    deviation_text) for every row that takes part and every component."""
    vectors = finite_vectors(table, id_col, vector_col)
    fitted = fit(vectors, components)
    if fitted is None:
        return table.sparkSession.createDataFrame([], RESULT)
    error = identity_error(vectors, fitted)
    project, mean, k = fitted.projection, fitted.mean, len(fitted.values)
    explained = [v / fitted.trace for v in fitted.values.tolist()] if fitted.trace else [None] * k
    usable = np.flatnonzero(fitted.usable)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                y = matrix(part.column("vector"))
                white = np.zeros((len(y), k))
                white[:, usable] = (y - mean) @ project
                whole = deviations(y, fitted.n, fitted.sums)
                times = np.repeat(np.arange(len(y)), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(pa.array(times)),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))),
                     pa.array(np.full(len(times), fitted.n)),
                     pa.array([v if v < 2 ** 63 else None for v in whole], pa.int64()).take(pa.array(times)),
                     pa.array(white.ravel(), mask=np.tile(~fitted.usable, len(y))),
                     pa.array(explained * len(y), pa.float64()),
                     pa.array([error], pa.float64()).take(pa.array(np.zeros(len(times), np.int64))),
                     pa.array([str(v) for v in whole]).take(pa.array(times))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error",
                     "deviation_text"])

    return vectors.mapInArrow(rows, RESULT)
