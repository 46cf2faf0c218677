"""Approximate nearest neighbours by cross-polytope hashing.

A hash rotates a unit vector pseudo-randomly (three rounds of random signs and
a fast Hadamard transform) and takes the nearest signed axis: the coordinate
with the largest magnitude and its sign.  A table concatenates ``hashes`` of
them.  Every vector is in one bucket of every table; a query looks into its own
bucket and into the next ``probes`` - 1 likeliest, in the order of the loss in
the rotated coordinates.  Candidates are reranked by exact distance in double
precision on the original vectors.

How many hashes a table concatenates, how many tables there are and how many
buckets a query looks into are not set by the number of rows alone: a bounded
set of queries is answered by brute force over all rows first, and the setting
is the one with the least work that finds ``TARGET`` of their neighbours
(``choose``).  Fewer hashes, more tables and more probes are tried until one
does; looking into every bucket finds all, so one always does.

Equal vectors are one entry of the index that carries its smallest ids (k + 1
of them: no more can be among a query's k nearest), so a vector that a third
of all rows share fills no bucket.  Distances are taken where a bucket and its
queries meet, in batches, and only each query's k best of a bucket leave it.
A query that finds fewer than k candidates is compared with all rows instead,
queries in blocks and rows in slots, whose number grows with the rows.

Defined cases: vectors that are null, zero, of another length than most, or
with null or non-finite components take no part, neither as query nor as
candidate; null ids likewise; rows that share an id are candidates once, with
their smallest distance; other columns are ignored; no queries or no vectors
give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.frames import shuffle_partitions, stage
from larder.llm.jaccard_join import groups

#: Production parameters: vectors that a bucket should hold on average at most
#: (more hashes make smaller buckets), recall that a setting must show, queries
#: that it is measured on, tables and probes that are tried.
BUCKET_ROWS, TARGET, MEASURED = 4096, 0.95, 128
TABLES, PROBES = (8, 16, 24, 32, 48, 64, 96), (2, 4, 6, 9, 12, 18, 27, 36, 54, 81, 128, 216)
QUERY_BLOCK, BLOCKS_AT_ONCE = 256, 16


class Rotations:
    """The pseudo-rotations of all tables, drawn from one seed."""

    def __init__(self, dim: int, tables: int, hashes: int, seed: int = 11):
        self.dim, self.size = dim, 1 << max(1, (dim - 1).bit_length())
        self.tables, self.hashes = tables, hashes
        self.signs = np.random.default_rng(seed).choice(np.array([-1.0, 1.0]), (tables, hashes, 3, self.size))

    def __call__(self, unit: np.ndarray, table: int) -> np.ndarray:
        """(rows, hashes, size) rotated vectors."""
        out = np.zeros((len(unit), self.hashes, self.size))
        out[:, :, :self.dim] = unit[:, None, :]
        for r in range(3):
            out *= self.signs[table, :, r]
            h = 1
            while h < self.size:
                view = out.reshape(len(unit), self.hashes, -1, 2, h)
                a, b = view[..., 0, :] + view[..., 1, :], view[..., 0, :] - view[..., 1, :]
                view[..., 0, :], view[..., 1, :] = a, b
                h *= 2
            out /= math.sqrt(self.size)
        return out

    def buckets(self, rotated: np.ndarray, probes: int) -> np.ndarray:
        """(rows, probes) buckets, the nearest first.  An axis' loss is what
        its coordinate lacks of the largest; losses add up over hashes."""
        n = len(rotated)
        both = np.concatenate([rotated, -rotated], axis=2)           # 2 x size signed axes
        take = min(probes, both.shape[2])
        best = np.argsort(-both, axis=2, kind="stable")[:, :, :take]
        value = np.take_along_axis(both, best, axis=2)
        loss = value[:, :, :1] - value
        code, cost = np.zeros((n, 1), np.int64), np.zeros((n, 1))
        for h in range(self.hashes):
            code = (code[:, :, None] * (2 * self.size) + best[:, h, None, :]).reshape(n, -1)
            cost = (cost[:, :, None] + loss[:, h, None, :]).reshape(n, -1)
            order = np.argsort(cost, axis=1, kind="stable")[:, :probes]
            code, cost = np.take_along_axis(code, order, 1), np.take_along_axis(cost, order, 1)
        return code


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    return (vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("vector"))
            .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
            .where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
                   & F.exists("vector", lambda x: x != 0)))


def distances(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, from the differences."""
    out = np.empty((len(queries), len(rows)))
    for a in range(len(queries)):
        out[a] = np.sqrt(((rows - queries[a]) ** 2).sum(axis=1))
    return out


def best_of(query_ids: list[int], queries: np.ndarray, ids: list[list[int]], rows: np.ndarray, k: int
            ) -> list[tuple[int, int, float]]:
    """Each query's k nearest (query_id, vec_id, score) of the rows, where a
    row stands for all its ids; ties to smaller ids."""
    found = []
    gap = distances(queries, rows)
    for q, own, row in zip(range(len(query_ids)), query_ids, gap):
        near = np.argpartition(row, k)[:k + 1] if len(row) > k + 1 else np.arange(len(row))
        near = np.flatnonzero(row <= row[near].max()) if len(row) > k + 1 else near
        pairs = sorted((row[r], i) for r in near for i in ids[r] if i != own)[:k]
        found += [(own, i, d) for d, i in pairs]
    return found


def found_batch(found: list[tuple[int, int, float]]) -> pa.RecordBatch:
    cols = list(zip(*found)) or [[]] * 3
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))],
        ["query_id", "vec_id", "score"])


def small(batches: Iterable[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for a in range(0, b.num_rows, rows):
            yield b.slice(a, rows)


def matrix(lists: list) -> np.ndarray:
    return np.array(lists, np.float64).reshape(len(lists), -1)


class Setting(NamedTuple):
    hashes: int
    tables: int
    probes: int
    recall: float


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def choose(queries: np.ndarray, neighbours: list[np.ndarray], rows: int, bucket_rows: int = BUCKET_ROWS,
           target: float = TARGET) -> Setting:
    """The setting with the least expected work that finds ``target`` of the
    true ``neighbours`` (vectors, for each query).  With h hashes the axes'
    codes make (2 size)^h buckets; a query's work is the rows that its buckets
    hold plus what looking into a bucket costs.  h is at most what makes the
    average bucket hold ``bucket_rows`` rows."""
    dim = queries.shape[1]
    axes = 2 << max(1, (dim - 1).bit_length())
    most = max(1, math.ceil(math.log(max(rows, 1) / bucket_rows, axes)))
    found: list[tuple[float, Setting]] = []
    owner = np.repeat(np.arange(len(queries)), [len(n) for n in neighbours])
    near = unit_rows(np.concatenate(neighbours))
    unit = unit_rows(queries)
    for hashes in range(most, 0, -1):
        turn = Rotations(dim, TABLES[-1], hashes)
        probes = [p for p in PROBES if p < axes ** hashes] + ([axes] if hashes == 1 else [])
        hit_after = np.empty((TABLES[-1], len(owner)), np.int64)      # probes until the neighbour's bucket comes up
        for t in range(TABLES[-1]):
            own = turn.buckets(turn(near, t), 1)[:, 0]
            looked = turn.buckets(turn(unit, t), probes[-1])[owner] == own[:, None]
            hit_after[t] = np.where(looked.any(axis=1), looked.argmax(axis=1), 1 << 40)
        for tables in TABLES:
            for p in probes:
                recall = float((hit_after[:tables] < p).any(axis=0).mean())
                if recall >= target or (hashes == 1 and p == axes):
                    work = tables * p * (rows / axes ** hashes + 32)
                    found.append((work, Setting(hashes, tables, p, recall)))
                    break
    return min(found)[1]


def measured_queries(wanted: DataFrame, index: DataFrame, k: int, most: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(vectors, their true neighbours' vectors) of at most ``most`` queries,
    drawn by a hash of their ids, by brute force over all rows: ``most`` vectors
    go to every task, and ``most`` x k come back from all of them."""
    drawn = wanted.orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).select("vec_id", "vector").collect()
    if not drawn:
        return np.zeros((0, 1)), []
    own, asked = [r["vec_id"] for r in drawn], matrix([r["vector"] for r in drawn])

    def best(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            rows = matrix(b.column("vector").to_pylist())
            ids = b.column("ids").to_pylist()
            gap = (rows ** 2).sum(axis=1) - 2 * asked @ rows.T      # in the order of the distances
            out = []
            for q, row in enumerate(gap):
                for r in np.argsort(row, kind="stable")[:k + 1]:
                    if any(i != own[q] for i in ids[r]):
                        out.append((q, float(row[r]), rows[r].tolist()))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out]),
                                              pa.array([o[2] for o in out], pa.list_(pa.float64()))],
                                             ["q", "score", "vector"])

    order = Window.partitionBy("q").orderBy("score")
    near = (index.mapInArrow(best, "q int, score double, vector array<double>")
            .withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).collect())
    lists: list[list] = [[] for _ in drawn]
    for r in near:
        lists[r["q"]].append(r["vector"])
    kept = [q for q, n in enumerate(lists) if n]
    return asked[kept], [matrix(lists[q]) for q in kept]


def nearest(vectors: DataFrame, queries: Column | None = None, k: int = 10, bucket_rows: int = BUCKET_ROWS,
            target: float = TARGET, measured: int = MEASURED, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows found for every
    row of ``vectors`` that ``queries`` (a condition on ``vec_id``) selects."""
    rows = stage(usable(vectors, id_col, vector_col), "vectors")
    lengths = rows.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows")).orderBy(
        F.desc("rows"), "n").first()
    dim, total = (lengths["n"], lengths["rows"]) if lengths else (1, 0)
    rows = rows.where(F.size("vector") == dim).dropDuplicates(["vec_id", "vector"])
    wanted = rows if queries is None else rows.where(queries)
    parts = shuffle_partitions(vectors.sparkSession)

    order = Window.partitionBy("vector").orderBy("vec_id")
    index = stage(rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
                  .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "index")

    asked, near = measured_queries(wanted, index, k, measured)
    if not near:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    hashes, tables, probes, _ = choose(asked, near, total, bucket_rows, target)

    def hashed(looks: int, with_vectors: bool):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            turn = Rotations(dim, tables, hashes)
            for b in small(batches):
                x = unit_rows(matrix(b.column("vector").to_pylist()))
                for t in range(tables):
                    code = turn.buckets(turn(x, t), looks)
                    at = np.repeat(np.arange(b.num_rows), code.shape[1])
                    cols = {"table": pa.array(np.full(len(at), t), pa.int32()),
                            "bucket": pa.array(code.ravel(), pa.int64())}
                    if with_vectors:
                        got = b.take(pa.array(at))
                        cols |= {"ids": got.column("ids"), "vector": got.column("vector")}
                    yield pa.RecordBatch.from_pydict(cols)
        return run

    place, schema = "table int, bucket long", "table int, bucket long, ids array<long>, vector array<double>"
    asked = wanted.select(F.array("vec_id").alias("ids"), "vector")
    held = index.select("ids", "vector").mapInArrow(hashed(1, True), schema)
    asks = asked.mapInArrow(hashed(probes, True), schema)
    # a bucket that is much larger than it should be is searched in parts:
    # its rows are dealt to them and its queries go to each
    sizes = index.select("ids", "vector").mapInArrow(hashed(1, False), place)
    large = stage(sizes.groupBy("table", "bucket").agg(F.count("*").alias("n"))
                  .where(F.col("n") > 4 * bucket_rows)
                  .select("table", "bucket", F.ceil(F.col("n") / bucket_rows).cast("int").alias("parts")), "large")
    if large.limit(1).count():
        held = held.join(large, ["table", "bucket"], "left")
        asks = asks.join(large, ["table", "bucket"], "left")
    else:
        held, asks = held.withColumn("parts", F.lit(1)), asks.withColumn("parts", F.lit(1))
    n_parts = F.coalesce("parts", F.lit(1))
    placed = (held.withColumn("part", F.pmod(F.xxhash64(F.col("ids")[0]), n_parts).cast("int"))
              .withColumn("is_query", F.lit(False))
              .unionByName(asks.withColumn("part", F.explode(F.sequence(F.lit(0), n_parts - 1)))
                           .withColumn("is_query", F.lit(True)))
              .select("table", "bucket", "part", "is_query", "ids", "vector"))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, ("table", "bucket", "part")):
            asks = [i for i, q in enumerate(g["is_query"]) if q]
            held = [i for i, q in enumerate(g["is_query"]) if not q]
            if not asks or not held:
                continue
            ids, rows = [g["ids"][i] for i in held], matrix([g["vector"][i] for i in held])
            for a in range(0, len(asks), QUERY_BLOCK):
                block = asks[a:a + QUERY_BLOCK]
                yield found_batch(best_of([g["ids"][i][0] for i in block], matrix([g["vector"][i] for i in block]),
                                          ids, rows, k))

    found_schema = "query_id long, vec_id long, score double"
    by = ["table", "bucket", "part"]
    candidates = placed.repartition(*by).sortWithinPartitions(*by).mapInArrow(search, found_schema)
    top = Window.partitionBy("query_id").orderBy("score", "vec_id")
    first = stage(candidates.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
                  .withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k), "found")

    # an exact way for the rest: queries that found fewer than k
    enough = first.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    short = asked.withColumn("query_id", F.col("ids")[0]).join(enough, "query_id", "left_anti")
    n_short = short.count()
    if not n_short:
        return first.select("query_id", "rank", "vec_id", "score")
    # every slot of the index meets the query blocks, a bounded number at a time
    n_slots, n_blocks = max(parts, -(-total // bucket_rows)), -(-n_short // QUERY_BLOCK)
    rounds = -(-n_blocks // BLOCKS_AT_ONCE)
    blocks = (short.withColumn("q", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int"))
              .groupBy("q").agg(F.collect_list(F.struct("query_id", "vector")).alias("queries"))
              .select((F.col("q") % rounds).alias("round"), "queries",
                      F.explode(F.sequence(F.lit(0), F.lit(n_slots - 1))).alias("slot")))

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        ids, held = left.column("ids").to_pylist(), left.column("vector").to_pylist()
        for block in right.column("queries").to_pylist():
            if ids:
                out += best_of([q["query_id"] for q in block], matrix([q["vector"] for q in block]), ids, matrix(held), k)
        return pa.Table.from_batches([found_batch(out)])

    slots = (index.withColumn("slot", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(n_slots)).cast("int"))
             .withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1)))))
    met = ["slot", "round"]
    exact = (slots.groupBy(*met).cogroup(blocks.groupBy(*met)).applyInArrow(scan, found_schema)
             .groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
             .withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k))
    return (first.join(enough.select("query_id"), "query_id", "left_semi").unionByName(exact)
            .select("query_id", "rank", "vec_id", "score"))
