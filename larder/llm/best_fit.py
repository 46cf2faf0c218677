"""Best-fit packing of documents into sequences by linear grouping.

A document is its ids and an end id; one longer than a sequence is cut into
full pieces and one shorter remainder, which comes first.  Lengths have at
most ``capacity`` values, so the whole packing problem is a table of counts
per length, whatever the number of documents.  The plan is made on those
counts, and the documents are then put in its places by their rank among the
pieces of their length:

1. large lengths, in descending order, are cut into groups of equal
   cardinality, and each is rounded up to its group's largest, so that a few
   sizes stand for all of them;
2. the linear programme over all configurations of the few rounded sizes (what
   fits into a sequence) is solved by column generation: a knapsack over the
   sizes' prices finds the configuration that helps most, until none does.
   Each configuration is used the whole number of times that the solution has
   it;
3. the places of a configuration are given to actual lengths, so the slack of
   rounding is known exactly and free again;
4. whatever large lengths the whole numbers left over, and then the small
   ones, go, in descending order, to the fullest open sequences that have room:
   best fit.

All of this is arithmetic on counts: sequences of the same content are one
row of the plan, split only where a length runs out.

Defined cases: a null text is empty and takes one place (its end id); rows
that share an id are packed each; rows with a null id are packed as well;
other columns are ignored; no rows give no sequences.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.frames import id_and_text, shuffle_partitions, slices, stage, tokenizer_path
from larder.llm.token_ids import encoder

PIECE_SCHEMA = "doc_id long, piece int, start long, length int, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: the first is the shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, capacity: int = 1024, vocabulary: str = "byte_bpe_50k.json",
           end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's pieces;
    ``with_ids`` adds the ids themselves."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = encoder(tokenizer_path(vocabulary))
        end = np.array([end_id], dtype="<u4")
        for ids, texts in slices(batches):
            rows = []
            for i, t in zip(ids, texts):
                own = np.concatenate([to_ids(t or ""), end])
                for k, (s, n) in enumerate(cut(len(own), capacity)):
                    part = own[s:s + n]
                    rows.append((i, k, s, n, zlib.crc32(part.tobytes()),
                                 part.astype("<i4") if with_ids else None))
            cols = list(zip(*rows))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            n = 5 + with_ids
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols[:n], kinds[:n])], names[:n])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        encode, PIECE_SCHEMA + ", ids array<int>" * with_ids)


class Plan:
    """Classes of equal sequences while they are filled."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rows: list[tuple[list[int], int]] = []      # (lengths in order, sequences)
        self.open: dict[int, list[int]] = {}             # room left -> classes
        self.rooms: list[int] = []                       # rooms that have classes, ascending

    def add(self, lengths: list[int], times: int) -> None:
        if times <= 0:
            return
        room = self.capacity - sum(lengths)
        if room not in self.open:
            self.open[room] = []
            insort(self.rooms, room)
        self.open[room].append(len(self.rows))
        self.rows.append((lengths, times))

    def best_fit(self, length: int, count: int) -> None:
        """Put ``count`` pieces of ``length`` where least room is left over."""
        while count:
            k = bisect_left(self.rooms, length)
            if k == len(self.rooms):
                each = min(self.capacity // length, count)
                times = count // each
                self.add([length] * each, times)
                count -= each * times
                continue
            room = self.rooms[k]
            row = self.open[room].pop()
            if not self.open[room]:
                del self.open[room], self.rooms[k]
            lengths, times = self.rows[row]
            used = min(times, count)
            self.rows[row] = ([], 0)
            self.add([*lengths, length], used)
            self.add(lengths, times - used)
            count -= used


def grouped(counts: dict[int, int], groups: int) -> list[list[int]]:
    """The lengths, longest first, in groups of about equal cardinality; a
    length that fills a group's share by itself is its own group."""
    lengths = sorted(counts, reverse=True)
    if len(lengths) <= groups:
        return [[x] for x in lengths]
    share = sum(counts.values()) / groups
    out: list[list[int]] = [[]]
    held = 0
    for x in lengths:
        if out[-1] and held + counts[x] / 2 > share:
            out.append([])
            held = 0
        out[-1].append(x)
        held += counts[x]
    return out


def dearest(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration (a number of each size) with the highest total price
    that fits, and that price: a knapsack by dynamic programming over the room,
    one step for each copy of a size that could go in."""
    steps = [k for k in range(len(sizes)) for _ in range(capacity // sizes[k])]
    best, took = np.zeros(capacity + 1), np.zeros((len(steps), capacity + 1), bool)
    for step, k in enumerate(steps):
        value = best[:-sizes[k]] + prices[k]
        took[step, sizes[k]:] = value > best[sizes[k]:] + 1e-12
        best[sizes[k]:] = np.maximum(best[sizes[k]:], value)
    chosen, room = np.zeros(len(sizes)), capacity
    for step in range(len(steps) - 1, -1, -1):
        if took[step, room]:
            chosen[steps[step]] += 1
            room -= sizes[steps[step]]
    return float(best[capacity]), chosen


def configurations(sizes: list[int], wanted: list[int], capacity: int, gap: float = 1e-3,
                   most: int = 4000) -> list[tuple[list[int], int]]:
    """(sizes of a configuration, times) that hold no more than ``wanted`` of
    each size: the solution of the linear programme min sum x, A x >= wanted
    over all configurations, rounded down.  The simplex steps end when the
    solution is within ``gap`` of its lower bound (price of the demand over
    the dearest configuration's price)."""
    order = np.argsort(sizes)
    size, need = np.array(sizes)[order], np.array(wanted, float)[order]
    if not len(size):
        return []
    columns = np.diag((capacity // size).astype(float))
    inverse = np.diag(1 / np.diag(columns))
    for _ in range(most):
        prices = inverse.sum(axis=0)                            # of the basis, whose columns cost 1 each
        top, entering = dearest(size, prices, capacity)
        if top <= 1 + gap:
            break
        times, change = inverse @ need, inverse @ entering
        ratio = np.where(change > 1e-9, np.maximum(times, 0) / np.where(change > 1e-9, change, 1), np.inf)
        out = int(ratio.argmin())
        columns[:, out] = entering
        row = inverse[out] / change[out]
        inverse -= np.outer(change, row)
        inverse[out] = row
    times = np.floor(np.maximum(np.linalg.solve(columns, need), 0) + 1e-6).astype(int)
    left, found = np.array(wanted)[order], []
    for k in np.argsort(-(size @ columns)):                     # the fullest first
        own = columns[:, k].astype(int)
        n = min([int(times[k]), *(left[own > 0] // own[own > 0]).tolist()])
        if n > 0:
            left -= n * own
            found.append(([int(x) for x in np.repeat(size, own)[::-1]], n))
    return found


def make_plan(counts: dict[int, int], capacity: int, groups: int = 128,
              small: float = 1 / 8) -> list[tuple[list[int], int]]:
    """(lengths in order, number of sequences) for counts per length."""
    plan = Plan(capacity)
    full = counts.get(capacity, 0)
    plan.add([capacity], full)
    large = {x: n for x, n in counts.items() if capacity > x > capacity * small and n}
    stock: dict[int, list[list[int]]] = {}               # rounded size -> [[length, left], ...]
    for group in grouped(large, groups):
        if group:
            stock[group[0]] = [[x, large[x]] for x in group]
    sizes = sorted(stock)
    for config, times in configurations(sizes, [sum(n for _, n in stock[s]) for s in sizes], capacity):
        need = Counter(config)
        # substitute actual lengths; split where one runs out
        while times:
            lengths, most = [], times
            taken: Counter = Counter()
            for s in config:
                have = next(h for h in stock[s] if h[1] - taken[h[0]] > 0)
                taken[have[0]] += 1
                lengths.append(have[0])
            for s in need:
                for h in stock[s]:
                    if taken[h[0]]:
                        most = min(most, h[1] // taken[h[0]])
            plan.add(lengths, most)
            for s in need:
                for h in stock[s]:
                    h[1] -= taken[h[0]] * most
                stock[s] = [h for h in stock[s] if h[1]]
            times -= most
    rest = {x: n for have in stock.values() for x, n in have}
    for x in sorted((x for x in counts if x < capacity and (x <= capacity * small or rest.get(x))), reverse=True):
        plan.best_fit(x, counts[x] if x <= capacity * small else rest[x])
    return [(lengths, times) for lengths, times in plan.rows if times]


#: Groups of the large lengths, and bounds of small lengths (as shares of a
#: sequence) that are tried; each try is arithmetic on counts.
GROUPS, SMALL = 128, (1 / 8, 1 / 4)


def best_plan(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """The plan with the fewest sequences over a few bounds."""
    plans = (make_plan(counts, capacity, GROUPS, s) for s in SMALL)
    return min(plans, key=lambda p: sum(n for _, n in p))


def places(plan: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """The plan by length and rank: pieces of ``length`` with ranks from
    ``rank`` on go to consecutive sequences from ``sequence`` on."""
    rows, sequence = [], 0
    used: Counter = Counter()
    for lengths, times in plan:
        offset = 0
        for x in lengths:
            rows.append((x, used[x], sequence, offset))
            used[x] += times
            offset += x
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), table.T.copy()))


def ranked(found: DataFrame, capacity: int) -> DataFrame:
    """A rank from 0 for every piece among those of its length.  A length
    that very many pieces have is ranked in chunks whose counts are summed."""
    chunks = shuffle_partitions(found.sparkSession)
    found = found.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(chunks)))
    sizes = found.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = sizes.select("length", "chunk", F.coalesce(F.sum("n").over(
        Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "chunk").orderBy("doc_id", "piece", "start", "ids_crc32")
    return (found.withColumn("within", F.row_number().over(order) - 1)
            .join(before, ["length", "chunk"])
            .withColumn("rank", F.col("base") + F.col("within")))


def pack(docs: DataFrame, capacity: int = 1024, vocabulary: str = "byte_bpe_50k.json", end_id: int = 2,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every
    piece of every document."""
    found = stage(pieces(docs, capacity, vocabulary, end_id, id_col, text_col), "pieces")
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    at = places(best_plan(counts, capacity))          # collected: one row per length, at most capacity rows

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (at["length"] << 44) + at["rank"]
        for b in batches:
            rank = b.column(5).to_numpy()
            k = np.searchsorted(key, (b.column(3).to_numpy().astype(np.int64) << 44) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], b.column(3).cast(pa.int64()), b.column(4),
                 pa.array(at["sequence"][k] + rank - at["rank"][k], pa.int64()),
                 pa.array(at["offset"][k], pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return (ranked(found, capacity)
            .select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("long"))
            .mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                               "sequence_id long, offset long"))
