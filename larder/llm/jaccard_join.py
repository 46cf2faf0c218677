"""N-gram Jaccard self-join by chosen paths.

A text is the set of its five-word shingles.  A run is a tree of paths: at
every node a set picks ``branch`` of its shingles, the smallest under a hash
that the path seeds, and goes on under each.  Two sets with similarity J pick
the same shingle with probability J, so similar sets share paths and others
part after a step or two.  The recursion is a sequence of tables: paths with
one set are dropped, paths with at most ``bucket_rows`` sets become buckets,
larger ones are split by the next step.  A node that is still large at
``depth`` steps holds sets that are alike (or hold one common passage); it is a
bucket too, compared in blocks of rows that are dealt to many tasks.  Runs are
repeated until the expected recall at the threshold reaches ``target_recall``.

A pair is verified exactly (full shingle sets), in the first bucket that its
sets share and in no other, so links can be counted where they are found and
no table of pairs is made: each block of comparisons gives one row per set,
with its number of links and one neighbour towards the block's component.

Texts with equal shingle sets are one set with a number of copies, so exact
copies cost nothing beyond the first.

Defined cases: a text of fewer than five words is one shingle of all its
words; a text without words (or null) has no shingles, no links and is its own
class; rows that share an id are one document, with the set of the smallest digest;
a row with a null id takes no part and has no class; other columns are
ignored; a text of any length is shingled whole; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.components import components
from larder.llm.frames import WordNumbers, id_and_text, slices, stage

#: Production parameters.
WORDS, THRESHOLD, TARGET_RECALL = 5, 0.8, 0.9999
BRANCH, DEPTH, BUCKET_ROWS = 2, 3, 96
#: Sets, and shingles in all, that a part of a bucket holds at most about.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 1 << 18
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Columns of a dense block of comparisons, products held at once.
COLUMNS, PRODUCTS = 1 << 12, 1 << 19


def recall_of_run(similarity: float, branch: int, depth: int) -> float:
    """Chance that two sets share a path through all levels of one run."""
    p = 1.0
    for _ in range(depth):
        p = 1 - (1 - similarity * p) ** branch
    return p


def runs_needed(threshold: float, target: float, branch: int = BRANCH, depth: int = DEPTH) -> int:
    """Runs until a pair at the threshold is missed with 1 - target at most."""
    return max(1, math.ceil(math.log(1 - target) / math.log(1 - recall_of_run(threshold, branch, depth))))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX_A
    x = (x ^ (x >> np.uint64(29))) * MIX_B
    return x ^ (x >> np.uint64(32))


class Shingles:
    """Sorted 64-bit hashes of a text's shingles."""

    def __init__(self, words: int):
        self.words, self.numbers = words, WordNumbers(xxhash.xxh3_64_intdigest)

    def __call__(self, text: str | None) -> np.ndarray:
        found = text.encode().split() if text else []
        if not found:
            return np.zeros(0, np.uint64)
        ids = self.numbers.of(found)
        n = max(1, len(ids) - self.words + 1)
        key = np.full(n, len(ids) if len(ids) < self.words else self.words, np.uint64)
        for k in range(min(self.words, len(ids))):
            key = mixed(key ^ ids[k:n + k])
        return np.unique(key)


def path_tree(shingles: np.ndarray, runs: int, branch: int, depth: int) -> np.ndarray:
    """Keys of all paths of a set, level by level: the first ``runs x branch``
    are the first steps, and the children of place k of a level stand from
    ``k x branch`` on in the next.  A node picks the shingle whose product with
    an odd number, drawn from the path, is smallest."""
    out = []
    level = mixed(np.arange(1, runs + 1, dtype=np.uint64))
    at_once = max(1, PRODUCTS // len(shingles))
    for _ in range(depth):
        seeds = mixed(np.repeat(level, branch) + np.tile(np.arange(1, branch + 1, dtype=np.uint64), len(level)))
        picked = np.concatenate([
            shingles[((seeds[k:k + at_once, None] | np.uint64(1)) * shingles[None, :]).argmin(axis=1)]
            for k in range(0, len(seeds), at_once)])
        level = mixed(seeds ^ picked)
        out.append(level)
    return np.concatenate(out)


def level_places(runs: int, branch: int, depth: int) -> list[int]:
    """The place of :func:`path_tree` where each level begins, and the end."""
    out = [0]
    for d in range(depth):
        out.append(out[-1] + runs * branch ** (d + 1))
    return out


def sets_of(rows: DataFrame, words: int, runs: int, branch: int, depth: int) -> DataFrame:
    """(doc_id, low, high, size, paths) of rows (doc_id, text): a 128-bit
    digest of the shingle set, its size and its path keys."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for ids, texts in slices(batches):
            got = [(i, shingles(t)) for i, t in zip(ids, texts)]
            digests = [digest(s) for _, s in got]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in got], pa.int64()),
                 pa.array([d[0] for d in digests], pa.int64()),
                 pa.array([d[1] for d in digests], pa.int64()),
                 pa.array([len(s) for _, s in got], pa.int64()),
                 pa.array([path_tree(s, runs, branch, depth).view(np.int64) if len(s) else [] for _, s in got],
                          pa.list_(pa.int64()))],
                ["doc_id", "low", "high", "size", "paths"])

    return rows.mapInArrow(make, "doc_id long, low long, high long, size long, paths array<long>")


def buckets(sets: DataFrame, runs: int, branch: int, depth: int, bucket_rows: int) -> DataFrame:
    """(path, rep, n, shingles) of the sets in every bucket of two or more,
    with the bucket's number of sets and of shingles, from rows (rep, size,
    paths)."""
    begin = level_places(runs, branch, depth)
    here = sets.select("rep", "size", F.posexplode(F.slice("paths", 1, begin[1])).alias("place", "path"))
    out = None
    for d in range(depth):
        sizes = stage(here.groupBy("path").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"))
                      .where("n > 1"), "paths")
        done = sizes if d == depth - 1 else sizes.where(F.col("n") <= bucket_rows)
        part = here.join(done, "path").select("path", "rep", "n", "shingles")
        out = part if out is None else out.unionByName(part)
        if d < depth - 1:
            # only sets on a path that is still large take the next step
            open_nodes = here.join(sizes.where(F.col("n") > bucket_rows), "path").select("rep", "place")
            children = (open_nodes.join(sets, "rep")
                        .select("rep", "size", F.col("place").alias("above"), F.posexplode(F.slice(
                            "paths", F.lit(begin[d + 1] + 1) + F.col("place") * branch, F.lit(branch)))
                            .alias("k", "path")))
            here = stage(children.select("rep", "size", (F.col("above") * branch + F.col("k")).alias("place"), "path"),
                         "nodes")
    return out


def without_twins(members: DataFrame) -> DataFrame:
    """One bucket of those with exactly the same sets: two similar texts meet
    on most of their paths, and once is enough.  A bucket's sets are told by
    two independent hashes over them."""
    marks = members.groupBy("path").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("rep")).alias("x"),
        F.bit_xor(F.xxhash64("rep", F.lit("second"))).alias("y"))
    first = marks.groupBy("n", "x", "y").agg(F.min("path").alias("path")).select("path")
    return members.join(first, "path", "left_semi")


def intersections(members: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairs' intersections, over shingles that two or more
    members hold, a bounded number of them at a time."""
    flat = np.concatenate(members)
    who = np.repeat(np.arange(len(members), dtype=np.int32), [len(m) for m in members])
    order = np.argsort(flat, kind="stable")
    keys, who = flat[order], who[order]
    new = np.append(True, keys[1:] != keys[:-1])
    column = np.cumsum(new, dtype=np.int32) - 1
    shared = (np.bincount(column) > 1)[column]
    column, who = column[shared], who[shared]
    out = np.zeros((len(members), len(members)), np.float32)
    if len(column):
        column = np.cumsum(np.append(True, column[1:] != column[:-1])) - 1
        for a in range(0, int(column[-1]) + 1, COLUMNS):
            x, z = np.searchsorted(column, [a, a + COLUMNS])
            dense = np.zeros((len(members), int(column[z - 1]) - a + 1), np.float32)
            dense[who[x:z], column[x:z] - a] = 1
            out += dense @ dense.T
    return out


def compare(block: dict[str, list], threshold: float) -> list[tuple[int, int, int]]:
    """(rep, links weighted by copies, neighbour) of the sets of one block of
    comparisons, counting the pairs whose first common bucket this is."""
    path, near, far = block["path"][0], block["i"][0], block["j"][0]
    once = list({r: k for k, r in enumerate(block["rep"])}.values())     # repeated rows
    if len(once) < len(block["rep"]):
        block = {n: [c[k] for k in once] for n, c in block.items()}
    sets = [np.frombuffer(s, np.uint64) for s in block["shingles"]]
    m = len(sets)
    part = np.array(block["part"])
    pairs = np.triu(np.ones((m, m), bool), 1)
    if near != far:
        pairs &= part[:, None] != part[None, :]
    # pairs that share a smaller bucket are counted there
    smaller: dict[int, list[int]] = {}
    for k, paths in enumerate(block["paths"]):
        for p in paths:
            if p < path:
                smaller.setdefault(p, []).append(k)
    both = [v for v in smaller.values() if len(v) > 1]
    for a in range(0, len(both), COLUMNS):
        seen = np.zeros((m, min(COLUMNS, len(both) - a)), np.float32)
        for c, v in enumerate(both[a:a + COLUMNS]):
            seen[v, c] = 1
        pairs &= (seen @ seen.T) == 0
    if not pairs.any():
        return []
    size = np.array([len(s) for s in sets], np.float64)
    busy = np.flatnonzero(pairs.any(0) | pairs.any(1))
    common = np.zeros((m, m), np.float32)
    common[np.ix_(busy, busy)] = intersections([sets[k] for k in busy])
    union = size[:, None] + size[None, :] - common
    linked = pairs & (common >= threshold * union - 1e-9)
    if not linked.any():
        return []
    both_ways = linked | linked.T
    copies = np.array(block["copies"], np.int64)
    links = both_ways @ copies
    # a spanning tree of each component: every set and one that leads on
    root = np.full(m, -1)
    rows = []
    for k in np.flatnonzero(both_ways.any(0)):
        if root[k] >= 0:
            continue
        queue, root[k] = [k], k
        while queue:
            x = queue.pop()
            fresh = np.flatnonzero(both_ways[x] & (root < 0))
            root[fresh] = k
            queue.extend(fresh.tolist())
    for k in np.flatnonzero(root >= 0):
        rows.append((block["rep"][k], int(links[k]), block["rep"][int(root[k])]))
    return rows


def groups(batches: Iterable[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[dict[str, list]]:
    """Runs of rows with equal keys, from batches that are sorted by them."""
    held: dict[str, list] | None = None
    for batch in batches:
        cols = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        marks = list(zip(*(cols[k] for k in keys)))
        at = 0
        while at < len(marks):
            end = at + 1
            while end < len(marks) and marks[end] == marks[at]:
                end += 1
            part = {n: c[at:end] for n, c in cols.items()}
            if held is not None and tuple(held[k][0] for k in keys) == marks[at]:
                for n, c in part.items():
                    held[n].extend(c)
            else:
                if held is not None:
                    yield held
                held = part
            at = end
    if held is not None:
        yield held


def digest(shingles: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(shingles.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def links_of(members: DataFrame, rows: DataFrame, words: int, threshold: float, block_rows: int) -> DataFrame:
    """(rep, links, neighbour) rows from the buckets' members (path, rep, n,
    shingles, copies, low, high) and the texts (doc_id, text)."""
    # a set is in at most runs x branch ^ depth buckets, so its list is short
    lists = members.groupBy("rep", "copies", "low", "high").agg(
        F.sort_array(F.collect_list(F.struct("path", "n", F.col("shingles").alias("held")))).alias("in"))

    def shingle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Shingles(words)
        for b in batches:
            sets = [make(t.as_py()) for t in b.column("text")]
            own = [digest(x) == d for x, d in zip(sets, zip(b.column("low").to_pylist(), b.column("high").to_pylist()))]
            yield pa.RecordBatch.from_arrays(
                [b.column("rep"), b.column("copies"), b.column("in"),
                 pa.array([x.tobytes() for x in sets], pa.binary())],
                ["rep", "copies", "in", "shingles"]).filter(pa.array(own, pa.bool_()))

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in groups(batches, ("path", "i", "j")):
            if rows := compare(block, threshold):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                 ["rep", "links", "neighbour"])

    held = (lists.join(rows.withColumnRenamed("doc_id", "rep"), "rep")
            .select("rep", "copies", "in", "low", "high", "text")
            .mapInArrow(shingle, "rep long, copies long, in array<struct<path:long,n:long,held:long>>, shingles binary"))
    # a bucket of n sets is parts x parts blocks of comparisons; a set goes
    # to the blocks of its part, which hold at most two parts' rows
    parts = F.ceil(F.greatest(F.col("n") / block_rows, F.col("held") / BLOCK_SHINGLES)).cast("int")
    placed = (held.select("rep", "copies", "shingles", F.col("in.path").alias("paths"), F.explode("in").alias("b"))
              .select("rep", "copies", "shingles", "paths", "b.path", "b.n", "b.held")
              .withColumn("part", F.pmod(F.xxhash64("rep"), parts).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
              .withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other"))
              .select("path", "i", "j", "part", "rep", "copies", "paths", "shingles"))
    return (placed.repartition("path", "i", "j").sortWithinPartitions("path", "i", "j")
            .mapInArrow(check, "rep long, links long, neighbour long"))


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS,
                 target_recall: float = TARGET_RECALL, branch: int = BRANCH, depth: int = DEPTH,
                 bucket_rows: int = BUCKET_ROWS, block_rows: int = BLOCK_ROWS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, set_id, n_links) for every document: the smallest id that
    the document is linked to by similar documents, the smallest id with the
    same shingle set, and the number of other documents with a similarity of
    at least ``threshold``."""
    rows = id_and_text(docs, id_col, text_col)
    runs = runs_needed(threshold, target_recall, branch, depth)
    found = stage(sets_of(rows, words, runs, branch, depth), "sets")
    named = found.where(F.col("doc_id").isNotNull() & (F.col("size") > 0))
    # one set per document, then one row per distinct set with its copies
    owned = named.groupBy("doc_id").agg(F.min(F.struct("low", "high")).alias("d")).select("doc_id", "d.low", "d.high")
    distinct = stage(owned.groupBy("low", "high").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")),
                     "distinct")
    sets = stage(named.withColumnRenamed("doc_id", "rep").join(distinct, ["rep", "low", "high"], "left_semi")
                 .select("rep", "size", "paths").dropDuplicates(["rep"]), "reps")
    members = stage(buckets(sets, runs, branch, depth, bucket_rows), "buckets")
    members = stage(without_twins(members), "members")
    links = stage(links_of(members.join(distinct, "rep"), rows, words, threshold, block_rows), "links")
    counted = links.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(links.select(F.col("rep").alias("a"), F.col("neighbour").alias("b")))
    classes = (distinct.join(counted, "rep", "left")
               .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
               .select("low", "high", F.col("rep").alias("set_id"), F.coalesce("root", "rep").alias("class_id"),
                       (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links")))
    alone = found.where(F.col("doc_id").isNull() | (F.col("size") == 0)).select("doc_id")
    alone = alone.where("doc_id is null").unionByName(
        alone.where("doc_id is not null").distinct().join(owned.select("doc_id"), "doc_id", "left_anti"))
    return (owned.join(classes, ["low", "high"]).select("doc_id", "class_id", "set_id", "n_links")
            .unionByName(alone.select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("set_id"),
                                      F.lit(0).cast("long").alias("n_links"))))
