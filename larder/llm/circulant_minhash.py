"""Near-duplicate documents by circulant MinHash.

A document is the set of its two-word shingles, each a 64-bit number.  One
permutation of the 32-bit numbers places every shingle on a circle, and one
second permutation, shifted around the circle by k, gives coordinate k of the
signature: the smallest value that it assigns to a placed shingle.  Two
permutations make all coordinates.  ``bands`` groups of ``band_rows``
coordinates are the keys under which documents meet; two sets with similarity J
share a key with a chance of 1 - (1 - J^rows)^bands.

Documents with equal sets are one node, so exact copies cost nothing beyond the
first.  What shares a key is confirmed on the full sets, in two steps that make
no table of all pairs:

1. Every node of a key meets one pivot only, in slices of a pivot with at most
   about ``SLICE_ROWS`` others.  This is repeated with another pivot, from the
   key's largest component, for the nodes outside of it, while blocks of what
   is left would copy rows many times: one large group of near copies becomes
   one component in time that grows with its rows.
2. Keys whose nodes are still in several components are compared in blocks: the
   nodes outside of the key's largest component among each other and with the
   largest one, in parts of at most about ``SLICE_ROWS``; pairs inside of one
   component are left out, since they can join nothing.

So every two nodes that share a key are either confirmed, found too different,
or known to be connected.

Defined cases: words are ASCII white space delimited, A-Z lower-cased; a text of
one word is one shingle; a text without words (or null) has no shingles, is
linked with nothing and is its own component.  Rows are nodes whether or not
they share an id; ``component_id`` is the smallest id among the rows of the
component.  A row with a null id links like any other but names no component:
its ``component_id`` is null, and it is kept, only if nothing in its component
has an id.  Texts are read whole.  Empty tables return no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.frames import WordNumbers, id_and_text, slices, stage

#: Production parameters: words of a shingle, least similarity in hundredths,
#: bands and rows of a band (a pair at 0.80 is missed with a chance of 5e-6).
WORDS, PERCENT, BANDS, BAND_ROWS = 2, 80, 40, 6
#: Nodes that meet one pivot, or make one part of a block, at most about.
SLICE_ROWS = 256
#: Steps with a pivot before blocks at most, and copies of a row that blocks
#: may make on average before another such step is worth it.
STARS, MOST_COPIES = 8, 3
#: Shingles whose coordinates are found at a time.
AT_ONCE = 1 << 15
#: Odd multipliers of the permutations.
SPREAD, TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
FIRST, SECOND = np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)


def chance_missed(similarity: float, bands: int = BANDS, rows: int = BAND_ROWS) -> float:
    return (1 - similarity ** rows) ** bands


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * SPREAD
    x = (x ^ (x >> np.uint64(27))) * TURN
    return x ^ (x >> np.uint64(31))


def permuted(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """The second permutation, of the 32-bit numbers, in place."""
    for shift, times in ((np.uint32(16), FIRST), (np.uint32(13), SECOND)):
        np.right_shift(x, shift, out=spare)
        np.bitwise_xor(x, spare, out=x)
        np.multiply(x, times, out=x)
    return x


class Shingles:
    """Sorted 64-bit numbers of a text's shingles."""

    def __init__(self, words: int = WORDS):
        self.words, self.numbers = words, WordNumbers(xxhash.xxh3_64_intdigest)

    def __call__(self, text: str | None) -> np.ndarray:
        found = text.encode().lower().split() if text else []
        if not found:
            return np.zeros(0, np.uint64)
        ids = self.numbers.of(found)
        n = min(self.words, len(ids))
        key = np.full(len(ids) - n + 1, n, np.uint64)
        for k in range(n):
            key = mixed(key ^ ids[k:len(ids) - n + 1 + k])
        return np.unique(key)


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """(sets, coordinates) of sets that aren't empty."""
    ends = np.cumsum([len(s) for s in sets])
    starts = ends - [len(s) for s in sets]
    # the first permutation: a place on the circle of 2^32 for every shingle
    placed = (mixed(np.concatenate(sets) + SPREAD) >> np.uint64(32)).astype(np.uint32)
    out = np.full((len(sets), coordinates), 2 ** 32 - 1, np.uint32)
    a = 0
    while a < len(sets):
        # as many whole sets as fit, or one large set in parts
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + AT_ONCE, "right")))
        cuts = starts[a:b] - starts[a]
        for c in range(starts[a], ends[b - 1], AT_ONCE):
            part = placed[c:min(c + AT_ONCE, ends[b - 1])]
            values, spare = np.empty_like(part), np.empty_like(part)
            for k in range(coordinates):
                np.subtract(part, np.uint32(k), out=values)      # shifted around the circle by k
                least = np.minimum.reduceat(permuted(values, spare), cuts)
                np.minimum(out[a:b, k], least, out=out[a:b, k])
        a = b
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(sets, bands): a 64-bit key for each band."""
    of_bands = signature.reshape(len(signature), bands, rows).astype(np.uint64)
    key = np.broadcast_to(mixed(np.arange(1, bands + 1, dtype=np.uint64)), of_bands.shape[:2])
    for r in range(rows):
        key = mixed(key ^ of_bands[:, :, r])
    return key


def digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def sets_of(rows: DataFrame, words: int, bands: int, band_rows: int) -> DataFrame:
    """(doc_id, digest, size, keys) of rows (doc_id, text): 128 bits that tell
    the shingle set (null for an empty one), its size and band keys."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for ids, texts in slices(batches):
            sets = [shingles(t) for t in texts]
            full = [s for s in sets if len(s)]
            keys = iter(band_keys(signatures(full, bands * band_rows), bands, band_rows).view(np.int64)
                        if full else [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                ["doc_id", "digest", "size", "keys"])

    return rows.mapInArrow(make, "doc_id long, digest binary, size long, keys array<long>")


def common_with(one: np.ndarray, flat: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many shingles each of n sets, laid out in ``flat``, shares with one."""
    at = np.searchsorted(one, flat)
    at[at == len(one)] = 0
    return np.bincount(owner[one[at] == flat], minlength=n)


def links_of_group(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Confirmed links of one group: rows (node, role, component, shingles).
    Those of role 0 are compared with all of another component; those of role 1
    only with role 0.  Links within what the group has joined are left out."""
    found: dict[int, tuple] = {r[0]: r for r in rows}      # a node that comes twice is one
    rows = sorted(found.values(), key=lambda r: (r[1], r[0]))
    size = np.array([len(r[3]) for r in rows])
    flat, owner = np.concatenate([r[3] for r in rows]), np.repeat(np.arange(len(rows)), size)
    _, root = np.unique([r[2] for r in rows], return_inverse=True)
    out = []
    for k, (node, role, _, shingles) in enumerate(rows):
        if role:
            break
        open_ones = root != root[k]
        open_ones &= 100 * np.minimum(size, size[k]) >= percent * np.maximum(size, size[k])
        if not open_ones.any():
            continue
        mask = open_ones[owner]
        common = common_with(shingles, flat[mask], owner[mask], len(rows))
        linked = open_ones & (100 * common >= percent * (size + size[k] - common))
        for other in np.flatnonzero(linked):
            if root[other] != root[k]:
                out.append((node, rows[other][0]))
                root[root == root[other]] = root[k]
    return out


def confirmed(groups: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b) links found in groups (group columns, node, role, component);
    ``texts`` has one text (node, text) for each node that occurs."""
    keys = [c for c in groups.columns if c not in ("node", "role", "component")]

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        mark, held = None, []

        def done() -> pa.RecordBatch:
            links = links_of_group(held, percent)
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()),
                                               pa.array([b for _, b in links], pa.int64())], ["a", "b"])

        for batch in batches:
            marks = zip(*(batch.column(k).to_pylist() for k in keys))
            for own, node, role, component, text in zip(marks, batch.column("node").to_pylist(),
                                                        batch.column("role").to_pylist(),
                                                        batch.column("component").to_pylist(), batch.column("text")):
                if own != mark and held:
                    yield done()
                    held.clear()
                mark = own
                held.append((node, role, component, shingles(text.as_py())))
        if held:
            yield done()

    dealt = groups.join(texts.hint("merge"), "node").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.select(*keys, "node", "role", "component", "text").mapInArrow(compare, "a long, b long")


def roots_of(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node with a link, over rows (a, b): root is one
    node for each component.  Each round every node goes to its smallest
    neighbour if that is smaller, paths are cut short until they end, and the
    links that still join two roots make the next round.  Joins are between
    written tables, so a hub's rows can be split."""
    links = stage(links.where("a <> b").distinct(), "links")
    labels = None
    for _ in range(max_rounds):
        ways = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stage(ways.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"),
                                                                    F.least("a", "b").alias("root")), "up")
        while True:
            above = up.select(F.col("node").alias("root"), F.col("root").alias("top"))
            up = stage(up.join(above, "root").select("node", F.col("top").alias("root"),
                                                    (F.col("top") != F.col("root")).alias("moved")), "up")
            moved = up.where("moved").limit(1).count()
            up = up.select("node", "root")
            if not moved:
                break
        if labels is None:
            labels = up
        else:
            above = up.select(F.col("node").alias("root"), F.col("root").alias("top"))
            labels = stage(labels.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root")),
                           "labels")
        a, b = (up.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("a", "b"))
        links = stage(links.join(a, "a").join(b, "b").where("a_root <> b_root")
                      .select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).distinct(), "links")
        if not links.limit(1).count():
            return labels
    raise RuntimeError(f"links did not settle in {max_rounds} rounds")


def pivot_groups(members: DataFrame, slice_rows: int) -> DataFrame:
    """Groups of step 1 from members (key, node, pivot): a pivot and at most
    about ``slice_rows`` of those that share a key with it."""
    pairs = stage(members.where("node <> pivot").select("node", "pivot").distinct(), "pairs")
    parts = stage(pairs.groupBy("pivot").agg(F.ceil(F.count("*") / slice_rows).cast("int").alias("parts")), "parts")
    others = (pairs.join(parts, "pivot")
              .select("pivot", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "node",
                      F.lit(1).alias("role"), F.col("node").alias("component")))
    own = parts.select("pivot", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                       F.col("pivot").alias("node"), F.lit(0).alias("role"), F.col("pivot").alias("component"))
    return others.unionByName(own)


def open_members(members: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, node, component) of the keys whose nodes are in several
    components, and (key, main, n_main, n): their largest component."""
    known = labels.withColumnRenamed("root", "component")
    placed = (members.join(known, "node", "left")
              .select("key", "node", F.coalesce("component", "node").alias("component")))
    several = stage(placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"),
                                              F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("m"),
                                              F.bit_xor(F.xxhash64("node", F.lit("twin"))).alias("w"))
                    # a key of two nodes has been settled by its pivot, and one key of those with the same nodes is enough
                    .where("x <> y and n > 2").groupBy("n", "m", "w").agg(F.min("key").alias("key")).select("key"),
                    "several")
    placed = stage(placed.join(several, "key"), "open")
    sizes = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    main = stage(sizes.groupBy("key").agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("n"))
                 .select("key", F.col("most.component").alias("main"), F.col("most.n").alias("n_main"), "n"), "main")
    return placed, main


def parts_of(n: Column, slice_rows: int) -> Column:
    return F.greatest(F.ceil(n / slice_rows), F.lit(1)).cast("int")


def block_copies(main: DataFrame, slice_rows: int) -> tuple[int, int]:
    """(rows of the open keys, rows that their blocks would hold)."""
    out = F.col("n") - F.col("n_main")
    p_main, p_out = parts_of(F.col("n_main"), slice_rows), parts_of(out, slice_rows)
    r = main.agg(F.sum("n").alias("n"), F.sum(out * (p_out + p_main) + F.col("n_main") * p_out).alias("copies")).first()
    return r["n"] or 0, r["copies"] or 0


def star_members(placed: DataFrame, main: DataFrame, number: int) -> DataFrame:
    """Members (key, node, pivot) of another step like the first: the nodes
    outside of the largest component, with one node of it, another each time."""
    dealt = placed.join(main.select("key", "main"), "key")
    inside = dealt.where("component = main")
    pivot = stage(inside.groupBy("key").agg(F.min(F.struct(F.xxhash64("node", F.lit(number)).alias("h"), "node")).alias("p"))
                  .select("key", F.col("p.node").alias("pivot")), "pivot")
    return dealt.where("component <> main").join(pivot, "key").select("key", "node", "pivot")


def block_groups(placed: DataFrame, main: DataFrame, slice_rows: int) -> DataFrame:
    """Groups of step 2: blocks of two parts of the nodes outside of a key's
    largest component, i <= j, and of one such part with each part of the
    largest component."""
    dealt = (placed.join(main, "key").withColumn("outside", F.col("component") != F.col("main"))
             .withColumns({"p_main": parts_of(F.col("n_main"), slice_rows),
                           "p_out": parts_of(F.col("n") - F.col("n_main"), slice_rows)})
             .withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("outside"), F.col("p_out"))
                                       .otherwise(F.col("p_main"))).cast("int")))
    cells = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    outside, inside = dealt.where("outside"), dealt.where("not outside")
    among = (outside.select("key", "node", "component", "own", F.explode(cells("p_out")).alias("other"))
             .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     F.lit(False).alias("main"), "node", F.lit(0).alias("role"), "component"))
    across = (outside.select("key", F.col("own").alias("i"), F.explode(cells("p_main")).alias("j"),
                             F.lit(True).alias("main"), "node", F.lit(0).alias("role"), "component")
              .unionByName(inside.select("key", F.explode(cells("p_out")).alias("i"), F.col("own").alias("j"),
                                         F.lit(True).alias("main"), "node", F.lit(1).alias("role"), "component")))
    return among.unionByName(across)


def connected(members: DataFrame, texts: DataFrame, words: int, percent: int, slice_rows: int,
              max_stars: int = STARS) -> DataFrame:
    """(node, root) of all nodes that have a confirmed link."""
    links = stage(confirmed(stage(pivot_groups(members, slice_rows), "pivots"), texts, words, percent), "found")
    for star in range(1, max_stars + 1):
        roots = roots_of(links)
        placed, main = open_members(members, roots)
        rows, copies = block_copies(main, slice_rows)
        if not rows:
            return roots
        if copies <= MOST_COPIES * rows or star == max_stars:
            groups = block_groups(placed, main, slice_rows)
        else:
            groups = pivot_groups(star_members(placed, main, star), slice_rows)
        more = confirmed(stage(groups, "groups"), texts, words, percent)
        links = stage(links.unionByName(more), "found")
        if copies <= MOST_COPIES * rows:
            break
    return roots_of(links)


def texts_of(rows: DataFrame, lent: DataFrame, words: int) -> DataFrame:
    """One text (node, text) for each node of ``lent`` (node, digest, least):
    of the document with the smallest id, or of one without an id."""

    def right(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # an id may have rows with other sets, and many rows with this one
        shingles, seen = Shingles(words), set()
        for batch in batches:
            own = []
            for text, node, mark in zip(batch.column("text"), batch.column("node").to_pylist(),
                                        batch.column("digest").to_pylist()):
                own.append(node not in seen and digest(shingles(text.as_py())) == mark)
                if own[-1]:
                    seen.add(node)
            yield batch.select(["node", "text"]).filter(pa.array(own, pa.bool_()))

    def marked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = Shingles(words), set()
        for batch in batches:
            marks = [digest(shingles(t.as_py())) for t in batch.column("text")]
            new = [k for k, m in enumerate(marks) if not (m in seen or seen.add(m))]
            yield pa.RecordBatch.from_arrays([pa.array([marks[k] for k in new], pa.binary()),
                                              batch.column("text").take(pa.array(new, pa.int64()))], ["digest", "text"])

    # one plan at every size: below some size Spark would send the wanted ids to the texts
    with_id = (rows.hint("merge").join(lent.select("node", "digest", F.col("least").alias("doc_id")), "doc_id")
               .select("node", "digest", "text").mapInArrow(right, "node long, text string"))
    nameless = lent.where("least is null").select("node", "digest")
    without = (rows.where(F.col("doc_id").isNull() & F.col("text").isNotNull()).select("text")
               .mapInArrow(marked, "digest binary, text string").join(nameless, "digest").select("node", "text"))
    return with_id.unionByName(without)


def near_duplicates(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, bands: int = BANDS,
                    band_rows: int = BAND_ROWS, slice_rows: int = SLICE_ROWS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row."""
    rows = id_and_text(docs, id_col, text_col)
    found = stage(sets_of(rows, words, bands, band_rows), "sets")
    # one numbered node for each distinct set; the numbers are fixed by writing them
    nodes = stage(found.where(F.col("digest").isNotNull()).groupBy("digest")
                  .agg(F.min("doc_id").alias("least"), F.first("keys").alias("keys"))
                  .withColumn("node", F.monotonically_increasing_id()), "nodes")
    met = nodes.select("node", F.explode("keys").alias("key"))
    shared = stage(met.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).where("n > 1")
                   .select("key", "pivot"), "shared")
    members = stage(met.join(shared, "key").select("key", "node", "pivot"), "members")
    lent = nodes.select("node", "digest", "least").join(members.select("node").distinct(), "node")
    texts = stage(texts_of(rows, stage(lent, "lent"), words), "texts")
    roots = connected(members, texts, words, percent, slice_rows)
    # (digest, component): the smallest id among the nodes that are connected
    placed = stage(nodes.select("node", "digest", "least").join(roots, "node", "left")
                   .select("digest", "least", F.coalesce("root", "node").alias("root")), "placed")
    least = stage(placed.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    component = stage(placed.select("digest", "root").join(least, "root").select("digest", "component_id"), "components")
    full = found.where(F.col("digest").isNotNull()).join(component, "digest")
    empty = found.where(F.col("digest").isNull()).withColumn("component_id", F.col("doc_id"))
    return (full.select("doc_id", "size", "component_id").unionByName(empty.select("doc_id", "size", "component_id"))
            .select("doc_id", F.col("size").alias("n_shingles"), "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))
