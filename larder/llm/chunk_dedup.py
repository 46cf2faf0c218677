"""Substring dedup by content-defined chunks.

A gear rolling hash over the last 16 bytes decides, at every start of a word,
whether the text is cut there, so cuts depend on nearby bytes only and an
insertion moves none of the cuts after it.  The pieces between cuts have about
two words, so many recur by chance; the chunk that is compared runs from a cut
to the first cut that is ``min_words`` words on or more, and from the last such
cut to the end of the text.  Chunks vary in length and overlap; each is known
by a 128-bit digest of its words, white space doesn't count.  A chunk is a
repeat in a document if a document with a smaller id holds it, and the words
of its repeated chunks go.  So whatever goes stood together, ``min_words``
words at least, in one earlier document, however often its short phrases recur
elsewhere.  The document with the smallest id keeps every word, so one copy of
each passage always stays.

Defined cases: a null or empty text is returned as it is, with no pieces; rows
that share an id count as one document; a row with a null id takes no part and
is returned whole; other columns are ignored; a text of any length is cut
whole, and no piece between cuts has more than ``MOST_WORDS`` words;
``n_chunks`` counts those pieces and ``n_dropped_chunks`` the ones that lost a
word.  A passage of n words is found if two of the cuts in it are
``min_words`` apart: with 28 words and n = 51 it is missed with a chance of
about 1e-5, a passage of fewer than 28 words is never found.  An empty table
gives no rows.  Rows with one id and one text meet in one block of documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import blocks as B
from larder.llm.frames import id_and_text

#: Production parameters: one word start in RATE is a cut; most words between
#: cuts; least words of a chunk.
RATE, MOST_WORDS, MIN_WORDS = 2, 64, 28
BLOCK_BYTES = 4 << 20
#: The gear table comes from a rule: the hash of each byte's number.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), seed=7) for b in range(256)], np.uint32)
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
SIGN = np.uint64(1 << 63)
SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
SCHEMA = ("doc_id long, text string, n_chunks long, n_dropped_chunks long, n_dropped_words long, "
          "dropped array<struct<begin:long,end:long>>")


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte, the gear hash of the last 16 bytes: every step shifts by
    two bits, so older bytes have left the 32 bits.  Doubling the window four
    times gives the rolling value without a loop over bytes."""
    h = GEAR[data]
    for w in (1, 2, 4, 8):
        h[w:] = h[w:] + (h[:-w] << np.uint32(2 * w))
    return h


def word_pieces(text: bytes, rate: int = RATE) -> tuple[np.ndarray, np.ndarray]:
    """(first byte of every word, words between one cut and the next)."""
    data = np.frombuffer(text, np.uint8)
    blank = BLANK[data]
    edge = np.diff(blank.astype(np.int8), prepend=1, append=1)
    first = np.flatnonzero(edge == -1)
    if not len(first):
        return first, np.zeros(0, np.int64)
    h = gear_hashes(data)
    starts = np.zeros(len(first), bool)
    starts[0] = True
    starts[1:] = h[first[1:] - 1] < np.uint32(2 ** 32 // rate)
    cut = np.flatnonzero(starts)
    words = np.diff(cut, append=len(first))
    if words.max() > MOST_WORDS:
        cut = np.concatenate([np.arange(c, c + n, MOST_WORDS) for c, n in zip(cut, words)])
        words = np.diff(cut, append=len(first))
    return first, words


def chunks(text: bytes, pieces: np.ndarray, min_words: int = MIN_WORDS
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, word after the last, digest in two halves) of every chunk."""
    plain = b" ".join(text.split())
    first = np.append(0, np.flatnonzero(np.frombuffer(plain, np.uint8) == 32) + 1)
    cut = np.append(0, np.cumsum(pieces))
    upto = np.searchsorted(cut, cut + min_words)
    begin, end = cut[upto < len(cut)], cut[upto[upto < len(cut)]]
    if len(begin) and end[-1] < cut[-1]:
        begin, end = np.append(begin, begin[-1]), np.append(end, cut[-1])
    last = np.append(first[1:] - 1, len(plain))[end - 1]
    digests = b"".join(xxhash.xxh3_128_digest(plain[a:b]) for a, b in zip(first[begin].tolist(), last.tolist()))
    return begin, end, np.frombuffer(digests, "<u8").reshape(-1, 2)


def runs(begin: np.ndarray, end: np.ndarray, n_words: int) -> list[tuple[int, int]]:
    """[from, to) of the words that the chunks [begin, end) cover."""
    steps = np.zeros(n_words + 1, np.int64)
    np.add.at(steps, begin, 1)
    np.add.at(steps, end, -1)
    edge = np.flatnonzero(np.diff((np.cumsum(steps) > 0).astype(np.int8), prepend=0, append=0))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def smallest(digests: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct digests in order, the smallest id with each, every row's place
    among them)."""
    order = np.lexsort((ids, digests[:, 1], digests[:, 0]))
    ordered = digests[order]
    new = np.append(True, (ordered[1:] != ordered[:-1]).any(axis=1))[:len(ordered)]
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[new], ids[order][new], place


def unsigned(ids: list[int]) -> np.ndarray:
    """Ids in their order as unsigned numbers: the sign bit is turned."""
    return np.array(ids, np.int64).view(np.uint64) ^ SIGN


def block_chunks(table: pa.Table, rate: int, min_words: int) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
    """Per row (bytes, first byte of every word, words between cuts, begin and
    end of its chunks), and :func:`smallest` over the block's chunks."""
    rows, digests = [], [np.zeros((0, 2), np.uint64)]
    for t in table.column("text"):
        data = (t.as_py() or "").encode()
        first, pieces = word_pieces(data, rate)
        begin, end, found = chunks(data, pieces, min_words)
        rows.append((data, first, pieces, begin, end))
        digests.append(found)
    ids = np.repeat(unsigned(table.column("doc_id").to_pylist()), [len(d) for d in digests[1:]])
    return rows, *smallest(np.concatenate(digests), ids)


def smaller_elsewhere(table: pa.Table) -> pa.Table:
    """For the cells of a key bucket: to each block, the places in its cell of
    the digests that another block's document with a smaller id holds."""
    cells = [B.unpacked(k.as_py(), 16) for k in table.column("keys")]
    ids = np.concatenate([B.unpacked(p.as_py(), 8) for p in table.column("payload")])
    _, least, place = smallest(np.concatenate(cells), ids)
    less = least[place] < ids
    out, at = [], 0
    for block, own in zip(table.column("block").to_pylist(), cells):
        places = np.flatnonzero(less[at:at + len(own)])
        at += len(own)
        if len(places):
            out.append((block, table.column("bucket")[0].as_py(), B.packed(places, 4), b""))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), B.REQUEST_ARROW)] if out else
                    [pa.array([], f.type) for f in B.REQUEST_ARROW], schema=B.REQUEST_ARROW)


def dedup_substrings(docs: DataFrame, rate: int = RATE, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                     text_col: str = "text", carry: bool = False) -> DataFrame:
    """(doc_id, text, n_chunks, n_dropped_chunks, n_dropped_words, dropped)
    for every row: ``text`` without its repeated passages and the byte spans
    that went.  ``carry`` adds the other columns as a struct."""
    every = id_and_text(docs, id_col, text_col, carry)
    rows = every.where("doc_id is not null")
    rest = f", rest {every.schema['rest'].dataType.simpleString()}" if carry else ""
    n_blocks, n_buckets = B.sizes(rows, BLOCK_BYTES)

    def ask(table: pa.Table) -> pa.Table:
        _, keys, ids, _ = block_chunks(table, rate, min_words)
        return B.requests(table.column("block")[0].as_py(), keys, ids, n_buckets, 16, 8)

    def settle(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, keys, least, place = block_chunks(left, rate, min_words)
        elsewhere = np.zeros(len(keys), bool)
        which = B.buckets_of(keys[:, 0], n_buckets)
        for b, k in zip(right.column("bucket").to_pylist(), right.column("keys")):
            elsewhere[np.searchsorted(which, np.uint64(b)) + B.unpacked(k.as_py(), 4).astype(np.int64)] = True
        ids, out, at = left.column("doc_id").to_pylist(), [], 0
        for i, own, t, (data, first, pieces, begin, end) in zip(ids, unsigned(ids), left.column("text"), rows):
            mine = place[at:at + len(begin)]
            at += len(begin)
            again = elsewhere[mine] | (least[mine] < own)
            gone = runs(begin[again], end[again], len(first))
            starts, ends = np.append(first, len(data)), np.cumsum(pieces)
            spans = [(int(starts[a]), int(starts[b])) for a, b in gone]
            cuts = [0, *(x for s in spans for x in s), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2])).decode() if spans else t.as_py()
            lost = np.zeros(len(first) + 1, np.int64)
            for a, b in gone:
                lost[a + 1:b + 1] = 1
            lost = np.cumsum(lost)
            out.append((i, kept, len(pieces), int((lost[ends] > lost[ends - pieces]).sum()), int(lost[-1]),
                        [{"begin": a, "end": b} for a, b in spans]))
        cols = list(zip(*out)) or [[]] * 6
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(SPAN)]
        done = pa.table([pa.array(c, k) for c, k in zip(cols, kinds)],
                        names=["doc_id", "text", "n_chunks", "n_dropped_chunks", "n_dropped_words", "dropped"])
        return done.append_column("rest", left.column("rest")) if rest else done

    found = B.exchanged(B.dealt(rows, n_blocks), ask, smaller_elsewhere, settle, SCHEMA + rest)
    none = F.lit(0).cast("long")
    apart = every.where("doc_id is null").select(
        "doc_id", "text", none.alias("n_chunks"), none.alias("n_dropped_chunks"), none.alias("n_dropped_words"),
        F.array().cast(found.schema["dropped"].dataType).alias("dropped"), *(["rest"] if carry else []))
    return found.unionByName(apart)
