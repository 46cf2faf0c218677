"""Every stage of the pipeline against a plain version on its own input."""

import itertools
import re
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from helpers import oracle_rows
from larder.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"
CAPITALS = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = [docs.collect()]
    for name, apply in corpus_pipeline.STAGES:
        apply(spark, docs, SF).write.parquet(str(out / name))
        docs = spark.read.parquet(str(out / name))
        got.append(docs.collect())
    return got


def texts(rows):
    found = {r["doc_id"]: r["text"] for r in rows}
    assert len(found) == len(rows)
    return found


def stays(after, before):
    """Not a remainder: untouched, or half of the text or 300 code points are left."""
    return after == before or (WORD.search(after) and (len(after) >= 300 or 2 * len(after) >= len(before)))


def test_quality_rules(tables):
    kept = {r["doc_id"] for r in oracle_rows(ORACLE["op1_quality_rules"], SF) if r["kept"]}
    assert kept and texts(tables[1]) == {i: t for i, t in texts(tables[0]).items() if i in kept}
    assert {tuple(r) for r in tables[1]} <= {tuple(r) for r in tables[0]}


def test_line_dedup(tables):
    first, holders = {}, {}
    key = lambda line: line.strip(BLANKS).translate(CAPITALS)
    for i, t in sorted(texts(tables[1]).items()):
        for k in map(key, t.split("\n")):
            first.setdefault(k, i)
            holders.setdefault(k, set()).add(i)
    expected = {}
    for i, t in texts(tables[1]).items():
        stay = [x for x in t.split("\n")
                if len(key(x)) < 10 or len(holders[key(x)]) < 2 or first[key(x)] == i]
        expected[i] = "\n".join(stay)
    assert texts(tables[2]) == {i: t for i, t in expected.items() if stays(t, texts(tables[1])[i])}
    assert all(r["n_chars"] == len(r["text"]) for r in tables[2])


def test_near_duplicates(tables):
    sets = {}
    for i, t in texts(tables[2]).items():
        words = t.encode().split()
        sets[i] = {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))}
    group = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and group[a] != group[b]:
            low, high = sorted((group[a], group[b]))
            group = {i: low if g == high else g for i, g in group.items()}
    assert texts(tables[3]) == {i: t for i, t in texts(tables[2]).items() if group[i] == i}


def plain_chunks(text, n=28, most=64):
    """(first word, words) of the chunks that run from a cut to the first cut
    n words on, and from the last of these cuts to the end, by a rolling hash
    that goes byte by byte."""
    gear = [xxhash.xxh32_intdigest(bytes([b]), seed=7) for b in range(256)]
    data, h, state = text.encode(), 0, []
    for b in data:
        h = ((h << 2) + gear[b]) % 2 ** 32
        state.append(h)
    spots = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
    cuts = [0]
    for k, (begin, _) in enumerate(spots):
        if k and (state[begin - 1] < 2 ** 31 or k - cuts[-1] == most):
            cuts.append(k)
    cuts.append(len(spots))
    spans = [(c, next(d for d in cuts if d >= c + n)) for c in cuts if c + n <= len(spots)]
    spans += [(spans[-1][0], len(spots))] if spans else []
    words = [data[a:b] for a, b in spots]
    return spots, [(c, tuple(words[c:d])) for c, d in spans]


def test_repeated_passages(tables):
    given, owner = texts(tables[3]), {}
    found = {i: plain_chunks(t) for i, t in given.items()}
    for i in sorted(given):
        for _, words in found[i][1]:
            owner.setdefault(words, i)
    expected = {}
    for i, t in given.items():
        spots, chunks = found[i]
        gone = {k + d for k, words in chunks if owner[words] < i for d in range(len(words))}
        data = t.encode()
        ends = [b for b, _ in spots[1:]] + [len(data)]
        kept = data[:spots[0][0]] if spots else data
        kept += b"".join(data[spots[k][0]:ends[k]] for k in range(len(spots)) if k not in gone)
        expected[i] = kept.decode()
    assert texts(tables[4]) == {i: t for i, t in expected.items() if stays(t, given[i])}


def test_no_remainder_of_a_near_copy_is_packed(tables):
    """Documents that a dedup stage cut down keep half of their text, or 300
    code points."""
    first = texts(tables[1])
    for i, t in texts(tables[4]).items():
        assert len(t) >= 300 or 4 * len(t) >= len(first[i]), i


def test_packing(tables):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4")
           for i, t in texts(tables[4]).items()}
    assert {r["doc_id"] for r in tables[5]} == set(ids)
    filled, at = {}, {}
    for r in sorted(tables[5], key=lambda r: (r["doc_id"], r["piece"])):
        own = ids[r["doc_id"]]
        assert r["start"] == at.get(r["doc_id"], 0) and 0 < r["length"] <= 1024
        at[r["doc_id"]] = r["start"] + r["length"]
        assert r["ids_crc32"] == zlib.crc32(own[r["start"]:at[r["doc_id"]]].tobytes())
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert at == {i: len(x) for i, x in ids.items()}
    for places in filled.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    # no worse than first fit by decreasing length of the same pieces
    bins = []
    for n in sorted((r["length"] for r in tables[5]), reverse=True):
        k = next((k for k, b in enumerate(bins) if b + n <= 1024), None)
        if k is None:
            bins.append(n)
        else:
            bins[k] += n
    assert len(filled) <= len(bins) + 1
