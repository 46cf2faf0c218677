"""Circulant MinHash near-dedup against all pairs."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import EDGES, frame, given
from larder.llm import circulant_minhash as M


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k:k + 2]) for k in range(max(1, len(words) - 1))} if words else set()


def plain(docs, percent=80):
    sets = [shingle_set(t) for _, t in docs]
    group = list(range(len(docs)))

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for a, b in itertools.combinations(range(len(docs)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            group[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    out = []
    for k, (i, _) in enumerate(docs):
        c = least.get(top(k)) if sets[k] else i
        out.append((i, len(sets[k]), c, i == c))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def corpus(seed=4):
    """Groups of near copies, chains whose ends are far apart, short texts
    that share most of their few words, one passage in most texts."""
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    passage = rnd.sample(words, 40)
    docs = []
    for _ in range(25):
        base = rnd.sample(words, rnd.randint(30, 120)) + (passage if rnd.random() < 0.7 else [])
        docs.append(base)
        for _ in range(rnd.randint(0, 12)):
            copy = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 14))):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            docs.append(copy)
    chain = rnd.sample(words, 100)
    for k in range(30):
        docs.append(list(chain))
        chain[3 * k % 100:3 * k % 100 + 3] = rnd.sample(words, 3)
    docs += [rnd.choices("abc", k=rnd.randint(0, 4)) for _ in range(40)]
    rnd.shuffle(docs)
    return [(k, " ".join(d)) for k, d in enumerate(docs)]


def test_two_permutations_estimate_similarity():
    rnd = np.random.default_rng(1)
    a = rnd.integers(0, 2 ** 63, 900, np.uint64)
    for share in (0, 300, 600, 800):
        b = np.concatenate([a[:share], rnd.integers(0, 2 ** 63, 900 - share, np.uint64)])
        got = M.signatures([np.unique(a), np.unique(b)], 2000)
        assert abs((got[0] == got[1]).mean() - share / (1800 - share)) < 0.05
    x = M.permuted(np.arange(1 << 20, dtype=np.uint32), np.empty(1 << 20, np.uint32))
    assert len(np.unique(x)) == 1 << 20
    assert M.chance_missed(0.8) < 1e-5


def test_large_sets_in_parts(monkeypatch):
    rnd = np.random.default_rng(2)
    sets = [np.unique(rnd.integers(0, 2 ** 63, n, np.uint64)) for n in (3, 700, 1, 50, 900, 2)]
    whole = M.signatures(sets, 30)
    monkeypatch.setattr(M, "AT_ONCE", 64)
    assert np.array_equal(M.signatures(sets, 30), whole)


@pytest.mark.parametrize("slice_rows", [256, 3])
def test_against_all_pairs(spark, slice_rows):
    docs = corpus()
    assert found(M.near_duplicates(frame(spark, docs).repartition(5), slice_rows=slice_rows)) == plain(docs)


def test_large_group_of_near_copies(spark):
    rnd = random.Random(8)
    base = [f"b{k}" for k in range(200)]
    docs = []
    for k in range(600):
        copy = list(base)
        for _ in range(rnd.randint(1, 14)):
            copy[rnd.randrange(200)] = f"x{rnd.randrange(10_000)}"
        docs.append((k, " ".join(copy)))
    want = plain(docs)
    assert sum(kept for *_, kept in want) < 150
    # with blocks only in the end, and without any step between
    assert found(M.near_duplicates(frame(spark, docs), slice_rows=20)) == want
    assert found(M.near_duplicates(frame(spark, docs), slice_rows=1000)) == want


def test_given_documents(spark):
    docs = given("/root/testdata/sf0.001")
    assert found(M.near_duplicates(frame(spark, docs))) == plain(docs)


def test_edges(spark):
    docs = EDGES + [(20, "A B c d e f g h i j"), (None, "only here"), (None, "ONLY  here"), (21, "one"), (6, "other text")]
    df = frame(spark, docs)
    for c in ("node", "digest", "key", "keys", "size", "pivot", "part", "role", "component", "root", "least", "a", "b"):
        df = df.withColumn(c, F.lit("x"))
    assert found(M.near_duplicates(df)) == plain(docs)


def test_empty_table(spark):
    assert M.near_duplicates(frame(spark, [])).collect() == []
    assert found(M.near_duplicates(frame(spark, [(1, None), (2, "  ")]))) == [(1, 0, 1, True), (2, 0, 2, True)]
