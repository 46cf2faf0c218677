"""Embedding whitening against whole-number and numpy arithmetic."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import SF, given
from larder.llm import whitening
from larder.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k=32):
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    far = [sum((n * r[j] - sums[j]) ** 2 for j in range(d)) for r in x]
    centred = np.array([[r[j] - sums[j] / n for j in range(d)] for r in x])
    v = np.array([[sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x) / n ** 3 for j in range(d)]
                  for i in range(d)])
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1][:k], axes[:, ::-1][:, :k]
    return far, centred @ axes / np.sqrt(e), e / np.trace(v)


def test_cross_products_are_exact():
    rnd = random.Random(3)
    for bits in (3, 20, 61):
        y = np.array([[rnd.randint(-2 ** bits, 2 ** bits) for _ in range(5)] for _ in range(130)], np.int64)
        sums, cross = whitening.block_products(y)
        rows = y.tolist()
        assert sums.tolist() == [sum(r[j] for r in rows) for j in range(5)]
        assert cross.tolist() == [[sum(r[i] * r[j] for r in rows) for j in range(5)] for i in range(5)]


def test_query_against_plain_arithmetic(spark):
    rows = given(SF, "embeddings", "vec_id, embedding")
    far, white, share = plain(rows)
    got = {}
    for r in QUERIES["op11_embedding_whitening"](spark, SF).collect():
        got[r["vec_id"], r["component"]] = r
    assert len(got) == len(rows) * 32
    signs = np.array([np.sign(got[rows[0][0], c + 1]["whitened"] * white[0, c]) for c in range(32)])
    for k, (i, _) in enumerate(rows):
        for c in range(32):
            r = got[i, c + 1]
            assert (r["n"], r["deviation"], r["deviation_text"]) == (len(rows), far[k], str(far[k]))
            assert abs(r["whitened"] - signs[c] * white[k, c]) < 1e-8
            assert abs(r["explained"] / share[c] - 1) < 1e-9 and r["identity_error"] < 1e-9


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 0.25, 2.0]), (2, [1.5, -0.25, 1.0]), (2, [1.5, -0.25, 1.0]), (None, [0.0, 3.0, 5.5])]
    odd = [(5, None), (6, []), (7, [nan, 1.0, 1.0]), (8, [inf, 1.0, 1.0]), (9, [None, 1.0, 1.0]), (10, [1.0])]
    table = spark.createDataFrame(good + odd, SCHEMA)
    for c in ("n", "vector", "component", "whitened", "i"):
        table = table.withColumn(c, F.lit("x"))
    rows = whitening.whiten(table).collect()
    far, white, _ = plain(good)
    assert sorted((str(r["vec_id"]), r["component"]) for r in rows) == sorted(
        (str(i), c) for i, _ in good for c in (1, 2, 3))
    assert sorted(r["deviation"] for r in rows) == sorted(f for f in far for _ in range(3))
    # four rows, two of them equal: two components
    assert {r["component"] for r in rows if r["whitened"] is None} == {3}
    assert all(abs(abs(r["whitened"]) - abs(white[1, r["component"] - 1])) < 1e-9
               for r in rows if r["vec_id"] == 2 and r["component"] < 3)
    assert {r["identity_error"] < 1e-9 for r in rows} == {True}


@pytest.mark.parametrize("vectors", [[[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_rows_without_spread(spark, vectors):
    rows = whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), SCHEMA)).collect()
    assert len(rows) == 2 * len(vectors)
    assert {(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in rows} == {(0, None, None, None)}


def test_empty_table(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []


def test_entries_of_any_size(spark):
    good = [(i, [float(np.float32(3.0e15 * (i + 1))), 1.0]) for i in range(3)]
    rows = whitening.whiten(spark.createDataFrame(good, SCHEMA)).collect()
    far, _, _ = plain(good)
    assert {(r["vec_id"], r["deviation_text"]) for r in rows} == {(i, str(f)) for (i, _), f in zip(good, far)}
    assert all(r["deviation"] is None or str(r["deviation"]) == r["deviation_text"] for r in rows)
    ends = whitening.whiten(spark.createDataFrame([(0, [3e38]), (1, [-3e38])], SCHEMA)).collect()
    assert len(ends) == 2 and abs(abs(ends[0]["whitened"]) - 1) < 1e-12


def test_blocks_and_partitions_do_not_matter(spark):
    rows = given(SF, "embeddings", "vec_id, embedding")
    one = whitening.fit(whitening.finite_vectors(spark.createDataFrame(rows, SCHEMA).coalesce(1), "vec_id", "embedding"))
    many = whitening.fit(whitening.finite_vectors(spark.createDataFrame(rows, SCHEMA).repartition(13), "vec_id",
                                                  "embedding"))
    assert one.sums == many.sums and np.array_equal(one.components, many.components)
