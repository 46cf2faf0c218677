"""The setting of the neighbour search is measured, not guessed."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import given
from larder.llm import cross_polytope as X


@pytest.fixture(scope="module")
def vectors():
    return np.array([v for _, v in given("/root/testdata/sf0.1", "embeddings", "vec_id, embedding")
                     if v and len(v) == 64 and None not in v], float)


def true_neighbours(vectors, queries, k=10):
    return [vectors[np.argsort(((vectors - q) ** 2).sum(axis=1), kind="stable")[1:k + 1]] for q in queries]


def recall(setting, queries, near):
    turn = X.Rotations(queries.shape[1], setting.tables, setting.hashes)
    hit = []
    for q, n in zip(queries, near):
        found = np.zeros(len(n), bool)
        for t in range(setting.tables):
            own = turn.buckets(turn(X.unit_rows(n), t), 1)[:, 0]
            found |= np.isin(own, turn.buckets(turn(X.unit_rows(q[None]), t), setting.probes)[0])
        hit.append(found.mean())
    return np.mean(hit)


@pytest.mark.parametrize("most", [1, 2, 3])
def test_recall_is_held_at_any_number_of_hashes(vectors, most, monkeypatch):
    """Settings for tables that ask for one, two and three hashes, each held
    against queries that it was not measured on."""
    fit, held_out = vectors[:30], vectors[100:120]
    if most > 1:
        monkeypatch.setattr(X, "TABLES", (8, 16, 24))
    rows = 128 ** most * 50
    setting = X.choose(fit, true_neighbours(vectors, fit), rows, bucket_rows=50)
    assert setting.recall >= X.TARGET and setting.hashes <= most
    assert recall(setting, held_out, true_neighbours(vectors, held_out)) >= 0.9


def test_a_setting_always_exists():
    rnd = np.random.default_rng(3)
    queries = rnd.normal(size=(20, 64))
    far = [rnd.normal(size=(10, 64)) for _ in queries]      # neighbours that no hash brings together
    setting = X.choose(queries, far, 10 ** 6)
    assert setting.recall >= X.TARGET or (setting.hashes, setting.probes) == (1, 128)


def test_exact_way_in_rounds(spark, monkeypatch):
    """More short queries than one round takes."""
    monkeypatch.setattr(X, "QUERY_BLOCK", 2)
    monkeypatch.setattr(X, "BLOCKS_AT_ONCE", 2)
    rows = [(i, [float(i % 7 + 1), float(i * i % 11), 1.0 + i]) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in X.nearest(df, F.col("vec_id") > 0, k=10).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    points = {i: np.array(v) for i, v in rows}
    assert got == {i: sorted((j for j in points if j != i), key=lambda j: (((points[i] - points[j]) ** 2).sum() ** 0.5, j))
                   for i in points}
