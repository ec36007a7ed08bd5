import numpy as np
import pytest
from pyspark.sql import functions as F

from matrixq.llm import forest, topk
from matrixq.llm.topk import ImpactIndex


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")


def brute(ids, values, query, k):
    scores = [(-int(v @ values[query]), i) for i, v in zip(ids, values) if i != ids[query]]
    return [(i, -s) for s, i in sorted(scores)[:k]]


@pytest.fixture(scope="module")
def odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [3.0]), (8, [-1.0, -1.0]), (8, [-1.0, -1.0]), (None, [9.0, 9.0]), (9, [])]
    return vectors(spark, [(i, v, "x") for i, v in rows])


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    values = rng.normal(size=(900, 16)).astype("f4")
    values[100:140] = values[100]  # ties
    table = vectors(spark, [(i, v.tolist(), "x") for i, v in enumerate(values)])
    found = topk.search(table, F.col("vec_id") % 100 == 0).toPandas()
    whole = np.floor(1024 * values.astype("f8")).astype(int)
    for q, rows in found.groupby("query_id"):
        rows = rows.sort_values("rank")
        assert list(zip(rows.vec_id, rows.score)) == brute(range(900), whole, q, 10)


def test_topk_large_components(spark):
    rows = [(0, [2.0**19, 1.0]), (1, [2.0**17, 0.0]), (2, [2.0**18, -2.0**16]), (3, None), (4, [float("inf"), 1.0])]
    found = topk.search(vectors(spark, [(i, v, "x") for i, v in rows]), F.col("vec_id") == 0).collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [(2, 2**57 - 2**36), (1, 2**56)]
    # Products beyond 64 bits on the way, scores within; then a score and a component beyond.
    far = [(0, [2.0**30, 1.0]), (1, [2.0**21, 2.0**40 - 2.0**51]), (2, [-(2.0**21), 2.0**51])]
    found = topk.search(vectors(spark, [(i, v, "x") for i, v in far]), F.col("vec_id") == 0).collect()
    exact = lambda v: (1 << 40) * int(1024 * v[0]) + 1024 * int(1024 * v[1])
    assert [(r["vec_id"], r["score"]) for r in found] == [(i, exact(v)) for i, v in far[1:]]
    for v in (2.0**43, 2.0**53):
        with pytest.raises(Exception, match="64 bits"):
            topk.search(vectors(spark, [(0, [2.0**20], "x"), (1, [v], "x")]), F.col("vec_id") == 0).collect()


def test_early_stop_keeps_every_possible_member():
    rng = np.random.default_rng(2)
    values = np.floor(1024 * rng.normal(size=(4000, 32)) * np.linspace(4, 0.1, 32)).astype(int)
    index = ImpactIndex(np.arange(4000), values)
    for q in range(20):
        ids, scores = index.best(q, values[q], 10)
        assert list(zip(ids, scores)) == brute(range(4000), values, q, 10)
        near = index.possible(values[q], 10, np.arange(4000))
        assert len(near) < 4000  # the work stopped, or left out most by its bounds


def test_topk_odd_vectors(odd_vectors):
    rows = topk.search(odd_vectors, F.col("vec_id") % 8 == 0, k=3).collect()
    of = {q: [(r["vec_id"], r["score"]) for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == q]
          for q in (0, 8)}
    unit = 1024 * 1024
    assert of[0] == [(1, 5 * unit), (7, 3 * unit), (2, 0)]
    # Two rows share the id 8, and both ask: neither is a candidate of the other.
    assert set(of[8]) == {(2, 0), (9, 0)}


def test_forest_odd_vectors(odd_vectors):
    rows = forest.search(odd_vectors, F.col("vec_id") == 0).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(rows, key=lambda r: r["rank"])] == [
        (1, 5.0), (7, 3.0), (8, -3.0), (8, -3.0)]


def test_empty_tables(odd_vectors):
    empty = odd_vectors.where("false")
    assert topk.search(empty, F.col("vec_id") == 0).count() == 0
    assert forest.search(empty, F.col("vec_id") == 0).count() == 0
    assert topk.search(odd_vectors, F.col("vec_id") == 77).count() == 0


def test_recall_on_uniform_directions(spark):
    rng = np.random.default_rng(3)
    values = rng.normal(size=(3000, 64))
    values = (values / np.linalg.norm(values, axis=1, keepdims=True)).astype("f4")
    table = vectors(spark, [(i, v.tolist(), "x") for i, v in enumerate(values)])
    found = forest.search(table, F.col("vec_id") % 60 == 0).toPandas()
    hits = 0
    for q, rows in found.groupby("query_id"):
        scores = values.astype("f8") @ values[q].astype("f8")
        scores[q] = -2
        hits += len(set(np.argsort(-scores)[:20]) & set(rows.vec_id))
        exact = scores[rows.sort_values("rank").vec_id]
        assert np.allclose(exact, rows.sort_values("rank").score, atol=1e-12)
    assert hits / (50 * 20) >= 0.9
