import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk as M


def rows_of(seed=1, n=700, dim=8):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 0.2, (n, dim))
    x[100:300] = x[50]  # many equal vectors, a query among them
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(900, None), (901, [0.1, None] + [0.0] * 6), (902, [float("nan")] * 8), (903, [float("inf")] * 8), (950, []),
             (None, rows[3][1]), (50, rows[7][1]), (1000, [0.5, 0.5])]
    return rows


def result(spark, rows):
    df = spark.createDataFrame([(i, v, 1, 0.0) for i, v in rows], "vec_id long, embedding array<double>, rank int, score double")
    return sorted(map(tuple, M.top_k(df, F.col("vec_id") % 50 == 0).collect()), key=str)


@pytest.mark.parametrize("shard,block,page", [(16_384, 4096, 64), (90, 4, 7)])
def test_against_brute_force(spark, monkeypatch, shard, block, page):
    for name, v in (("SHARD", shard), ("BLOCK", block), ("PAGE", page)):
        monkeypatch.setattr(M, name, v)
    rows = rows_of()
    assert result(spark, rows) == sorted(brute.best_products(rows), key=str)


def test_fewer_rows_than_k_and_none(spark):
    rows = [(0, [1.0, 2.0]), (50, [0.5, 0.0]), (3, [0.0, 1.0])]
    assert result(spark, rows) == sorted(brute.best_products(rows), key=str)
    assert result(spark, []) == []


def test_search_skips_most_of_clustered_vectors():
    rng = np.random.default_rng(3)
    x = (rng.normal(0, 1, (40, 1, 16)) * 100 + rng.normal(0, 1, (40, 100, 16))).reshape(-1, 16).astype(np.int64)
    tree = M.MTree(x, np.arange(len(x))).seal()

    class Counted(np.ndarray):
        rows = 0

        def __matmul__(self, other):
            Counted.rows += len(self)
            return np.asarray(self) @ other

    tree.rows = tree.rows.view(Counted)
    for q in range(0, 4000, 400):
        got = tree.search(x[q], q, 5)
        s = x @ x[q]
        s[q] = -(1 << 60)
        want = np.lexsort((np.arange(len(x)), -s))[:5]
        assert got == [(int(s[i]), int(i)) for i in want]
    assert Counted.rows < 0.5 * 10 * len(x)
