import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm import hard_negatives as hn
from tests.llm.conftest import same

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType())])


def brute(rows, anchor, n_positives=5, n_negatives=3, low=50, high=95):
    """The definition with Python's integers."""
    able = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        able.append((i, label, [math.floor(256 * x) for x in v]))
    able.sort(key=lambda r: (r[0], r[1], r[2]))
    out, seen = [], set()
    for i, label, v in able:
        if not anchor(i) or i in seen:
            continue
        seen.add(i)
        others = sorted(((-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in able if j != i))
        for s, j, _ in [x for x in others if x[2] == label][:n_positives]:
            hard = [x for x in others if x[2] != label and low * -s <= 100 * -x[0] <= high * -s]
            out += [(i, j, k + 1, x[1], -s, -x[0]) for k, x in enumerate(hard[:n_negatives])]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    return sorted(map(tuple, hn.mine(df, F.col("id") % 5 == 0, **more).collect()))


@pytest.mark.parametrize("size,dim", [(1.0, 8), (900.0, 3), (2.0 ** 18, 4)])
def test_exact_scores(size, dim):
    rng = np.random.default_rng(3)
    a, b = (np.floor(rng.normal(size=(n, dim)) * size).astype(np.int64) for n in (7, 9))
    bound = float(np.linalg.norm(a, axis=1).max() * np.linalg.norm(b, axis=1).max()) + 1
    primes = hn.primes_for(bound)
    got = hn.scores(hn.residues(a, primes), hn.residues(b, primes), primes)
    assert got.tolist() == [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]


def test_exact_over_many_components():
    a = np.full((1, 5000), -125 + 251, dtype=np.int64)  # the largest residues
    primes = hn.primes_for(float(5000 * 126 * 126))
    assert hn.scores(hn.residues(a, primes), hn.residues(-a, primes), primes).tolist() == [[-5000 * 126 * 126]]


def test_primes_fit():
    assert math.prod(hn.PRIMES) < 2 ** 63 and math.prod(hn.primes_for(hn.LARGEST_NORM2)) > 2 * hn.LARGEST_NORM2
    assert hn.CHUNK * 125 ** 2 < 2 ** 24
    with pytest.raises(ValueError):
        hn.primes_for(2.0 ** 63)


def test_best_keeps_ties_by_id():
    best, ids = hn.Best(2, 2), np.array([3, 5, 8, 9, 11, 12, 13, 14, 15, 16])
    s = np.full((2, 10), 7)
    best.add(np.array([0, 1]), s, ids, np.ones((2, 10), dtype=bool))
    best.add(np.array([0]), np.array([[7, 9]]), np.array([1, 20]), np.ones((1, 2), dtype=bool))
    assert best.id.tolist() == [[20, 1], [3, 5]]


def test_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(3, 6))
    rows = [(int(i), (centres[i % 3] * 0.8 + rng.normal(size=6) * 0.7).tolist(), int(rng.integers(0, 3))) for i in range(-20, 150)]
    want = brute(rows, lambda i: i % 5 == 0)
    assert len(want) > 100
    assert mined(spark, rows) == want
    assert mined(spark, rows, block_bytes=200) == want  # several blocks of anchors


def test_edges(spark):
    v = [0.5, 0.25, -0.125]
    rows = [(0, v, 1), (5, v, 2), (7, [0.4, 0.25, -0.125], 2), (8, [0.4, 0.25], 2), (9, [], 1), (10, [0.0, 0.0, 0.0], 1), (11, [0.3, 0.2, 0.0], 2),
            (12, None, 1), (13, v, None), (None, v, 1), (14, [None, 1.0, 1.0], 1), (15, [float("nan")] * 3, 1), (16, [float("inf"), 0.0, 0.0], 2),
            (20, [1e300, 0.0, 0.0], 1), (21, v, 1), (21, v, 1), (22, [0.35, 0.2, 0.0], 1), (23, [0.45, 0.3, -0.1], 2), (23, [0.45, 0.3, -0.1], 2)]
    assert mined(spark, rows) == brute([r for r in rows if r[0] != 20], lambda i: i % 5 == 0)


def test_many_copies(spark):
    """One vector that most rows hold: all scores tie."""
    rows = [(i, [0.5, 0.5], i % 2) for i in range(400)] + [(1000 + i, [0.4, 0.4], 2) for i in range(4)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 5 == 0)


def test_empty_and_clashing_names(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1)]) == []
    df = spark.createDataFrame([(0, [0.5], 1), (1, [0.5], 1), (2, [0.4], 2)], ROWS)
    for name in ("id", "q", "norm2", "anchor", "score", "rank", "slot", "v", "d"):
        df = df.withColumn(name, F.lit("x"))
    assert [tuple(r) for r in hn.mine(df, F.col("id") == 0).collect()] == [(0, 1, 1, 2, 128 * 128, 128 * 102)]


def test_query(query, oracle):
    same(query("op11_hard_negatives"), oracle("op11_hard_negatives"))
