import numpy as np
import pytest
from llm_fixtures import docs_of, sf_of  # noqa: F401
from pyspark.sql import functions as F

from pulsegrid.llm import hard_negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, anchor, positives=5, negatives=10):
    """rows (id, vector, label) -> result tuples by plain loops."""
    kept = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], label) for i, v, label in rows if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    order = lambda t: (-t[0], t[1] is None, t[1])
    out = set()
    for i, q, label in kept:
        if i is None or not anchor(i):
            continue
        near = {(sum(a * b for a, b in zip(q, v)), j) for j, v, other in kept if other == label and j != i}
        other = {(sum(a * b for a, b in zip(q, v)), j) for j, v, o in kept if o != label}
        for ps, p in sorted(near, key=order)[:positives]:
            band = [t for t in other if 30 * ps <= 100 * t[0] <= 90 * ps]
            out |= {(i, p, k + 1, n, ps, ns) for k, (ns, n) in enumerate(sorted(band, key=order)[:negatives])}
    return out


def rows_of(n, dims, seed, spread=1.0):
    r = np.random.default_rng(seed)
    v = r.normal(size=(n, dims)) * np.exp(spread * r.normal(size=(n, 1)))
    return [(i, (v[i] / 4).astype(np.float32).tolist(), int(r.integers(0, 4))) for i in range(n)]


def mined(spark, rows, every, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = [tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % every == 0, **more).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("dims,spread", [(2, 1.5), (6, 0.5), (24, 0.0)])
def test_equals_plain_loops(spark, monkeypatch, dims, spread):
    rows = rows_of(700, dims, dims, spread)
    assert mined(spark, rows, 20) == brute(rows, lambda i: i % 20 == 0)


def test_query_with_odd_rows_and_ties(spark, sf_of):
    rows = rows_of(400, 8, 5)
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(300)]  # one vector many times
    rows += [(2000, [0.0] * 8, 1), (2100, [0.0] * 8, 2), (None, rows[7][1], 3), (None, rows[7][1], 0), (7, rows[7][1], rows[7][2])]
    rows += [(3000, None, 1), (3100, [None] * 8, 1), (3200, rows[1][1], None), (3300, [float("nan")] * 8, 1), (-500, rows[11][1], 2)]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit(1)).withColumn("anchor", F.lit("a")).withColumn("x", F.lit(0)).withColumn("score", F.lit(0))
    got = {tuple(r) for r in queries.op11_hard_negatives(spark, sf_of(embeddings=table)).collect()}
    moved = [(i, v, (label + 1) % 10 if i is not None and label is not None and i % 7 == 0 else label) for i, v, label in rows]
    want = brute(moved, lambda i: i % 100 == 0)
    assert got == want and any(n is None for _, _, _, n, _, _ in want) is any(n is None for _, _, _, n, _, _ in got)


def test_blocks_of_anchors_and_small_buckets(spark, monkeypatch):
    rows = rows_of(300, 4, 9)
    monkeypatch.setattr(hard_negatives, "BLOCK", 7)
    assert mined(spark, rows, 10) == brute(rows, lambda i: i % 10 == 0)


def test_pruning_passes_buckets_and_rows_over():
    r = np.random.default_rng(1)
    x = r.normal(size=(2000, 3))
    x = np.round(1000 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int32)
    bucket = hard_negatives.Bucket(np.arange(2000), np.zeros(2000, np.int64), x)
    anchors = hard_negatives.Anchors(np.arange(20), np.zeros(20, np.int64), x[:20])
    scores = anchors.x.astype(np.int64) @ x.T.astype(np.int64)
    limits = np.sort(scores, axis=1)[:, -10]
    seen = np.zeros(scores.shape, bool)
    for which, rows in bucket.candidates(anchors, limits):
        seen[np.ix_(which, rows)] = True
    assert (seen >= (scores >= limits[:, None])).all()  # nothing that reaches the limit is pruned
    assert seen.mean() < 0.05
    assert list(bucket.candidates(anchors, np.full(20, 10 ** 9))) == []  # no row is long enough
    for limits in (np.full(20, hard_negatives.LEAST), np.full(20, -(10 ** 9))):
        assert sum(len(w) * len(rows) for w, rows in bucket.candidates(anchors, limits)) == seen.size


def test_empty_lonely_and_unequal_vectors(spark):
    assert mined(spark, [(0, None, 1)], 1) == set()
    assert mined(spark, [(0, [1.0, 2.0], 1)], 1) == set()
    rows = [(0, [1.0, 2.0, 1.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 1.0], 2), (3, [], 2), (4, [0.5, 0.5, 0.5, 9.0], 3)]
    padded = [(i, v + [0.0] * (4 - len(v)), label) for i, v, label in rows]
    assert mined(spark, rows, 1) == brute(padded, lambda i: True)
    assert hard_negatives.mine(spark.createDataFrame(rows, SCHEMA).where("false"), F.lit(True)).count() == 0


def test_large_integers(spark):
    rows = [(i, [30000.0 + i, 20000.0 - 7 * i], i % 2) for i in range(40)]
    assert mined(spark, rows, 5) == brute(rows, lambda i: i % 5 == 0)
