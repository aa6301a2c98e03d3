import hashlib

import numpy as np
import pytest
from llm_fixtures import docs_of, sf_of  # noqa: F401
from pyspark.sql import functions as F

from pulsegrid.llm import queries, vector_codes
from pulsegrid.llm.vector_codes import Codebooks, assign_again, assign_first

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """rows (id, vector, label) -> ({id: (code, error)}, label errors, digest) by plain loops over integers."""
    kept = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    w = len(kept[0][1]) // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for _, v, _ in kept]
    book = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e)), j) for j, e in enumerate(book[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for j in range(len(book[p])):
                mine = [c[p] for c, g in zip(cut, got) if g[p][1] == j]
                if mine:
                    book[p][j] = [sum(x) // len(mine) for x in zip(*mine)]
    got = assign()
    by_label = {}
    for (_, _, label), g in zip(kept, got):
        by_label[label] = by_label.get(label, 0) + sum(d for d, _ in g)
    digest = hashlib.sha256(",".join(str(x) for p in book for e in p for x in e).encode()).hexdigest()
    return sorted((i, "".join(f"{j:02x}" for _, j in g), sum(d for d, _ in g), by_label[label], digest) for (i, _, label), g in zip(kept, got)), digest


def rows_of(n, dims=32, seed=0, clusters=9):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, dims))
    v = centres[r.integers(0, clusters, n)] + 0.3 * r.normal(size=(n, dims))
    return [(1000 - i, v[i].astype(np.float32).tolist(), int(i % 3) if i % 11 else None) for i in range(n)]


def test_equals_plain_loops_with_odd_rows(spark, sf_of):
    rows = rows_of(150)
    # equal vectors, tied entries, incomplete rows
    rows += [(2000 + i, rows[i % 2][1], 1) for i in range(40)] + [(3000, [0.0] * 32, 0), (1, rows[9][1], 5)]
    odd = [(4000, None, 1), (4001, [None] + [0.5] * 31, 1), (4002, [float("nan")] * 32, None), (4003, [float("inf")] + [0.0] * 31, 2)]
    table = spark.createDataFrame(rows + odd, SCHEMA).withColumn("code", F.lit("x")).withColumn("error", F.lit(1)).withColumn("x", F.lit(2))
    got = queries.op13_vector_codes(spark, sf_of(embeddings=table.repartition(5))).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    want, _ = brute(rows + odd)
    assert sorted(tuple(r) for r in got) == want


def test_bounds_leave_the_assignment_exact_and_save_scans():
    r = np.random.default_rng(3)
    centres = np.repeat(np.round(np.cumsum(np.full(16, 900.0)))[:, None], 4, axis=1)
    x = (centres[r.integers(0, 16, 4000)] + r.normal(scale=40, size=(4000, 4))).astype(np.int64).reshape(-1, 1, 4)
    books = Codebooks([x[:64, 0][None].copy()], list(np.array_split(np.arange(64), 8)))
    code, bounds, stamps, _ = assign_first(x, books)
    total = 0
    for _ in range(4):
        new = books.history[-1].copy()
        for e in np.unique(code[:, 0]):
            new[0, e] = x[code[:, 0] == e, 0].sum(axis=0) // (code[:, 0] == e).sum()
        books.history.append(new)
        code, bounds, stamps, error, scans = assign_again(x, books, code, bounds, stamps, books.fallen())
        d = ((x[:, 0, None, :] - new[0][None]) ** 2).sum(axis=2)
        assert (code[:, 0] == d.argmin(axis=1)).all() and (error[:, 0] == d.min(axis=1)).all()
        # every stored bound holds in its own round
        for k, g in enumerate(books.groups):
            for s in np.unique(stamps[:, 0, k]):
                at = stamps[:, 0, k] == s
                then = ((x[at, 0, None, :] - books.history[s][0][g][None]) ** 2).sum(axis=2).astype(float)
                then[g[None, :] == code[at, 0, None]] = np.inf
                assert (bounds[at, 0, k] <= np.sqrt(then.min(axis=1)) + 1e-9).all()
        total += scans.sum()
    assert total < 0.6 * 4 * 4000 * 8  # most groups are never measured again
    assert len(np.unique(stamps)) > 1  # bounds of several rounds are in use


def test_net_displacement_is_below_the_moves_added_up():
    zigzag = [np.array([[[0, 0]]]), np.array([[[10, 0]]]), np.array([[[1, 0]]])]
    fallen = Codebooks([z.astype(np.int64) for z in zigzag], [np.array([0])]).fallen()
    assert fallen[0, 0, 0] == pytest.approx(1) and fallen[1, 0, 0] == pytest.approx(9)


def test_small_unequal_and_empty_tables(spark, sf_of):
    few = [(3, [1.0, 2.0, 3.0], None), (None, [1.0, 2.0], 1), (5, [1.0, 2.0, 0.0], 1), (5, [1.0, 2.0, 0.0], 1)]
    df, books = vector_codes.compress(spark.createDataFrame(few, SCHEMA), parts=2, entries=64)
    got = df.collect()
    assert sorted((r.vec_id or 0, bytes(r.code).hex(), r.error) for r in got) == [(0, "0001", 0), (3, "0000", 0), (5, "0001", 0), (5, "0001", 0)]
    assert books.history[-1].shape == (2, 4, 2)
    empty, none = vector_codes.compress(spark.createDataFrame(few, SCHEMA).where("false"))
    assert empty.count() == 0 and none is None
    assert queries.op13_vector_codes(spark, sf_of(embeddings=spark.createDataFrame([(1, None, 2)], SCHEMA))).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2 ** 17 + 4096 * i), -float(2 ** 16) * (i % 3)], 0) for i in range(20)]
    df, _ = vector_codes.compress(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), parts=1, entries=3)
    want, _ = brute(rows, 1, 3)
    assert sorted((r.vec_id, bytes(r.code).hex(), r.error) for r in df.collect()) == [w[:3] for w in want]
