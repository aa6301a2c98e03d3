import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, frame
from pulsegrid.operators import rolling, shared_forest
from pulsegrid.operators.rolling import FEATURES
from pulsegrid.sources import panels


def plain_score(x, m):
    """Path lengths of one row, tree by tree and node by node."""
    def c(n):
        return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n

    total = 0.0
    for t in range(m["n_trees"]):
        node, depth = t, 0
        while m["feature"][node] >= 0:
            node = m["left"][node] + (0 if x[m["feature"][node]] < m["split"][node] else 1)
            depth += 1
        total += depth + c(m["size"][node])
    return 2 ** (-total / m["n_trees"] / c(m["psi"]))


@pytest.fixture(scope="module")
def feats(spark):
    return rolling.anomaly_features(panels.user_series(spark, SF_SMALL))


@pytest.fixture(scope="module")
def forest(feats):
    return shared_forest.fit(feats, FEATURES, n_trees=30, max_samples=64)


def test_scores_equal_a_plain_walk(feats, forest):
    m = forest.first()
    got = shared_forest.score(feats, forest).collect()
    assert len(got) == feats.count() and m["n"] == len(got) and m["psi"] == 64
    for r in got[::7]:
        assert r["score"] == pytest.approx(plain_score([r[c] for c in FEATURES], m), rel=1e-12)


def test_every_tree_holds_a_full_sample_and_reruns_agree(feats, forest):
    m = forest.first()
    assert sorted(np.asarray(m["size"])[:30]) == [64] * 30 and list(m["tree"][:30]) == list(range(30))
    again = shared_forest.fit(feats.repartition(13), FEATURES, n_trees=30, max_samples=64).first()
    assert again == m


def test_scoring_moves_no_rows(feats, forest):
    scored = shared_forest.score(feats.sparkSession.read.schema(feats.schema).parquet(_written(feats)), forest)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ArrowEvalPython" in plan


def _written(df):
    from pulsegrid.session import shared_dir

    path = shared_dir(df.sparkSession, "test-forest", unique=True)
    df.write.parquet(path)
    return path


def test_a_new_series_and_missing_features(spark, feats, forest):
    row = feats.first().asDict()
    normal = {**row, "series_id": "new"}
    far = {**row, "series_id": "new", "seq": 2, **{c: 1e6 for c in FEATURES}}
    gap = {**row, "series_id": "new", "seq": 3, FEATURES[0]: None}
    got = {r["seq"]: r["score"] for r in shared_forest.score(spark.createDataFrame([normal | {"seq": 1}, far, gap], feats.schema), forest).collect()}
    assert got[3] is None and got[2] > got[1]


def test_flags_take_the_global_quantile(feats, forest):
    scores = shared_forest.score(feats, forest).cache()
    cut = shared_forest.threshold(scores, 0.1)
    values = np.array([r[0] for r in scores.select("score").collect()])
    assert cut == pytest.approx(np.quantile(values, 0.9), rel=1e-12)
    flagged = shared_forest.flag(scores, cut)
    assert flagged.where("anomaly").count() == (values > cut).sum()
    scores.unpersist()


def test_few_rows_repeated_rows_and_empty_tables(spark, feats):
    few = feats.limit(5)
    few = few.unionByName(few)
    m = shared_forest.fit(few, FEATURES, n_trees=10).first()
    assert m["psi"] == 5 and m["n"] == 10
    none = shared_forest.fit(feats.where("false"), FEATURES)
    assert none.count() == 0
    unscored = shared_forest.score(few, none)
    assert unscored.where("score is not null").count() == 0
    assert shared_forest.threshold(unscored) is None and shared_forest.flag(unscored, None).where("anomaly is null").count() == 10
