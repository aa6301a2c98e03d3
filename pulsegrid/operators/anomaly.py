"""ANO-02..05: isolation forest per series (100 trees, <= 256 rows each).

* Sampling (SEM-16 hashes, independent of partitioning), one scheme for every length: a
  row's hash for a tree is compared with a limit that leaves each tree somewhat more than
  ``psi = min(256, n)`` rows; a row is sent once, with the trees it passes, and each tree
  keeps its ``psi`` smallest hashes (sampling without replacement).
* Building: ``groupBy(series_id).applyInPandas`` over the sample of the series,
  which is bounded by about ``trees * 350`` rows whatever the series length; all trees
  grow together level by level with array operations (``grow_forest``).
* Scoring a stored forest: rows are cut into hash chunks of <= ``chunk_rows``; the node table
  of the series is joined to each chunk and ``cogroup(...).applyInPandas`` walks it tree
  by tree. No group ever holds a whole long series.
* ``iforest_scores`` fits and scores in one go. A series of at most ``max_samples`` rows is its
  own sample, so its forest is grown inside a group of short series and never stored.
* Flag: score above the ``1 - contamination`` quantile of the training scores
  (the same rule as the reference's detector).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.frame import KEY, ORDER
from pulsegrid.operators.quantiles import quantiles
from pulsegrid.operators.stats import attach
from pulsegrid.plans.blocked import join_null_safe
from pulsegrid.plans.lineage import materialize

# A forest is stored in pieces of at most ``PIECE`` nodes, ``first`` the number of a piece's first node: readers take
# thousands of rows at once. Children are created in pairs, so a node's right child is
# always ``left + 1`` and is not stored; feature (-1 at leaves) and tree are small ints.
PIECE = 128
FOREST_SCHEMA = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        T.StructField("n_trees", T.IntegerType()),
        T.StructField("psi", T.IntegerType()),
        T.StructField("first", T.IntegerType()),
        T.StructField("tree", T.ArrayType(T.ShortType())),
        T.StructField("feature", T.ArrayType(T.ByteType())),
        T.StructField("split", T.ArrayType(T.DoubleType())),
        T.StructField("left", T.ArrayType(T.IntegerType())),
        T.StructField("size", T.ArrayType(T.IntegerType())),
    ]
)

NODE_SCHEMA = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        T.StructField("tree", T.IntegerType()),
        T.StructField("node", T.IntegerType()),
        T.StructField("feature", T.IntegerType()),
        T.StructField("split", T.DoubleType()),
        T.StructField("left", T.IntegerType()),
        T.StructField("right", T.IntegerType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("psi", T.IntegerType()),
    ]
)


SCORE_SCHEMA = T.StructType(
    [T.StructField(KEY, T.StringType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("seq", T.LongType()), T.StructField("score", T.DoubleType())]
)


def _c(n):
    """Average path length of an unsuccessful BST search (vectorised)."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + 0.5772156649015329) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def sample_rows(features: DataFrame, n_trees: int = 100, max_samples: int = 256, seed: int = 42) -> DataFrame:
    """(series_id, ts, seq, features..., picks): each sampled row once, with the trees that may keep it and its hash for each.

    The limit is exceeded by a tree's ``psi`` smallest hashes with a chance below 1e-6 (expected
    rows psi + 6 sqrt(psi)); such a tree would be a few rows short, which is still a valid sample.
    """
    n = features.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n"))
    x = attach(features, n)
    limit = F.least(F.lit(1.0), F.lit(max_samples + 6.0 * math.sqrt(max_samples)) / F.col("_n"))
    row = F.xxhash64(F.lit(int(seed)), F.lit("iforest-sample"), KEY, "ts", "seq")
    draws = F.transform(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: F.struct(t.alias("tree"), (F.shiftrightunsigned(F.xxhash64(row, t), 11).cast("double") / F.lit(float(2**53))).alias("u")))
    return x.withColumn("picks", F.filter(draws, lambda d: d["u"] < limit)).filter(F.size("picks") > 0).drop("_n")


def _samples(pdf: pd.DataFrame, n_trees: int, max_samples: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, tree) of every tree's sample: its ``max_samples`` smallest hashes."""
    row = np.repeat(np.arange(len(pdf)), [len(p) for p in pdf["picks"]])
    tree = np.fromiter((d["tree"] for p in pdf["picks"] for d in p), np.int64, len(row))
    u = np.fromiter((d["u"] for p in pdf["picks"] for d in p), float, len(row))
    order = np.lexsort((u, tree))
    tree, row = tree[order], row[order]
    place = np.arange(len(tree)) - np.searchsorted(tree, tree, side="left")
    keep = place < max_samples
    return row[keep], tree[keep]


def grow_forest(X: np.ndarray, tree_of_row: np.ndarray, n_trees: int, limit: int, rng: np.random.Generator):
    """All trees of one forest grown level by level with array operations.

    Each node picks a feature uniformly among the features that are not constant
    in the node and a split uniformly between their min and max; growth stops at
    depth ``limit``, at one row, or when every feature is constant. Node ids are
    global and dense; node ``t`` is the root of tree ``t``.
    Returns (tree, feature, split, left, right, size) arrays.
    """
    node_of = tree_of_row.astype(np.int64).copy()
    tree = list(range(n_trees))
    feature = [-1] * n_trees
    split = [np.nan] * n_trees
    left = [-1] * n_trees
    right = [-1] * n_trees
    size = list(np.bincount(node_of, minlength=n_trees))  # rows of a node when it was made
    tree, feature, split, left, right, size = (np.asarray(v) for v in (tree, feature, split, left, right, size))
    split = split.astype(float)
    frontier = np.arange(n_trees)
    n_nodes = n_trees
    for _ in range(limit):
        cand = frontier[size[frontier] > 1]
        if cand.size == 0:
            break
        is_cand = np.zeros(n_nodes, dtype=bool)
        is_cand[cand] = True
        rows = np.flatnonzero(is_cand[node_of])
        order = rows[np.argsort(node_of[rows], kind="stable")]
        nodes_sorted = node_of[order]
        uniq, starts = np.unique(nodes_sorted, return_index=True)
        Xs = X[order]
        mins = np.minimum.reduceat(Xs, starts, axis=0)
        maxs = np.maximum.reduceat(Xs, starts, axis=0)
        usable = maxs > mins
        n_use = usable.sum(axis=1)
        can = n_use > 0
        u1 = rng.random(len(uniq))
        u2 = rng.random(len(uniq))
        k = np.minimum((u1 * n_use).astype(np.int64), np.maximum(n_use - 1, 0))
        cum = np.cumsum(usable, axis=1)
        f_choice = np.argmax((cum == (k + 1)[:, None]) & usable, axis=1)
        ar = np.arange(len(uniq))
        lo, hi = mins[ar, f_choice], maxs[ar, f_choice]
        sp = lo + u2 * (hi - lo)
        split_nodes = uniq[can]
        m = len(split_nodes)
        if m == 0:
            break
        new_left = n_nodes + 2 * np.arange(m)
        left_u = np.full(len(uniq), -1, dtype=np.int64)
        left_u[can] = new_left
        feature[split_nodes] = f_choice[can]
        split[split_nodes] = sp[can]
        left[split_nodes] = new_left
        right[split_nodes] = new_left + 1
        pos = np.searchsorted(uniq, nodes_sorted)
        sel = can[pos]
        p = pos[sel]
        go_left = Xs[sel, f_choice[p]] < sp[p]
        node_of[order[sel]] = np.where(go_left, left_u[p], left_u[p] + 1)
        child_tree = np.repeat(tree[split_nodes], 2)
        tree = np.concatenate([tree, child_tree])
        feature = np.concatenate([feature, np.full(2 * m, -1)])
        split = np.concatenate([split, np.full(2 * m, np.nan)])
        left = np.concatenate([left, np.full(2 * m, -1)])
        right = np.concatenate([right, np.full(2 * m, -1)])
        n_nodes += 2 * m
        size = np.concatenate([size, np.bincount(node_of, minlength=n_nodes)[n_nodes - 2 * m :]])
        frontier = np.arange(n_nodes - 2 * m, n_nodes)
    return tree, feature, split, left, right, size


def grow_many(X: np.ndarray, sizes: np.ndarray, n_trees: int, limits: np.ndarray, rngs: list[np.random.Generator]):
    """The forests of several series at once, each grown on all of its rows as ``grow_forest`` grows it alone.

    ``X``: the rows of all series, one series of ``sizes`` rows after another. Returns the nodes level by level, a
    level's by series, and the path length of every row in every tree:
    (series, tree, feature, split, left, size), (trees, rows)."""
    columns = np.ascontiguousarray(X.T)
    # a feature whose values all differ in a series is constant in none of its nodes with two rows
    owner = np.repeat(np.arange(len(sizes)), sizes)
    differs = np.ones((len(columns), len(sizes)), bool)
    for f, column in enumerate(columns):
        by = np.lexsort((column, owner))
        differs[f, owner[by[1:]][(owner[by[1:]] == owner[by[:-1]]) & ~(column[by[1:]] > column[by[:-1]])]] = False
    paths = np.zeros((n_trees, len(X)))
    at, tree = np.repeat(np.arange(len(sizes)), n_trees), np.tile(np.arange(n_trees), len(sizes))
    size = sizes[at]
    rows = np.repeat((np.cumsum(sizes) - sizes)[at] - np.cumsum(size) + size, size) + np.arange(size.sum())
    levels, made, depth = [], 0, 0
    while len(at):
        feature, split, left = np.full(len(at), -1), np.full(len(at), np.nan), np.full(len(at), -1)
        made += len(at)
        alive = np.flatnonzero((size > 1) & (depth < limits[at]))
        inside = np.zeros(len(at), bool)
        inside[alive] = True
        inside = np.repeat(inside, size)
        kids = np.empty(0, np.int64)
        if len(alive):
            own, n = rows[inside], size[alive]
            starts, node = np.cumsum(n) - n, np.repeat(np.arange(len(alive)), n)
            usable = differs[:, at[alive]]
            for f in np.flatnonzero(~usable.all(axis=1)):
                unsure = np.flatnonzero(~usable[f])
                x = columns[f, own[~usable[f][node]]]
                begin = np.cumsum(n[unsure]) - n[unsure]
                usable[f, unsure] = np.maximum.reduceat(x, begin) > np.minimum.reduceat(x, begin)
            n_use = usable.sum(axis=0)
            can = n_use > 0
            u1, u2, done = np.empty(len(alive)), np.empty(len(alive)), 0
            drawn = np.bincount(at[alive], minlength=len(sizes))
            for s in np.flatnonzero(drawn):
                c = drawn[s]
                u = rngs[s].random(2 * c)
                u1[done : done + c], u2[done : done + c] = u[:c], u[c:]
                done += c
            k = np.minimum((u1 * n_use).astype(np.int64), np.maximum(n_use - 1, 0))
            chosen = np.argmax((np.cumsum(usable, axis=0) == k + 1) & usable, axis=0)
            x = columns[chosen[node], own]
            lo, hi = np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts)
            cut = lo + u2 * (hi - lo)
            kids = alive[can]
            feature[kids], split[kids], left[kids] = chosen[can], cut[can], made + 2 * np.arange(len(kids))
        whole = np.repeat(feature < 0, size)  # rows that end in this level's leaves
        paths[np.repeat(tree, size)[whole], rows[whole]] = np.repeat(depth + _c(size), size)[whole]
        levels.append((at, tree, feature, split, left, size))
        if not len(kids):
            break
        goes = can[node]
        of = np.repeat(np.arange(len(kids)), size[kids])
        child = 2 * of + ~(x[goes] < cut[can][of])
        rows = own[goes][np.argsort(child, kind="stable")]
        at, tree, size = np.repeat(at[kids], 2), np.repeat(tree[kids], 2), np.bincount(child, minlength=2 * len(kids))
        depth += 1
    return tuple(np.concatenate(x) for x in zip(*levels)), paths


#: Rows of short series that one group holds (about), and that are worked on together.
BATCH_ROWS, TOGETHER = 8_000, 600


def _batches(short: DataFrame):
    """Whole series dealt into groups of about ``BATCH_ROWS`` rows: what a group costs is paid by many series."""
    groups = max(1, -(-short.count() // BATCH_ROWS))
    return short.groupBy(F.pmod(F.xxhash64(F.lit("forest-batch"), KEY), F.lit(groups)).alias("_batch"))


def _grown(pdf: pd.DataFrame, cols: list[str], n_trees: int, seed: int):
    """Some series of a batch at a time: (rows, series, number of rows, nodes, path lengths), see ``grow_many``."""
    code, names = pd.factorize(np.asarray(pdf[KEY], object), use_na_sentinel=False)
    rows = np.argsort(code, kind="stable")
    X, sizes = pdf[cols].to_numpy(dtype=float)[rows], np.bincount(code, minlength=len(names))
    names = [None if pd.isna(x) else x for x in names]
    ends = np.cumsum(sizes)
    part = (ends - 1) // TOGETHER
    for some in np.split(np.arange(len(names)), np.flatnonzero(np.diff(part)) + 1):
        lo, hi = ends[some[0]] - sizes[some[0]], ends[some[-1]]
        n, keys = sizes[some], names[some[0] : some[-1] + 1]
        limits = np.asarray([_depth_limit(psi) for psi in n])
        yield rows[lo:hi], keys, n, *grow_many(X[lo:hi], n, n_trees, limits, [_rng(seed, k) for k in keys])


def _pieces(sid, n_trees: int, psi: int, tree, feature, split, left, size) -> list[tuple]:
    """The rows of ``FOREST_SCHEMA`` that store a forest."""
    typed = [x.astype(t) for x, t in ((tree, np.int16), (feature, np.int8), (split, float), (left, np.int32), (size, np.int32))]
    return [(sid, n_trees, psi, at, *[x[at : at + PIECE] for x in typed]) for at in range(0, len(tree), PIECE)]


def _depth_limit(psi: int) -> int:
    return max(1, int(math.ceil(math.log2(max(psi, 2)))))


def _rng(seed: int, sid) -> np.random.Generator:
    return np.random.default_rng([seed, zlib.crc32(str(sid).encode())])


def _check(cols: list[str], n_trees: int) -> None:
    if len(cols) > 127 or n_trees > 32767:
        raise ValueError("at most 127 feature columns and 32767 trees")


def iforest_fit(features: DataFrame, cols: Sequence[str], n_trees: int = 100, max_samples: int = 256, seed: int = 42) -> DataFrame:
    """ANO-02: the forest of every series (rows of node arrays, see ``FOREST_SCHEMA``). A series of at most
    ``max_samples`` rows is its own sample."""
    cols = list(cols)
    _check(cols, n_trees)
    names = FOREST_SCHEMA.fieldNames()
    # read by the counts, the short and the long series: written once
    features = materialize(features.select(KEY, *ORDER, *cols), "iforest_features")
    n = features.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n"))
    x = join_null_safe(features, n, [KEY])
    long = x.filter(F.col("_n") > max_samples).drop("_n")

    def build_short(pdf: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, keys, n, (at, *nodes), _ in _grown(pdf, cols, n_trees, seed):
            by = np.argsort(at, kind="stable")  # a series' nodes in their own numbers
            many = np.bincount(at, minlength=len(keys))
            begins = np.cumsum(many) - many
            number = np.empty(len(at), np.int64)
            number[by] = np.arange(len(at)) - np.repeat(begins, many)
            nodes[3] = np.where(nodes[3] < 0, -1, number[nodes[3]])
            nodes = [x[by] for x in nodes]
            for i, k in enumerate(keys):
                found += _pieces(k, n_trees, int(n[i]), *[x[begins[i] : begins[i] + many[i]] for x in nodes])
        return pd.DataFrame(found, columns=names)

    short = _batches(x.filter(F.col("_n") <= max_samples).drop("_n")).applyInPandas(build_short, FOREST_SCHEMA)
    if long.isEmpty():
        return materialize(short, "iforest_forest")
    sampled = sample_rows(long, n_trees, max_samples, seed)

    def build_all(pdf: pd.DataFrame) -> pd.DataFrame:
        sid = pdf[KEY].iloc[0]
        X = pdf[cols].to_numpy(dtype=float)
        row, t = _samples(pdf, n_trees, max_samples)
        psi = int(np.bincount(t, minlength=n_trees).max())
        tree, feature, split, left, right, size = grow_forest(X[row], t, n_trees, _depth_limit(psi), _rng(seed, sid))
        return pd.DataFrame(_pieces(sid, n_trees, psi, tree, feature, split, left, size), columns=names)

    # the forest is the model (bounded by trees * (2 * 256 - 1) nodes a series): written once to the shared checkpoint folder
    return materialize(short.unionByName(sampled.groupBy(KEY).applyInPandas(build_all, FOREST_SCHEMA)), "iforest_forest")


#: Pairs of rows and trees that are walked at once.
PAIRS = 1 << 15


def walk(X: np.ndarray, feature, split, left, size, n_trees: int, psi: int) -> np.ndarray:
    """Scores ``2 ** (-E[h(x)] / c(psi))``: all rows through some trees at a time, one for many rows (node t is the root of tree t)."""
    total = np.zeros(len(X))
    length = _c(size)
    some = max(1, PAIRS // max(len(X), 1))
    for first in range(0, n_trees, some):
        trees = np.arange(first, min(first + some, n_trees))
        at, row = np.repeat(trees, len(X)), np.tile(np.arange(len(X)), len(trees))
        depth = np.zeros(len(at))
        inside = np.flatnonzero(feature[at] >= 0)
        while len(inside):
            p = at[inside]
            at[inside] = left[p] + ~(X[row[inside], feature[p]] < split[p])
            depth[inside] += 1
            inside = inside[feature[at[inside]] >= 0]
        total += (depth + length[at]).reshape(len(trees), len(X)).sum(axis=0)
    return np.power(2.0, -(total / n_trees) / max(_c([psi])[0], 1e-12))


def iforest_scores(features: DataFrame, cols: Sequence[str], n_trees: int = 100, max_samples: int = 256, seed: int = 42) -> DataFrame:
    """ANO-02/03 in one go: the scores of every row under its series' forest, which equal those of
    ``iforest_score`` with ``iforest_fit``. Forests of long series only are stored on the way."""
    cols = list(cols)
    _check(cols, n_trees)
    # read by the counts, the short and the long series: written once
    features = materialize(features.select(KEY, *ORDER, *cols), "iforest_features")
    n = features.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n"))
    x = attach(features, n)
    long = x.filter(F.col("_n") > max_samples).drop("_n")

    def fit_and_score(pdf: pd.DataFrame) -> pd.DataFrame:
        score = np.empty(len(pdf))
        for rows, _, n, _, paths in _grown(pdf, cols, n_trees, seed):
            psi = np.repeat(np.maximum(_c(n), 1e-12), n)
            score[rows] = np.power(2.0, -(paths.sum(axis=0) / n_trees) / psi)
        return pdf[[KEY, *ORDER]].assign(score=score)

    short = _batches(x.filter(F.col("_n") <= max_samples).drop("_n")).applyInPandas(fit_and_score, SCORE_SCHEMA)
    if long.isEmpty():
        return short
    return short.unionByName(iforest_score(long, iforest_fit(long, cols, n_trees, max_samples, seed), cols, seed=seed))


def forest_nodes(forest: DataFrame) -> DataFrame:
    """The forest as a long node table ``(series_id, tree, node, feature, split, left, right, size)``."""
    z = F.arrays_zip("tree", "feature", "split", "left", "size")
    x = forest.select(KEY, "psi", F.posexplode(z).alias("_at", "n"), "first")
    return x.select(
        KEY,
        F.col("n.tree").cast("int").alias("tree"),
        (F.col("first") + F.col("_at")).cast("int").alias("node"),
        F.col("n.feature").cast("int").alias("feature"),
        F.col("n.split").alias("split"),
        F.col("n.left").alias("left"),
        F.when(F.col("n.left") >= 0, F.col("n.left") + 1).otherwise(F.lit(-1)).alias("right"),
        F.col("n.size").alias("size"),
        "psi",
    )


def iforest_score(features: DataFrame, forest: DataFrame, cols: Sequence[str], chunk_rows: int = 200_000, seed: int = 42) -> DataFrame:
    """ANO-03 scoring: ``2 ** (-E[h(x)] / c(psi))`` over all trees of the series."""
    cols = list(cols)
    n = features.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n"))
    nchunks = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(chunk_rows)))
    x = attach(features.select(KEY, *ORDER, *cols), n.select(KEY, nchunks.alias("_k")))
    x = x.withColumn("_chunk", F.pmod(F.xxhash64(F.lit(seed), "ts", "seq"), F.col("_k")).cast("int")).drop("_k")
    chunks = x.select(F.col(KEY).alias("_sid"), (F.col("_chunk") + 0).alias("_c2")).distinct()
    nodes_c = forest.join(chunks, forest[KEY] == chunks["_sid"]).drop("_sid").withColumnRenamed("_c2", "_chunk")

    def score(rows: pd.DataFrame, tree_nodes: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame(columns=SCORE_SCHEMA.fieldNames())
        X = rows[cols].to_numpy(dtype=float)
        if tree_nodes.empty:
            s = np.full(len(X), np.nan)
        else:
            pieces = tree_nodes.sort_values("first")
            f0 = pieces.iloc[0]
            arrays = tuple(np.concatenate([np.asarray(x, t) for x in pieces[c]]) for c, t in (("feature", np.int64), ("split", float), ("left", np.int64), ("size", np.int64)))
            s = walk(X, *arrays, int(f0["n_trees"]), int(f0["psi"]))
        return pd.DataFrame({KEY: rows[KEY].to_numpy(), "ts": rows["ts"].to_numpy(), "seq": rows["seq"].to_numpy(), "score": s})

    return x.groupBy(KEY, "_chunk").cogroup(nodes_c.groupBy(KEY, "_chunk")).applyInPandas(score, SCORE_SCHEMA)


def threshold(scores: DataFrame, contamination: float = 0.1, approx: bool = False, plan: str = "auto") -> DataFrame:
    """ANO-04: per-series cut = the ``1 - contamination`` quantile of the scores
    (exact and distributed by default, see ``quantiles``)."""
    if not 0 < contamination < 0.5:
        raise ValueError("contamination must be in (0, 0.5)")
    q = 1.0 - contamination
    n = scores.groupBy(KEY).agg(F.count("score").alias("n_scored"))
    if approx:
        cut = scores.groupBy(KEY).agg(F.percentile_approx("score", q, 10000).alias("threshold"))
    else:
        cut = quantiles(scores, [q], "score", plan).select(KEY, F.col("q")[0].alias("threshold"))
    return n.join(cut, KEY, "left")


def flag(scores: DataFrame, cut: DataFrame) -> DataFrame:
    """ANO-03 flags: score above the series' cut."""
    return attach(scores, cut.select(KEY, "threshold")).withColumn("anomaly", F.col("score") > F.col("threshold")).drop("threshold")


def model_info(cut: DataFrame, contamination: float, n_trees: int = 100, max_samples: int = 256) -> DataFrame:
    """ANO-05: one model row per series, from the cuts of its scores (``threshold``)."""
    return cut.select(
        KEY,
        F.lit("isolation_forest").alias("model"),
        F.create_map(
            F.lit("contamination"), F.lit(float(contamination)),
            F.lit("threshold"), F.col("threshold"),
            F.lit("n_trees"), F.lit(float(n_trees)),
            F.lit("max_samples"), F.least(F.col("n_scored"), F.lit(max_samples)).cast("double"),
        ).alias("params"),
        F.col("n_scored").alias("n"),
        F.lit("ok").alias("status"),
    )
