"""Hard-negative mining: exact inner-product search with LEMP-style coordinate pruning.

Rows are sorted by length inside their partitions and read in length buckets (at most ``BUCKET`` rows, the
shortest at least ``SHRINK`` of the longest). Each bucket holds its normalised coordinates as sorted lists. For a score
limit, a bucket's longest row gives the least cosine an anchor needs there: buckets that cannot reach
it are passed over; else each of the anchor's ``FOCUS`` largest coordinates has a feasible range of values, found in the sorted
list, and the ranges' rows are intersected into candidates before any score is computed. Scores of candidates are exact
integers; they raise the limit for the next bucket.

An anchor's limit is its k-th best score so far in the task (positives), or the least score its positives allow
and then the k-th best inside the allowed band (negatives). Anchors come in blocks of about ``BLOCK``, a bounded
broadcast, whatever the table's size; a block reads the table once for positives and once for negatives, no row is shuffled but
each task's best rows, and Spark keeps the best of those.

Defined results: see ``vectors`` for vectors that take no part or differ in length; rows with a null label take no
part. "Other" rows have another id; of rows with one id and one score to an anchor one counts; a null id is no anchor, and comes
last among ties. Equal anchors (id, label, vector) count once. Anchors without positives, and pairs without rows in the band,
return nothing; a negative positive score allows no band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import map_batches, materialize
from pulsegrid.llm.vectors import blobs, complete, dimension, matrix, quantised

#: Anchors broadcast at once, about.
BLOCK = 16_384
#: Rows of a length bucket, and the shortest length in it as a share of the longest.
BUCKET = 2_048
SHRINK = 0.9
FOCUS = 4
#: Anchors whose scores against a bucket are held at once.
TOGETHER = 512
EXACT = 1 << 53
SLACK = 1e-9
NO_ID = np.iinfo(np.int64).max
LEAST = np.iinfo(np.int64).min


class Bucket:
    """Rows of about one length with their coordinates as sorted lists."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        lengths = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        self.longest, self.shortest = lengths.max(), lengths.min()
        self.unit = x / np.where(lengths > 0, lengths, 1)[:, None]
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows in the order of coordinate ``f``, and its values."""
        if f not in self._lists:
            order = np.argsort(self.unit[:, f])
            self._lists[f] = order, self.unit[order, f]
        return self._lists[f]

    def candidates(self, anchors: Anchors, limits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(anchors, rows) whose scores may reach ``limits``: first the anchors whose ranges hold every row, then one by one."""
        n = len(self.ids)
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where(limits > 0, limits / (anchors.lengths * self.longest), limits / (anchors.lengths * self.shortest))
        open_ = limits == LEAST
        cosine = np.where(open_ | np.isnan(cosine), -np.inf, cosine)
        alive = np.flatnonzero(cosine <= 1 + SLACK)
        spread = np.arccos(np.clip(cosine[alive], -1, 1)) + 1e-7
        spread[cosine[alive] <= -1] = np.pi
        angle = np.arccos(np.clip(np.take_along_axis(anchors.unit[alive], anchors.focus[alive], axis=1), -1, 1))
        low = np.cos(np.minimum(np.pi, angle + spread[:, None])) - SLACK
        high = np.cos(np.maximum(0, angle - spread[:, None])) + SLACK
        begin, end = np.zeros(low.shape, np.int64), np.full(low.shape, n)
        for f in np.unique(anchors.focus[alive]):
            at = anchors.focus[alive] == f
            begin[at] = np.searchsorted(self.sorted_list(f)[1], low[at], "left")
            end[at] = np.searchsorted(self.sorted_list(f)[1], high[at], "right")
        sizes = end - begin
        whole = (sizes == n).all(axis=1)
        if whole.any():
            yield alive[whole], np.arange(n)
        for i in np.flatnonzero(~whole & (sizes > 0).all(axis=1)):
            focus = anchors.focus[alive[i]]
            first = sizes[i].argmin()
            rows = self.sorted_list(focus[first])[0][begin[i, first] : end[i, first]]
            for j, f in enumerate(focus):
                if j != first and sizes[i, j] < n:
                    values = self.unit[rows, f]
                    rows = rows[(values >= low[i, j]) & (values <= high[i, j])]
            if len(rows):
                yield alive[i : i + 1], rows


class Anchors:
    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.lengths = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        self.unit = x / np.where(self.lengths > 0, self.lengths, 1)[:, None]
        self.focus = np.argsort(-np.abs(self.unit), axis=1, kind="stable")[:, :FOCUS]

    def part(self, at: slice) -> Anchors:
        return Anchors(self.ids[at], self.labels[at], self.x[at])


class Best:
    """The best ``k`` (score, id) of each slot; ``limit`` is what a further row must reach."""

    def __init__(self, k: int, limit: np.ndarray):
        self.k, self.limit = k, limit
        self.slot, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))

    def add(self, slot: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        slot, score, id_ = np.concatenate((self.slot, slot)), np.concatenate((self.score, score)), np.concatenate((self.id, id_))
        order = np.lexsort((id_, -score, slot))
        slot, score, id_ = slot[order], score[order], id_[order]
        fresh = np.ones(len(slot), bool)
        fresh[1:] = (slot[1:] != slot[:-1]) | (score[1:] != score[:-1]) | (id_[1:] != id_[:-1])
        slot, score, id_ = slot[fresh], score[fresh], id_[fresh]
        _, starts, counts = np.unique(slot, return_index=True, return_counts=True)
        rank = np.arange(len(slot)) - np.repeat(starts, counts)
        kept = rank < self.k
        self.slot, self.score, self.id = slot[kept], score[kept], id_[kept]
        last = rank == self.k - 1
        self.limit[slot[last]] = np.maximum(self.limit[slot[last]], score[last])


def _scores(bucket: Bucket, rows: np.ndarray, anchors: Anchors, which: np.ndarray) -> np.ndarray:
    x, q = bucket.x[rows] if len(rows) < len(bucket.ids) else bucket.x, anchors.x[which]
    if int(np.abs(x).max(initial=0)) * int(np.abs(q).max(initial=0)) * max(1, x.shape[1]) < EXACT:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    return q.astype(np.int64) @ x.T.astype(np.int64)


def _buckets(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[Bucket]:
    """Cut a stream of rows into length buckets; order only decides how narrow they are."""
    held: list[tuple] = []
    count, longest = 0, 0.0

    def close():
        return Bucket(*(np.concatenate(c) for c in zip(*held)))

    for b in batches:
        ids, labels = b.column("id").fill_null(int(NO_ID)).to_numpy(zero_copy_only=False), b.column("label").to_numpy(zero_copy_only=False)
        x, lengths = matrix(b.column("x"), np.int32, dims), b.column("length").to_numpy()
        at = 0
        while at < len(ids):
            if not count:
                longest = lengths[at]
            out = (lengths[at:] > longest) | (lengths[at:] < SHRINK * longest)
            stop = at + min(int(out.argmax()) if out.any() else len(out), BUCKET - count)
            if stop > at:
                held.append((ids[at:stop], labels[at:stop], x[at:stop]))
                count += stop - at
            if count == BUCKET or (stop < len(ids) and count):
                yield close()
                held, count = [], 0
            at = stop
    if count:
        yield close()


def _search(batches: Iterator[pa.RecordBatch], dims: int, anchors: Anchors, best: list[Best], wanted) -> None:
    """Run every bucket past every anchor; ``wanted`` turns candidates and scores into rows of ``best``."""
    parts = [(slice(at, at + TOGETHER), anchors.part(slice(at, at + TOGETHER))) for at in range(0, len(anchors.ids), TOGETHER)]
    for bucket in _buckets(batches, dims):
        for k, (_, part) in enumerate(parts):
            limits = wanted.limits(k, best[k])
            found = [wanted.rows(k, best[k], bucket, which, rows, _scores(bucket, rows, part, which)) for which, rows in bucket.candidates(part, limits)]
            if found:
                best[k].add(*(np.concatenate(c) for c in zip(*found)))


class Positives:
    """Rows of the anchor's label."""

    def __init__(self, anchors: Anchors):
        self.anchors = anchors

    def limits(self, k: int, best: Best) -> np.ndarray:
        return best.limit

    def rows(self, k: int, best: Best, bucket: Bucket, which, rows, scores):
        at = which + k * TOGETHER
        good = (bucket.labels[rows][None, :] == self.anchors.labels[at][:, None]) & (bucket.ids[rows][None, :] != self.anchors.ids[at][:, None]) & (scores >= best.limit[which][:, None])
        a, j = np.nonzero(good)
        return which[a], scores[a, j], bucket.ids[rows[j]]


class Negatives:
    """Rows of another label inside the band of each of the anchor's positives; slot = anchor * per + positive."""

    def __init__(self, anchors: Anchors, floor: np.ndarray, ceiling: np.ndarray):
        self.anchors, self.floor, self.ceiling = anchors, floor, ceiling  # (anchors, per), floor above ceiling: none

    def limits(self, k: int, best: Best) -> np.ndarray:
        at = slice(k * TOGETHER, (k + 1) * TOGETHER)
        usable = self.floor[at] <= self.ceiling[at]
        limit = np.where(usable, best.limit.reshape(usable.shape), NO_ID)
        return limit.min(axis=1)

    def rows(self, k: int, best: Best, bucket: Bucket, which, rows, scores):
        at = slice(k * TOGETHER, (k + 1) * TOGETHER)
        per = self.floor.shape[1]
        other = bucket.labels[rows][None, :] != self.anchors.labels[at][which][:, None]
        parts = []
        for p in range(per):
            limit = np.maximum(best.limit.reshape(-1, per)[which, p], self.floor[at][which, p])
            a, j = np.nonzero(other & (scores >= limit[:, None]) & (scores <= self.ceiling[at][which, p][:, None]))
            parts.append((which[a] * per + p, scores[a, j], bucket.ids[rows[j]]))
        return tuple(np.concatenate(c) for c in zip(*parts))


def _found(best: list[Best], per: int) -> pa.RecordBatch:
    """Slots over all anchors, scores and ids (null again)."""
    slot = np.concatenate([b.slot + k * TOGETHER * per for k, b in enumerate(best)])
    ids = np.concatenate([b.id for b in best])
    return pa.RecordBatch.from_arrays([pa.array(slot), pa.array(np.concatenate([b.score for b in best])), pa.array(ids, mask=ids == NO_ID)], names=["slot", "score", "id"])


def _kept(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of every slot with their rank."""
    order = Window.partitionBy("slot").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchor: Column, vector: str = "embedding", positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90) -> DataFrame:
    """``rows(vec_id long, label, vector)`` -> (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` tells the anchors; a negative's score is ``least`` to ``most`` percent of the positive's.
    """
    spark = rows.sparkSession
    rows = rows.select("vec_id", "label", vector, F.coalesce(anchor & F.col("vec_id").isNotNull(), F.lit(False)).alias("anchor"))
    rows = rows.where(complete(F.col(vector)) & F.col("label").isNotNull())
    dims = dimension(rows, vector)

    def pack(batches):
        for b in batches:
            x = quantised(b.column(vector), dims)
            length = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), b.column("anchor"), pa.array(length), blobs(x)], names=["id", "label", "anchor", "length", "x"])

    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    typed = rows.withColumn("vec_id", F.col("vec_id").cast("long")).withColumn("label", F.col("label").cast("long"))
    packed = map_batches(typed, pack, "id long, label long, anchor boolean, length double, x binary")
    # the search costs far more than its rows, so they are spread evenly first
    spread = packed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    table = materialize(spread.sortWithinPartitions(F.col("length").desc()), "hard_negatives")
    asked = table.where("anchor").select("id", "label", "x").distinct()
    blocks = -(-asked.count() // BLOCK)
    asked = materialize(asked.withColumn("block", F.pmod(F.xxhash64("id", "label", "x"), F.lit(max(blocks, 1)))), "hard_negatives")
    scanned = table.select("id", "label", "length", "x")
    results = [_mined(scanned, asked.where(F.col("block") == k), dims, positives, negatives, least, most) for k in range(blocks)]
    found = spark.createDataFrame([], out)
    for r in results:
        found = found.unionByName(r)
    return found


def _mined(scanned: DataFrame, block: DataFrame, dims: int, positives: int, negatives: int, least: int, most: int) -> DataFrame:
    spark = scanned.sparkSession
    asked = block.orderBy("id", "label", "x").collect()
    n = len(asked)
    anchors = Anchors(np.array([r.id for r in asked], np.int64), np.array([r.label for r in asked], np.int64), np.array([np.frombuffer(r.x, np.int32) for r in asked]).reshape(n, dims))
    sent = spark.sparkContext.broadcast((anchors.ids, anchors.labels, anchors.x))

    def nearest(batches):
        a = Anchors(*sent.value)
        best = [Best(positives, np.full(min(TOGETHER, n - at), LEAST)) for at in range(0, n, TOGETHER)]
        _search(batches, dims, a, best, Positives(a))
        yield _found(best, 1)

    near = _kept(map_batches(scanned, nearest, "slot long, score long, id long"), positives).collect()
    ids, scores = np.full((n, positives), NO_ID), np.zeros((n, positives), np.int64)
    floor, ceiling = np.ones((n, positives), np.int64), np.zeros((n, positives), np.int64)
    for r in near:
        at = r.slot, r["rank"] - 1
        ids[at], scores[at] = NO_ID if r.id is None else r.id, r.score
        floor[at], ceiling[at] = -(-least * r.score // 100), most * r.score // 100
    bands = spark.sparkContext.broadcast((floor, ceiling))

    def hard(batches):
        a, (low, high) = Anchors(*sent.value), bands.value
        best = [Best(negatives, low[at : at + TOGETHER].ravel().copy()) for at in range(0, n, TOGETHER)]
        _search(batches, dims, a, best, Negatives(a, low, high))
        yield _found(best, positives)

    kept = _kept(map_batches(scanned, hard, "slot long, score long, id long"), negatives)
    pairs = [(i * positives + p, int(anchors.ids[i]), None if ids[i, p] == NO_ID else int(ids[i, p]), int(scores[i, p])) for i in range(n) for p in range(positives) if floor[i, p] <= ceiling[i, p]]
    named = spark.createDataFrame(pairs, "at long, anchor_id long, positive_id long, positive_score long")
    joined = kept.join(named, F.col("slot") == F.col("at"))
    return materialize(joined.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "hard_negatives")


ORACLE = """WITH k AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda v: floor(256 * v::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS al, b.vec_id, b.label, list_dot_product(a.q, b.q)::BIGINT AS score FROM k a JOIN k b ON a.vec_id % 100 = 0 AND a.vec_id IS DISTINCT FROM b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = al QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id NULLS LAST) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS "rank", vec_id AS negative_id, positive_score, score AS negative_score
FROM s JOIN p USING (anchor_id) WHERE label <> al AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY "rank" <= 10"""
