"""Mixing sources to target weights by min-cost flow over membership patterns.

A document may belong to several sources. Documents are aggregated by membership pattern
(the sorted set of their sources), the words of a pattern are routed to source quotas by
min-cost flow, where each further repetition of the same words costs more (convex costs,
at most ``max_repeats`` in all), and the routed words of a pattern are then taken as whole
documents in a seeded order: full repetitions of all of them, and of the rest the
documents up to a cut in that order, as near to the remainder as whole documents allow.

Spark does the sizes, the pattern totals and the cuts (bucketed prefix sums, so a source with
a third of all rows is never one task); the driver sees one row per pattern (an error
beyond ``MAX_PATTERNS``). A document's fate is a pure function of its pattern and its
seeded order, so applying the mix to a table is one broadcast of that bounded plan.

Defined results: null texts and texts without words have size 0 and nothing is taken; a null source
is a source of its own, last in order; rows that share a doc_id share their place in
the seeded order and are taken or left together; an empty table gives an empty mix. Of rows with
a null id each text is a document of its own.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulsegrid.llm.common import WORD_RE, materialize

MAX_PATTERNS = 100_000
#: Characters of the seeded order that make a bucket of the prefix sums.
PREFIX = 3


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def order_of(doc_id: str, seed: int, text: str) -> Column:
    """The seeded order of a document: hexadecimal text. Null ids are ordered by a hash of the text."""
    unnamed = F.concat(F.lit("null:"), F.md5(F.coalesce(F.col(text), F.lit(""))))
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), unnamed)))


def water_fill(sizes: list[int], weights: list[int], max_repeats: int) -> list[float]:
    """Shares of the total by weight, none above ``max_repeats`` times its size; the excess is reshared by weight."""
    target = [0.0] * len(sizes)
    rest, weight = sum(sizes), sum(weights)
    order = sorted(range(len(sizes)), key=lambda i: (max_repeats * sizes[i] / weights[i], i))
    for at, i in enumerate(order):
        level = rest / weight
        if max_repeats * sizes[i] / weights[i] >= level:
            for j in order[at:]:
                target[j] = min(float(max_repeats * sizes[j]), level * weights[j])
            break
        target[i] = float(max_repeats * sizes[i])
        rest -= max_repeats * sizes[i]
        weight -= weights[i]
    return target


class Flow:
    """Residual network for maximum flows by blocking flows on level graphs."""

    def __init__(self, nodes: int):
        self.to: list[int] = []
        self.room: list[int] = []
        self.at: list[list[int]] = [[] for _ in range(nodes)]

    def arc(self, a: int, b: int, cap: int) -> int:
        for x, y, c in ((a, b, cap), (b, a, 0)):
            self.at[x].append(len(self.to))
            self.to.append(y)
            self.room.append(c)
        return len(self.to) - 2

    def _levels(self, start: int) -> list[int]:
        level = [-1] * len(self.at)
        level[start] = 0
        queue = deque([start])
        while queue:
            x = queue.popleft()
            for e in self.at[x]:
                if self.room[e] > 0 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[x] + 1
                    queue.append(self.to[e])
        return level

    def augment(self, start: int, end: int) -> None:
        """Raise the flow from ``start`` to ``end`` to its maximum."""
        to, room, at = self.to, self.room, self.at
        while True:
            level = self._levels(start)
            if level[end] < 0:
                return
            turn = [0] * len(at)
            path: list[int] = []
            x = start
            while True:
                if x == end:
                    push = min(room[e] for e in path)
                    for e in path:
                        room[e] -= push
                        room[e ^ 1] += push
                    # back to the first arc that is full now
                    first = next(i for i, e in enumerate(path) if room[e] == 0)
                    x = to[path[first] ^ 1]
                    del path[first:]
                    continue
                while turn[x] < len(at[x]):
                    e = at[x][turn[x]]
                    if room[e] > 0 and level[to[e]] == level[x] + 1:
                        break
                    turn[x] += 1
                else:
                    if x == start:
                        break
                    x = to[path.pop() ^ 1]
                    turn[x] += 1
                    continue
                path.append(e)
                x = to[e]


def route(patterns: list[tuple[int, ...]], sizes: list[int], quotas: list[int], max_repeats: int) -> dict[tuple[int, int], int]:
    """Min-cost flow (pattern, source) -> words; repetition e of a pattern's words costs e.

    Only the arcs into patterns have costs, so a cheapest augmenting path is one with the least e that reaches
    a quota: the repetitions are opened one after the other, each with a maximum flow."""
    n_p, n_s = len(patterns), len(quotas)
    start, end = n_p + n_s, n_p + n_s + 1
    net = Flow(end + 1)
    into = [net.arc(start, p, 0) for p in range(n_p)]
    arcs = [(p, s, net.arc(p, n_p + s, max_repeats * sizes[p])) for p, members in enumerate(patterns) for s in members]
    for s, q in enumerate(quotas):
        net.arc(n_p + s, end, q)
    for _ in range(max_repeats):
        for p, e in enumerate(into):
            net.room[e] += sizes[p]
        net.augment(start, end)
    return {(p, s): net.room[e ^ 1] for p, s, e in arcs if net.room[e ^ 1] > 0}


def plan(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3) -> tuple[DataFrame, DataFrame]:
    """``sized(members array<string>, size, ord)`` -> (patterns, sources).

    patterns(members, copies, cut): documents of the pattern are taken ``copies`` times, once more where ord <= cut.
    sources(source, source_size, target). Weights repeat over the sources by code point, null last.
    """
    spark = sized.sparkSession
    totals = sized.groupBy("members").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(totals) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    totals.sort(key=lambda r: [(s is None, s or "") for s in r.members])
    names = sorted({s for r in totals for s in r.members}, key=lambda s: (s is None, s or ""))
    place = {s: i for i, s in enumerate(names)}
    source_size = [0] * len(names)
    for r in totals:
        for s in r.members:
            source_size[place[s]] += r["size"]
    target = water_fill(source_size, [weights[i % len(weights)] for i in range(len(names))], max_repeats)
    flow = route([tuple(place[s] for s in r.members) for r in totals], [r["size"] for r in totals], [int(t + 0.5) for t in target], max_repeats)
    took = [0] * len(totals)
    for (p, _), f in flow.items():
        took[p] += f
    rows = [(r.members, *(divmod(took[i], r["size"]) if r["size"] else (0, 0))) for i, r in enumerate(totals)]
    routed = F.broadcast(spark.createDataFrame(rows, "m array<string>, copies long, rest long"))  # at most MAX_PATTERNS rows
    sources = spark.createDataFrame([(s, source_size[i], target[i]) for i, s in enumerate(names)], "source string, source_size long, target double")

    some = sized.where("size > 0").withColumn("bucket", F.substring("ord", 1, PREFIX)).join(routed.where("rest > 0"), F.col("members") == F.col("m"))
    run = W.partitionBy("m").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    # at most 16**PREFIX rows a pattern
    buckets = some.groupBy("m", "rest", "bucket").agg(F.sum("size").alias("sum")).withColumn("upto", F.sum("sum").over(run)).withColumn("before", F.col("upto") - F.col("sum"))
    edge = buckets.where("before < rest and rest <= upto").select(F.col("m").alias("em"), F.col("bucket").alias("eb"), "before")
    inner = W.partitionBy("m").orderBy("ord").rowsBetween(W.unboundedPreceding, 0)
    units = (
        some.join(F.broadcast(edge), (F.col("m") == F.col("em")) & (F.col("bucket") == F.col("eb")))  # at most one row a pattern
        .groupBy("m", "rest", "before", "ord")
        .agg(F.sum("size").alias("size"))
        .withColumn("upto", F.col("before") + F.sum("size").over(inner))
    )
    taken = (F.col("upto") <= F.col("rest")) | (2 * F.col("rest") > 2 * F.col("upto") - F.col("size"))
    # the bucket's prefix itself is above every order of the buckets before and below those inside
    cuts = edge.join(units.where(taken).groupBy("m").agg(F.max("ord").alias("cut")), F.col("em") == F.col("m"), "left").select("em", F.coalesce("cut", "eb").alias("cut"))
    patterns = materialize(routed.join(cuts, F.col("m") == F.col("em"), "left").select(F.col("m").alias("members"), "copies", F.coalesce("cut", F.lit("")).alias("cut")), "mixing")
    return patterns, sources


def copies_of(patterns: DataFrame, rows: DataFrame, members: Column, order: Column) -> DataFrame:
    """``rows`` with ``_copies``: how many times the mix takes each of them."""
    small = F.broadcast(patterns.select(F.col("members").alias("_members"), F.col("copies").alias("_full"), F.col("cut").alias("_cut")))  # at most MAX_PATTERNS rows
    joined = rows.join(small, members == F.col("_members"))
    return joined.withColumn("_copies", F.col("_full") + F.when(order <= F.col("_cut"), 1).otherwise(0)).drop("_members", "_full", "_cut")


def mix(docs: DataFrame, seed: int = 1, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """``docs(doc_id, text, source)`` -> (doc_id, size, source_size, target, taken)."""
    sized = materialize(docs.select("doc_id", "source", size_of().alias("size"), order_of("doc_id", seed, "text").alias("ord")).withColumn("members", F.array("source")), "mixing")
    patterns, sources = plan(sized, weights, max_repeats)
    got = copies_of(patterns, sized, F.col("members"), F.col("ord"))
    small = F.broadcast(sources.withColumnRenamed("source", "_source"))
    return got.join(small, F.col("source").eqNullSafe(F.col("_source"))).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("_copies")).alias("taken"))


def mixed(docs: DataFrame, seed: int = 1, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """The mix itself: the rows of ``docs``, all columns unchanged, each as many times as the mix takes it; texts without words are not in it."""
    sized = materialize(docs.select(F.array("source").alias("members"), size_of().alias("size"), order_of("doc_id", seed, "text").alias("ord")), "mixing")
    patterns, _ = plan(sized, weights, max_repeats)
    got = copies_of(patterns, docs.select(F.struct("*").alias("row")), F.array("row.source"), order_of("row.doc_id", seed, "row.text"))
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_time")
    return got.where((F.col("_copies") > 0) & F.col("row.text").rlike(WORD_RE)).select("row", times).select("row.*")


ORACLE = r"""
WITH s AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('1:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, '')))) AS ord
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM s GROUP BY source),
-- sources by the level at which they reach three times their size; those below the common level are full
r AS (
  SELECT *, 3 * source_size / w AS full_at,
         sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER b, 0) AS rest,
         sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS weight
  FROM src
  WINDOW b AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (SELECT rest / weight AS level FROM r WHERE full_at >= rest / weight ORDER BY full_at, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, level * w) AS target FROM r, lev),
q AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS copies,
         CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT % source_size ELSE 0 END AS over
  FROM t),
c AS (
  SELECT s.doc_id, s.size, q.source_size, q.target, q.copies, q.over,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.ord) AS upto
  FROM s JOIN q ON s.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       (size * (copies + CASE WHEN over > 0 AND (upto <= over OR 2 * over > 2 * upto - size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""
