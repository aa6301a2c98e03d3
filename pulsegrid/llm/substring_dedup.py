"""Substring dedup with prefix-partitioned suffix trees.

A window is ``window`` consecutive words of one document. Every window whose word sequence also
starts earlier (smaller doc_id, or the same document and an earlier start) marks its words as
removed.

1. Candidates, losslessly. The anchor of a window is its word ``GRAM``-gram with the least hash
   (the first of equals), so equal windows have equal anchors. Neighbouring windows share
   anchors, and only anchors are shuffled: (anchor, context, document, windows served), about one
   for eight words. The context is a hash of all words of the windows served. Anchors that
   occur once are dropped.
2. Occurrences of the same anchor with the same context have the same windows; all but the
   first occurrence are marked at once, whatever their number.
3. The first occurrences of anchors with several contexts may share some windows only. Their
   windows become suffixes (cut at ``window`` words, all that deep nodes need), which are
   split by variable-length prefixes: a prefix with more than ``group`` suffixes is lengthened;
   suffixes equal in all words that still are too many are dealt by salt. Small prefixes are put
   together to memory-sized groups.
4. A task builds the subtree of a group (sorted suffixes and the common prefix lengths of
   neighbours). Internal nodes at least ``window`` words deep are the repeats: every
   suffix below but the earliest is marked. Salted parts hand their earliest on to one more round.
5. The marks of a document come together and the words they cover are taken out.

Defined results: null and empty texts have no words; texts shorter than a window lose none.
Exact repeats of a row (doc_id and text) are one document to the order (the same start is not
earlier), so they keep what the row keeps. Rows that share a doc_id but not the text are
documents of their own, ordered by a hash of the text. Null ids come last in the order.
"""

from __future__ import annotations

import zlib
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import map_batches, materialize, words_of
from pulsegrid.session import ship_package

GRAM = 5
#: Windows handled at once; a position inside them fits ``PLACE`` bits.
BLOCK = 1 << 22
PLACE = np.uint64((1 << 24) - 1)
#: Words of a suffix that its group's prefix may have.
PREFIXES = (6, 12)
#: Suffixes a group may have.
GROUP = 20_000
#: Null ids come last.
LAST = (1 << 63) - 1
#: A document in its order: the id, and the hash of the text (128 bits) where several texts may share the id, else 0.
KEY = ("doc", "high", "low")
KEY_TYPES = ", ".join(f"{k} long" for k in KEY)


def same(a: str, b: str) -> Column:
    """Whether the keys in the structs ``a`` and ``b`` (or the columns themselves, for "") are equal."""
    at = lambda x, k: F.col(f"{x}.{k}" if x else k)
    return reduce(and_, (at(a, k) == at(b, k) for k in KEY))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, *KEY, text) of ``docs(doc_id, text)``."""
    hashes = [F.xxhash64(F.lit(i), "text") for i in range(2)]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("doc", F.coalesce("doc_id", F.lit(LAST)))
    ends = [f(h).alias(f"{n}{i}") for i, h in enumerate(hashes) for n, f in (("least", F.min), ("most", F.max))]
    several = rows.where(F.col("doc") < LAST).groupBy("doc").agg(*ends).where("least0 < most0 or least1 < most1")
    several = materialize(several.select(F.col("doc").alias("shared")), "substrings")
    own = F.col("shared").isNotNull() | (F.col("doc") == LAST)
    told = [F.when(own, h).otherwise(F.lit(0)).cast("long").alias(k) for k, h in zip(KEY[1:], hashes)]
    return rows.join(several, F.col("doc") == F.col("shared"), "left").select("doc_id", "doc", *told, "text")


def anchors(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, last window) of each run of windows with the same anchor place."""
    n = len(words) - window + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    out: list[list[np.ndarray]] = [[], [], []]
    for at in range(0, n, BLOCK):
        part = word[at : at + BLOCK + window - 1]
        m = len(part) - GRAM + 1
        h = np.zeros(m, np.uint64)
        for j in range(GRAM):
            h = (h ^ part[j : m + j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        key = (h & ~PLACE) | np.arange(m, dtype=np.uint64)
        need, size = window - GRAM + 1, 1
        while 2 * size <= need:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        if need > size:
            key = np.minimum(key[: -(need - size)], key[need - size :])
        place = (key & PLACE).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
        last = np.concatenate((first[1:] - 1, [len(place) - 1]))
        for store, value in zip(out, (h[place[first]].view(np.int64), first + at, last + at)):
            store.append(value)
    return tuple(np.concatenate(x) for x in out)


def spans_of(words: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by spaces, and where each starts and ends."""
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    return b" ".join(words), np.concatenate(([0], end[:-1] + 1)), end


def occurrences(docs: DataFrame, window: int) -> DataFrame:
    """(anchor, context, *KEY, at): at = 64 * first window + number of further windows."""

    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            out: list[list[np.ndarray]] = [[] for _ in range(3 + len(KEY))]
            for *key, text in zip(*(b.column(k).to_pylist() for k in KEY), b.column("text")):
                words = words_of(text.as_py())
                anchor, first, last = anchors(words, window)
                if not len(anchor):
                    continue
                joined, start, end = spans_of(words)
                spans = zip(start[first].tolist(), end[last + window - 1].tolist())
                out[0].append(anchor)
                out[1].append(np.fromiter((digest(joined[a:z]) for a, z in spans), np.uint64, len(first)).view(np.int64))
                for store, value in zip(out[2:], key):
                    store.append(np.full(len(first), value, np.int64))
                out[-1].append(first * 64 + (last - first))
            arrays = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in out]
            yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "context", *KEY, "at"])

    return map_batches(docs.select(*KEY, "text"), run, f"anchor long, context long, {KEY_TYPES}, at long")


def suffixes(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """``wanted(d, ats)``, d a key: the windows of those occurrences as suffixes with the hashes of their prefixes."""

    def run(batches):
        for b in batches:
            rows: list[tuple] = []
            for *key, text, ats in zip(*(b.column(k).to_pylist() for k in KEY), b.column("text"), b.column("ats").to_pylist()):
                words = words_of(text.as_py())
                for at in sorted(set(ats)):
                    for p in range(at // 64, at // 64 + at % 64 + 1):
                        if p + window > len(words):
                            continue
                        mine = words[p : p + window]
                        rows.append((b" ".join(mine), *key, p, *(xxhash.xxh3_64_intdigest(b" ".join(mine[:k])) - (1 << 63) for k in PREFIXES)))
                if len(rows) > 20_000:
                    yield batch(rows)
                    rows = []
            yield batch(rows)

    def batch(rows):
        names = ["suffix", *KEY, "start", *(f"p{i}" for i in range(len(PREFIXES)))]
        kinds = [pa.binary(), *[pa.int64()] * (1 + len(KEY) + len(PREFIXES))]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    joined = docs.join(wanted, same("", "d")).select(*KEY, "text", "ats")
    return map_batches(joined, run, f"suffix binary, {KEY_TYPES}, start long, " + ", ".join(f"p{i} long" for i in range(len(PREFIXES))))


def partition(found: DataFrame, group: int) -> DataFrame:
    """Suffixes with the ``bucket`` of their prefix; ``salted`` where equal suffixes are dealt to several."""
    spark = found.sparkSession
    total = found.count()
    # several groups a task, each of at most about ``group`` suffixes
    buckets = max(-(-total // group), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = found.withColumn("key", F.col("p0")).withColumn("level", F.lit(0)).withColumn("salt", F.lit(0).cast("long"))
    for level in range(1, len(PREFIXES) + 1):
        longer = F.col(f"p{level}") if level < len(PREFIXES) else F.xxhash64("suffix")
        large = rows.where(F.col("level") == level - 1).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > group)
        large = materialize(large.select(F.col("key").alias("big")), "suffixes")
        hit = F.col("big").isNotNull() & (F.col("level") == level - 1)
        rows = rows.join(large, F.col("key") == F.col("big"), "left").withColumn("key", F.when(hit, longer).otherwise(F.col("key"))).withColumn("level", F.when(hit, level).otherwise(F.col("level"))).drop("big")
    last = len(PREFIXES)
    equal = materialize(rows.where(F.col("level") == last).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > group).select(F.col("key").alias("big"), F.ceil(F.col("n") / group).alias("parts")), "suffixes")
    rows = rows.join(equal, F.col("key") == F.col("big"), "left").withColumn("salted", F.col("big").isNotNull() & (F.col("level") == last))
    rows = rows.withColumn("salt", F.when(F.col("salted"), F.pmod(F.xxhash64(*KEY, "start"), F.col("parts"))).otherwise(F.col("salt")))
    return rows.select("suffix", *KEY, "start", "salted", F.pmod(F.xxhash64("level", "key", "salt"), F.lit(buckets)).alias("bucket"))


def deep_nodes(sorted_suffixes: list[list[bytes]], depth: int) -> list[tuple[int, int, int]]:
    """(depth, first, last) of the internal nodes at least ``depth`` words deep, from neighbours' common prefixes."""
    n = len(sorted_suffixes)
    lcp = [0] * (n + 1)  # lcp[i]: of suffix i - 1 and i
    for i in range(1, n):
        a, b = sorted_suffixes[i - 1], sorted_suffixes[i]
        k = 0
        for x, y in zip(a, b):
            if x != y:
                break
            k += 1
        lcp[i] = k
    nodes, stack = [], [(0, 0)]  # (depth, first suffix) of the open nodes
    for i in range(1, n + 1):
        first = i - 1
        while stack[-1][0] > lcp[i]:
            d, first = stack.pop()
            if d >= depth:
                nodes.append((d, first, i - 1))
        if stack[-1][0] < lcp[i]:
            stack.append((lcp[i], first))
    return nodes


def subtrees(dealt: DataFrame, window: int) -> DataFrame:
    """(*KEY, start, state, suffix): state 1 marks a window that starts earlier too, state 2 is the earliest of a salted part."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["suffix", *KEY, "start"], kind="stable").reset_index(drop=True)
        state = np.zeros(len(pdf), np.int32)
        cut = [bytes(s).split(b" ") for s in pdf["suffix"]]
        place = list(zip(*(pdf[k] for k in KEY), pdf["start"]))
        for _, a, z in deep_nodes(cut, window):
            for i in range(a + 1, z + 1):  # below a deep node in order of place, so the first is the earliest
                if place[i] != place[a]:
                    state[i] = 1
        state[(state == 0) & pdf["salted"].to_numpy()] = 2
        out = pdf.loc[state > 0, [*KEY, "start"]].assign(state=state[state > 0], suffix=pdf["suffix"])
        out.loc[out["state"] == 1, "suffix"] = None
        return out

    ship_package(dealt.sparkSession)
    return dealt.groupBy("bucket").applyInPandas(run, f"{KEY_TYPES}, start long, state int, suffix binary")


def marks(docs: DataFrame, window: int = 20, group: int = GROUP) -> DataFrame:
    """(*KEY, first, last): windows, as ranges of starts, whose word sequence also starts earlier. ``docs(*KEY, text)``."""
    if not GRAM <= window <= 64:
        raise ValueError(f"window must be {GRAM} to 64 words")
    found = occurrences(docs, window)
    again = materialize(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select(F.col("anchor").alias("a")), "substrings")
    found = materialize(found.join(again, F.col("anchor") == F.col("a"), "left_semi"), "substrings")
    firsts = materialize(found.groupBy("anchor", "context").agg(F.min(F.struct(*KEY, "at")).alias("first")).select(F.col("anchor").alias("a"), F.col("context").alias("c"), "first"), "substrings")
    later = found.join(firsts, (F.col("anchor") == F.col("a")) & (F.col("context") == F.col("c"))).where(~same("", "first") | (F.col("at") != F.col("first.at")))
    ranges = later.select(*KEY, F.floor(F.col("at") / 64).alias("first"), (F.floor(F.col("at") / 64) + F.col("at") % 64).alias("last"))
    several = materialize(firsts.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select(F.col("a").alias("b")), "substrings")
    wanted = firsts.join(several, F.col("a") == F.col("b"), "left_semi").groupBy(F.struct(*(f"first.{k}" for k in KEY)).alias("d")).agg(F.collect_list("first.at").alias("ats"))
    tails = materialize(suffixes(docs, wanted, window), "substrings")
    judged = materialize(subtrees(partition(tails, group), window), "substrings")
    # the earliest of salted parts: one row for each part and suffix
    open_ = judged.where("state = 2").select("suffix", *KEY, "start")
    best = open_.groupBy("suffix").agg(F.min(F.struct(*KEY, "start")).alias("first")).select(F.col("suffix").alias("s"), "first")
    beaten = open_.join(best, F.col("suffix") == F.col("s")).where(~same("", "first") | (F.col("start") != F.col("first.start"))).select(*KEY, "start")
    single = judged.where("state = 1").select(*KEY, "start").unionByName(beaten)
    return ranges.unionByName(single.select(*KEY, F.col("start").alias("first"), F.col("start").alias("last")))


def remove(docs: DataFrame, window: int = 20, group: int = GROUP) -> DataFrame:
    """``docs(doc_id, text)`` -> (doc_id, n_words, n_removed, kept): kept words joined by one space."""
    rows = keyed(docs)
    # a set: repeats of a row have the same ranges
    of = marks(rows, window, group).groupBy(F.struct(*KEY).alias("d")).agg(F.collect_set(F.struct("first", "last")).alias("ranges"))

    def run(batches):
        for b in batches:
            n, gone, kept = [], [], []
            for text, ranges in zip(b.column("text"), b.column("ranges").to_pylist()):
                words = words_of(text.as_py())
                edge = np.zeros(len(words) + 1, np.int64)
                for r in ranges or ():
                    if r["last"] + window <= len(words):
                        edge[r["first"]] += 1
                        edge[r["last"] + window] -= 1
                cover = np.cumsum(edge)[:-1] > 0
                n.append(len(words))
                gone.append(int(cover.sum()))
                kept.append(b" ".join([w for w, c in zip(words, cover.tolist()) if not c] if gone[-1] else words))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())], names=["doc_id", "n_words", "n_removed", "kept"]
            )

    joined = rows.join(of, same("", "d"), "left").select("doc_id", "text", "ranges")
    return map_batches(joined, run, "doc_id long, n_words long, n_removed long, kept binary")


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, i AS start, array_to_string(ws[i:i + 19], ' ') AS seq FROM w, unnest(range(1, len(ws) - 18)) t(i)),
again AS (SELECT doc_id, start FROM (SELECT doc_id, start, row_number() OVER (PARTITION BY seq ORDER BY doc_id, start) AS k FROM s) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, start + j AS place FROM again, unnest(range(20)) t(j)),
kept AS (
  SELECT u.doc_id, string_agg(u.word, ' ' ORDER BY u.place) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS place FROM w) u ANTI JOIN gone g ON u.doc_id = g.doc_id AND u.place = g.place
  GROUP BY u.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""
