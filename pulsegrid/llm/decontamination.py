"""Benchmark decontamination: CGK embedding, bit-sampling LSH and exact edit verification.

Texts are compared as sequences of lower-cased letter-and-digit words. An item leaks into a
document if some passage is at most ``max_edit`` times the item's words away from it in edit
distance (words inserted, deleted or replaced).

The CGK random walk reads a sequence with a pointer that stays or moves on by a random bit for
each (step, word); what it reads is an embedding whose Hamming distance follows the
edit distance. A repetition is one walk with ``BITS`` sampled steps; equal samples of a
document window and an item make them a candidate. Items are put in classes of similar
length and a window of a class has the length of its shortest item. How many repetitions
reach the target recall is measured on items with the most edits allowed, changed at
random with a fixed seed. Every candidate is verified by its exact edit distance.

Before the walk, windows with too few words of the items' vocabulary are left out: a passage
within the distance has at most that many other words, so nothing is lost.

Items of fewer than ``WALKED`` words are too short for the walk and are matched word by word, without edits. Scripts
written without blanks are cut into characters.

The benchmark is the stated query set: it is indexed in blocks of about ``BLOCK`` items; up to ``PASS`` blocks are sent
to the workers together, and each document is walked once for all of them. No shuffle.

Defined results: null and empty texts and texts without words match nothing; repeated items and repeated
rows are each reported; null ids are carried. An empty benchmark finds nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import map_batches, type_of

#: Scripts without blanks between words: Thai to Lao, Myanmar, Khmer, kana, CJK ideographs.
JOINED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003134f"
TOKEN = re.compile(rf"[{JOINED}]|[^\W_{JOINED}]+")
BLOCK = 2_000
#: Blocks whose indexes are sent to the workers at once.
PASS = 25
#: Words an item needs to be searched by the walk.
WALKED = 8
BITS = 2
#: Words of documents compared at once.
PIECE = 100_000
U = np.uint64


@dataclass
class Group:
    """Items of similar length: window length, edits allowed at most, the words of any and of each of them, and per repetition the sorted keys with their items."""

    length: int
    edits: int
    any_word: np.ndarray
    words: np.ndarray  # item of the group x word
    items: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    walks: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # steps, factors, keys, items


@dataclass
class Index:
    names: list = field(default_factory=list)
    items: list[np.ndarray] = field(default_factory=list)
    edits: list[int] = field(default_factory=list)
    vocabulary: dict[str, int] = field(default_factory=dict)
    groups: list[Group] = field(default_factory=list)
    short: dict[int, dict[tuple, list[int]]] = field(default_factory=dict)  # words of an item -> its words -> items

    @property
    def pad(self) -> int:
        return len(self.vocabulary) + 1


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def walk_keys(seq: np.ndarray, starts: np.ndarray, length: int, pad: int, steps: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """A key of the sampled steps of the walk over each window of ``seq``."""
    at = np.zeros(len(starts), np.int64)
    key = np.zeros(len(starts), U)
    sampled = set(steps.tolist())
    for j in range(int(steps.max()) + 1):
        symbol = np.where(at < length, seq[starts + np.minimum(at, length - 1)], pad).astype(U)
        if j in sampled:
            key = (key ^ (symbol + U(1))) * U(0x9E3779B97F4A7C15)
            key ^= key >> U(29)
        at += (((symbol + U(1)) * factors[j, 0] + factors[j, 1]) >> U(63)).astype(np.int64)
    return key


def _draw(rng: np.random.Generator, length: int) -> tuple[np.ndarray, np.ndarray]:
    span = max(BITS, length + length // 2)
    return np.sort(rng.choice(span, BITS, replace=False)), rng.integers(0, 1 << 64, (span, 2), dtype=U) | U(1)


def _changed(item: np.ndarray, edits: int, words: int, rng: np.random.Generator) -> np.ndarray:
    out = item.tolist()
    for _ in range(edits):
        i, kind = int(rng.integers(0, len(out))), int(rng.integers(0, 3))
        if kind == 0:
            out[i] = int(rng.integers(0, words + 1))
        elif kind == 1:
            out.insert(i, int(rng.integers(0, words + 1)))
        elif len(out) > 1:
            del out[i]
    return np.array(out, np.int64)


def _windows(items: list[np.ndarray], length: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``length`` words of each item one after the other, and their starts."""
    body = np.full((len(items), length), pad, np.int64)
    for row, x in zip(body, items):
        row[: min(length, len(x))] = x[:length]
    return body.ravel(), np.arange(len(items)) * length


def build(rows: list[tuple], max_edit: float, recall: float, seed: int) -> Index:
    """rows: (item id, text)."""
    index = Index()
    for name, text in rows:
        words = tokens(text)
        if words:
            index.names.append(name)
            index.items.append(np.array([index.vocabulary.setdefault(w, len(index.vocabulary) + 1) for w in words], np.int64))
            index.edits.append(int(max_edit * len(words)))
            if len(words) < WALKED:
                same = index.short.setdefault(len(words), {})
                same.setdefault(tuple(index.items[-1].tolist()), []).append(len(index.items) - 1)
    rng = np.random.default_rng(seed)
    order = sorted((i for i, x in enumerate(index.items) if len(x) >= WALKED), key=lambda i: len(index.items[i]))
    while order:
        length = len(index.items[order[0]])
        mine = [i for i in order if len(index.items[i]) <= length * 1.25]
        order = order[len(mine) :]
        words = np.zeros((len(mine), index.pad + 1), bool)
        for row, i in zip(words, mine):
            row[index.items[i]] = True
        group = Group(length, max(index.edits[i] for i in mine), words.any(axis=0), words)
        body, starts = _windows([index.items[i] for i in mine], length, index.pad)
        tried = [mine[k] for k in rng.integers(0, len(mine), 100)]
        before, at = _windows([index.items[i] for i in tried], length, index.pad)
        after, _ = _windows([_changed(index.items[i], index.edits[i], len(index.vocabulary), rng) for i in tried], length, index.pad)
        met = np.mean([(walk_keys(before, at, length, index.pad, *w) == walk_keys(after, at, length, index.pad, *w)).mean() for w in (_draw(rng, length) for _ in range(40))])
        repeats = int(np.ceil(np.log(1 - recall) / np.log(1 - min(max(met, 0.02), 0.999))))
        for _ in range(max(repeats, 1)):
            steps, factors = _draw(rng, length)
            keys = walk_keys(body, starts, length, index.pad, steps, factors)
            by = np.argsort(keys, kind="stable")
            group.walks.append((steps, factors, keys[by], by))
        index.groups.append(group)
        group.items = np.array(mine)
    return index


def infix_distance(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """(least edit distance of the item to a passage of the region, end of the first such passage)."""
    place = np.arange(len(region) + 1)
    row = np.zeros(len(region) + 1, np.int64)
    for i, word in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (region != word))
        row = np.minimum.accumulate(new - place) + place
    best = int(row.argmin())
    return int(row[best]), best


def _verify(index: Index, seq: np.ndarray, low: int, high: int, hits: np.ndarray, item: int) -> tuple[int, int] | None:
    """Least distance and end (in words of the document) of an item near candidate starts of one document."""
    x, e = index.items[item], index.edits[item]
    best = None
    for starts in np.split(hits, np.flatnonzero(np.diff(hits) > len(x) + e) + 1):
        a, z = max(low, int(starts[0]) - e), min(high, int(starts[-1]) + len(x) + 2 * e)
        d, end = infix_distance(x, seq[a:z])
        if d <= e and (best is None or d < best[0]):
            best = (d, a - low + end)
    return best


def find(texts: list[str | None], index: Index) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, distance, end word) of every leak."""
    if not index.items:
        return
    gap = np.full(max([g.length for g in index.groups] + list(index.short)), index.pad, np.int64)
    get = index.vocabulary.get
    held: list[np.ndarray] = []
    of: list[int] = []
    size = 0
    for t, text in enumerate(texts):
        words = tokens(text)
        if words:
            held.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
            of.append(t)
            size += len(words) + len(gap)
        if held and (size >= PIECE or t == len(texts) - 1):
            yield from _find(held, of, index, gap)
            held, of, size = [], [], 0
    if held:
        yield from _find(held, of, index, gap)


def _find(held: list[np.ndarray], of: list[int], index: Index, gap: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    seq = np.concatenate([x for h in held for x in (h, gap)])
    low = np.cumsum([0] + [len(h) + len(gap) for h in held[:-1]])
    high = low + [len(h) for h in held]
    yield from _find_short(seq, low, of, index)
    for group in index.groups:
        n = group.length
        known = np.concatenate(([0], np.cumsum(group.any_word[seq], dtype=np.int32)))
        starts = np.flatnonzero(known[n:] - known[:-n] >= n - group.edits)
        if not len(starts):
            continue
        found: list[np.ndarray] = []
        for steps, factors, keys, items in group.walks:
            key = walk_keys(seq, starts, n, index.pad, steps, factors)
            a, z = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            hit = np.flatnonzero(z > a)
            if len(hit):
                many = z[hit] - a[hit]
                which = np.repeat(a[hit] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
                found.append(np.repeat(starts[hit], many) * len(group.items) + items[which])
        if not found:
            continue
        start, item = np.divmod(np.unique(np.concatenate(found)), len(group.items))
        # a passage within the distance starts with a window that has at most so many words foreign to its item
        shared = np.zeros(len(start), np.int64)
        for j in range(n):
            shared += group.words[item, seq[start + j]]
        good = shared >= n - np.array(index.edits)[group.items[item]]
        start, item = start[good], group.items[item[good]]
        doc = np.searchsorted(low, start, "right") - 1
        order = np.lexsort((start, item, doc))
        start, item, doc = start[order], item[order], doc[order]
        edge = np.flatnonzero((np.diff(doc) != 0) | (np.diff(item) != 0)) + 1
        for a, z in zip([0, *edge.tolist()], [*edge.tolist(), len(doc)]):
            if a < z:
                got = _verify(index, seq, int(low[doc[a]]), int(high[doc[a]]), start[a:z], int(item[a]))
                if got:
                    yield of[doc[a]], int(item[a]), *got


def _find_short(seq: np.ndarray, low: np.ndarray, of: list[int], index: Index) -> Iterator[tuple[int, int, int, int]]:
    """Exact matches of short items: the first of each item in each document."""
    for n, same in index.short.items():
        first = np.zeros(index.pad + 1, bool)
        first[[words[0] for words in same]] = True
        last = np.zeros(index.pad + 1, bool)
        last[[words[-1] for words in same]] = True
        seen = set()
        for start in np.flatnonzero(first[seq[: len(seq) - n + 1]] & last[seq[n - 1 :]]).tolist():
            for item in same.get(tuple(seq[start : start + n].tolist()), ()):
                doc = int(np.searchsorted(low, start, "right")) - 1
                if (doc, item) not in seen:
                    seen.add((doc, item))
                    yield of[doc], item, 0, start - int(low[doc]) + n


def indexes(benchmark: DataFrame, max_edit: float, recall: float, seed: int) -> Iterator[list[Index]]:
    """Indexes of the blocks of ``benchmark(item_id, text)``, ``PASS`` at a time."""
    rows = benchmark.where(F.col("text").isNotNull()).select("item_id", "text")
    blocks = -(-rows.count() // BLOCK)
    held = []
    for k in range(blocks):
        # about BLOCK items reach the driver at a time
        mine = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        held.append(build(sorted(((r.item_id, r.text) for r in mine), key=lambda r: (r[0] is None, r[0] or 0, r[1])), max_edit, recall, seed))
        if len(held) == PASS or k == blocks - 1:
            yield held
            held = []


def leaks(docs: DataFrame, benchmark: DataFrame, max_edit: float = 0.2, recall: float = 0.95, seed: int = 5) -> DataFrame:
    """(doc_id, item_id, edit_distance, item_words, end_word): one row for each document and item that leaks into it."""
    texts = docs.select("doc_id", "text")
    schema = f"doc_id {type_of(docs, 'doc_id')}, item_id {type_of(benchmark, 'item_id')}, edit_distance int, item_words int, end_word int"
    out = docs.sparkSession.createDataFrame([], schema)

    def over(some: list[Index]):
        def run(batches):
            for b in batches:
                here = b.column("text").to_pylist()
                rows = [(index, *r) for index in some for r in find(here, index)]
                arrays = [
                    b.column("doc_id").take(pa.array([t for _, t, _, _, _ in rows], pa.int64())),
                    pa.array([index.names[i] for index, _, i, _, _ in rows], kind),
                    pa.array([d for _, _, _, d, _ in rows], pa.int32()),
                    pa.array([len(index.items[i]) for index, _, i, _, _ in rows], pa.int32()),
                    pa.array([end for _, _, _, _, end in rows], pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "item_id", "edit_distance", "item_words", "end_word"])

        return run

    kind = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[type_of(benchmark, "item_id")]
    for some in indexes(benchmark, max_edit, recall, seed):
        out = out.unionByName(map_batches(texts, over(some), schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, max_edit: float = 0.2, recall: float = 0.95, seed: int = 5) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, into which no item leaks."""

    def over(some: list[Index]):
        def run(batches):
            for b in batches:
                keep, here = np.ones(b.num_rows, bool), b.column("text").to_pylist()
                for index in some:
                    keep[[r[0] for r in find(here, index)]] = False
                yield b.filter(pa.array(keep))

        return run

    for some in indexes(benchmark, max_edit, recall, seed):
        docs = map_batches(docs, over(some), docs.schema)
    return docs
