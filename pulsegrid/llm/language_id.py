"""Language ID: averaged hashed subword embeddings and a linear softmax, trained by
stochastic gradient descent in numpy, with calibrated rejection.

A text becomes its lower-cased letters with single spaces between runs; every
character n-gram (n = 1..4) hashes to one of ``buckets`` embeddings; the mean of the
embeddings goes through a linear softmax. As the mean is linear, scoring gathers rows
of ``embedding @ weights`` (buckets x languages) and averages those.

Rejection: a temperature is fitted on a held-back part of the labelled sample (so the
score is a calibrated probability), then the smallest score at which accepted texts of
that part reach ``max_error`` becomes the limit below which a prediction is rejected.

Defined results: null texts, empty texts and texts without a letter get ``und``, score 0,
rejected. Rows are scored one by one, so ties, repeated rows and null ids change nothing.
A fit without a labelled row returns a model without languages: all is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulsegrid.llm.common import map_batches, materialize, type_of

ORDERS = (1, 2, 3, 4)
#: Code points handled at once; longer texts go through in pieces that overlap by an n-gram.
PIECE = 250_000
UND = "und"


@dataclass
class Params:
    buckets: int = 1 << 15
    dim: int = 16
    per_lang: int = 300  # labelled documents a language: the bound of the sample
    epochs: int = 12
    batch: int = 32
    rate: float = 0.5
    max_error: float = 0.01
    seed: int = 7


@dataclass
class Model:
    langs: list[str] = field(default_factory=list)
    table: np.ndarray = field(default_factory=lambda: np.zeros((1, 0), np.float32))  # buckets x languages
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    temperature: float = 1.0
    limit: float = 0.0


@lru_cache(1)
def _letters() -> np.ndarray:
    """Is the code point a letter?"""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(code points joined by 0, row of each text, code points at the start that the piece before has counted)."""
    held: list[str] = []
    rows: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        if not t:
            continue
        if len(t) > PIECE:
            for at in range(0, len(t), PIECE):
                start = max(0, at - (max(ORDERS) - 1))
                yield _points([t[start : at + PIECE]]), np.array([i]), at - start
            continue
        held.append(t)
        rows.append(i)
        size += len(t) + 1
        if size >= PIECE:
            yield _points(held), np.array(rows), 0
            held, rows, size = [], [], 0
    if held:
        yield _points(held), np.array(rows), 0


def _points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("\0".join(t.replace("\0", " ") for t in texts).lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(points: np.ndarray, n_texts: int, overlap: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the bucket of every n-gram, and the text it belongs to (ascending)."""
    letter = _letters()[points]
    end = points == 0
    before = np.empty_like(letter)
    before[0] = False
    before[1:] = letter[:-1]
    keep = letter | before | end  # one space after each run of letters
    text = np.cumsum(end)[keep]
    sym = np.where(letter, points, 32)[keep].astype(np.uint64)
    sym[end[keep]] = 0
    gap = sym == 0
    skip = int(keep[:overlap].sum())
    h = np.zeros(len(sym), np.uint64)
    bad = gap.copy()
    for n in ORDERS:
        m = len(sym) - n + 1
        if m <= 0:
            return
        h = h[:m] * np.uint64(0x9E3779B97F4A7C15) + sym[n - 1 :] + np.uint64(1)
        bad = bad[:m] | gap[n - 1 :]
        ok = ~bad
        if n == 1:
            ok &= sym != 32
        if skip:
            ok[: max(0, skip - n + 1)] = False
        x = h[ok] * np.uint64(0xFF51AFD7ED558CCD)
        yield ((x ^ (x >> np.uint64(29))) % np.uint64(buckets)).astype(np.int64), text[:m][ok]


def features(texts: list[str | None], buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text (bucket, count) of its n-grams."""
    got: list[list[np.ndarray]] = [[] for _ in texts]
    for points, rows, overlap in _pieces(texts):
        for b, t in _grams(points, len(rows), overlap, buckets):
            cut = np.searchsorted(t, np.arange(len(rows) + 1))
            for k, row in enumerate(rows):
                if cut[k] < cut[k + 1]:
                    got[row].append(b[cut[k] : cut[k + 1]])
    return [np.unique(np.concatenate(g), return_counts=True) if g else (np.zeros(0, np.int64), np.zeros(0, np.int64)) for g in got]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(samples: list[tuple[str, np.ndarray, np.ndarray]], p: Params) -> Model:
    """samples: (language, buckets, counts). A fifth is held back for calibration."""
    langs = sorted({s[0] for s in samples})
    samples = [s for s in samples if len(s[1])]
    if not samples:
        return Model()
    rng = np.random.default_rng(p.seed)
    order = rng.permutation(len(samples))
    back = set(order[: len(samples) // 5].tolist()) if len(samples) >= 10 else set()
    fit = [i for i in order.tolist() if i not in back]
    y = np.array([langs.index(s[0]) for s in samples])
    k = len(langs)
    emb = rng.normal(0, 0.1, (p.buckets, p.dim)).astype(np.float32)
    out = rng.normal(0, 0.1, (p.dim, k)).astype(np.float32)
    bias = np.zeros(k, np.float32)
    share = np.bincount(y[fit], minlength=k) / len(fit)
    weight = np.where(share > 0, 1 / np.maximum(share * k, 1e-9), 0)
    steps = p.epochs * -(-len(fit) // p.batch)
    done = 0
    for _ in range(p.epochs):
        rng.shuffle(fit)
        for at in range(0, len(fit), p.batch):
            ids = fit[at : at + p.batch]
            rate = p.rate * (1 - done / steps)
            done += 1
            xs = [samples[i] for i in ids]
            idx = np.concatenate([x[1] for x in xs])
            val = np.concatenate([x[2] / x[2].sum() for x in xs]).astype(np.float32)
            cut = np.cumsum([0] + [len(x[1]) for x in xs])[:-1]
            hid = np.add.reduceat(emb[idx] * val[:, None], cut, axis=0)
            grad = _softmax(hid @ out + bias)
            grad[np.arange(len(ids)), y[ids]] -= 1
            grad *= (weight[y[ids]] / len(ids))[:, None]
            d_hid = grad @ out.T
            out -= rate * (hid.T @ grad).astype(np.float32)
            bias -= rate * grad.sum(axis=0).astype(np.float32)
            row = np.repeat(np.arange(len(ids)), [len(x[1]) for x in xs])
            # a bucket's share of a text is small, so its embedding takes a larger step
            np.add.at(emb, idx, (-rate * 100) * val[:, None] * d_hid[row].astype(np.float32))
    table = (emb @ out).astype(np.float32)
    model = Model(langs, table, bias)
    hold = sorted(back) or fit
    logits = np.stack([(table[samples[i][1]] * (samples[i][2] / samples[i][2].sum())[:, None]).sum(axis=0) + bias for i in hold])
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 60))
    nll = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(hold)), y[hold]], 1e-12)).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(nll))])
    prob = _softmax(logits / model.temperature)
    model.limit = rejection_limit(prob.max(axis=1), prob.argmax(axis=1) == y[hold], p.max_error)
    return model


def rejection_limit(score: np.ndarray, right: np.ndarray, max_error: float) -> float:
    """The smallest score from which on the accepted texts err at most ``max_error``; 0.999 where none does."""
    order = np.argsort(score, kind="stable")
    wrong = np.cumsum((~right[order])[::-1])[::-1] / np.arange(len(order), 0, -1)
    good = np.flatnonzero(wrong <= max_error)
    if not len(good):
        return 0.999
    return 0.0 if good[0] == 0 else float(score[order][good[0]])


def fit(docs: DataFrame, lang: str = "lang", params: Params | None = None) -> Model:
    """Learn from the labelled rows of ``docs(doc_id, text, <lang>)``.

    Every label is learned, from at most ``per_lang`` different rows (the lowest hashes of id and
    text), so the driver gets ``per_lang`` times the labels rows of n-gram counts, never texts. Rows that repeat an id
    and a text count once, null ids or not.
    """
    p = params or Params()
    tag = F.xxhash64("doc_id", "text")
    known = docs.where(F.col(lang).isNotNull() & F.col("text").isNotNull()).select(F.col(lang).alias("_lang"), tag.alias("_tag"), "text")
    sizes = known.groupBy("_lang").agg(F.approx_count_distinct("_tag").alias("_n")).withColumnRenamed("_lang", "_of")
    # hashes below a limit that leaves about twice the rows wanted, then the lowest of these
    place = F.pmod(F.col("_tag"), F.lit(1 << 30))
    rank = W.partitionBy("_lang").orderBy(place, "_tag")
    near = known.select("_lang", "_tag").join(sizes, F.col("_lang") == F.col("_of")).where(place * F.col("_n") <= F.lit((2 * p.per_lang + 50) * (1 << 30)))
    picked = near.select("_lang", "_tag").distinct().withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= p.per_lang).select("_lang", "_tag")
    # written, so its size is known and texts are not shuffled to meet it
    picked = materialize(picked, "language_id")
    rows = known.join(picked, ["_lang", "_tag"], "left_semi").groupBy("_lang", "_tag").agg(F.min("text").alias("text"))
    buckets = p.buckets

    def bags(batches):
        for b in batches:
            got = features(b.column("text").to_pylist(), buckets)
            yield pa.RecordBatch.from_arrays(
                [b.column("_tag"), b.column("_lang").cast(pa.string()), pa.array([x[0].astype(np.int32).tobytes() for x in got], pa.binary()), pa.array([x[1].astype(np.int32).tobytes() for x in got], pa.binary())],
                names=["tag", "lang", "idx", "n"],
            )

    got = map_batches(rows, bags, "tag long, lang string, idx binary, n binary").collect()
    got.sort(key=lambda r: (r.lang, r.tag, bytes(r.idx), bytes(r.n)))
    return train([(r.lang, np.frombuffer(r.idx, np.int32).astype(np.int64), np.frombuffer(r.n, np.int32)) for r in got], p)


def score_texts(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """(language, calibrated score) of each text."""
    k = len(model.langs)
    total = np.zeros((len(texts), k))
    count = np.zeros(len(texts))
    buckets = len(model.table)
    columns = [np.ascontiguousarray(model.table[:, j]) for j in range(k)]
    for points, rows, overlap in _pieces(texts) if k else ():
        for b, t in _grams(points, len(rows), overlap, buckets):
            if not len(b):
                continue
            n = np.bincount(t, minlength=len(rows))[: len(rows)]
            some = np.flatnonzero(n)
            cut = np.concatenate(([0], np.cumsum(n[some])[:-1]))
            count[rows[some]] += n[some]
            for j in range(k):
                total[rows[some], j] += np.add.reduceat(columns[j][b], cut, dtype=np.float64)
    if not k:
        return [UND] * len(texts), np.zeros(len(texts))
    prob = _softmax((total / np.maximum(count, 1)[:, None] + model.bias) / model.temperature)
    best = prob.argmax(axis=1)
    none = count == 0
    return [UND if none[i] else model.langs[best[i]] for i in range(len(texts))], np.where(none, 0.0, prob.max(axis=1))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) of every whole text."""

    def run(batches):
        for b in batches:
            lang, score = score_texts(b.column("text").to_pylist(), model)
            yes = [x != UND and s >= model.limit for x, s in zip(lang, score)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(yes, pa.bool_())], names=["doc_id", "lang_pred", "score", "accepted"])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {type_of(docs, 'doc_id')}, lang_pred string, score double, accepted boolean")


def accept(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose language is accepted."""

    def run(batches):
        for b in batches:
            lang, score = score_texts(b.column("text").to_pylist(), model)
            yield b.filter(pa.array([x != UND and s >= model.limit for x, s in zip(lang, score)], pa.bool_()))

    return map_batches(docs, run, docs.schema)
