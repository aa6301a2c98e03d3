"""Quality classifier by positive-unlabelled learning.

Trusted positives P and unlabelled texts U give a scorer that minimises the non-negative
unbiased risk (logistic loss l, class prior pi):

    pi E_P[l(f)] + max(0, E_U[l(-f)] - pi E_P[l(-f)])

by stochastic gradient descent in numpy; where the bracket of a batch is negative, the
step ascends it instead. Weights are averaged over the later steps and over a few descents, because the
ascending steps make single iterates wander. The prior pi is estimated from held-back parts of P and U as the
smallest ratio of their score tails (with a confidence term). Negative labels are never read.

Features of a whole text: word, line, repetition, symbol, case and compression statistics,
each as indicators of the deciles of the unlabelled sample (an additive model of steps),
and frequencies of hashed character-shape 3-grams and 4-grams.

Scores lie in 0..1. Null and empty texts have the features of an empty text and get its
score. Rows are scored one by one; repeated rows and null ids change nothing. Without
positives or unlabelled rows the model scores everything 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import map_batches, type_of
from pulsegrid.llm.text_stats import BLANKS, duplicate_lines, repeated_in_windows, word_ids

SHAPES = 1024
PUNCT = "!#$%&*,.:;<=>?@_|~"
N_DENSE = 14 + len(PUNCT)
PIECE = 1_000_000


@dataclass
class Params:
    n_pos: int = 5000  # trusted positives read: a bound
    n_unl: int = 5000  # unlabelled rows read: a bound
    epochs: int = 15
    batch: int = 250
    rate: float = 0.03
    l2: float = 1e-3
    runs: int = 3  # descents whose weights are averaged
    bins: int = 10
    seed: int = 11


@dataclass
class Model:
    prior: float = 0.5
    cuts: np.ndarray = field(default_factory=lambda: np.zeros((N_DENSE, 0)))
    scale: np.ndarray = field(default_factory=lambda: np.ones(SHAPES))
    weights: np.ndarray | None = None
    bias: float = 0.0


@lru_cache(1)
def _shape_of() -> np.ndarray:
    """Shape class of each code point: lower 1, upper 2, other letter 3, digit 4, blank 5, ASCII marks 6.., the rest 0."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            out[c] = 1 if ch.islower() else 2 if ch.isupper() else 3
        elif ch.isdigit():
            out[c] = 4
    for ch in BLANKS:
        out[ord(ch)] = 5
    out[ord("\n")] = 6
    for i, c in enumerate(c for c in range(33, 127) if not chr(c).isalnum()):
        out[c] = 7 + i
    return out


def dense(text: str, shape: np.ndarray, packer: zstandard.ZstdCompressor) -> list[float]:
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n, chars = max(len(words), 1), max(len(text), 1)
    ids = word_ids(words)
    counts = np.bincount(shape, minlength=8)
    lines = text.split("\n")
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return [
        np.log1p(len(words)),
        np.log1p(len(text)),
        sizes.mean() if len(words) else 0.0,
        sizes.std() if len(words) else 0.0,
        len(set(words)) / n,
        float((ids[1:] == ids[:-1]).mean()) if len(ids) > 1 else 0.0,
        repeated_in_windows(ids) / n,
        duplicate_lines(text) / len(lines),
        len(words) / len(lines),
        counts[2] / max(counts[1] + counts[2] + counts[3], 1),
        counts[4] / chars,
        counts[7:].sum() / chars,
        sum(w[:1].isalpha() for w in words) / n,
        len(data) / len(packer.compress(data)) if data else 0.0,
        *(text.count(c) / n for c in PUNCT),
    ]


def shape_counts(shape: np.ndarray) -> np.ndarray:
    """Frequencies of the hashed shape 3-grams and 4-grams; runs longer than three of a class count as three."""
    out = np.zeros(SHAPES)
    keep = np.ones(len(shape), bool)
    if len(shape) > 3:
        keep[3:] = ~((shape[3:] == shape[2:-1]) & (shape[2:-1] == shape[1:-2]) & (shape[1:-2] == shape[:-3]))
    s = shape[keep].astype(np.uint32)
    for n in (3, 4):
        if len(s) < n:
            break
        h = np.zeros(len(s) - n + 1, np.uint32)
        for j in range(n):
            h = h * np.uint32(0x01000193) + s[j : len(s) - n + 1 + j] + np.uint32(n)
        h *= np.uint32(0x9E3779B1)
        out += np.bincount(h >> np.uint32(22), minlength=SHAPES)
    return out / max(out.sum(), 1)


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    table, packer = _shape_of(), zstandard.ZstdCompressor(level=1)
    a, b = np.zeros((len(texts), N_DENSE)), np.zeros((len(texts), SHAPES), np.float32)
    for i, t in enumerate(texts):
        t = t or ""
        shape = np.concatenate([np.zeros(0, np.uint8), *(table[np.frombuffer(t[k : k + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)] for k in range(0, len(t), PIECE))])
        a[i], b[i] = dense(t, shape, packer), shape_counts(shape)
    return a, b


def _design(a: np.ndarray, b: np.ndarray, m: Model) -> np.ndarray:
    steps = [(a[:, [j]] > m.cuts[j][None, :]) for j in range(N_DENSE)]
    return np.hstack([np.hstack(steps).astype(np.float32), np.sqrt(b) * m.scale]).astype(np.float32)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Class prior: the smallest ratio of tails P(score >= c) of unlabelled to positives, with a confidence term."""
    if not len(pos) or not len(unl):
        return 0.5
    cut = np.unique(pos)
    qp = 1 - np.searchsorted(np.sort(pos), cut, side="left") / len(pos)
    qu = 1 - np.searchsorted(np.sort(unl), cut, side="left") / len(unl)
    slack = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(pos)) + 1 / np.sqrt(len(unl)))
    best = int(np.argmin((qu + 1.1 * slack) / np.maximum(qp, 1e-9)))
    return float(np.clip(qu[best] / max(qp[best], 1e-9), 0.02, 0.98))


def _descend(xp: np.ndarray, xu: np.ndarray, prior: float, p: Params, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    """Adam on the non-negative risk; the mean of the weights after the first third of the epochs."""
    w = np.zeros(xp.shape[1] + 1)
    mean, n = np.zeros_like(w), 0
    m, v, t = np.zeros_like(w), np.zeros_like(w), 0
    steps = max(1, len(xu) // p.batch)
    for epoch in range(p.epochs):
        op, ou = rng.permutation(len(xp)), rng.permutation(len(xu))
        for s in range(steps):
            bp, bu = xp[op[s::steps]], xu[ou[s::steps]]
            if not len(bp) or not len(bu):
                continue
            fp, fu = bp @ w[:-1] + w[-1], bu @ w[:-1] + w[-1]
            # derivatives of l(f) = log(1 + e^-f) and l(-f)
            gp, gn_p, gn_u = (_sigmoid(fp) - 1) / len(fp), _sigmoid(fp) / len(fp), _sigmoid(fu) / len(fu)
            rest = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
            if rest >= 0:
                dp, du = prior * (gp - gn_p), gn_u
            else:  # ascend the negative part
                dp, du = prior * gn_p, -gn_u
            grad = np.concatenate([bp.T @ dp + bu.T @ du, [dp.sum() + du.sum()]])
            grad[:-1] += p.l2 * w[:-1]
            t += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            rate = p.rate * (1 - epoch / p.epochs)
            w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            if epoch >= p.epochs // 3:
                mean, n = mean + w, n + 1
    w = mean / n if n else w
    return w[:-1], float(w[-1])


def train(pos: tuple[np.ndarray, np.ndarray], unl: tuple[np.ndarray, np.ndarray], p: Params) -> Model:
    model = Model()
    if not len(pos[0]) or not len(unl[0]):
        return model
    rng = np.random.default_rng(p.seed)
    qs = np.linspace(0, 1, p.bins + 1)[:-1]
    model.cuts = np.stack([np.quantile(unl[0][:, j], np.concatenate([qs, [0.95, 0.98, 0.99]])) for j in range(N_DENSE)])
    model.scale = 1 / np.maximum(np.sqrt(unl[1]).std(axis=0), 0.01)
    xp, xu = _design(*pos, model), _design(*unl, model)
    # a first scorer of "positive or unlabelled" on half of the samples, the prior on the other half
    hp, hu = rng.random(len(xp)) < 0.5, rng.random(len(xu)) < 0.5
    w, b = _descend(xp[hp], xu[hu], 0.5, p, rng) if hp.any() and hu.any() else (np.zeros(xp.shape[1]), 0.0)
    model.prior = estimate_prior(xp[~hp] @ w + b, xu[~hu] @ w + b)
    found = [_descend(xp, xu, model.prior, p, rng) for _ in range(p.runs)]
    model.weights, model.bias = np.mean([w for w, _ in found], axis=0), float(np.mean([b for _, b in found]))
    return model


def fit(docs: DataFrame, positives: DataFrame, params: Params | None = None) -> Model:
    """``docs(doc_id, text)``: unlabelled texts; ``positives(doc_id)``: ids of trusted ones.

    Reads at most ``n_pos`` + ``n_unl`` texts (the lowest hashes of the id, one text an id, no null ids); the driver gets
    their feature vectors only.
    """
    p = params or Params()
    docs = docs.select(F.col("doc_id").alias("_id"), "text")
    order = F.xxhash64("_id")

    def lowest(ids: DataFrame, n: int, kind: int) -> DataFrame:
        return ids.where(F.col("_id").isNotNull()).select("_id").distinct().orderBy(order, "_id").limit(n).withColumn("_kind", F.lit(kind))

    # bounded by n_pos + n_unl ids; of texts that share an id the one with the least hash is read
    chosen = lowest(positives.select(F.col("doc_id").alias("_id")), p.n_pos, 1).unionByName(lowest(docs, p.n_unl, 0))
    chosen = chosen.groupBy("_id").agg(F.max("_kind").alias("_pos"), F.min("_kind").alias("_low"))
    met = docs.join(F.broadcast(chosen), "_id").groupBy("_id", "_pos", "_low")
    rows = met.agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))

    def run(batches):
        for b in batches:
            x, s = features(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("_id").cast(pa.string()), b.column("_pos"), b.column("_low"), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in s], pa.binary())], names=["id", "pos", "low", "x", "s"]
            )

    got = sorted(map_batches(rows, run, "id string, pos int, low int, x binary, s binary").collect(), key=lambda r: (r.id, bytes(r.x)))

    def part(want) -> tuple[np.ndarray, np.ndarray]:
        of = [r for r in got if want(r)]
        return np.array([np.frombuffer(r.x, np.float64) for r in of]).reshape(-1, N_DENSE), np.array([np.frombuffer(r.s, np.float32) for r in of]).reshape(-1, SHAPES)

    return train(part(lambda r: r.pos == 1), part(lambda r: r.low == 0), p)


def score_texts(texts: list[str | None], m: Model) -> np.ndarray:
    if m.weights is None:
        return np.full(len(texts), 0.5)
    out = []
    for k in range(0, len(texts), 2000):
        a, b = features(texts[k : k + 2000])
        out.append(_sigmoid(_design(a, b, m) @ m.weights + m.bias))
    return np.concatenate(out) if out else np.zeros(0)


def predict(docs: DataFrame, model: Model, limit: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted) of every whole text."""

    def run(batches):
        for b in batches:
            s = score_texts(b.column("text").to_pylist(), model)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64()), pa.array((s >= limit).astype(np.int32), pa.int32())], names=["doc_id", "score", "predicted"])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {type_of(docs, 'doc_id')}, score double, predicted int")
