"""Vector codes: product quantisation whose k-means rounds skip entries by norm-of-sum bounds.

Vectors are cut into parts with a codebook each. For every part a row keeps its nearest entry and, for
each group of entries, a lower bound of the distance to the group's other entries with the
round in which it was measured. All codebooks of earlier rounds are retained, so a bound of round s falls
in round t by the true net displacement of the group's entries from s to t (the norm of the
sum of their moves, never more than the sum of the norms of the single moves). A group is scanned again, exactly,
only where the exact distance to the row's own entry is not below that bound.

Bounds are stored as half floats rounded down, so they only ever err towards a scan; distances are exact
integers and ties go to the lower entry. Each round's rows (vector, code, bounds, stamps) are one table in the shared
folder; what reaches the driver are the codebooks: parts x entries sums, added up in Spark.

Defined results: see ``vectors`` for rows that take no part and for vectors of unequal length; a dimension that the
parts do not divide is filled up with zeros. First entries are the rows of the smallest ids (null last, ties by the
vector); with fewer rows than entries the codebook is smaller. Repeated rows get equal codes. An empty table
gives an empty result and no codebooks. Null labels are one label.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import map_batches, materialize, type_of
from pulsegrid.llm.vectors import blobs, complete, dimension, matrix, quantised

#: Distances whose squares stay exact in a double.
EXACT = 1 << 53
HALF_MAX = 65504.0


@dataclass
class Codebooks:
    """``history[t]`` is (parts, entries, width): the entries that round t assigned to."""

    history: list[np.ndarray]
    groups: list[np.ndarray]

    def fallen(self) -> np.ndarray:
        """(earlier round, part, group) -> largest net displacement of an entry of the group since that round."""
        now = self.history[-1].astype(np.float64)
        moved = [np.sqrt(((now - then) ** 2).sum(axis=2)) for then in self.history]
        return np.array([[[m[p, g].max() for g in self.groups] for p in range(len(now))] for m in moved]) * (1 + 1e-12)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.history[-1].ravel().tolist())).encode()).hexdigest()


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, (rows, entries); x and entries are int64."""
    far = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    if 4 * x.shape[1] * int(far) ** 2 < EXACT:
        x, entries = x.astype(np.float64), entries.astype(np.float64)
    cross = x @ entries.T
    return ((x * x).sum(axis=1)[:, None] - 2 * cross + (entries * entries).sum(axis=1)).astype(np.int64)


def _rounded_down(x: np.ndarray) -> np.ndarray:
    """As half floats not above x; infinite only where x is."""
    near = np.where(np.isinf(x), x, np.minimum(x, HALF_MAX)).astype(np.float16)
    return np.where(near.astype(np.float64) > x, np.nextafter(near, np.float16(-np.inf)), near)


def assign_first(x: np.ndarray, books: Codebooks):
    """(rows, parts, width) -> code, bounds, stamps, squared distance of every part; every group is scanned."""
    n, parts = x.shape[:2]
    code, error = np.empty((n, parts), np.uint8), np.empty((n, parts), np.int64)
    bounds, stamps = np.empty((n, parts, len(books.groups)), np.float16), np.zeros((n, parts, len(books.groups)), np.uint8)
    rows = np.arange(n)
    for p in range(parts):
        d = _distances(x[:, p], books.history[-1][p])
        own = d.argmin(axis=1)
        code[:, p], error[:, p] = own, d[rows, own]
        roots = np.sqrt(d.astype(np.float64))
        roots[rows, own] = np.inf
        for k, g in enumerate(books.groups):
            bounds[:, p, k] = _rounded_down(roots[:, g].min(axis=1))
    return code, bounds, stamps, error


def assign_again(x: np.ndarray, books: Codebooks, code: np.ndarray, bounds: np.ndarray, stamps: np.ndarray, fallen: np.ndarray):
    """The same from the state of an earlier round; also the number of groups scanned for each row."""
    n, parts = x.shape[:2]
    now = len(books.history) - 1
    code, bounds, stamps, error, scans = code.copy(), bounds.copy(), stamps.copy(), np.empty((n, parts), np.int64), np.zeros(n, np.int64)
    of_entry = np.concatenate([np.full(len(g), k) for k, g in enumerate(books.groups)])
    for p in range(parts):
        entries, xp, old = books.history[-1][p], x[:, p], code[:, p].astype(np.int64)
        own = ((xp - entries[old]) ** 2).sum(axis=1)
        reach = np.sqrt(own.astype(np.float64))
        low = bounds[:, p].astype(np.float64) - fallen[stamps[:, p], p, np.arange(len(books.groups))]
        best, best_d, scanned = old.copy(), own.copy(), []
        for k, g in enumerate(books.groups):
            rows = np.flatnonzero(reach * (1 + 1e-12) >= low[:, k] * (1 - 1e-12))
            if not len(rows):
                continue
            d = _distances(xp[rows], entries[g])
            j = d.argmin(axis=1)
            got = d[np.arange(len(rows)), j]
            nearer = (got < best_d[rows]) | ((got == best_d[rows]) & (g[j] < best[rows]))
            best[rows[nearer]], best_d[rows[nearer]] = g[j[nearer]], got[nearer]
            scanned.append((k, g, rows, d))
            scans[rows] += 1
        # the entry a row leaves is covered by its group's bound from now on
        left = np.flatnonzero(best != old)
        k = of_entry[old[left]]
        bounds[left, p, k] = _rounded_down(np.maximum(np.minimum(low[left, k], reach[left]), 0))
        stamps[left, p, k] = now
        for k, g, rows, d in scanned:
            others = np.where(g[None, :] == best[rows, None], np.inf, np.sqrt(d.astype(np.float64)))
            bounds[rows, p, k] = _rounded_down(others.min(axis=1))
            stamps[rows, p, k] = now
        code[:, p], error[:, p] = best, best_d
    return code, bounds, stamps, error, scans


def _packed(rows: DataFrame, vector: str, dims: int, fill: int) -> DataFrame:
    """(vec_id, label, x): x the integer components as int32, ``fill`` zeros at the end."""

    def run(batches):
        for b in batches:
            x = np.pad(quantised(b.column(vector), dims), ((0, 0), (0, fill)))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), blobs(x)], names=["vec_id", "label", "x"])

    return map_batches(rows.select("vec_id", "label", vector), run, f"vec_id {type_of(rows, 'vec_id')}, label {type_of(rows, 'label')}, x binary")


def _assigned(state: DataFrame, books: Codebooks, parts: int) -> DataFrame:
    """(vec_id, label, x, code, bounds, stamps, error, scans) against the last codebooks."""
    width, groups = books.history[0].shape[2], len(books.groups)
    first = "code" not in state.columns
    fallen = books.fallen()

    def run(batches):
        for b in batches:
            n = b.num_rows
            x = matrix(b.column("x"), np.int32, parts * width).reshape(n, parts, width).astype(np.int64)
            if first:
                code, bounds, stamps, error = assign_first(x, books)
                scans = np.full(n, parts * groups)
            else:
                held = [matrix(b.column(c), t, w) for c, t, w in (("code", np.uint8, parts), ("bounds", np.float16, parts * groups), ("stamps", np.uint8, parts * groups))]
                code, bounds, stamps, error, scans = assign_again(x, books, held[0], held[1].reshape(n, parts, groups), held[2].reshape(n, parts, groups), fallen)
            columns = [b.column("vec_id"), b.column("label"), b.column("x"), blobs(code), blobs(bounds.reshape(n, -1)), blobs(stamps.reshape(n, -1)), pa.array(error.sum(axis=1)), pa.array(scans, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "x", "code", "bounds", "stamps", "error", "scans"])

    ids = ", ".join(f"{c} {type_of(state, c)}" for c in ("vec_id", "label"))
    return map_batches(state, run, f"{ids}, x binary, code binary, bounds binary, stamps binary, error long, scans long")


def _updated(state: DataFrame, books: Codebooks, parts: int) -> np.ndarray:
    """Entries replaced by the floored mean of their parts; unused entries stay."""
    entries, width = books.history[-1].shape[1:]

    def run(batches):
        sums, count = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for b in batches:
            x = matrix(b.column("x"), np.int32, parts * width).reshape(-1, width).astype(np.int64)
            at = (matrix(b.column("code"), np.uint8, parts).astype(np.int64) + entries * np.arange(parts)).ravel()
            order = np.argsort(at, kind="stable")
            used, starts = np.unique(at[order], return_index=True)
            if len(used):
                sums[used] += np.add.reduceat(x[order], starts, axis=0)
                count += np.bincount(at, minlength=len(count))
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(count[used], pa.int64()), pa.array(sums[used].tolist(), pa.list_(pa.int64()))], names=["slot", "n", "sums"])

    partial = map_batches(state.select("x", "code"), run, "slot long, n long, sums array<long>")
    added = partial.groupBy("slot").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)))
    new = books.history[-1].reshape(-1, width).copy()
    for r in added.collect():
        new[r.slot] = [int(r[f"s{i}"]) // r.n for i in range(width)]
    return new.reshape(parts, entries, width)


def compress(rows: DataFrame, vector: str = "embedding", parts: int = 16, entries: int = 64, rounds: int = 2, groups: int = 4) -> tuple[DataFrame, Codebooks | None]:
    """``rows(vec_id, label, vector)`` -> ((vec_id, label, code, error, scans) of every complete row, codebooks).

    ``code`` is binary, an entry's index a part; ``error`` the squared distances added up; ``scans`` the groups that
    the last assignment measured exactly for the row (of parts x groups).
    """
    if not 0 < entries <= 256:
        raise ValueError("codes hold 1 to 256 entries")
    rows = rows.select("vec_id", "label", vector).where(complete(F.col(vector)))
    dims = dimension(rows, vector)
    width = max(1, -(-dims // parts))
    packed = _packed(rows, vector, dims, parts * width - dims)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), vector).limit(entries)
    start = [np.frombuffer(r.x, np.int32) for r in _packed(first, vector, dims, parts * width - dims).collect()]
    if not start:
        return packed.select("vec_id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"), F.lit(None).cast("long").alias("scans")), None
    book = np.array(start, np.int64).reshape(len(start), parts, width).transpose(1, 0, 2)
    books = Codebooks([book], [g for g in np.array_split(np.arange(len(start)), groups) if len(g)])
    state = materialize(_assigned(packed, books, parts), "vector_codes")
    for step in range(rounds):
        books.history.append(_updated(state, books, parts))
        done = _assigned(state, books, parts)
        state = materialize(done.select("vec_id", "label", "code", "error", "scans") if step == rounds - 1 else done, "vector_codes")
    return state.select("vec_id", "label", "code", "error", "scans"), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``: the errors of all rows with the same label, nulls together."""
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error")).withColumnRenamed("label", "of_label")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")


def _oracle(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """The same result in DuckDB SQL, every part against every entry."""
    book = f"""b0 AS (SELECT p, e, x AS c FROM x JOIN (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, rid) - 1 AS e FROM k) USING (rid) WHERE e < {entries})"""
    steps = [book]
    for t in range(rounds + 1):
        steps.append(f"""a{t} AS (SELECT rid, p, m // {entries} AS d, m % {entries} AS e FROM (
  SELECT rid, p, min((list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c))::BIGINT * {entries} + e) AS m FROM x JOIN b{t} USING (p) GROUP BY rid, p))""")
        if t < rounds:
            steps.append(f"""b{t + 1} AS (SELECT p, e, coalesce(n.c, b{t}.c) AS c FROM b{t} LEFT JOIN (
  SELECT p, e, list(v ORDER BY i) AS c FROM (SELECT p, e, i, floor(sum(x[i]) / count(*)) AS v FROM a{t} JOIN x USING (rid, p), (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM x))) AS i) GROUP BY p, e, i) GROUP BY p, e) n USING (p, e))""")
    joined = ",\n".join(steps)
    return f"""WITH k AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label, list_transform(embedding, lambda v: floor(256 * v::DOUBLE)) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
x AS (SELECT rid, p, list_slice(q, p * (len(q) // {parts}) + 1, (p + 1) * (len(q) // {parts})) AS x FROM k, (SELECT unnest(range({parts})) AS p)),
{joined},
coded AS (SELECT rid, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY rid),
total AS (SELECT sha256(string_agg(v::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM (SELECT p, e, unnest(c) AS v, generate_subscripts(c, 1) AS i FROM b{rounds}))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded JOIN k USING (rid), total"""


ORACLE = _oracle()
