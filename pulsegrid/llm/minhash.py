"""MinHash fingerprints of documents, their likeness, and near-duplicate classes by signature bands.

A text's shingles are its runs of ``WIDTH`` words; a text of fewer words has its runs of ``WIDTH`` characters
instead, or itself if it is shorter still. Shingles are hashed from word hashes by a polynomial, and ``PERMUTATIONS``
universal hash functions (multiply, add, keep the high half) give the signature: the least value of each. The fingerprint keeps the low
byte of each least value, in hexadecimal. Two fingerprints are as alike as their share of equal
bytes, less the share that unequal values give by chance.

Neighbouring documents meet by one range shuffle on the id: within a range rows follow each other, and the last row of a
range meets the first of the next one in a small second step. A row at a time is held, whatever the text's length.

Near-duplicate classes: the fingerprint is cut into ``BANDS`` bands; texts with an equal band meet in Spark. Each is verified
against the least text of its bucket, by the exact Jaccard similarity of the shingle sets; buckets whose texts
are not all of one class after that have the pairs between their classes verified too. So a large bucket of
copies costs one verification a text, and no pair that meets is left undecided unless its class is.

Defined results: null and blank texts have no shingles; their fingerprints are equal to each other only. Descending order of ids
puts null last; rows that share an id follow the hash of their text, and equal rows are interchangeable. A
table of one row is its own next document. An empty table gives an empty result. Classes: equal texts are of one class,
null and blank texts too; class_id is the smallest id, null if all are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import map_batches, materialize, type_of
from pulsegrid.llm.components import components

WIDTH = 5
PERMUTATIONS = 128
#: Bands of ROWS bytes of the fingerprint: a pair of Jaccard similarity 0.8 shares one with probability 0.99995.
BANDS, ROWS = 25, 5
#: Shingles times permutations at once.
BLOCK = 4096
#: Word hashes kept.
KNOWN = 200_000
FILL = np.uint64(np.iinfo(np.uint64).max)
_SEEDED = np.random.Generator(np.random.PCG64(12))
_FACTORS = _SEEDED.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _SEEDED.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
_PLACES = _SEEDED.integers(1, 1 << 63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Words(dict):
    """Hash of each word, computed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 12)
        return h


_words = _Words()


def shingles(text: str | None) -> np.ndarray:
    """32-bit hashes of the shingles in order, as uint64."""
    words = text.encode("utf-8", "surrogatepass").split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < WIDTH:
        line = b" ".join(words).decode("utf-8", "surrogatepass")
        units = np.array([ord(c) for c in line], np.uint64) + np.uint64(1)
    else:
        units = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = max(1, len(units) - WIDTH + 1)
    mixed = np.zeros(n, np.uint64)
    for i in range(min(WIDTH, len(units))):
        mixed += units[i : i + n] * _PLACES[i]
    mixed ^= mixed >> np.uint64(29)
    mixed *= _PLACES[0]
    return mixed >> np.uint64(32)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The low byte of the least value of each permutation."""
    least = np.full(PERMUTATIONS, FILL)
    for at in range(0, len(hashes), BLOCK):
        values = _FACTORS[:, None] * hashes[at : at + BLOCK]
        values += _TERMS[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity, 0 to 1."""
    return float(max(0.0, ((a == b).mean() - 1 / 256) / (1 - 1 / 256)))


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _result(text: str, own: np.ndarray, following: str, theirs: np.ndarray) -> tuple:
    changed = edited(text, following)
    new = own if changed == text else signature(shingles(changed))
    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return len(text), digest, own.tobytes().hex(), new.tobytes().hex(), likeness(own, new), likeness(own, theirs)


_COLUMNS = (("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()))
_SQL = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rows(ids: list, found: list[tuple], id_type, **more) -> pa.RecordBatch:
    columns = list(zip(*found)) or [()] * len(_COLUMNS)
    arrays = [pa.array(ids, id_type), *(pa.array(c, t) for c, (_, t) in zip(columns, _COLUMNS)), *more.values()]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", *(n for n, _ in _COLUMNS), *more])


def with_edits(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every document;
    a document is edited with the next one in descending order of ids, the last with the first."""
    spark = docs.sparkSession
    order = [F.col("doc_id").desc_nulls_last(), "tie", "place"]
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("*", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("place"))
    ranged = keyed.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order).select("doc_id", "text")

    def follow(batches):
        at = TaskContext.get().partitionId()
        previous = None
        kind = None
        for b in batches:
            id_type = b.schema.field("doc_id").type
            ids, found, edges = [], [], []
            for d, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                own = signature(shingles(text))
                if previous is None:
                    edges.append((d, "first", text))
                else:
                    ids.append(previous[0])
                    found.append(_result(previous[1], previous[2], text, own))
                previous = d, text, own
            kind = id_type
            n = len(ids)
            yield _rows(ids, found, id_type, part=pa.array([at] * n, pa.int32()), edge=pa.nulls(n, pa.string()), text=pa.nulls(n, pa.string()))
            if edges:
                yield edge(edges, at, id_type)
        if previous is not None:
            yield edge([(previous[0], "last", previous[1])], at, kind)

    def edge(rows, at, id_type):
        blank = [(None,) * len(_COLUMNS)] * len(rows)
        ids, edges, texts = zip(*rows)
        return _rows(list(ids), blank, id_type, part=pa.array([at] * len(rows), pa.int32()), edge=pa.array(edges, pa.string()), text=pa.array(texts, pa.string()))

    ids = f"doc_id {type_of(docs, 'doc_id')}"
    done = materialize(map_batches(ranged, follow, f"{ids}, {_SQL}, part int, edge string, text string"), "minhash")
    ends = done.where(F.col("edge").isNotNull())
    parts = ends.where("edge = 'first'").select("part")
    # one row a range
    following = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("then"))
    last = ends.where("edge = 'last'").select("doc_id", "part", "text").join(following, "part")
    first = ends.where("edge = 'first'").select(F.col("part").alias("then"), F.col("text").alias("following"))

    def close(batches):
        for b in batches:
            pairs = zip(b.column("text").to_pylist(), b.column("following").to_pylist())
            found = [_result(t, signature(shingles(t)), f, signature(shingles(f))) for t, f in pairs]
            yield _rows(b.column("doc_id").to_pylist(), found, b.schema.field("doc_id").type)

    closed = map_batches(last.join(first, "then").select("doc_id", "text", "following"), close, f"{ids}, {_SQL}")
    return done.where(F.col("edge").isNull()).select(closed.columns).unionByName(closed)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every document."""

    def run(batches):
        for b in batches:
            prints = [signature(shingles(t)).tobytes().hex() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {type_of(docs, 'doc_id')}, fingerprint string")


def _shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, shingles): sorted distinct shingle hashes of one text of each wanted id."""

    def run(batches):
        for b in batches:
            sets = [np.unique(shingles(t)).astype(np.uint32).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(sets, pa.binary())], names=["id", "shingles"])

    rows = docs.select(F.xxhash64("text").alias("id"), "text").join(wanted, "id", "left_semi").dropDuplicates(["id"])
    return map_batches(rows, run, "id long, shingles binary")


def _verified(pairs: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """``pairs(a, b)``, distinct -> those of at least that Jaccard similarity."""

    def run(batches):
        for b in batches:
            good = []
            for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both >= least * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = materialize(_shingle_sets(docs, wanted), "minhash")
    x, y = (sets.select(F.col("id").alias(i), F.col("shingles").alias(s)) for i, s in (("a", "x"), ("b", "y")))
    return map_batches(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y"), run, "a long, b long")


def near_duplicates(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, class_id) of every document: classes of texts linked by a Jaccard similarity of ``least`` or more."""
    docs = docs.select("doc_id", F.when(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.col("text")).otherwise("").alias("text"))

    def run(batches):
        for b in batches:
            prints = [signature(shingles(t)).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("id"), pa.array(prints, pa.binary())], names=["doc_id", "id", "print"])

    prints = materialize(map_batches(docs.withColumn("id", F.xxhash64("text")), run, f"doc_id {type_of(docs, 'doc_id')}, id long, print binary"), "minhash")
    texts = prints.groupBy("id").agg(F.first("print").alias("print"), F.min("doc_id").alias("first"))
    cuts = F.array(*(F.struct(F.lit(i).alias("band"), F.substring("print", ROWS * i + 1, ROWS).alias("key")) for i in range(BANDS)))
    bands = texts.where(F.col("id") != F.xxhash64(F.lit(""))).select("id", F.explode(cuts).alias("c")).select("id", F.xxhash64("c.band", "c.key").alias("bucket"))
    least_of = bands.groupBy("bucket").agg(F.min("id").alias("pivot"), F.count("*").alias("n")).where("n > 1").select("bucket", "pivot")
    met = materialize(bands.join(least_of, "bucket").select("bucket", "pivot", "id"), "minhash")
    direct = materialize(_verified(met.where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct(), docs, least), "minhash")
    root = lambda links: components(links).select(F.col("vertex").alias("of"), "root")
    rooted = met.join(root(direct), F.col("id") == F.col("of"), "left").select("bucket", "pivot", "id", F.coalesce("root", "id").alias("root"))
    mixed = rooted.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("bucket")
    open_ = materialize(rooted.join(mixed, "bucket"), "minhash")
    x, y = open_.select("bucket", F.col("id").alias("a"), F.col("root").alias("ra"), F.col("pivot").alias("p")), open_.select("bucket", F.col("id").alias("b"), F.col("root").alias("rb"))
    across = x.join(y, "bucket").where("a < b and ra <> rb and a <> p").select("a", "b").distinct()
    links = direct.unionByName(_verified(materialize(across, "minhash"), docs, least))
    member = texts.select("id", "first").join(root(materialize(links, "minhash")), F.col("id") == F.col("of"), "left").select("id", "first", F.coalesce("root", "id").alias("root"))
    named = member.groupBy("root").agg(F.min("first").alias("class_id"))
    classes = member.select("id", "root").join(named, "root").select(F.col("id").alias("of"), "class_id")
    return prints.join(classes, F.col("id") == F.col("of")).select("doc_id", "class_id")
