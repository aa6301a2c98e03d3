"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint bit is 1 if it is set in over half of the 64-bit hashes of the text's word
shingles. Two fingerprints at most ``radius`` bits apart have a common point within half
the radius of each, so every distinct fingerprint emits all variants within
``ceil(radius / 2)`` bits, variants are the shuffle key, and the fingerprints that meet at
one variant are deduplicated and verified by their exact bit distance. A variant is
met by at most 65 fingerprints at radius 2 (the points of the ball around it), however many
documents there are, so no group grows with the data; equal fingerprints are folded first.

For an even radius all fingerprints at one variant are linked pairwise, so links to
the least of them keep every component; an odd radius verifies every pair of the group.

Defined results: null, empty and word-less texts have fingerprint zero, which links like any
other; texts of fewer words than a shingle hash their whole word sequence. Repeated
rows get equal results. A component of null ids only has a null component_id. Where ids are
null or shared by several texts, the first row of a component is told by a hash of the whole row.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from pulsegrid.llm.common import map_batches, materialize, type_of
from pulsegrid.llm.components import components

SEED = 42
#: Shingles whose hashes are counted at once.
BLOCK = 200_000


def fingerprint(text: str | None, width: int = 3) -> int:
    """The fingerprint as a signed 64-bit integer."""
    data = text.encode("utf-8", "surrogatepass").lower() if text else b""  # bytes.lower changes A-Z only
    words = data.split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - width + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED) - (1 << 64 if xxhash.xxh64_intdigest(joined, SEED) >> 63 else 0)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[:n].tolist(), ends[width - 1 :].tolist())
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        ones += np.unpackbits(hashes[at : at + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(docs: DataFrame, width: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) of every whole text, and the long columns ``carry``."""

    def run(batches):
        for b in batches:
            prints = pa.array([fingerprint(t, width) for t in b.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), prints, *map(b.column, carry)], names=["doc_id", "fp", *carry])

    return map_batches(docs.select("doc_id", "text", *carry), run, ", ".join([f"doc_id {type_of(docs, 'doc_id')}", "fp long", *(f"{c} long" for c in carry)]))


def masks(bits: int) -> list[int]:
    """All 64-bit masks with at most ``bits`` ones, signed."""
    found = [sum(1 << i for i in c) for k in range(bits + 1) for c in combinations(range(64), k)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """``prints(fp)``, distinct -> verified links (a, b), a < b, that connect all fingerprints within ``radius`` bits."""
    near = masks(-(-radius // 2))
    # every row becomes many, so rows are spread before; by another expression than they are grouped by, or Spark would leave it out
    spread = prints.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("fp"))
    variants = spread.select("fp", F.explode(F.array(*map(F.lit, near))).alias("mask")).select(F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), "fp")
    met = variants.groupBy("variant").agg(F.array_sort(F.collect_set("fp")).alias("fps")).where(F.size("fps") > 1)
    if radius % 2 == 0:
        pairs = met.select(F.col("fps")[0].alias("a"), F.explode(F.slice("fps", 2, len(near))).alias("b"))
    else:
        pairs = met.select("fps", F.posexplode("fps").alias("i", "a")).select("a", F.explode(F.slice("fps", F.col("i") + 2, len(near))).alias("b"))
    return pairs.distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, root, component_id, *carry): component_id is the smallest doc_id reachable, root the component's least fingerprint."""
    prints = materialize(fingerprints(docs, width, carry), "simhash")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    reached = components(links(classes.select("fp"), radius))
    rooted = classes.join(reached, F.col("fp") == F.col("vertex"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "simhash")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id")).withColumnRenamed("root", "at")
    member = rooted.join(least, F.col("root") == F.col("at")).select(F.col("fp").alias("print"), "root", "component_id")
    return prints.join(member, F.col("fp") == F.col("print")).select("doc_id", "fp", "root", "component_id", *carry)


#: Two hashes of a whole row.
TAGS = ("_tag", "_tag2")


def tags(docs: DataFrame) -> list[Column]:
    """``TAGS`` of the rows of ``docs``: equal for equal rows, and 128 bits tell different ones apart."""
    parts = []
    for f in docs.schema.fields:
        c = F.col(f"`{f.name}`")
        # hashes pass over nulls and know no maps
        parts += [c.isNull(), F.to_json(c) if isinstance(f.dataType, (ArrayType, MapType, StructType)) else c]
    return [F.xxhash64(F.lit(i), *parts).alias(t) for i, t in enumerate(TAGS)]


def keep_first(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that come first in their component: one document of each.

    First is the smallest id, null last, and of rows with that id the one with the least hash of the whole row.
    Of equal rows one stays.
    """
    found = near_duplicates(docs.select("doc_id", "text", *tags(docs)), width, radius, TAGS)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *TAGS)
    firsts = found.groupBy("root").agg(F.min(place).alias("_first")).select("_first", F.col("root").alias("_first_root"))
    mine = F.col("row.doc_id").eqNullSafe(F.col("_first.doc_id"))
    for t in TAGS:
        mine = mine & (F.col(t) == F.col(f"_first.{t}"))
    kept = docs.select(F.struct("*").alias("row"), *tags(docs)).join(firsts, mine)
    return kept.dropDuplicates(["_first_root"]).select("row.*")
