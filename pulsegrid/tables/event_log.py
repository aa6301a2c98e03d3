"""An append-only event table whose small files are compacted behind a snapshot pointer.

Appends add files to ``events/`` and nothing else. ``compact`` merges the last snapshot and the files present into a new folder,
in buckets by ``experiment_id``, and then publishes a pointer that names the folder and the files it covers. Readers take
the newest pointer's folder and the files that it does not cover, so an append during a compaction is kept, a compaction that dies
changes nothing, and of two at once one wins. Covered files and the folder before stay until the next compaction, for readers that have listed them already.
A reader of one experiment opens its bucket only.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 16
#: Files beside the snapshot from which on an append compacts.
COMPACT_FILES = 100


def _store(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    """File names in a folder; none if there is no folder."""
    store, p = _store(spark, path)
    if not store.exists(p):
        return []
    return sorted(n for n in (s.getPath().getName() for s in store.listStatus(p) if s.isFile()) if not n.startswith(("_", ".")))


def _pointer(spark: SparkSession, root: str) -> dict:
    """The newest pointer: version, folder, covered files."""
    versions = [int(n.split(".")[0]) for n in _names(spark, f"{root}/pointers")]
    if not versions:
        return {"version": 0, "folder": None, "covers": [], "before": None}
    text = spark.read.option("wholetext", "true").text(f"{root}/pointers/{max(versions):09d}.json").first()[0]
    return json.loads(text)


def bucket_of(experiment_id: Column) -> Column:
    return F.pmod(F.xxhash64(experiment_id), F.lit(BUCKETS)).cast("int")


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        store, p = _store(spark, path)
        store.delete(p, True)


def event_files(spark: SparkSession, root: str) -> tuple[str | None, list[str]]:
    """(folder of the snapshot, files beside it)."""
    pointer = _pointer(spark, root)
    covered = set(pointer["covers"])
    return pointer["folder"], [f"{root}/events/{n}" for n in _names(spark, f"{root}/events") if n not in covered]


def read_events(spark: SparkSession, root: str, schema: T.StructType, experiment_id: str | None = None, skip_corrupt: bool = False) -> DataFrame:
    """All events, or those of one experiment."""
    folder, fresh = event_files(spark, root)
    reader = spark.read.option("ignoreCorruptFiles", str(skip_corrupt).lower())
    out = spark.createDataFrame([], schema)
    if fresh:
        out = reader.schema(schema).parquet(*fresh)
    if folder:
        old = reader.schema(T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])).parquet(f"{root}/{folder}")
        if experiment_id is not None:
            old = old.where(F.col("_bucket") == bucket_of(F.lit(experiment_id)))
        out = out.unionByName(old.drop("_bucket"))
    return out if experiment_id is None else out.where(F.col("experiment_id") == experiment_id)


def compact(spark: SparkSession, root: str, schema: T.StructType) -> bool:
    """Merge the snapshot and the files beside it; False if there was nothing to merge or another compaction came first."""
    before = _pointer(spark, root)
    present = _names(spark, f"{root}/events")
    if not set(present) - set(before["covers"]):
        return False
    folder = f"snapshots/{uuid.uuid4().hex}"
    # what the last pointer covers is in its snapshot
    fresh = [f"{root}/events/{n}" for n in present if n not in set(before["covers"])]
    rows = spark.read.schema(schema).parquet(*fresh)
    if before["folder"]:
        rows = rows.unionByName(spark.read.schema(schema).parquet(f"{root}/{before['folder']}").drop("_bucket"))
    rows.withColumn("_bucket", bucket_of(F.col("experiment_id"))).repartition(BUCKETS, "_bucket").write.partitionBy("_bucket").parquet(f"{root}/{folder}")
    version = before["version"] + 1
    text = json.dumps({"version": version, "folder": folder, "covers": present, "before": before["folder"]})
    store, place = _store(spark, f"{root}/pointers/{version:09d}.json")
    _, draft = _store(spark, f"{root}/pointers/.{uuid.uuid4().hex}")
    try:
        out = store.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        # a rename does not replace a file that is there
        won = not store.exists(place) and store.rename(draft, place)
    except Py4JJavaError:
        won = False
    if not won:
        _delete(spark, [f"{root}/{folder}", draft.toString()])
        return False
    _delete(spark, [f"{root}/events/{n}" for n in before["covers"]])
    if before.get("before"):
        _delete(spark, [f"{root}/{before['before']}"])
    return True


def compact_if_many(spark: SparkSession, root: str, schema: T.StructType, files: int = COMPACT_FILES) -> None:
    if len(event_files(spark, root)[1]) > files:
        compact(spark, root, schema)
