"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.plans.lineage import materialize  # noqa: F401  (re-exported for the operators)
from pulsegrid.session import ship_package

#: A word: a run of characters other than ASCII white space. ``bytes.split()`` cuts UTF-8 at the same places.
WORD_RE = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """True where crc32(doc_id as text) mod 4 is 2; false for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8 bytes; none for null."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


#: Rows whose texts are Python objects at once.
ROWS = 1000


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, max(b.num_rows, 1), ROWS):
            yield b.slice(at, ROWS)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` over batches of at most ``ROWS`` rows, with the package shipped to the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(lambda batches: fn(_cut(batches)), schema)


def type_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()
