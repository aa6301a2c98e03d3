"""The corpus pipeline: from raw documents to packed token rows.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
reread as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.llm import decontamination, language_id, mixing, packing, simhash
from pulsegrid.llm.common import held_out, materialize


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts without letters and rejected predictions go."""
    return language_id.accept(docs, language_id.fit(docs.where(~held_out())))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (3-word shingles, at most 2 bits apart)."""
    return simhash.keep_first(docs, width=3, radius=2)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources to weights 1, 2, 3; a document comes as many times as the mix repeats it."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mix in packed rows."""
    return packing.packed(docs)


STAGES = [
    ("language ID", languages),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token packing", packed),
]

#: Models, fingerprints and token ids have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
