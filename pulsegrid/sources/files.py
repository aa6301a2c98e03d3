"""SRC-01..03 and SNK-01..04: file sources and sinks with explicit schemas.

Datasets are written under a folder with a ``_manifest`` table next to the data:
name, created, format, rows, schema_json and caller metadata (SNK-03). Row counts
come from an ``Observation`` on the write job itself, not a second pass.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.frame import SCHEMA, canonical

FORMATS = ("parquet", "csv", "json")

# text formats keep microseconds (Spark's default NTZ text format stops at millis)
TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _text_options(fmt: str) -> dict[str, str]:
    if fmt == "parquet":
        return {}
    opts = {"timestampNTZFormat": TS_TEXT, "timestampFormat": TS_TEXT}
    if fmt == "csv":
        opts["header"] = "true"
    return opts

SERIES_CSV = T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("value", T.DoubleType())])

MANIFEST = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("created", T.TimestampNTZType()),
        T.StructField("format", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("schema_json", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)


def read_series_csv(spark: SparkSession, path: str, series_id: str = "series", schema: T.StructType = SERIES_CSV) -> DataFrame:
    """SRC-01: CSV with a header, first column the timestamp, one value column."""
    raw = spark.read.schema(schema).options(**_text_options("csv")).csv(path)
    ts_name, v_name = schema.fieldNames()[:2]
    return canonical(raw, series_id=F.lit(series_id), ts=ts_name, value=v_name)


def read_frame(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = SCHEMA) -> DataFrame:
    """SRC-02: read a canonical frame (no schema inference)."""
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format: {fmt}")
    return spark.read.schema(schema).options(**_text_options(fmt)).format(fmt).load(path)


def write_frame(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None, mode: str = "errorifexists") -> None:
    """SNK-01/02/04: CSV (header), Parquet or JSON; optional partition columns."""
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format: {fmt}")
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.options(**_text_options(fmt)).format(fmt).save(path)


def save_dataset(
    df: DataFrame, path: str, name: str, metadata: dict[str, str] | None = None, fmt: str = "parquet"
) -> DataFrame:
    """SNK-02 + SNK-03: write the data and append its manifest row; returns the manifest row."""
    obs = Observation(f"rows_{name}")
    write_frame(df.observe(obs, F.count(F.lit(1)).alias("rows")), f"{path}/data", fmt)
    rows = obs.get["rows"]
    spark = df.sparkSession
    created = datetime.now(timezone.utc).replace(tzinfo=None)
    manifest = spark.createDataFrame(
        [(name, created, fmt, int(rows), df.schema.json(), {str(k): str(v) for k, v in (metadata or {}).items()})],
        MANIFEST,
    )
    manifest.write.mode("append").parquet(f"{path}/_manifest")
    return manifest


def load_dataset(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC-03: read the manifest, dispatch on its format (unknown -> ValueError)."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/_manifest")
    latest = manifest.orderBy(F.col("created").desc()).limit(1).first()
    if latest is None:
        raise FileNotFoundError(path)
    fmt = latest["format"]
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format: {fmt}")
    schema = T.StructType.fromJson(__import__("json").loads(latest["schema_json"]))
    return read_frame(spark, f"{path}/data", fmt, schema), manifest
