"""REG-01..04: model registry.

Every save writes its rows to a folder of its own (any schema) and appends one row to a
small metadata table; a delete appends a tombstone. A save is live while its time is after
the tombstones of its name and version, so a deleted version can be saved again. Nothing
is rewritten, so concurrent writers do not meet. Loads read one folder and fail on a
damaged file; only the listing goes on without an unreadable entry, with a warning.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.tables.listing import path_exists, read_listing

META = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("saved_at", T.TimestampNTZType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("rows", T.LongType()),
        T.StructField("n_fitted", T.LongType()),
        T.StructField("folder", T.StringType()),
    ]
)
TOMB = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("deleted_at", T.TimestampNTZType()),
    ]
)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def save_model(models: DataFrame, root: str, name: str, version: str | None = None, metadata: dict[str, str] | None = None) -> tuple[str, str]:
    """REG-01: store the model rows (one per series) under ``name``/``version``
    (default version: ``%Y%m%d_%H%M%S`` of now)."""
    version = version or _now().strftime("%Y%m%d_%H%M%S")
    folder = f"models/{quote(name, safe='')}/{quote(version, safe='')}-{uuid.uuid4().hex}"
    out = models.drop("version") if "version" in models.columns else models
    fitted = F.count_if(F.col("status") == "ok") if "status" in out.columns else F.count(F.lit(1))
    seen = Observation()
    out.observe(seen, F.count(F.lit(1)).alias("rows"), fitted.alias("n_fitted")).write.parquet(f"{root}/{folder}")
    counts = seen.get
    row = (name, version, _now(), {str(k): str(v) for k, v in (metadata or {}).items()}, counts["rows"], counts["n_fitted"], folder)
    models.sparkSession.createDataFrame([row], META).coalesce(1).write.mode("append").parquet(f"{root}/metadata")
    return name, version


def _live(spark: SparkSession, root: str, meta: DataFrame) -> DataFrame:
    """The newest save of every (name, version) that was not deleted after it."""
    if path_exists(spark, f"{root}/tombstones"):
        tombs = spark.read.schema(TOMB).parquet(f"{root}/tombstones").groupBy("model_name", "version").agg(F.max("deleted_at").alias("deleted_at"))
        meta = meta.join(tombs, ["model_name", "version"], "left").where(F.col("deleted_at").isNull() | (F.col("saved_at") > F.col("deleted_at")))
    last = F.max_by(F.struct("saved_at", "metadata", "rows", "n_fitted", "folder"), F.struct("saved_at", "folder"))
    return meta.groupBy("model_name", "version").agg(last.alias("s")).select("model_name", "version", "s.*")


def load_model(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    """REG-02: rows of one saved model (latest save when no version is given), read from its folder only."""
    if not path_exists(spark, f"{root}/metadata"):
        raise FileNotFoundError(f"no model {name!r}")
    meta = _live(spark, root, spark.read.schema(META).parquet(f"{root}/metadata")).where(F.col("model_name") == name)
    if version is not None:
        meta = meta.where(F.col("version") == version)
    found = meta.orderBy(F.desc("saved_at"), F.desc("version")).first()
    if found is None:
        raise FileNotFoundError(f"no model {name!r} {version or ''}")
    return spark.read.parquet(f"{root}/{found.folder}").withColumns({"model_name": F.lit(name), "version": F.lit(found.version), "saved_at": F.lit(found.saved_at.isoformat(sep=" ")).cast("timestamp_ntz")})


def list_checkpoints(spark: SparkSession, root: str, name: str | None = None) -> DataFrame:
    """REG-03: one row per live (name, version), newest first; AGG-07 counts fitted rows."""
    live = _live(spark, root, read_listing(spark, f"{root}/metadata", META))
    if name is not None:
        live = live.where(F.col("model_name") == name)
    return live.select("model_name", "version", "saved_at", "metadata", "rows", "n_fitted").orderBy(F.col("saved_at").desc(), "model_name", "version")


def delete_checkpoint(spark: SparkSession, root: str, name: str, version: str) -> bool:
    """REG-04: tombstone one (name, version); False when it does not exist."""
    if list_checkpoints(spark, root, name).where(F.col("version") == version).isEmpty():
        return False
    spark.createDataFrame([(name, version, _now())], TOMB).coalesce(1).write.mode("append").parquet(f"{root}/tombstones")
    return True
