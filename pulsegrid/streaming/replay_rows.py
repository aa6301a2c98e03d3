"""SRC-05: stored rows replayed in chunks of a fixed number of rows, by a streaming source whose offsets are row ordinals.

``stage_rows`` writes a frame once in the order of ``(ts, seq, series_id)`` with exact ordinals, as small files, and an index of the files'
ordinal ranges. ``replay_rows`` streams them: every micro-batch is the next slice of ``rows`` ordinals, whatever the files. Executors read
the files of a slice (pyarrow, any file system it knows); the driver only knows the index. After a restart the source goes on
after the last slice in the checkpoint.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from pulsegrid.frame import KEY, ORDER
from pulsegrid.plans.blocked import rank_within
from pulsegrid.session import ship_package

NAME = "pulsegrid_rows"
#: Rows of a staged file, at most.
FILE_ROWS = 5_000


class Slice(InputPartition):
    def __init__(self, path: str, begin: int, end: int):
        self.path, self.begin, self.end = path, begin, end


class RowsReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.index = json.loads(options["index"])  # (path, first ordinal, rows), ascending
        self.rows = int(options["rows"])
        self.columns = json.loads(options["columns"])
        self.total = sum(n for _, _, n in self.index)
        self.planned = int(options.get("start", 0))

    def initialOffset(self) -> dict:
        return {"row": 0}

    def latestOffset(self) -> dict:
        return {"row": min(self.total, self.planned + self.rows)}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        lo, hi = start["row"], end["row"]
        self.planned = max(self.planned, hi)
        return [Slice(path, max(lo, first), min(hi, first + n)) for path, first, n in self.index if first < hi and first + n > lo]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(partition.path)
        with store.open_input_file(path) as f:
            table = pq.read_table(f)
        inside = pc.and_(pc.greater_equal(table["row_no"], partition.begin), pc.less(table["row_no"], partition.end))
        yield from table.filter(inside).sort_by("row_no").select(self.columns).combine_chunks().to_batches()

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class RowsSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return self.options["schema"]

    def streamReader(self, schema) -> RowsReader:
        return RowsReader(dict(self.options))


def stage_rows(df: DataFrame, path: str, file_rows: int = FILE_ROWS, plan: str = "auto") -> None:
    """Write canonical rows with ``row_no``, their place in the order of ``(ts, seq, series_id)``."""
    one = df.select(F.lit("all").alias(KEY), F.col(KEY).alias("_sid"), *[c for c in df.columns if c != KEY])
    placed = rank_within(one, "row_no", [*ORDER, "_sid"], plan).withColumn(KEY, F.col("_sid")).drop("_sid")
    n = placed.agg(F.max("row_no").alias("n")).first()["n"]
    if n is None:  # one file without rows keeps the columns
        placed.coalesce(1).write.parquet(f"{path}/rows")
    else:
        filed = placed.withColumn("_file", F.floor(F.col("row_no") / file_rows))
        filed.repartition(min(n // file_rows + 1, 10_000), "_file").sortWithinPartitions("row_no").write.partitionBy("_file").parquet(f"{path}/rows")
    staged = df.sparkSession.read.parquet(f"{path}/rows").groupBy(F.input_file_name().alias("path"))
    staged.agg(F.min("row_no").alias("first"), F.count(F.lit(1)).alias("rows")).write.parquet(f"{path}/index")


def _reached(spark: SparkSession, checkpoint: str | None) -> int:
    """End of the last slice in a checkpoint's offset log; 0 for a new one."""
    if checkpoint is None:
        return 0
    log = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/offsets")
    store = log.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(log) or not store.listStatus(log):
        return 0
    ends = [json.loads(r.value)["row"] for r in spark.read.text(f"{checkpoint}/offsets").where(F.col("value").startswith('{"row"')).collect()]
    return max(ends, default=0)


def replay_rows(spark: SparkSession, path: str, rows: int = 50, checkpoint: str | None = None) -> DataFrame:
    """A stream of staged rows in micro-batches of exactly ``rows`` rows (the last may be smaller)."""
    ship_package(spark)
    spark.dataSource.register(RowsSource)
    index = [(r["path"], r["first"], r["rows"]) for r in spark.read.parquet(f"{path}/index").orderBy("first").collect()]
    schema = spark.read.parquet(f"{path}/rows").drop("_file").schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"index": json.dumps(index), "rows": rows, "columns": json.dumps(schema.fieldNames()), "schema": ddl, "start": _reached(spark, checkpoint)}
    return spark.readStream.format(NAME).options(**options).load()


def run_slices(stream_out: DataFrame, checkpoint: str, out_path: str | None = None, foreach=None) -> None:
    """Run a query over ``replay_rows`` until the last staged row is through (its source takes a slice a trigger)."""
    w = stream_out.writeStream.option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds")
    q = w.foreachBatch(foreach).start() if foreach is not None else w.outputMode("append").format("parquet").option("path", out_path).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    if q.exception() is not None:
        raise q.exception()
