"""Incremental merge into a keyed table that rewrites only the partitions a
micro-batch touches (``foreach_batch_merge``).

The table is a Parquet folder partitioned by a hash of the merge key.  A
micro-batch reads and rewrites the partitions its own keys hash to, by
Spark's dynamic partition overwrite; all other files stay as they are, so a
batch costs what it touches and not the whole state.

Each batch has three steps, and a log (``_log``) of the finished ones:

1. ``fold(touched rows, batch)`` is written to the ``pending`` folder;
2. the pending rows replace their partitions of the table;
3. the batch is done.

A batch that is tried again goes on behind its last logged step.  Step 2
may have been cut off within a partition; as the pending rows are complete
and only replaced by the next batch's, doing it again restores every
partition.  So each batch is applied exactly once, whatever the fold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from segmentflow.sinks.tables import stream_writer
from segmentflow.sources.files import path_not_found

LOG = "stream STRING, batch BIGINT, step STRING"
BUCKET = "_bucket"


class PartitionedState:
    """A keyed table below ``folder`` with ``buckets`` partitions.  The
    bucket count belongs to the table and must not change."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, keys: list[str], buckets: int):
        self.spark, self.schema, self.keys, self.buckets = spark, schema, list(keys), buckets
        root = folder.rstrip("/")
        self.table, self.pending, self.log = f"{root}/table", f"{root}/pending", f"{root}/_log"
        self.stored = StructType([*schema.fields, StructField(BUCKET, IntegerType())])

    def _read(self, path: str, schema: StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except Exception as e:
            if path_not_found(e):
                return self.spark.createDataFrame([], schema)
            raise

    def read(self) -> DataFrame:
        return self._read(self.table, self.stored).drop(BUCKET)

    def bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def step(self, stream: str, batch_id: int) -> set[str]:
        log = self._read(self.log, StructType.fromDDL(LOG))
        return {r.step for r in log.filter((F.col("stream") == stream) & (F.col("batch") == batch_id)).collect()}

    def _logged(self, stream: str, batch_id: int, step: str) -> None:
        row = self.spark.createDataFrame([(stream, int(batch_id), step)], LOG)
        row.coalesce(1).write.mode("append").parquet(self.log)

    def apply(self, batch: DataFrame, batch_id: int, fold: Callable[[DataFrame, DataFrame], DataFrame], stream: str) -> None:
        """Fold one micro-batch, at most once.  ``fold`` gets the rows of the
        touched partitions and must keep their keys; rows with a key of
        another partition must not depend on it."""
        done = self.step(stream, batch_id)
        if "done" in done:
            return
        if "pending" not in done:
            # At most ``buckets`` numbers.
            touched = [r[0] for r in batch.select(self.bucket()).distinct().collect()]
            before = self._read(self.table, self.stored).filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
            after = fold(before, batch).select(*self.schema.names).withColumn(BUCKET, self.bucket())
            after.write.mode("overwrite").parquet(self.pending)
            self._logged(stream, batch_id, "pending")
        rows = self._read(self.pending, self.stored)
        # One file a partition; adaptive execution splits large ones.
        rows = rows.hint("rebalance", BUCKET)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.table)
        self._logged(stream, batch_id, "done")


def merge_stream(df: DataFrame, state: PartitionedState, fold: Callable[[DataFrame, DataFrame], DataFrame], stream: str, checkpoint: str) -> None:
    """Run ``df`` with ``availableNow`` into ``state``; one writer at a time.
    Returns when the backlog is processed."""
    stream_writer(df, checkpoint).foreachBatch(lambda batch, i: state.apply(batch, i, fold, stream)).start().awaitTermination()
