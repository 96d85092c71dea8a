"""Incrementally maintained aggregates (the order models' materialized
view over a streaming table).

The stream is aggregated in Spark's state store: each trigger adds the new
files' counts to the running counts and emits the whole result (one row per
group), which replaces the published copy.  State and output are bounded
by the number of groups (days), not by the number of orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentflow.operators.marts import orders_raw


def daily_counts_stream(orders: DataFrame, date_range: tuple[str, str] | None = None) -> DataFrame:
    """Streaming ``orders_daily``: running count of orders per day."""
    raw = orders_raw(orders)
    if date_range is not None:
        lo, hi = date_range
        raw = raw.filter((F.col("order_date") >= F.lit(lo).cast("date")) & (F.col("order_date") < F.lit(hi).cast("date")))
    return raw.groupBy("order_date").agg(F.count("*").alias("number_of_orders"))


KEPT_VERSIONS = 2  # the newest, and the one a reader may have begun


def _complete(spark: SparkSession, path: str) -> list:
    """The complete versions, oldest first.  A version counts once Spark's
    commit marker is there, so a reader never sees half of one."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")
    found = fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(fs_path) or []
    return sorted((f.getPath().getParent() for f in found), key=lambda p: p.toString())


def maintain_view(agg: DataFrame, path: str, checkpoint: str) -> None:
    """Run a streaming aggregate with ``availableNow`` in complete mode and
    publish each trigger's full result as a version of its own below
    ``path`` (Parquet); ``read_view`` gives the newest complete one.  The
    last ``KEPT_VERSIONS`` are kept.

    The number of state partitions is the session's shuffle width on the
    first run of a checkpoint."""

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/version={batch_id:012d}")
        for old in _complete(spark, path)[:-KEPT_VERSIONS]:
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)

    q = (
        agg.writeStream.outputMode("complete")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def read_view(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version."""
    found = _complete(spark, path)
    if not found:
        raise ValueError(f"no complete version in {path}")
    return spark.read.parquet(found[-1].toString())
