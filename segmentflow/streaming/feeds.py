"""CSV feeds to tables: columns bound by each file's header, lines that
don't fit to a quarantine table."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from segmentflow.sinks.tables import add_missing_columns, create_if_missing, replace_partitions, stream_writer
from segmentflow.sources.files import aligned, grown_schema, stream_lines

LINEAGE_DDL = "source_file STRING, ingestion_timestamp TIMESTAMP, file_modification_time TIMESTAMP"
FEED_QUARANTINE_DDL = "source_file STRING, raw STRING, reason STRING, rejected BOOLEAN, feed STRING, batch BIGINT"


def land_batch(batch: DataFrame, batch_id: int, schema: StructType, required: list[str] | None, table: str, quarantine: str, feed: str) -> None:
    """One micro-batch of raw lines: its rows to ``table``, and each line
    with a reason (rejected, or with a value that became NULL) to
    ``quarantine``.  Both go to the batch's own partition, which a repeated
    batch replaces."""
    rows = aligned(batch, schema, required).withColumn("batch", F.lit(batch_id).cast("bigint")).checkpoint()
    replace_partitions(rows.filter("reason is not null").withColumn("feed", F.lit(feed)), quarantine)
    replace_partitions(rows.filter("not rejected"), table)


def land_feed(
    lines: DataFrame, schema: StructType, table: str, quarantine: str, feed: str, checkpoint: str, required: list[str] | None = None
) -> StreamingQuery:
    """Start a stream of raw lines (``stream_lines``) into ``table``, the
    declared columns with lineage and the batch; it ends when the files
    that are there now are read.  A table that is there already gains the
    columns it lacks."""
    spark = lines.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    create_if_missing(spark, table, f"{columns}, {LINEAGE_DDL}, batch BIGINT", ["batch"])
    add_missing_columns(spark, table, schema)
    create_if_missing(spark, quarantine, FEED_QUARANTINE_DDL, ["feed", "batch"])
    on_batch = partial(land_batch, schema=schema, required=required, table=table, quarantine=quarantine, feed=feed)
    return stream_writer(lines, checkpoint).foreachBatch(on_batch).start()


def land_inferred(
    spark: SparkSession, path: str, schema_location: str, table: str, quarantine: str, feed: str, checkpoint: str, max_files: int = 1000
) -> StreamingQuery:
    """``land_feed`` without a declared schema (``csv_stream_inferred``): the
    stored one, widened by the columns of the files that are new
    (``grown_schema``).  A file may lack columns; they are NULL."""
    schema = grown_schema(spark, path, schema_location)
    return land_feed(stream_lines(spark, path, max_files), schema, table, quarantine, feed, checkpoint, required=[])
