"""Table writes and table lifecycle on plain Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType


def stream_writer(df: DataFrame, checkpoint: str, available_now: bool = True) -> DataStreamWriter:
    """Append writer with its own checkpoint; ``available_now`` processes
    the backlog in rate-limited micro-batches and then stops."""
    w = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return w.trigger(availableNow=True) if available_now else w


def append_available_now(df: DataFrame, table: str, checkpoint: str) -> None:
    """Append a stream to a table, process what is there, wait for the end
    (``stream_append``).  A second run with no new files adds nothing."""
    q = stream_writer(df, checkpoint).format("parquet").toTable(table)
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced by awaitTermination
        raise q.exception()


def append_path_available_now(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Same as ``append_available_now`` into a folder instead of a table."""
    q = stream_writer(df, checkpoint).format(fmt).start(path)
    q.awaitTermination()


def read_additive(spark: SparkSession, path: str) -> DataFrame:
    """Read a Parquet folder whose files gained columns over time
    (``additive_schema``): the union of all file schemas, missing columns
    as NULL."""
    return spark.read.option("mergeSchema", True).parquet(path)


def overwrite_table(df: DataFrame, name: str, cut_lineage: bool = False) -> None:
    """Replace a table with ``df`` (``overwrite_table``, ``replace_table_as``).

    A table cannot be overwritten while the plan still reads it; with
    ``cut_lineage`` the result is first checkpointed to the shared
    checkpoint folder, which breaks that dependency and survives executor
    loss."""
    if cut_lineage:
        df = df.checkpoint(eager=True)
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def insert_by_name(df: DataFrame, table: str, overwrite: bool = True) -> None:
    """``INSERT [OVERWRITE] t SELECT ...`` with columns matched by name, not
    by position (``insert_overwrite``); columns that ``df`` lacks are NULL."""
    fields = df.sparkSession.table(table).schema.fields
    have = {c.lower() for c in df.columns}
    cols = [F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    df.select(*cols).write.insertInto(table, overwrite=overwrite)


def add_missing_columns(spark: SparkSession, table: str, schema: StructType) -> list[str]:
    """Columns of ``schema`` that a catalog table lacks are added to it;
    rows it has show NULL there (``additive_schema``).  A column it has with
    another type is an error.  Returns the added names."""
    have = {f.name.lower(): f.dataType for f in spark.table(table).schema}
    for f in schema:
        if have.get(f.name.lower(), f.dataType) != f.dataType:
            raise ValueError(f"{table}.{f.name} is {have[f.name.lower()].simpleString()}, not {f.dataType.simpleString()}")
    new = [f for f in schema if f.name.lower() not in have]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return [f.name for f in new]


def append_growing(batch: DataFrame, batch_id: int, table: str, stream: str = "") -> None:
    """One micro-batch into a catalog table that gains the batch's new
    columns first.  The rows go to the partition of the stream and batch,
    which a repeated batch replaces."""
    spark = batch.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema)
    create_if_missing(spark, table, f"{columns}, stream STRING, batch BIGINT", ["stream", "batch"])
    add_missing_columns(spark, table, batch.schema)
    replace_partitions(batch.withColumn("stream", F.lit(stream)).withColumn("batch", F.lit(batch_id).cast("bigint")), table)


def replace_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions of ``table`` that ``df`` has rows of, and no
    others (Spark's dynamic partition overwrite), columns by name."""
    spark = df.sparkSession
    key = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        insert_by_name(df, table)
    finally:
        spark.conf.set(key, old)


def stream_into_growing(df: DataFrame, table: str, checkpoint: str, stream: str = "") -> None:
    """Append a stream to a catalog table, batch by batch, adding columns
    the table lacks; process what is there and wait for the end."""
    stream_writer(df, checkpoint).foreachBatch(lambda batch, i: append_growing(batch, i, table, stream)).start().awaitTermination()


def create_if_missing(spark: SparkSession, name: str, ddl: str, partitioned_by: list[str] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS name (ddl) USING PARQUET``."""
    part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{part}")


def drop_tables(spark: SparkSession, names: list[str]) -> None:
    """``DROP TABLE IF EXISTS`` for each name."""
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def preview(df: DataFrame, n: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows for a look; ordered when keys are given so the
    preview is repeatable (``preview``, ``limit_n``)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
