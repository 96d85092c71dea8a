"""Profiles of loaded data: NULLs per column, rows per group, rows and
bytes per source file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentflow.functions.columns import null_count


def null_profile(df: DataFrame, by: list[str] | str | None, cols: list[str], key: str | None = None) -> DataFrame:
    """Per group (or overall): rows, non-NULL keys and the NULL count of
    each column in ``cols`` (``null_<col>``).  One pass, combined map-side."""
    by = [by] if isinstance(by, str) else list(by or [])
    aggs = [F.count("*").alias("records")]
    if key is not None:
        aggs.append(F.count(key).alias(f"non_null_{key}"))
    aggs += [null_count(c).alias(f"null_{c}") for c in cols]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def count_by(df: DataFrame, cols: list[str], name: str = "count") -> DataFrame:
    """Rows per group (``count_by_two``)."""
    return df.groupBy(*cols).agg(F.count("*").alias(name))


def with_source_file(df: DataFrame) -> DataFrame:
    """Attach path and size of the file each row came from.  Only valid on
    a DataFrame read straight from files."""
    return df.withColumn("_file_path", F.col("_metadata.file_path")).withColumn(
        "_file_size", F.col("_metadata.file_size")
    )


def file_inventory(df: DataFrame) -> DataFrame:
    """Rows and bytes per source file of a file-based DataFrame."""
    return (
        with_source_file(df)
        .groupBy(F.col("_file_path").alias("file_path"))
        .agg(F.count("*").alias("records"), F.max("_file_size").alias("size_bytes"))
    )


def inventory_totals(inventory: DataFrame) -> DataFrame:
    """Files, total rows and bytes, and per-file means of an inventory."""
    return inventory.agg(
        F.count("*").alias("files"),
        F.sum("records").alias("total_records"),
        F.sum("size_bytes").alias("total_bytes"),
        F.avg("records").alias("avg_records_per_file"),
        F.avg("size_bytes").alias("avg_bytes_per_file"),
    )
