"""Small literal inputs: segment lists and local rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The segment list created by the reference job.
DEFAULT_SEGMENTS = ["blue", "green", "red"]


def inline_values(spark: SparkSession, values: list[str] | None = None, name: str = "segment") -> DataFrame:
    """``VALUES (...) AS data(segment)``: a literal one-column table."""
    vals = DEFAULT_SEGMENTS if values is None else values
    body = ", ".join("('" + v.replace("'", "''") + "')" for v in vals)
    return spark.sql(f"SELECT * FROM VALUES {body} AS data({name})")


def local_rows(spark: SparkSession, rows, schema=None) -> DataFrame:
    """Rows (tuples with a schema or column names) or a pandas frame."""
    return spark.createDataFrame(rows, schema)
