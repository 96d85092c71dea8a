"""Data checks.  Each returns the failing rows, so an empty result means
the check passed and a non-empty one can be written for inspection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentflow.functions.columns import any_null


def not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with a NULL in any required column."""
    return df.filter(any_null(cols))


def valid_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows that pass ``not_null`` (put in front of merges)."""
    return df.filter(~any_null(cols))


def unique_key(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count.  Keys with a NULL
    part are left out, as a unique constraint does."""
    return (
        df.filter(~any_null(cols))
        .groupBy(*cols)
        .agg(F.count("*").alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def check_passes(failing: DataFrame) -> bool:
    """True when a check returned no rows (one short job, no collect)."""
    return failing.isEmpty()


def check_report(df: DataFrame, table: str, not_null_cols: list[str] = (), key: list[str] | None = None) -> DataFrame:
    """One row per check of a table: ``(table_name, check_name, columns,
    failing_rows)``.  All NULL checks run in one aggregate pass; the key
    check is one grouped count (map-side combined), reporting the number of
    rows whose key occurs more than once."""
    spark = df.sparkSession
    schema = "table_name STRING, check_name STRING, columns STRING, failing_rows BIGINT"
    parts = []
    if not_null_cols:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null_cols])
        parts.append(
            counts.select(
                F.explode(
                    F.array(
                        *[
                            F.struct(
                                F.lit(table).alias("table_name"),
                                F.lit("not_null").alias("check_name"),
                                F.lit(c).alias("columns"),
                                F.col(c).cast("bigint").alias("failing_rows"),
                            )
                            for c in not_null_cols
                        ]
                    )
                ).alias("r")
            ).select("r.*")
        )
    if key:
        dup = unique_key(df, key).agg(F.coalesce(F.sum("occurrences"), F.lit(0)).cast("bigint").alias("failing_rows"))
        parts.append(
            dup.select(
                F.lit(table).alias("table_name"),
                F.lit("unique_key").alias("check_name"),
                F.lit(",".join(key)).alias("columns"),
                "failing_rows",
            )
        )
    out = spark.createDataFrame([], schema)
    for p in parts:
        out = out.unionByName(p)
    return out


def frame_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that don't occur equally often in both frames, with
    ``left_rows`` and ``right_rows`` (``frame_equal``).

    The order of rows and columns doesn't matter, NULLs equal each other,
    and repeats count.  Both frames go through one aggregation of signed
    counts that combines map-side, so a row that is repeated often is no hot
    key.  Frames whose columns differ in name or type can't be compared and
    raise ``ValueError``."""
    kinds = [{f.name: f.dataType for f in df.schema} for df in (left, right)]
    if kinds[0] != kinds[1] or len(left.columns) != len(right.columns):
        odd = sorted({n for n in {*kinds[0], *kinds[1]} if kinds[0].get(n) != kinds[1].get(n)})
        raise ValueError(f"columns differ: {', '.join(odd) or 'repeated names'}")
    columns = [F.col(f"`{c}`") for c in sorted(left.columns)]
    side = lambda df, l, r: df.select(*columns, F.lit(l).alias("left_rows"), F.lit(r).alias("right_rows"))
    both = side(left, 1, 0).union(side(right, 0, 1))
    counts = both.groupBy(*columns).agg(F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows"))
    return counts.filter("left_rows <> right_rows")


def frames_equal(left: DataFrame, right: DataFrame) -> bool:
    """Whether two frames hold the same rows equally often."""
    return frame_difference(left, right).isEmpty()
