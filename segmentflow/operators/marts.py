"""Derived tables: main table, per-segment fan-out, daily orders, zone sums,
ingest status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentflow.config import broadcast_limit
from segmentflow.functions.columns import epoch_to_date

SALTS = 32
ROW_OVERHEAD = 32  # bytes of a row besides its values, for size checks


def active_segments(memberships: DataFrame, key: str = "email") -> DataFrame:
    """Sorted list of active segments per contact (``collect_list_by_key``).

    The list of one contact is bounded by the number of segments, and the
    aggregation combines map-side, so a contact in every segment is no hot
    spot.  Sorted, because ``collect_list`` order is not defined.
    """
    return (
        memberships.filter(F.col("is_active"))
        .groupBy(key)
        .agg(F.sort_array(F.collect_list("segment")).alias("list_of_segments"))
    )


def main_table(contacts: DataFrame, memberships: DataFrame, key: str = "email") -> DataFrame:
    """Contacts LEFT JOIN their active segments.  A contact without an
    active segment gets a NULL list, not an empty one."""
    joined = contacts.join(active_segments(memberships, key), key, "left")
    return joined.select(*contacts.columns, "list_of_segments")


def join_listed(rows: DataFrame, listed: DataFrame, key: str, salts: int = SALTS) -> DataFrame:
    """``rows`` equi-joined to ``listed`` (one row per ``key``), where one
    key may hold most of the rows.

    The list's bytes are measured.  Up to Spark's broadcast limit the list
    is broadcast and ``rows`` stay where they are.  Beyond it both sides are
    shuffled by the key and a salt: a row's salt is a hash of the row, and
    the list is repeated for each salt, so a hot key is joined by ``salts``
    tasks.  ``rows`` are never the side that is broadcast."""
    spark = rows.sparkSession
    width = F.octet_length(F.to_json(F.struct(*listed.columns)))
    size = listed.agg(F.sum(width + ROW_OVERHEAD)).first()[0] or 0
    if size <= broadcast_limit(spark):
        return rows.join(F.broadcast(listed), key)
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
    spread = listed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", salt).join(spread.hint("merge"), [key, "_salt"]).drop("_salt")


def exploded_segments(main: DataFrame, list_col: str) -> DataFrame:
    """One row per contact and distinct segment of its list; a NULL list
    gives none."""
    keep = [c for c in main.columns if c != list_col]
    return main.select(*keep, F.explode(F.array_distinct(F.col(list_col))).alias("segment"))


def segment_fanout(main: DataFrame, segments: DataFrame, list_col: str = "list_of_segments") -> DataFrame:
    """One row per (contact, listed segment) the contact belongs to.

    The reference filters the main table once per segment on the driver.
    Here the list is exploded once and equi-joined to the segment list
    (``join_listed``), instead of a nested-loop ``array_contains`` join.
    Contacts without a list belong to no segment.
    """
    listed = segments.select("segment").filter("segment is not null").distinct()
    exploded = exploded_segments(main, list_col)
    return join_listed(exploded, listed, "segment").select(*exploded.columns)


def orders_raw(df: DataFrame) -> DataFrame:
    """Order model: customer, order date from epoch text, order number."""
    return df.select(
        "customer_name",
        epoch_to_date(F.col("order_datetime")).alias("order_date"),
        F.col("order_number").cast("bigint").alias("order_number"),
    )


def orders_daily(
    df: DataFrame,
    date_range: tuple[str, str] | None = None,
    date_col: str = "order_date",
) -> DataFrame:
    """Orders per day.  ``date_range`` is the half-open development window
    ``[start, end)``; pass ``None`` (production) to count all days.  The
    filter is a plain predicate, so it reaches the Parquet scan."""
    if date_range is not None:
        lo, hi = date_range
        df = df.filter((F.col(date_col) >= F.lit(lo).cast("date")) & (F.col(date_col) < F.lit(hi).cast("date")))
    return df.groupBy(F.col(date_col).alias("order_date")).agg(F.count("*").alias("number_of_orders"))


def sum_by_group(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Total of ``value`` per ``key`` (fare per pickup zip)."""
    return df.groupBy(key).agg(F.sum(value).alias(name))


def ingest_status(added: DataFrame, removed: DataFrame, file_col: str = "source_file",
                  time_col: str = "ingestion_timestamp") -> DataFrame:
    """Files processed and last processing time per feed type."""
    both = added.select(F.lit("add").alias("file_type"), file_col, time_col).unionByName(
        removed.select(F.lit("remove").alias("file_type"), file_col, time_col)
    )
    return both.groupBy("file_type").agg(
        F.countDistinct(file_col).alias("file_count"),
        F.max(time_col).alias("last_processed"),
    )
