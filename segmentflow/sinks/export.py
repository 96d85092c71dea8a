"""Per-segment export (``segment_export``)."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentflow.config import advisory_bytes, ensure_checkpoint_dir
from segmentflow.operators.marts import exploded_segments, join_listed


def segment_files(main: DataFrame, segments: DataFrame, file_bytes: int, list_col: str = "list_of_segments") -> DataFrame:
    """Per listed segment its ``n`` rows, their text ``bytes``, and the
    ``files`` of about ``file_bytes`` they need (0 without members): one
    pass over the main table with map-side sums, checkpointed."""
    ensure_checkpoint_dir(main.sparkSession)
    rows = exploded_segments(main, list_col)
    fields = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in rows.columns if c != "segment"]
    width = reduce(lambda a, b: a + b, fields, F.lit(0)) + len(fields)
    sizes = rows.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("long")).alias("bytes"))
    listed = segments.select("segment").filter("segment is not null").distinct()
    files = F.when(F.col("n").isNull(), 0).otherwise(F.greatest(F.ceil(F.col("bytes") / file_bytes), F.lit(1))).cast("int")
    return listed.join(sizes, "segment", "left").select("segment", "n", "bytes", files.alias("files")).checkpoint()


def export_segments(
    main: DataFrame,
    segments: DataFrame,
    out_dir: str,
    date: str,
    max_records_per_file: int = 5_000_000,
    file_bytes: int | None = None,
) -> DataFrame:
    """Write the members of each listed segment as CSV with a header, one
    folder per segment: ``<out_dir>/date=<date>/segment=<s>/part-*.csv``.

    The reference filters the main table once per segment and pulls each
    result to the driver.  Here a first pass measures the segments
    (``segment_files``) and a second writes them: rows are dealt by segment
    and, in a segment of more than ``file_bytes`` (Spark's advisory
    partition size by default), by a hash of the row to as many tasks as it
    needs files.  A task that gets several of these starts a new file after
    the rows that fill one, and after ``max_records_per_file`` at most.  A listed
    segment without members gets a header-only file.

    Those are written first, and only the last write leaves ``_SUCCESS``: a
    folder without it is incomplete, and the next run replaces it.

    Returns the exported rows (without the segment list column).
    """
    spark = main.sparkSession
    target = os.path.join(out_dir, f"date={date}")
    file_bytes = file_bytes or advisory_bytes(spark)
    planned = segment_files(main, segments, file_bytes)
    n, size = planned.agg(F.sum("n"), F.sum("bytes")).first()
    records = min(max_records_per_file, -(-file_bytes * n // size)) if size else max_records_per_file
    rows = exploded_segments(main, "list_of_segments")
    fields = [c for c in rows.columns if c != "segment"]
    (
        planned.filter("files = 0").select("segment", F.lit(",".join(fields)).alias("value"))
        .write.mode("overwrite")
        .option("sep", "\u0001")  # the header line is one value, not to be quoted
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        .partitionBy("segment")
        .csv(target)
    )
    fan = join_listed(rows, planned.filter("files > 0").select("segment", "files"), "segment")
    fan = fan.withColumn("_file", F.pmod(F.xxhash64(*fields), F.col("files")).cast("int"))
    (
        # A partition of its own for each file; rebalancing joins the small
        # ones again.
        fan.hint("rebalance", "segment", "_file")
        .select(*fields, "segment")
        .write.mode("append")
        .option("header", True)
        .option("maxRecordsPerFile", records)
        .partitionBy("segment")
        .csv(target)
    )
    return fan.select(*fields, "segment")
