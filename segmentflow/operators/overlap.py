"""Key overlap between source files: shared keys per file pair, first
sightings, duplicate rate, keys not seen before.

All of these start from the distinct (file, key) pairs, which collapses a
key repeated inside a file before anything is shuffled by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentflow.operators.dedup import latest_per_key


def file_keys(df: DataFrame, file_col: str, key_col: str) -> DataFrame:
    """Distinct (file, key) pairs with a non-NULL key (``dropna``)."""
    return (
        df.filter(F.col(key_col).isNotNull() & F.col(file_col).isNotNull())
        .select(F.col(file_col).alias("file"), F.col(key_col).alias("key"))
        .distinct()
    )


def all_pairs(df: DataFrame, file_col: str) -> DataFrame:
    """All unordered pairs of distinct files (``file_a < file_b``).

    The pair list is the output itself (files^2 / 2 rows) and grows with
    the number of files, never with rows; Spark broadcasts the file list
    when its measured bytes are few.  Nothing else here lists all pairs:
    ``pair_counts`` has the pairs that share a key, ``pair_overlap_stats``
    counts the others.
    """
    files = df.filter(F.col(file_col).isNotNull()).select(F.col(file_col).alias("f")).distinct()
    a, b = files.alias("a"), files.alias("b")
    return a.join(b, F.col("a.f") < F.col("b.f")).select(
        F.col("a.f").alias("file_a"), F.col("b.f").alias("file_b")
    )


def pair_counts(df: DataFrame, file_col: str, key_col: str) -> DataFrame:
    """Shared keys for each file pair that shares at least one key.

    Keys are first grouped by the exact set of files they occur in (their
    signature); identical signatures are counted once with a weight, and
    only the distinct signatures are expanded to file pairs.  The work
    therefore grows with the number of distinct signatures rather than
    with keys.  The expansion is two generators with a shuffle in between:
    the first gives a row per file of a signature with the files after it,
    dealt over all tasks, the second a row per pair.  So no row ever holds
    more than one file's partners, however many files a key is in.
    """
    d = file_keys(df, file_col, key_col)
    sig = d.groupBy("key").agg(F.array_sort(F.collect_set("file")).alias("files"))
    weights = sig.filter(F.size("files") >= 2).groupBy("files").agg(F.count("*").alias("n"))
    firsts = weights.select(F.posexplode("files").alias("i", "file_a"), "files", "n")
    rest = firsts.select("file_a", F.slice("files", F.col("i") + 2, F.size("files")).alias("later"), "n")
    spread = rest.filter(F.size("later") > 0).hint("rebalance")
    return (
        spread.select("file_a", F.explode("later").alias("file_b"), "n")
        .groupBy("file_a", "file_b")
        .agg(F.sum("n").alias("shared_keys"))
    )


def pair_overlap(df: DataFrame, file_col: str, key_col: str) -> DataFrame:
    """Shared keys for every unordered file pair, zeros included: the list
    of ``all_pairs``, whose size is its own.  ``pair_counts`` leaves the
    zeros out."""
    return (
        all_pairs(df, file_col)
        .join(pair_counts(df, file_col, key_col), ["file_a", "file_b"], "left")
        .select("file_a", "file_b", F.coalesce("shared_keys", F.lit(0).cast("bigint")).alias("shared_keys"))
    )


def shared_at_least(df: DataFrame, file_col: str, key_col: str, min_shared: int = 3) -> DataFrame:
    """File pairs sharing at least ``min_shared`` keys (``filter_min_shared``).
    From one shared key on, zero pairs cannot qualify, so only the pairs
    that share keys are built."""
    pairs = pair_counts(df, file_col, key_col) if min_shared >= 1 else pair_overlap(df, file_col, key_col)
    return pairs.filter(F.col("shared_keys") >= min_shared)


def overlap_stats(pairs: DataFrame, col: str = "shared_keys") -> DataFrame:
    """Min / max / mean shared keys and number of pairs of a pair list
    that includes its zero pairs."""
    return pairs.agg(
        F.min(col).alias("min_shared"),
        F.max(col).alias("max_shared"),
        F.avg(col).alias("avg_shared"),
        F.count("*").alias("pair_count"),
    )


def pair_overlap_stats(df: DataFrame, file_col: str, key_col: str) -> DataFrame:
    """``overlap_stats`` over all file pairs, zeros included, without
    listing the pairs: the number of pairs is files * (files - 1) / 2, the
    zero pairs are those not among the pairs that share a key.  One
    aggregate over the sharing pairs and the file names together."""
    file_type = dict(df.dtypes)[file_col]
    shared = pair_counts(df, file_col, key_col).select(
        F.col("shared_keys").alias("n"), F.lit(None).cast(file_type).alias("f")
    )
    files = df.filter(F.col(file_col).isNotNull()).select(
        F.lit(None).cast("bigint").alias("n"), F.col(file_col).alias("f")
    )
    s = shared.unionByName(files).agg(
        F.min("n").alias("_min"),
        F.max("n").alias("_max"),
        F.sum("n").alias("_sum"),
        F.count("n").alias("_nz"),
        F.countDistinct("f").alias("_files"),
    )
    pairs = (F.col("_files") * (F.col("_files") - 1) / 2).cast("bigint")
    zeros = pairs - F.col("_nz")
    return s.select(
        F.when(zeros > 0, F.lit(0).cast("bigint")).otherwise(F.col("_min")).alias("min_shared"),
        F.when((F.col("_max").isNull()) & (pairs > 0), F.lit(0).cast("bigint")).otherwise(F.col("_max")).alias("max_shared"),
        F.when(pairs > 0, F.coalesce(F.col("_sum"), F.lit(0)).cast("double") / pairs).alias("avg_shared"),
        pairs.alias("pair_count"),
    )


def overlap_summary(df: DataFrame, file_col: str, key_col: str) -> DataFrame:
    """Unique keys, keys found in two or more files, their share in
    percent, and the mean number of distinct keys per file."""
    d = file_keys(df, file_col, key_col)
    file_type = dict(df.dtypes)[file_col]
    per_key = d.groupBy("key").agg(F.count("*").alias("nf")).select(
        "nf", F.lit(None).cast(file_type).alias("f")
    )
    files = df.filter(F.col(file_col).isNotNull()).select(
        F.lit(None).cast("bigint").alias("nf"), F.col(file_col).alias("f")
    )
    # One aggregate over both inputs instead of joining two one-row results.
    s = per_key.unionByName(files).agg(
        F.count("nf").alias("unique_keys"),
        F.count_if(F.col("nf") >= 2).alias("overlapping_keys"),
        F.sum("nf").alias("_pairs"),
        F.countDistinct("f").alias("_files"),
    )
    return s.select(
        "unique_keys",
        "overlapping_keys",
        F.try_divide(F.col("overlapping_keys").cast("double") * 100.0, F.col("unique_keys")).alias("overlap_pct"),
        F.try_divide(F.col("_pairs").cast("double"), F.col("_files")).alias("avg_keys_per_file"),
    )


def seen_before(df: DataFrame, file_col: str, key_col: str) -> DataFrame:
    """Per file: distinct keys, and keys already present in a file that
    sorts earlier: the file's keys less those it is the first file of.
    Two aggregates (the second over the grouped ``min`` of each key), so
    only per-file counts are joined, never the keys."""
    d = file_keys(df, file_col, key_col)
    per_file = d.groupBy("file").agg(F.count("*").alias("unique_keys"))
    first = d.groupBy("key").agg(F.min("file").alias("file")).groupBy("file").agg(F.count("*").alias("new_keys"))
    return per_file.join(first, "file", "left").select(
        F.col("file").alias(file_col),
        "unique_keys",
        (F.col("unique_keys") - F.coalesce("new_keys", F.lit(0))).alias("seen_before"),
    )


def duplicate_rate(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys and (rows - distinct) / rows.  A NULL key counts
    as one distinct value, as ``select(key).distinct().count()`` does."""
    return df.agg(
        F.count("*").alias("total_rows"),
        (F.countDistinct(key) + F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))).alias(
            "distinct_keys"
        ),
    ).withColumn(
        "duplicate_rate",
        F.try_divide((F.col("total_rows") - F.col("distinct_keys")).cast("double"), F.col("total_rows")),
    )


def unseen_keys(
    df: DataFrame,
    pool: DataFrame,
    key: str,
    pool_key: str | None = None,
    order_col: str | None = None,
) -> DataFrame:
    """One row per key of ``df`` whose key is not in ``pool``.

    Re-aims the reference's retry loop (draw until unseen) as an anti join.
    With ``order_col`` the newest row per key is kept; otherwise the
    smallest row, so the pick is repeatable.
    """
    pk = pool_key or key
    # Distinct pool keys first: a key repeated a million times in the pool
    # collapses map-side before the anti join.
    seen = pool.select(F.col(pk).alias(key)).filter(F.col(key).isNotNull()).distinct()
    fresh = df.filter(F.col(key).isNotNull()).join(seen, key, "left_anti")
    if order_col is None:
        return fresh.groupBy(key).agg(
            F.min(F.struct(*[c for c in df.columns if c != key])).alias("_r")
        ).select(key, "_r.*").select(*df.columns)
    return latest_per_key(fresh, [key], order_col)
