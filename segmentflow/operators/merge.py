"""Keyed merges expressed as joins: upsert that never erases with NULL,
segment membership with soft delete and an out-of-order guard.

Every function is pure: it takes the current state and a batch and returns
the next state as a DataFrame.  Writing it (snapshot per batch) is the job
of ``streaming.fold``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentflow.functions.columns import keep_old_if_null
from segmentflow.operators.dedup import latest_per_key
from segmentflow.operators.surrogate import hash_id

MEMBERSHIP_KEYS = ["email", "segment"]
MEMBERSHIP_COLUMNS = ["email", "segment", "file_modification_time", "is_active"]


def upsert_keep_non_null(
    target: DataFrame,
    source: DataFrame,
    key: str,
    cols: list[str],
    id_col: str | None = "random_id",
    new_id: Callable[[Column], Column] | str | None = None,
    order_col: str | None = None,
    tie_cols: list[str] | None = None,
    time_guard: str | None = None,
) -> DataFrame:
    """Fold one batch into a keyed table.

    * ``order_col`` given: the batch is first cut to its newest row per key.
    * Match on ``key``: each non-NULL source column overwrites, a NULL never
      erases, the id stays.
    * No match: insert with a new id: ``new_id(key)`` (default a hash of
      the key, see ``surrogate``), or, when ``new_id`` names a source
      column, that column (ids assigned before the merge).
    * Target columns not in ``cols`` (such as ``list_keys``) pass through;
      inserted rows get NULL there.
    * Rows with a NULL key are rejected up front: they would never match
      and would be inserted again on every batch.

    By default there is no time guard: a later batch wins even when its
    file is older, as in the reference job.  With ``time_guard`` (a column
    of both target and source, such as the file time) a matched row is only
    updated by a strictly newer source row, and the column keeps the newest
    time applied.

    One full outer join on the key.  Both sides hold at most one row per
    key, so the join cannot fan out and a hot key cannot skew it.
    """
    src = source.filter(F.col(key).isNotNull())
    if order_col is not None:
        src = latest_per_key(src, [key], order_col, tie_cols)
    id_src = new_id if isinstance(new_id, str) else None
    extra = [c for c in (id_src, time_guard) if c and c not in cols]
    src = src.select(key, *cols, *extra)
    make_id = (lambda k: F.col(f"s.{id_src}")) if id_src else (new_id or (lambda k: hash_id(k)))

    t, s = target.alias("t"), src.alias("s")
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full")
    # Whether the source row may change the target row.
    apply = F.lit(True)
    if time_guard is not None:
        tg, sg = F.col(f"t.{time_guard}"), F.col(f"s.{time_guard}")
        apply = F.col(f"t.{key}").isNull() | F.coalesce(tg < sg, tg.isNull() & sg.isNotNull())
    out = []
    for c in target.columns:
        if c == key:
            out.append(F.coalesce(F.col(f"t.{key}"), F.col(f"s.{key}")).alias(key))
        elif c in cols or c == time_guard:
            merged = keep_old_if_null(F.col(f"s.{c}"), F.col(f"t.{c}"))
            out.append((merged if time_guard is None else F.when(apply, merged).otherwise(F.col(f"t.{c}"))).alias(c))
        elif id_col is not None and c == id_col:
            out.append(F.coalesce(F.col(f"t.{c}"), make_id(F.col(f"s.{key}"))).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return joined.select(*out)


def upsert_replay(
    batches: DataFrame,
    key: str,
    cols: list[str],
    batch_col: str,
    order_col: str,
    tie_cols: list[str] | None = None,
    id_col: str | None = "random_id",
) -> DataFrame:
    """Closed form of folding many batches with ``upsert_keep_non_null``
    into an empty table: per key and column, the last non-NULL value among
    the per-batch newest rows.

    Two aggregations, both with map-side partial aggregation: newest row per
    (key, batch), then ``max_by(value, batch)`` over non-NULL values per key.
    """
    latest = latest_per_key(
        batches.filter(F.col(key).isNotNull()), [key, batch_col], order_col, tie_cols
    )
    aggs = [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(batch_col))).alias(c) for c in cols
    ]
    out = latest.groupBy(key).agg(*aggs)
    if id_col is not None:
        out = out.withColumn(id_col, hash_id(F.col(key)))
    return out


def membership_events(df: DataFrame, segment: Column | None = None) -> DataFrame:
    """Newest event per (email, segment) of a bronze batch.

    ``max`` is enough here (no other column is carried), so this is a plain
    partial aggregation rather than a window.
    """
    if segment is not None:
        df = df.withColumn("segment", segment)
    return (
        df.filter(F.col("email").isNotNull() & F.col("segment").isNotNull())
        .groupBy(*MEMBERSHIP_KEYS)
        .agg(F.max("file_modification_time").alias("file_modification_time"))
    )


def segment_activate(target: DataFrame, adds: DataFrame) -> DataFrame:
    """Adds into membership: a match with an older target time becomes
    active at the new time; an equal or newer target time is kept
    (``late_guard``); no match inserts an active row."""
    s = membership_events(adds).alias("s")
    t = target.select(*MEMBERSHIP_COLUMNS).alias("t")
    cond = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in MEMBERSHIP_KEYS]
    j = t.join(s, cond, "full")
    newer = F.col("t.email").isNull() | F.coalesce(
        F.col("t.file_modification_time") < F.col("s.file_modification_time"), F.lit(False)
    )
    newer = F.col("s.email").isNotNull() & newer
    return j.select(
        *[F.coalesce(F.col(f"t.{k}"), F.col(f"s.{k}")).alias(k) for k in MEMBERSHIP_KEYS],
        F.when(newer, F.col("s.file_modification_time"))
        .otherwise(F.col("t.file_modification_time"))
        .alias("file_modification_time"),
        F.when(newer, F.lit(True)).otherwise(F.col("t.is_active")).alias("is_active"),
    )


def segment_deactivate(target: DataFrame, removes: DataFrame) -> DataFrame:
    """Removes into membership (soft delete): a match with an older target
    time becomes inactive at the new time; a remove without a matching row
    is dropped."""
    s = membership_events(removes).alias("s")
    t = target.select(*MEMBERSHIP_COLUMNS).alias("t")
    cond = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in MEMBERSHIP_KEYS]
    j = t.join(s, cond, "left")
    newer = F.coalesce(
        F.col("t.file_modification_time") < F.col("s.file_modification_time"), F.lit(False)
    )
    return j.select(
        *[F.col(f"t.{k}").alias(k) for k in MEMBERSHIP_KEYS],
        F.when(newer, F.col("s.file_modification_time"))
        .otherwise(F.col("t.file_modification_time"))
        .alias("file_modification_time"),
        F.when(newer, F.lit(False)).otherwise(F.col("t.is_active")).alias("is_active"),
    )


def membership_closed_form(events: DataFrame, is_add: Column, is_remove: Column) -> DataFrame:
    """Membership after one run (all adds, then all removes) from a single
    event feed, in one pass: the newest add and the newest remove per
    (email, segment) come from one conditional aggregation (combined
    map-side), so the feed is read and shuffled once and no join is needed.
    Inactive when the remove is newer (a tie stays active); a pair with
    removes only is dropped."""
    t = F.col("file_modification_time")
    e = events.filter(F.col("email").isNotNull() & F.col("segment").isNotNull() & (is_add | is_remove))
    agg = e.groupBy(*MEMBERSHIP_KEYS).agg(
        F.max(F.when(is_add, t)).alias("_a"), F.max(F.when(is_remove, t)).alias("_r")
    )
    removed = F.coalesce(F.col("_a") < F.col("_r"), F.lit(False))
    return agg.filter(F.col("_a").isNotNull()).select(
        *MEMBERSHIP_KEYS,
        F.when(removed, F.col("_r")).otherwise(F.col("_a")).alias("file_modification_time"),
        (~removed).alias("is_active"),
    )


def segment_membership(
    adds: DataFrame, removes: DataFrame, target: DataFrame | None = None
) -> DataFrame:
    """Membership after one run: all adds, then all removes.

    Without a prior ``target`` this is the closed form (see
    ``membership_closed_form``; the two inputs are tagged and aggregated
    together).  With a target the two merges are folded in order, which
    also covers the cross-run case where a remove seen before any add was
    dropped.
    """
    if target is not None:
        return segment_deactivate(segment_activate(target, adds), removes)
    cols = [*MEMBERSHIP_KEYS, "file_modification_time"]
    tagged = adds.select(*cols, F.lit(True).alias("_add")).unionByName(
        removes.select(*cols, F.lit(False).alias("_add"))
    )
    return membership_closed_form(tagged, F.col("_add"), ~F.col("_add"))


def empty_membership(spark) -> DataFrame:
    return spark.createDataFrame(
        [],
        "email STRING, segment STRING, file_modification_time TIMESTAMP, is_active BOOLEAN",
    )
