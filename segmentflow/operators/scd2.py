"""Slowly changing dimension, type 2 (``scd2_merge``)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentflow.operators.dedup import latest_per_key

HISTORY_COLUMNS = ("start_timestamp", "end_timestamp")


def _now_col(now) -> Column:
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now
    if isinstance(now, _dt.datetime):
        return F.lit(now)
    return F.lit(now).cast("timestamp")


def scd2_merge(
    target: DataFrame,
    incoming: DataFrame,
    id_col: str,
    order_col: str,
    now=None,
) -> DataFrame:
    """Next state of a history table after one batch.

    * The batch is cut to its newest row per id by ``order_col``.
    * Unknown id (no open row): a new open row.
    * Newer ``order_col`` than the open row: the open row is closed
      (``end_timestamp = now``) and a new open row starts at ``now``.
    * Equal or older: ignored.
    * Closed rows never change.

    Only the open rows take part in the join; closed history is passed
    through untouched, so the shuffle grows with the current table, not
    with the history.  There is one join: each joined row gives an array of
    up to two rows, the kept (or closed) one and the started one, which is
    exploded.
    """
    ts_type = dict(target.dtypes).get("start_timestamp", "timestamp")
    now_c = _now_col(now).cast(ts_type)
    value_cols = [c for c in target.columns if c not in HISTORY_COLUMNS]
    inc = latest_per_key(incoming.filter(F.col(id_col).isNotNull()), [id_col], order_col)
    inc = inc.select(*[F.col(c).alias(f"{c}_incoming") for c in value_cols])

    is_open = F.col("end_timestamp").isNull()
    closed = target.filter(~is_open)
    open_rows = target.filter(is_open).alias("t")
    j = open_rows.join(inc.alias("i"), F.col(f"t.{id_col}") == F.col(f"i.{id_col}_incoming"), "full")
    newer = F.coalesce(F.col(f"i.{order_col}_incoming") > F.col(f"t.{order_col}"), F.lit(False))

    struct_type = target.select(*target.columns).schema
    kept = F.struct(
        *[F.col(f"t.{c}").alias(c) for c in value_cols],
        F.col("t.start_timestamp").alias("start_timestamp"),
        F.when(newer, now_c).otherwise(F.col("t.end_timestamp")).alias("end_timestamp"),
    )
    started = F.struct(
        *[F.col(f"i.{c}_incoming").cast(struct_type[c].dataType).alias(c) for c in value_cols],
        now_c.alias("start_timestamp"),
        F.lit(None).cast(ts_type).alias("end_timestamp"),
    )
    starts = F.col(f"i.{id_col}_incoming").isNotNull() & (F.col(f"t.{id_col}").isNull() | newer)
    rows = F.array(F.when(F.col(f"t.{id_col}").isNotNull(), kept), F.when(starts, started))
    merged = j.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("_r")).select("_r.*")
    return closed.select(*target.columns).unionByName(merged.select(*target.columns))


def current_rows(history: DataFrame) -> DataFrame:
    """Open rows only (``filter_current``)."""
    return history.filter(F.col("end_timestamp").isNull())


def scd2_fold(id_col: str, order_col: str, now=None):
    """``scd2_merge`` as a fold for ``streaming.fold_stream``: each
    micro-batch is merged into the history with the batch's own time as
    ``now`` unless one is given."""

    def fold(history: DataFrame, batch: DataFrame) -> DataFrame:
        return scd2_merge(history, batch, id_col, order_col, now)

    return fold
