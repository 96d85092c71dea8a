"""Stateful fold of a stream into a keyed table without a table format
(``foreach_batch_merge``).

State is a series of complete snapshots under ``state_dir``.  A small
Parquet log ``state_dir/_log`` records every finished
(seq, stream, batch_id, path).  For each micro-batch:

1. if the log already holds (stream, batch_id) the batch was applied
   before (a retry after a failure) and is skipped;
2. otherwise the newest logged snapshot is read, the pure fold
   ``fold(state, batch) -> state`` is applied, the result is written to a
   fresh folder ``snap/seq=<n>/run=<id>``, and only then the log row is
   appended.

A crash before the log row leaves an unlogged folder that no reader ever
sees; the retry writes a new one.  So each batch is applied exactly once.
Everything is plain Spark reads and writes on the shared folder.  The log
row also holds how its snapshot is bucketed and its schema, and snapshots
are read with that, never with the caller's settings: a new bucket count
takes effect with the next snapshot, which is written with it.  Only a
missing log means that there is no state; any other error is raised.  The
last ``KEPT_SNAPSHOTS`` snapshots stay for readers, older ones are removed
after a batch is logged.  Two streams may feed one table as long as they run one after the other (the
reference job also allows one run at a time).

With ``Bucketing`` the snapshots are written as tables bucketed and sorted
by the merge key.  The next merge then reads the state already hash
partitioned by the key, so only the micro-batch is shuffled; the state,
which is the large side, is neither shuffled nor re-sorted for the join.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from segmentflow.sources.files import path_not_found

LOG_SCHEMA = "seq BIGINT, stream STRING, batch_id BIGINT, path STRING, keys ARRAY<STRING>, buckets INT, schema STRING"
KEPT_SNAPSHOTS = 2


@dataclass(frozen=True)
class Bucketing:
    """Hash bucketing of the state by its merge key."""

    keys: tuple[str, ...]
    buckets: int


@dataclass(frozen=True)
class Snapshot:
    """A logged snapshot: its place and how it was written."""

    seq: int
    path: str
    bucketing: Bucketing | None
    schema: StructType


def _join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def _log(spark: SparkSession, state_dir: str) -> DataFrame | None:
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(_join(state_dir, "_log"))
    except Exception as e:
        if path_not_found(e):
            return None
        raise


def _head(
    spark: SparkSession, state_dir: str, stream: str | None = None, batch_id: int | None = None
) -> tuple[Snapshot | None, bool]:
    """One pass over the log: the newest snapshot, and whether (stream,
    batch_id) was applied already."""
    log = _log(spark, state_dir)
    if log is None:
        return None, False
    done = F.lit(False)
    if stream is not None:
        done = (F.col("stream") == stream) & (F.col("batch_id") == batch_id)
    newest = F.max_by(F.struct("path", "keys", "buckets", "schema"), "seq").alias("last")
    r = log.agg(F.max("seq").alias("seq"), newest, F.max(done.cast("int")).alias("done")).first()
    if r is None or r.seq is None:
        return None, False
    spec = Bucketing(tuple(r.last.keys), r.last.buckets) if r.last.buckets else None
    return Snapshot(int(r.seq), r.last.path, spec, StructType.fromJson(json.loads(r.last.schema))), r.done == 1


def _table_name(path: str) -> str:
    return "sf_state_" + hashlib.sha1(path.encode()).hexdigest()[:16]


def read_snapshot(spark: SparkSession, snapshot: Snapshot) -> DataFrame:
    """A logged snapshot; a bucketed one is read through a table definition
    so Spark knows its partitioning (declared again over the files when
    the session does not know it, always with the logged bucketing)."""
    if snapshot.bucketing is None:
        return spark.read.schema(snapshot.schema).parquet(snapshot.path)
    name = _table_name(snapshot.path)
    if not spark.catalog.tableExists(name):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in snapshot.schema.fields)
        keys = ", ".join(f"`{k}`" for k in snapshot.bucketing.keys)
        spark.sql(
            f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
            f"INTO {snapshot.bucketing.buckets} BUCKETS LOCATION '{snapshot.path}'"
        )
    return spark.table(name)


def write_snapshot(df: DataFrame, path: str, bucketing: Bucketing | None = None) -> None:
    if bucketing is None:
        df.write.mode("errorifexists").parquet(path)
        return
    (
        df.write.format("parquet")
        .bucketBy(bucketing.buckets, *bucketing.keys)
        .sortBy(*bucketing.keys)
        .option("path", path)
        .saveAsTable(_table_name(path))
    )


def latest_snapshot(spark: SparkSession, state_dir: str) -> int | None:
    """Sequence number of the newest complete snapshot, or None."""
    head, _ = _head(spark, state_dir)
    return None if head is None else head.seq


def read_state(spark: SparkSession, state_dir: str, initial: Callable[[SparkSession], DataFrame]) -> DataFrame:
    """The newest complete snapshot, or ``initial(spark)`` before the first."""
    head, _ = _head(spark, state_dir)
    return initial(spark) if head is None else read_snapshot(spark, head)


def applied(spark: SparkSession, state_dir: str, stream_name: str, batch_id: int) -> bool:
    """Whether the log holds this batch."""
    return _head(spark, state_dir, stream_name, batch_id)[1]


def _remove_old(spark: SparkSession, state_dir: str, newest: int) -> None:
    """Drop the tables and folders of snapshots that no reader starts from
    any more, also those that a run cut off here before has left.  Folders
    of crashed attempts lie below the same ``seq=<n>``."""
    root = spark._jvm.org.apache.hadoop.fs.Path(_join(state_dir, "snap"))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {int(f.getPath().getName().partition("=")[2]): f.getPath() for f in fs.listStatus(root)}
    old = [n for n in found if n <= newest - KEPT_SNAPSHOTS]
    if not old:
        return
    for r in _log(spark, state_dir).filter(F.col("seq").isin(old)).select("path").distinct().collect():
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(r.path)}")
    for n in old:
        fs.delete(found[n], True)


def apply_batch(
    batch: DataFrame,
    batch_id: int,
    fold: Callable[[DataFrame, DataFrame], DataFrame],
    state_dir: str,
    stream_name: str,
    initial: Callable[[SparkSession], DataFrame],
    bucketing: Bucketing | None = None,
) -> None:
    """Fold one micro-batch into the next snapshot, at most once."""
    spark = batch.sparkSession
    head, done = _head(spark, state_dir, stream_name, batch_id)
    if done:
        return
    prev = initial(spark) if head is None else read_snapshot(spark, head)
    nxt = 0 if head is None else head.seq + 1
    out = _join(state_dir, "snap", f"seq={nxt}", f"run={uuid.uuid4().hex}")
    result = fold(prev, batch)
    if bucketing is None:
        write_snapshot(result, out)
    else:
        # The batch's own shuffles (dedupe, aggregation) use the bucket
        # count, so they hash the key exactly as the stored state does and
        # the merge join needs no exchange on the state side.
        key = "spark.sql.shuffle.partitions"
        old = spark.conf.get(key)
        spark.conf.set(key, str(bucketing.buckets))
        try:
            write_snapshot(result, out, bucketing)
        finally:
            spark.conf.set(key, old)
    keys, buckets = (list(bucketing.keys), bucketing.buckets) if bucketing else (None, None)
    row = (nxt, stream_name, int(batch_id), out, keys, buckets, result.schema.json())
    spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(_join(state_dir, "_log"))
    _remove_old(spark, state_dir, nxt)


def fold_stream(
    df: DataFrame,
    fold: Callable[[DataFrame, DataFrame], DataFrame],
    state_dir: str,
    stream_name: str,
    checkpoint: str,
    initial: Callable[[SparkSession], DataFrame],
    bucketing: Bucketing | None = None,
) -> None:
    """Run ``df`` with ``availableNow`` and fold each micro-batch into the
    snapshot state; returns when the backlog is processed."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, fold, state_dir, stream_name, initial, bucketing)

    q = (
        df.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
