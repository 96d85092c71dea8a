"""Helpers shared by the operators: reading, scratch folders, the label
split, and running a text function over Arrow batches in bounded slices."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmentflow.config import ensure_checkpoint_dir, size_bytes

# Text bytes handled at once inside a task.  One longer text is a slice of
# its own; texts are never cut.
SLICE_BYTES = 2 << 20
# Bytes of a batch that the JVM sends to a Python worker.  Spark's own limit
# (64 MB) holds 10,000 documents, several times over in both processes.
BATCH_BYTES = 2 * SLICE_BYTES
HELD_OUT_FOLDS = 5


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the session's shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage
    with files every executor can read again after a loss."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(id_col: str = "doc_id") -> Column:
    """True for the held-out fold: crc32 of the id as text, mod 5, is 0.  A
    null id counts as an empty text, so it is held out."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(HELD_OUT_FOLDS)) == 0


def small(df: DataFrame, limit: int = 8 << 20) -> DataFrame:
    """``df`` marked for a broadcast if its measured bytes are at most
    ``limit``, else as it is."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))) + 32)).first()[0] or 0
    return F.broadcast(df) if size <= limit else df


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices of at most ``limit`` text bytes (or one row)."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    at, n = 0, batch.num_rows
    while at < n:
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's limit of an Arrow batch to ``BATCH_BYTES``.  It
    stays so, as the batches are made when a plan runs; no result depends
    on it, and batches are sliced to ``SLICE_BYTES`` of text anyway."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < size_bytes(spark.conf.get(key, None) or "-1") <= BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def arrow_column(values, field: T.StructField) -> pa.Array:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(field.dataType)
    if isinstance(values, pa.Array):
        return values.cast(kind)
    return pa.array(values, type=kind)


def append_columns(
    df: DataFrame,
    text_col: str,
    fields: list[T.StructField],
    factory: Callable[[], Callable[[list], list]],
    keep: list[str] | None = None,
    as_bytes: bool = False,
) -> DataFrame:
    """``df`` (or its columns ``keep``) with new columns computed per text.

    ``factory()`` runs once per task and returns a function from a list of
    texts (``str``, or UTF-8 ``bytes``; None for null) to one list or array
    per field.  An input column that has the name of a new one (in any
    case) is replaced by it.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    columns = [F.col(f"`{c}`") for c in kept]
    at = kept.index(text_col) if text_col in kept and df.schema[text_col].dataType == T.StringType() else len(kept)
    if at == len(kept):
        columns.append(F.col(f"`{text_col}`").cast("string").alias("__text"))
    bounded_batches(df.sparkSession)
    source = df.select(*columns)
    read = source.columns[at]
    schema = T.StructType([df.schema[c] for c in kept] + fields)

    def run(batches):
        forget_kept()
        apply = factory()
        batch = part = texts = columns = None
        for batch in batches:
            for part in text_slices(batch, read):
                texts = part.column(at)
                if as_bytes:
                    texts = texts.cast(pa.binary())
                columns = [part.column(i) for i in range(len(kept))]
                columns += [arrow_column(v, f) for v, f in zip(apply(texts.to_pylist()), fields, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *[f.name for f in fields]])
        del apply, batch, part, texts, columns
        give_back()

    return source.mapInArrow(run, schema)


def vocabulary_bytes(path: str, limit: int = 64 << 20) -> bytes:
    """A tokenizer file, read on the driver to be broadcast; its size is
    checked first."""
    with open(path, "rb") as f:
        data = f.read(limit + 1)
    if len(data) > limit:
        raise ValueError(f"{path} is over {limit} bytes, too large to broadcast")
    return data


def worker_kept(name: str, key, make: Callable[[], object]):
    """An object of this Python worker, which Spark reuses from task to
    task: made once for each ``key`` (the last one is kept), so that its
    tables are read and its bounded caches are filled once."""
    import sys
    import types

    place = sys.modules.setdefault("_segmentflow_worker", types.ModuleType("_segmentflow_worker")).__dict__
    if place.get(name, (None,))[0] != key:
        place[name] = (key, make())
    return place[name][1]


def forget_kept() -> None:
    """Drops what ``worker_kept`` holds: this worker has gone on to an
    operator that keeps nothing."""
    import sys

    sys.modules.pop("_segmentflow_worker", None)


def give_back() -> None:
    """Returns the freed memory of this Python worker to the system: it
    waits for its next task while the JVM beside it joins and sorts."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass
