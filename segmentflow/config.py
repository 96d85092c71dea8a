"""Session and job parameters.

The library never hard-codes a catalog, schema or folder: callers pass a
``JobConfig``.  ``get_session`` builds a local session for tests and the
bench; on a cluster the session comes from the platform and only
``ensure_checkpoint_dir`` is needed.
"""

from __future__ import annotations

import os
import tempfile
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# Settings every session of this library relies on.  UTC keeps timestamp
# text and epoch conversions independent of the machine; AQE re-plans joins
# and coalesces small shuffle partitions at run time; skew-join splitting is
# on so a hot key does not pin one task.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "segmentflow",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and benchmarks.

    ``master`` defaults to ``local[$BENCH_CPUS]`` (8 when unset).  The
    number of shuffle partitions defaults to twice the cores, which keeps
    partitions small enough at the test scales; at cluster scale AQE
    coalesces or splits them from the runtime sizes.
    """
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    builder = builder.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(os.environ.get("SF_SHUFFLE_PARTITIONS", cpus * 2))))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_session_defaults(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_session_defaults(spark: SparkSession) -> None:
    """Pin the runtime settings that results depend on (time zone) and
    the adaptive planner.  Safe to call on a session made elsewhere."""
    for k, v in SESSION_DEFAULTS.items():
        if k.startswith("spark.ui."):
            continue
        spark.conf.set(k, v)


def scale_settings(input_bytes: int, partition_mb: int = 256) -> dict[str, str]:
    """Scan and shuffle sizing for a job reading ``input_bytes``.

    Scan splits and post-shuffle partitions aim at ``partition_mb``, which
    fits comfortably in an executor task's memory share; the initial
    shuffle width is the input size over that target, and AQE coalesces it
    down when stages turn out smaller.  A partition four times the target
    counts as skewed and is split.  100 TB at 256 MB give about 380,000
    shuffle partitions; a larger ``partition_mb`` gives fewer.
    """
    parts = max(1, -(-input_bytes // (partition_mb << 20)))
    return {
        "spark.sql.files.maxPartitionBytes": f"{partition_mb}m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{partition_mb}m",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{partition_mb * 4}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def size_bytes(text: str) -> int:
    """A size setting (``64k``, ``10485760b``, ``256MB``) in bytes."""
    number = text.strip().lower().rstrip("b") or "0"
    power = {"k": 10, "m": 20, "g": 30, "t": 40}.get(number[-1])
    return int(number) if power is None else int(number[:-1]) << power


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes up to which a measured side of a join may be broadcast; -1
    where broadcasts are off."""
    return size_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))


def advisory_bytes(spark: SparkSession) -> int:
    """The size adaptive execution aims at for a shuffle partition."""
    return size_bytes(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))


def state_buckets_for(state_bytes: int, bucket_mb: int = 512) -> int:
    """Bucket count for keyed state of ``state_bytes``: a power of two with
    buckets near ``bucket_mb`` (each merge task reads one bucket)."""
    n = max(1, state_bytes // (bucket_mb << 20))
    return 1 << max(3, (n - 1).bit_length())


def apply_scale_settings(spark: SparkSession, input_bytes: int, partition_mb: int = 256) -> None:
    """Set ``scale_settings`` on a running session."""
    for k, v in scale_settings(input_bytes, partition_mb).items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder, which
    is used as is.  One is created only in local mode, where it is unset in
    tests.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="segmentflow-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", current)
        except Exception:  # some sessions refuse core settings at run time
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current.removeprefix("file:")


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A folder below the shared checkpoint folder for state and staging."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, *parts) if not root.startswith(("hdfs:", "s3", "abfs", "gs:")) else "/".join([root.rstrip("/"), *parts])


@dataclass(frozen=True)
class JobConfig:
    """Where the segment job reads and writes.

    ``catalog`` / ``schema`` select the namespace (``namespace`` operator);
    ``landing`` holds ``<segment>/add/*.csv`` and ``<segment>/remove/*.csv``;
    ``state`` holds stream checkpoints and keyed state snapshots;
    ``export`` receives one file set per segment.
    """

    landing: str
    state: str
    export: str
    catalog: str | None = None
    schema: str | None = None
    max_files_per_trigger: int = 1000
    # Hash buckets of the keyed state (contacts, memberships).  Size it so a
    # bucket stays near 128-512 MB at the target state size; merges then
    # shuffle only the micro-batch.
    state_buckets: int = 64
    tables: dict[str, str] = field(
        default_factory=lambda: {
            "bronze_add": "bronze_add",
            "bronze_remove": "bronze_remove",
            "contact_silver": "contact_silver",
            "contact_segment": "contact_segment_table",
            "main": "main_table",
            "segments": "segments",
            "quarantine": "contact_quarantine",
            "feed_quarantine": "feed_quarantine",
        }
    )

    def table(self, role: str) -> str:
        return self.tables[role]


def use_namespace(spark: SparkSession, cfg: JobConfig) -> None:
    """Select catalog and schema given by parameters (``namespace``)."""
    if cfg.catalog:
        spark.catalog.setCurrentCatalog(cfg.catalog)
    if cfg.schema:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{cfg.schema}`")
        spark.catalog.setCurrentDatabase(cfg.schema)
