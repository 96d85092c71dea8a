"""The segment job, stage by stage (``run_segment_pipeline``).

1. ingest   add and remove CSV drops stream into ``bronze_add`` /
            ``bronze_remove`` with file lineage (availableNow); columns are
            bound by each file's header, lines that don't fit go to the
            quarantine of the feeds;
2. contacts the add stream is folded into the contact state: newest row
            per email per micro-batch, NULL never erases, new ids;
3. segments the add stream, then the remove stream, are folded into the
            membership state (activate, then soft delete; older events
            never win);
4. main     contacts LEFT JOIN their sorted active segments;
5. export   one CSV file set per listed segment, written by executors.

State of stages 2 and 3 lives in snapshot folders under ``cfg.state``
(see ``streaming.fold``); after each run it is also published as the
tables ``contact_silver`` and ``contact_segment_table``.
"""

from __future__ import annotations

import datetime as _dt
import os
import time
from contextlib import contextmanager

from pyspark.logger import PySparkLogger
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from segmentflow.config import JobConfig, apply_session_defaults, ensure_checkpoint_dir, use_namespace
from segmentflow.functions.columns import path_part
from segmentflow.operators.marts import main_table
from segmentflow.operators.merge import segment_activate, segment_deactivate, upsert_keep_non_null
from segmentflow.operators.quality import valid_rows
from segmentflow.operators.surrogate import assign_new_ids
from segmentflow.sinks.export import export_segments
from segmentflow.sinks.tables import create_if_missing, overwrite_table, replace_partitions
from segmentflow.sources.files import CONTACT_COLUMNS, FEED_SCHEMA, add_feed, aligned, read_lines, remove_feed, stream_table
from segmentflow.streaming.feeds import land_feed
from segmentflow.streaming.fold import Bucketing, applied, apply_batch, fold_stream, read_state

# Table layouts of the job.
REMOVE_SCHEMA = StructType([FEED_SCHEMA["email"]])
CONTACT_DDL = (
    "Name STRING, email STRING, DOB DATE, occupation STRING, phone_number STRING, "
    "random_id STRING, list_keys STRING"
)
MEMBERSHIP_DDL = "email STRING, segment STRING, file_modification_time TIMESTAMP, is_active BOOLEAN"
HISTORIC_SCHEMA = (
    "Name STRING, email STRING, DOB DATE, occupation STRING, phone_number STRING, "
    "random_id STRING, list_keys STRING"
)

QUARANTINE_DDL = CONTACT_DDL + ", reason STRING, source STRING, load STRING"


def _p(cfg: JobConfig, *parts: str) -> str:
    return os.path.join(cfg.state, *parts)


def ingest(spark: SparkSession, cfg: JobConfig) -> None:
    """Stage 1: both feeds to their bronze tables (``land_feed``).  The two
    streams run at the same time (they write different partitions) and the
    stage ends when both have processed their backlog."""
    limit, bad = cfg.max_files_per_trigger, cfg.table("feed_quarantine")
    feeds = [("add", add_feed, FEED_SCHEMA), ("remove", remove_feed, REMOVE_SCHEMA)]
    queries = [
        land_feed(lines(spark, cfg.landing, limit), schema, cfg.table(f"bronze_{feed}"), bad, feed, _p(cfg, "checkpoints", f"{feed}_stream"))
        for feed, lines, schema in feeds
    ]
    try:
        for q in queries:
            q.awaitTermination()
    finally:  # a failed stream must not leave the other one running
        for q in queries:
            if q.isActive:
                q.stop()


def split_historic(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Historic contacts as (one row per email, rejected rows with their
    ``reason``).  The email is the key of the contact table: rows without
    one are rejected, and of rows that repeat one all but the smallest row
    (by the other columns in order, NULLs first)."""
    cols = [c.split()[0] for c in CONTACT_DDL.split(", ")]
    others = [c for c in cols if c != "email"]
    keyed = valid_rows(df, ["email"])
    counted = keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    first = keyed.groupBy("email").agg(F.min(F.struct(*others)).alias("_first"))
    rows = counted.join(first, "email").withColumn("_is", F.struct(*others).eqNullSafe(F.col("_first")))
    # The accepted row may itself be there several times.
    over = F.col("_n") - F.col("_is").cast("int")
    rejected = rows.filter(over > 0).withColumn("_k", F.explode(F.sequence(F.lit(1), over)))
    rejected = rejected.select(*cols, F.lit("duplicate email").alias("reason"))
    missing = df.filter(F.col("email").isNull()).select(*cols, F.lit("missing email").alias("reason"))
    return first.select("email", "_first.*").select(*cols), rejected.unionByName(missing)


def checked_ids(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Historic rows (one per email) with ``random_id`` set and unique over
    the rows and the contact state, and a ``reason`` where they can't be.

    Emails the state knows keep the state's id, so theirs isn't looked at.
    Of the others, an id that the state has already is ``taken``; one that
    several rows hold stays with the smallest email and is ``repeated`` for
    the rest.  Rows without an id (NULL or blank) are numbered like new
    contacts."""
    known = state.select(F.col("email").alias("_known"), F.lit(True).alias("_is_known"))
    rows = rows.withColumn("random_id", F.when(F.trim("random_id") != "", F.col("random_id")))
    rows = rows.join(known, F.col("email") == F.col("_known"), "left").drop("_known")
    own_id = F.col("_is_known").isNull() & F.col("random_id").isNotNull()
    keeper = rows.filter(own_id).groupBy(F.col("random_id").alias("_id")).agg(F.min("email").alias("_keeper"))
    # The state's ids are unique, so this keeps one row per id.
    held = state.select(F.col("random_id").alias("_held")).filter("_held is not null")
    keeper = keeper.join(held, F.col("_id") == F.col("_held"), "left")
    found = rows.join(keeper, own_id & (F.col("random_id") == F.col("_id")), "left")
    reason = F.when(F.col("_held").isNotNull(), "taken random_id").when(F.col("email") != F.col("_keeper"), "repeated random_id")
    columns = [c for c in rows.columns if c != "_is_known"]
    found = found.select(*columns, "_is_known", reason.alias("reason")).checkpoint()
    bare = found.filter("random_id is null and _is_known is null").select("email")
    in_use = state.select("random_id").union(found.filter("reason is null and random_id is not null").select("random_id"))
    numbered = assign_new_ids(bare, in_use, "email", "random_id").withColumnRenamed("random_id", "_new")
    found = found.join(numbered, "email", "left").withColumn("random_id", F.coalesce("random_id", "_new"))
    return found.select(*columns, "reason")


def historic_fold(prev: DataFrame, batch: DataFrame) -> DataFrame:
    """Historic contacts into the contact state: unknown emails are added
    with their own id, known ones keep their id and values and only have
    their NULLs filled, as the history is older than any drop."""
    cols = [c for c in prev.columns if c != "email"]
    return prev.alias("t").join(batch.alias("h"), "email", "full").select(
        "email", *[F.coalesce(f"t.{c}", f"h.{c}").alias(c) for c in cols]
    ).select(*prev.columns)


def load_key(df: DataFrame) -> str:
    """A name for the files ``df`` reads: the same for the same files, so a
    load that is tried again is recognised."""
    parts = [F.col(f"_metadata.{c}") for c in ("file_path", "file_size", "file_modification_time")]
    files = df.select(F.xxhash64(*parts).alias("h")).distinct()
    n, total = files.agg(F.count(F.lit(1)), F.sum(F.col("h").cast("decimal(38,0)"))).first()
    return f"historic-{n}-{total or 0}"


def initial_load(spark: SparkSession, path: str, cfg: JobConfig) -> DataFrame:
    """Historic contacts CSV, columns matched by name, into the contact
    state and table (``initial_load``), before or after any run.  Each
    contact has an email and a ``random_id`` of its own afterwards.

    Rejected rows go to the quarantine table, with the file and the reason,
    in a partition of the load.  A load of the same files that is tried
    again replaces that partition if the first try failed, and changes
    nothing if it was finished."""
    ensure_checkpoint_dir(spark)
    load, state_dir = load_key(spark.read.text(path)), _p(cfg, "state", "contact")
    if not applied(spark, state_dir, load, 0):
        schema = StructType.fromDDL(HISTORIC_SCHEMA)
        source = aligned(read_lines(spark, path), schema).checkpoint()
        good, bad = split_historic(source.filter("not rejected"))
        bad = bad.unionByName(source.filter("rejected").select(*schema.names, "reason"))
        good = checked_ids(good, read_state(spark, state_dir, _empty(CONTACT_DDL))).checkpoint()
        bad = bad.unionByName(good.filter("reason is not null"))
        create_if_missing(spark, cfg.table("quarantine"), QUARANTINE_DDL, ["load"])
        replace_partitions(bad.select("*", F.lit(path).alias("source"), F.lit(load).alias("load")), cfg.table("quarantine"))
        accepted = good.filter("reason is null").drop("reason")
        apply_batch(accepted, 0, historic_fold, state_dir, load, _empty(CONTACT_DDL), contact_bucketing(cfg))
    overwrite_table(read_state(spark, state_dir, _empty(CONTACT_DDL)), cfg.table("contact_silver"))
    return spark.table(cfg.table("contact_silver"))


def quarantine(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    """Rows that never reach the state, by ``source`` and ``reason``: the
    rejected historic rows, the feeds' lines that could not be read, and the
    bronze rows without an email or (for membership) without a segment in
    their path."""
    parts = []
    if spark.catalog.tableExists(cfg.table("feed_quarantine")):
        lines = spark.table(cfg.table("feed_quarantine")).filter("rejected")
        parts.append(lines.select(F.col("source_file").alias("source"), "reason"))
    if spark.catalog.tableExists(cfg.table("quarantine")):
        parts.append(spark.table(cfg.table("quarantine")).select("source", "reason"))
    for feed in ("bronze_add", "bronze_remove"):
        if spark.catalog.tableExists(cfg.table(feed)):
            rows = spark.table(cfg.table(feed)).select(F.col("source_file").alias("source"), "email", path_part("source_file", -3).alias("segment"))
            reason = F.when(F.col("email").isNull(), "missing email").when(F.col("segment").isNull(), "missing segment")
            parts.append(rows.select("source", reason.alias("reason")).filter("reason is not null"))
    out = parts[0] if parts else spark.createDataFrame([], "source STRING, reason STRING")
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("rejected_rows"))


def _empty(ddl: str):
    return lambda s: s.createDataFrame([], ddl)


def contact_fold(prev: DataFrame, batch: DataFrame) -> DataFrame:
    """One micro-batch of adds into the contact state.

    Ids for emails not yet in the state are assigned first (checked
    against the existing ids and each other), then the merge runs once."""
    src = valid_rows(batch, ["email"])
    new_keys = src.select("email").distinct().join(prev.select("email"), "email", "left_anti")
    ids = assign_new_ids(new_keys, prev, "email", "random_id").withColumnRenamed("random_id", "_new_id")
    return upsert_keep_non_null(
        prev,
        src.join(ids, "email", "left"),
        "email",
        CONTACT_COLUMNS,
        new_id="_new_id",
        order_col="file_modification_time",
        tie_cols=["source_file"],
    )


def with_segment(df: DataFrame) -> DataFrame:
    """email, file time and the segment named by the landing path."""
    return df.select("email", "file_modification_time", path_part("source_file", -3).alias("segment"))


def contact_bucketing(cfg: JobConfig) -> Bucketing:
    return Bucketing(("email",), cfg.state_buckets)


def membership_bucketing(cfg: JobConfig) -> Bucketing:
    return Bucketing(("email", "segment"), cfg.state_buckets)


def contacts(spark: SparkSession, cfg: JobConfig) -> None:
    """Stage 2."""
    fold_stream(
        stream_table(spark, cfg.table("bronze_add"), cfg.max_files_per_trigger),
        contact_fold,
        _p(cfg, "state", "contact"),
        "add",
        _p(cfg, "checkpoints", "contact"),
        _empty(CONTACT_DDL),
        contact_bucketing(cfg),
    )


def segments(spark: SparkSession, cfg: JobConfig) -> None:
    """Stage 3: adds to their end, then removes (one writer at a time)."""
    state = _p(cfg, "state", "contact_segment")
    fold_stream(
        with_segment(stream_table(spark, cfg.table("bronze_add"), cfg.max_files_per_trigger)),
        segment_activate,
        state,
        "add",
        _p(cfg, "checkpoints", "contact_segment"),
        _empty(MEMBERSHIP_DDL),
        membership_bucketing(cfg),
    )
    fold_stream(
        with_segment(stream_table(spark, cfg.table("bronze_remove"), cfg.max_files_per_trigger)),
        segment_deactivate,
        state,
        "remove",
        _p(cfg, "checkpoints", "contact_segment_remove"),
        _empty(MEMBERSHIP_DDL),
        membership_bucketing(cfg),
    )


def publish(spark: SparkSession, cfg: JobConfig) -> tuple[DataFrame, DataFrame]:
    """Current contact and membership state, also saved as tables."""
    contact_state = _p(cfg, "state", "contact")
    c = read_state(spark, contact_state, _empty(CONTACT_DDL))
    m = read_state(spark, _p(cfg, "state", "contact_segment"), _empty(MEMBERSHIP_DDL))
    # The state is read from its snapshot folders, never from these tables,
    # so they can be overwritten directly without an extra copy.
    overwrite_table(c, cfg.table("contact_silver"))
    overwrite_table(m, cfg.table("contact_segment"))
    return spark.table(cfg.table("contact_silver")), spark.table(cfg.table("contact_segment"))


def build_main(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    """Stage 4."""
    c = spark.table(cfg.table("contact_silver"))
    m = spark.table(cfg.table("contact_segment"))
    overwrite_table(main_table(c, m), cfg.table("main"))
    return spark.table(cfg.table("main"))


def export(spark: SparkSession, cfg: JobConfig, date: str | None = None) -> DataFrame:
    """Stage 5."""
    date = date or _dt.date.today().isoformat()
    return export_segments(spark.table(cfg.table("main")), spark.table(cfg.table("segments")), cfg.export, date)


def ingest_report(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    """Files ingested and last ingestion time per feed (``ingest_status``)."""
    from segmentflow.operators.marts import ingest_status

    return ingest_status(spark.table(cfg.table("bronze_add")), spark.table(cfg.table("bronze_remove")))


def landing_profile(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    """Per add file: records, non-NULL emails and NULLs per contact column
    (``null_profile``)."""
    from segmentflow.operators.profile import null_profile

    return null_profile(spark.table(cfg.table("bronze_add")), "source_file", CONTACT_COLUMNS, key="email")


def validate_tables(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    """The planned table checks: lineage columns and email set on both
    bronze tables, email unique and set in the contact table, one row per
    (email, segment) in the membership table."""
    from segmentflow.operators.quality import check_report

    lineage = ["email", "source_file", "file_modification_time"]
    return (
        check_report(spark.table(cfg.table("bronze_add")), cfg.table("bronze_add"), lineage)
        .unionByName(check_report(spark.table(cfg.table("bronze_remove")), cfg.table("bronze_remove"), lineage))
        .unionByName(
            check_report(spark.table(cfg.table("contact_silver")), cfg.table("contact_silver"), ["email", "random_id"], ["email"])
        )
        .unionByName(
            check_report(
                spark.table(cfg.table("contact_segment")), cfg.table("contact_segment"), ["email", "segment"], ["email", "segment"]
            )
        )
    )


@contextmanager
def _stage(name: str):
    """Log a stage and its duration as a structured (JSON) record with
    PySpark's own logger (level INFO)."""
    log = PySparkLogger.getLogger("segmentflow")
    t0 = time.perf_counter()
    yield
    log.info("stage finished", stage=name, seconds=round(time.perf_counter() - t0, 3))


def run_segment_pipeline(spark: SparkSession, cfg: JobConfig, date: str | None = None) -> DataFrame:
    """All stages in order.  The segment list table must exist (set up
    once, as is the historic contact load)."""
    apply_session_defaults(spark)
    use_namespace(spark, cfg)
    with _stage("ingest"):
        ingest(spark, cfg)
    with _stage("contacts"):
        contacts(spark, cfg)
    with _stage("segments"):
        segments(spark, cfg)
    with _stage("publish"):
        publish(spark, cfg)
    with _stage("main"):
        build_main(spark, cfg)
    with _stage("export"):
        return export(spark, cfg, date)


def replay_all(spark: SparkSession, cfg: JobConfig, new_state: str) -> JobConfig:
    """Start over (``replay_all``): drop the job's tables and return a
    configuration with a new state folder, so every landed file is read
    again by fresh checkpoints.  The contact table goes too: historic
    contacts are loaded again after it.  The old folder is left for
    inspection."""
    from dataclasses import replace

    from segmentflow.sinks.tables import drop_tables

    drop_tables(spark, [cfg.table(k) for k in ("bronze_add", "bronze_remove", "contact_silver", "contact_segment", "main", "quarantine", "feed_quarantine")])
    return replace(cfg, state=new_state)


def create_segments(spark: SparkSession, cfg: JobConfig, values: list[str] | None = None) -> None:
    """One-off set-up: the segment list table."""
    from segmentflow.sources.tables import inline_values

    overwrite_table(inline_values(spark, values), cfg.table("segments"))


