"""Operators of the contact/segment job run on the driver's tables.

The driver's tables stand in for the job's inputs:

* ``events`` is a feed of membership events: ``user<user_id>`` is the
  contact, ``seg<k mod 7>`` the segment (``k`` from ``props``), ``ts`` the
  file time; signups and purchases are adds, errors are removes.
* ``customer`` is the contact table (``email`` = ``user<c_custkey>``).
* ``orders`` is the file drop: ``o_orderpriority`` names the file,
  ``o_custkey`` the contact.

Each entry pairs a Spark plan (built from the library's operators) with a
DuckDB query computed independently from the same tables.  Every plan reads
whole tables; none samples or caps rows (some scenarios start from a
predicate over them, as in ``upsert_target``).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from segmentflow.config import JobConfig, apply_session_defaults, use_namespace, work_dir
from segmentflow.functions.columns import (
    batch_stamp,
    changed_non_null,
    export_file_name,
    keep_old_if_null,
    path_part,
)
from segmentflow.operators import diff as dff
from segmentflow.operators import marts, merge, overlap, profile, quality, scd2
from segmentflow.operators.dedup import deduplicate, latest_per_key
from segmentflow.operators.surrogate import fix_collisions, hash_id, hash_id_sql
from segmentflow.plans import segment_job
from segmentflow.sinks.export import export_segments
from segmentflow.sinks.tables import (
    append_available_now,
    create_if_missing,
    drop_tables,
    insert_by_name,
    overwrite_table,
    preview,
    stream_into_growing,
)
from segmentflow.sources.files import (
    FEED_SCHEMA,
    aligned,
    read_csv,
    read_lines,
    read_parquet_table,
    stream_json,
    stream_lines,
    stream_parquet,
    stream_table,
    with_file_metadata,
)
from segmentflow.sources.tables import inline_values
from segmentflow.streaming.feeds import land_feed, land_inferred
from segmentflow.streaming.fold import fold_stream, read_state
from segmentflow.streaming.touched import PartitionedState, merge_stream
from segmentflow.streaming.views import daily_counts_stream, maintain_view, read_view

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn

    return deco


def T(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_session_defaults(spark)
    return read_parquet_table(spark, sf_dir, name)


# Fixed scenario values shared by the Spark plans and the oracle SQL.
SEGMENT_COUNT = 7
CUT_TS = "2024-01-15 00:00:00"
LISTED_SEGMENTS = [f"seg{i}" for i in range(SEGMENT_COUNT)] + ["seg_unused"]
MEMBER_SEGMENT = "seg3"
EXPORT_DATE = "2024-01-31"
DAILY_RANGE = ("1998-08-01", "1998-09-01")
SCD2_NOW = "2030-01-01 00:00:00"


# ---------------------------------------------------------------- feeds --
def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership events: email, segment, file time, kind."""
    e = T(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    return e.select(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("email"),
        F.concat(F.lit("seg"), F.pmod(k, F.lit(SEGMENT_COUNT)).cast("string")).alias("segment"),
        F.col("ts").alias("file_modification_time"),
        F.col("event_type"),
    )


def adds_of(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_type").isin("signup", "purchase"))


def removes_of(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_type") == "error")


FEED_SQL = f"""
feed AS (
  SELECT 'user' || CAST(user_id AS VARCHAR) AS email,
         'seg' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % {SEGMENT_COUNT} AS VARCHAR) AS segment,
         ts AS file_modification_time, event_type
  FROM events),
adds AS (SELECT email, segment, max(file_modification_time) AS t FROM feed
         WHERE event_type IN ('signup', 'purchase') GROUP BY email, segment),
rems AS (SELECT email, segment, max(file_modification_time) AS t FROM feed
         WHERE event_type = 'error' GROUP BY email, segment),
membership AS (
  SELECT a.email, a.segment,
         CASE WHEN r.t > a.t THEN r.t ELSE a.t END AS file_modification_time,
         NOT coalesce(r.t > a.t, false) AS is_active
  FROM adds a LEFT JOIN rems r ON a.email = r.email AND a.segment = r.segment)"""


def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass over the event feed (see ``merge.membership_closed_form``)."""
    kind = F.col("event_type")
    return merge.membership_closed_form(feed(spark, sf_dir), kind.isin("signup", "purchase"), kind == "error")


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = T(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("user"), F.col("c_custkey").cast("string")).alias("email"),
        "c_custkey",
        "c_name",
        "c_mktsegment",
    )


CONTACTS_SQL = """
contacts AS (SELECT 'user' || CAST(c_custkey AS VARCHAR) AS email, c_custkey, c_name, c_mktsegment FROM customer)"""


def main_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.main_table(contacts(spark, sf_dir), membership(spark, sf_dir))


MAIN_SQL = (
    FEED_SQL
    + ","
    + CONTACTS_SQL
    + """,
seglist AS (SELECT email, list_sort(list(segment)) AS l FROM membership WHERE is_active GROUP BY email),
main AS (SELECT c.*, s.l AS list_of_segments FROM contacts c LEFT JOIN seglist s ON c.email = s.email)"""
)


def as_text(col: str = "list_of_segments") -> F.Column:
    return F.array_join(F.col(col), ",").alias(col)


# ------------------------------------------------------- minimum slice --
@register(
    "latest_per_key",
    """SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
  FROM events) WHERE rn = 1""",
)
def q_latest_per_key(spark, sf_dir):
    return latest_per_key(T(spark, sf_dir, "events"), ["user_id"], "ts", ["event_id"])


@register(
    "latest_per_key2",
    """SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
  FROM events) WHERE rn = 1""",
)
def q_latest_per_key2(spark, sf_dir):
    return latest_per_key(T(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", ["event_id"])


@register(
    "deduplicate_latest",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST,
         o_orderkey DESC NULLS LAST) AS rn FROM orders) WHERE rn = 1""",
)
def q_deduplicate_latest(spark, sf_dir):
    return deduplicate(T(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")


@register(
    "derive_drop",
    """SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
         ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def q_derive_drop(spark, sf_dir):
    e = T(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return latest_per_key(e, ["user_id", "day"], "ts", ["event_id"]).drop("day")


@register("segment_membership", f"WITH {FEED_SQL} SELECT * FROM membership")
def q_segment_membership(spark, sf_dir):
    return membership(spark, sf_dir)


@register(
    "left_join_agg",
    f"""WITH {MAIN_SQL}
SELECT email, c_custkey, c_name, c_mktsegment, array_to_string(list_of_segments, ',') AS list_of_segments FROM main""",
)
def q_left_join_agg(spark, sf_dir):
    return main_rows(spark, sf_dir).select("email", "c_custkey", "c_name", "c_mktsegment", as_text())


@register(
    "collect_list_by_key",
    f"""WITH {FEED_SQL}
SELECT email, array_to_string(list_sort(list(segment)), ',') AS list_of_segments
FROM membership WHERE is_active GROUP BY email""",
)
def q_collect_list_by_key(spark, sf_dir):
    return marts.active_segments(membership(spark, sf_dir)).select("email", as_text())


@register("filter_flag", f"WITH {FEED_SQL} SELECT * FROM membership WHERE is_active = true")
def q_filter_flag(spark, sf_dir):
    return membership(spark, sf_dir).filter(F.col("is_active"))


@register(
    "filter_array_member",
    f"""WITH {MAIN_SQL}
SELECT email, c_custkey, array_to_string(list_of_segments, ',') AS list_of_segments FROM main
WHERE list_contains(list_of_segments, '{MEMBER_SEGMENT}')""",
)
def q_filter_array_member(spark, sf_dir):
    m = main_rows(spark, sf_dir)
    return m.filter(F.array_contains("list_of_segments", MEMBER_SEGMENT)).select("email", "c_custkey", as_text())


@register(
    "array_member",
    f"""WITH {MAIN_SQL}
SELECT email, list_contains(list_of_segments, '{MEMBER_SEGMENT}') AS is_member FROM main""",
)
def q_array_member(spark, sf_dir):
    m = main_rows(spark, sf_dir)
    return m.select("email", F.array_contains("list_of_segments", MEMBER_SEGMENT).alias("is_member"))


def _segments_values_sql() -> str:
    return ", ".join(f"('{s}')" for s in LISTED_SEGMENTS)


FANOUT_SQL = f"""WITH {MAIN_SQL},
segs AS (SELECT * FROM (VALUES {_segments_values_sql()}) AS data(segment)),
ex AS (SELECT DISTINCT email, c_custkey, c_name, c_mktsegment, unnest(list_of_segments) AS segment FROM main)
SELECT ex.email, ex.c_custkey, ex.c_name, ex.c_mktsegment, ex.segment FROM ex JOIN segs ON ex.segment = segs.segment"""


@register("segment_fanout", FANOUT_SQL)
def q_segment_fanout(spark, sf_dir):
    segs = inline_values(spark, LISTED_SEGMENTS)
    return marts.segment_fanout(main_rows(spark, sf_dir), segs).select(
        "email", "c_custkey", "c_name", "c_mktsegment", "segment"
    )


@register("segment_export", FANOUT_SQL)
def q_segment_export(spark, sf_dir):
    """Writes the export files, then reads them back: the rows compared are
    the rows on disk."""
    segs = inline_values(spark, LISTED_SEGMENTS)
    out = work_dir(spark, "export", uuid.uuid4().hex)
    fan = export_segments(main_rows(spark, sf_dir), segs, out, EXPORT_DATE)
    schema = fan.drop("segment").schema
    back = spark.read.schema(schema).option("header", True).csv(os.path.join(out, f"date={EXPORT_DATE}"))
    return back.select("email", "c_custkey", "c_name", "c_mktsegment", F.col("segment").cast("string"))


@register(
    "segment_activate",
    f"""WITH {FEED_SQL},
early AS (SELECT * FROM feed WHERE file_modification_time < TIMESTAMP '{CUT_TS}'),
ea AS (SELECT email, segment, max(file_modification_time) AS t FROM early WHERE event_type IN ('signup','purchase') GROUP BY 1, 2),
er AS (SELECT email, segment, max(file_modification_time) AS t FROM early WHERE event_type = 'error' GROUP BY 1, 2),
base AS (SELECT a.email, a.segment, CASE WHEN r.t > a.t THEN r.t ELSE a.t END AS file_modification_time,
                NOT coalesce(r.t > a.t, false) AS is_active
         FROM ea a LEFT JOIN er r ON a.email = r.email AND a.segment = r.segment),
la AS (SELECT email, segment, max(file_modification_time) AS t FROM feed
       WHERE file_modification_time >= TIMESTAMP '{CUT_TS}' AND event_type IN ('signup','purchase') GROUP BY 1, 2),
j AS (SELECT b.*, a.email AS ae, a.segment AS asg, a.t AS a_t,
             a.email IS NOT NULL AND (b.email IS NULL OR coalesce(b.file_modification_time < a.t, false)) AS newer
      FROM base b FULL JOIN la a ON b.email = a.email AND b.segment = a.segment)
SELECT coalesce(email, ae) AS email, coalesce(segment, asg) AS segment,
       CASE WHEN newer THEN a_t ELSE file_modification_time END AS file_modification_time,
       CASE WHEN newer THEN true ELSE is_active END AS is_active FROM j""",
)
def q_segment_activate(spark, sf_dir):
    f = feed(spark, sf_dir)
    early = f.filter(F.col("file_modification_time") < F.lit(CUT_TS).cast("timestamp_ntz"))
    late = f.filter(F.col("file_modification_time") >= F.lit(CUT_TS).cast("timestamp_ntz"))
    base = merge.segment_membership(adds_of(early), removes_of(early))
    return merge.segment_activate(base, adds_of(late))


@register(
    "segment_deactivate",
    f"""WITH {FEED_SQL},
early AS (SELECT * FROM feed WHERE file_modification_time < TIMESTAMP '{CUT_TS}'),
ea AS (SELECT email, segment, max(file_modification_time) AS t FROM early WHERE event_type IN ('signup','purchase') GROUP BY 1, 2),
er AS (SELECT email, segment, max(file_modification_time) AS t FROM early WHERE event_type = 'error' GROUP BY 1, 2),
base AS (SELECT a.email, a.segment, CASE WHEN r.t > a.t THEN r.t ELSE a.t END AS file_modification_time,
                NOT coalesce(r.t > a.t, false) AS is_active
         FROM ea a LEFT JOIN er r ON a.email = r.email AND a.segment = r.segment),
lr AS (SELECT email, segment, max(file_modification_time) AS t FROM feed
       WHERE file_modification_time >= TIMESTAMP '{CUT_TS}' AND event_type = 'error' GROUP BY 1, 2)
SELECT b.email, b.segment,
       CASE WHEN coalesce(b.file_modification_time < r.t, false) THEN r.t ELSE b.file_modification_time END AS file_modification_time,
       CASE WHEN coalesce(b.file_modification_time < r.t, false) THEN false ELSE b.is_active END AS is_active
FROM base b LEFT JOIN lr r ON b.email = r.email AND b.segment = r.segment""",
)
def q_segment_deactivate(spark, sf_dir):
    f = feed(spark, sf_dir)
    early = f.filter(F.col("file_modification_time") < F.lit(CUT_TS).cast("timestamp_ntz"))
    late = f.filter(F.col("file_modification_time") >= F.lit(CUT_TS).cast("timestamp_ntz"))
    base = merge.segment_membership(adds_of(early), removes_of(early))
    return merge.segment_deactivate(base, removes_of(late))


@register(
    "late_guard",
    f"""WITH {FEED_SQL},
late AS (SELECT * FROM feed WHERE file_modification_time >= TIMESTAMP '{CUT_TS}'),
la AS (SELECT email, segment, max(file_modification_time) AS t FROM late WHERE event_type IN ('signup','purchase') GROUP BY 1, 2),
lr AS (SELECT email, segment, max(file_modification_time) AS t FROM late WHERE event_type = 'error' GROUP BY 1, 2),
base AS (SELECT a.email, a.segment, CASE WHEN r.t > a.t THEN r.t ELSE a.t END AS file_modification_time,
                NOT coalesce(r.t > a.t, false) AS is_active
         FROM la a LEFT JOIN lr r ON a.email = r.email AND a.segment = r.segment),
ea AS (SELECT email, segment, max(file_modification_time) AS t FROM feed
       WHERE file_modification_time < TIMESTAMP '{CUT_TS}' AND event_type IN ('signup','purchase') GROUP BY 1, 2),
j AS (SELECT b.*, a.email AS ae, a.segment AS asg, a.t AS a_t,
             a.email IS NOT NULL AND (b.email IS NULL OR coalesce(b.file_modification_time < a.t, false)) AS newer
      FROM base b FULL JOIN ea a ON b.email = a.email AND b.segment = a.segment)
SELECT coalesce(email, ae) AS email, coalesce(segment, asg) AS segment,
       CASE WHEN newer THEN a_t ELSE file_modification_time END AS file_modification_time,
       CASE WHEN newer THEN true ELSE is_active END AS is_active FROM j""",
)
def q_late_guard(spark, sf_dir):
    """Newer state, older adds processed late: matched rows keep their newer
    time and flag; only unseen pairs are inserted."""
    f = feed(spark, sf_dir)
    early = f.filter(F.col("file_modification_time") < F.lit(CUT_TS).cast("timestamp_ntz"))
    late = f.filter(F.col("file_modification_time") >= F.lit(CUT_TS).cast("timestamp_ntz"))
    base = merge.segment_membership(adds_of(late), removes_of(late))
    return merge.segment_activate(base, adds_of(early))


# ------------------------------------------------------------ upserts --
UPSERT_COLS = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def upsert_target(spark, sf_dir) -> DataFrame:
    c = T(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "BUILDING")
    return c.select(
        "c_custkey",
        *UPSERT_COLS,
        hash_id(F.col("c_custkey")).alias("random_id"),
        F.concat(F.lit("#K"), F.col("c_nationkey").cast("string")).alias("list_keys"),
    )


def upsert_source(spark, sf_dir) -> DataFrame:
    c = T(spark, sf_dir, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return c.select(
        "c_custkey",
        F.when(F.col("c_nationkey") < 12, F.lit(None)).otherwise(F.concat("c_name", F.lit("-v2"))).alias("c_name"),
        "c_nationkey",
        F.when(F.col("c_acctbal") < 2000, F.lit(None)).otherwise(F.col("c_acctbal") + 1).alias("c_acctbal"),
        "c_mktsegment",
    )


UPSERT_SQL = f"""
tgt AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
               {hash_id_sql('c_custkey')} AS random_id, '#K' || CAST(c_nationkey AS VARCHAR) AS list_keys
        FROM customer WHERE c_mktsegment <> 'BUILDING'),
src AS (SELECT c_custkey, CASE WHEN c_nationkey < 12 THEN NULL ELSE c_name || '-v2' END AS c_name, c_nationkey,
               CASE WHEN c_acctbal < 2000 THEN NULL ELSE c_acctbal + 1 END AS c_acctbal, c_mktsegment
        FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))"""


@register(
    "upsert_keep_non_null",
    f"""WITH {UPSERT_SQL}
SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, coalesce(s.c_name, t.c_name) AS c_name,
       coalesce(s.c_nationkey, t.c_nationkey) AS c_nationkey, coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal,
       coalesce(s.c_mktsegment, t.c_mktsegment) AS c_mktsegment,
       coalesce(t.random_id, {hash_id_sql('s.c_custkey')}) AS random_id, t.list_keys
FROM tgt t FULL JOIN src s ON t.c_custkey = s.c_custkey""",
)
def q_upsert_keep_non_null(spark, sf_dir):
    return merge.upsert_keep_non_null(
        upsert_target(spark, sf_dir), upsert_source(spark, sf_dir), "c_custkey", UPSERT_COLS
    )


@register(
    "changed_non_null",
    f"""WITH {UPSERT_SQL}
SELECT t.c_custkey,
  (s.c_name IS NOT NULL AND (t.c_name IS NULL OR t.c_name <> s.c_name))
  OR (s.c_nationkey IS NOT NULL AND (t.c_nationkey IS NULL OR t.c_nationkey <> s.c_nationkey))
  OR (s.c_acctbal IS NOT NULL AND (t.c_acctbal IS NULL OR t.c_acctbal <> s.c_acctbal))
  OR (s.c_mktsegment IS NOT NULL AND (t.c_mktsegment IS NULL OR t.c_mktsegment <> s.c_mktsegment)) AS changed
FROM tgt t JOIN src s ON t.c_custkey = s.c_custkey""",
)
def q_changed_non_null(spark, sf_dir):
    t, s = upsert_target(spark, sf_dir).alias("t"), upsert_source(spark, sf_dir).alias("s")
    return t.join(s, F.col("t.c_custkey") == F.col("s.c_custkey")).select(
        F.col("t.c_custkey"), changed_non_null(UPSERT_COLS).alias("changed")
    )


@register(
    "keep_old_if_null",
    f"""WITH {UPSERT_SQL}
SELECT t.c_custkey, coalesce(s.c_name, t.c_name) AS c_name, coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal
FROM tgt t JOIN src s ON t.c_custkey = s.c_custkey""",
)
def q_keep_old_if_null(spark, sf_dir):
    t, s = upsert_target(spark, sf_dir).alias("t"), upsert_source(spark, sf_dir).alias("s")
    return t.join(s, F.col("t.c_custkey") == F.col("s.c_custkey")).select(
        F.col("t.c_custkey"),
        keep_old_if_null("s.c_name", "t.c_name").alias("c_name"),
        keep_old_if_null("s.c_acctbal", "t.c_acctbal").alias("c_acctbal"),
    )


@register(
    "is_null_tests",
    f"""WITH {UPSERT_SQL}
SELECT t.c_custkey, s.c_name IS NULL AS src_name_null, t.c_name IS NOT NULL AS tgt_name_set,
       s.c_acctbal > t.c_acctbal AS acctbal_up, s.c_acctbal <> t.c_acctbal AS acctbal_differs,
       (s.c_name IS NULL AND s.c_acctbal IS NULL) AS both_null,
       (s.c_name IS NULL OR s.c_acctbal IS NULL) AS any_null
FROM tgt t JOIN src s ON t.c_custkey = s.c_custkey""",
)
def q_is_null_tests(spark, sf_dir):
    t, s = upsert_target(spark, sf_dir).alias("t"), upsert_source(spark, sf_dir).alias("s")
    sn, sa, ta = F.col("s.c_name"), F.col("s.c_acctbal"), F.col("t.c_acctbal")
    return t.join(s, F.col("t.c_custkey") == F.col("s.c_custkey")).select(
        F.col("t.c_custkey"),
        sn.isNull().alias("src_name_null"),
        F.col("t.c_name").isNotNull().alias("tgt_name_set"),
        (sa > ta).alias("acctbal_up"),
        (sa != ta).alias("acctbal_differs"),
        (sn.isNull() & sa.isNull()).alias("both_null"),
        (sn.isNull() | sa.isNull()).alias("any_null"),
    )


@register(
    "merge_join",
    f"""WITH {UPSERT_SQL}
SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey,
       CASE WHEN t.c_custkey IS NULL THEN 'insert' WHEN s.c_custkey IS NULL THEN 'keep' ELSE 'update' END AS match_kind
FROM tgt t FULL JOIN src s ON t.c_custkey = s.c_custkey""",
)
def q_merge_join(spark, sf_dir):
    t, s = upsert_target(spark, sf_dir).alias("t"), upsert_source(spark, sf_dir).alias("s")
    return t.join(s, F.col("t.c_custkey") == F.col("s.c_custkey"), "full").select(
        F.coalesce("t.c_custkey", "s.c_custkey").alias("c_custkey"),
        F.when(F.col("t.c_custkey").isNull(), "insert")
        .when(F.col("s.c_custkey").isNull(), "keep")
        .otherwise("update")
        .alias("match_kind"),
    )


# ------------------------------------------------ replay / stream fold --
REPLAY_COLS = ["event_type", "value", "props"]


def replay_batches(spark, sf_dir) -> DataFrame:
    """Events as three batches (day of month mod 3), with NULLs made from
    the data: no type for views, no value below 5."""
    e = T(spark, sf_dir, "events")
    return e.select(
        "user_id",
        "ts",
        "event_id",
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("event_type"),
        F.when(F.col("value") >= 5, F.col("value")).alias("value"),
        "props",
        F.pmod(F.dayofmonth("ts"), F.lit(3)).alias("batch"),
    )


REPLAY_SQL = f"""WITH b AS (
  SELECT user_id, ts, event_id, CASE WHEN event_type <> 'view' THEN event_type END AS event_type,
         CASE WHEN value >= 5 THEN value END AS value, props, dayofmonth(ts) % 3 AS batch FROM events),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, batch ORDER BY ts DESC, event_id DESC) AS rn
      FROM b) WHERE rn = 1)
SELECT user_id,
       arg_max(event_type, batch) FILTER (WHERE event_type IS NOT NULL) AS event_type,
       arg_max(value, batch) FILTER (WHERE value IS NOT NULL) AS value,
       arg_max(props, batch) FILTER (WHERE props IS NOT NULL) AS props,
       {hash_id_sql('user_id')} AS random_id
FROM l GROUP BY user_id"""


@register("upsert_replay", REPLAY_SQL)
def q_upsert_replay(spark, sf_dir):
    return merge.upsert_replay(replay_batches(spark, sf_dir), "user_id", REPLAY_COLS, "batch", "ts", ["event_id"])


REPLAY_STATE = "user_id BIGINT, event_type STRING, value DOUBLE, props STRING, random_id STRING"
REPLAY_BUCKETS = 8


@register("foreach_batch_merge", REPLAY_SQL)
def q_foreach_batch_merge(spark, sf_dir):
    """The same result through a streaming merge: the batches land as files
    one run after another, each run is an ``availableNow`` stream whose
    micro-batches rewrite the partitions of the state that they touch."""
    root = work_dir(spark, "fold", uuid.uuid4().hex)
    landing, ckpt = os.path.join(root, "landing"), os.path.join(root, "checkpoint")
    state = PartitionedState(spark, os.path.join(root, "state"), StructType.fromDDL(REPLAY_STATE), ["user_id"], REPLAY_BUCKETS)
    batches = replay_batches(spark, sf_dir)
    schema = batches.schema

    def fold(prev: DataFrame, batch: DataFrame) -> DataFrame:
        return merge.upsert_keep_non_null(
            prev, batch, "user_id", REPLAY_COLS, order_col="ts", tie_cols=["event_id"]
        )

    # One logical stream with one checkpoint; each run picks up only the
    # files that landed since the run before.
    for b in range(3):
        batches.filter(F.col("batch") == b).write.mode("overwrite").parquet(os.path.join(landing, f"b{b}"))
        stream = spark.readStream.schema(schema).parquet(os.path.join(landing, "*"))
        merge_stream(stream, state, fold, "replay", ckpt)
    return state.read()


# --------------------------------------------------------------- SCD2 --
def scd2_target(spark, sf_dir) -> DataFrame:
    c = T(spark, sf_dir, "customer")
    opened = c.filter(F.col("c_mktsegment") != "HOUSEHOLD").select(
        "c_custkey",
        "c_name",
        "c_acctbal",
        F.date_add(F.lit("1998-01-01").cast("date"), F.col("c_nationkey") * 30).cast("timestamp_ntz").alias("modifiedon"),
        F.lit("1990-01-01 00:00:00").cast("timestamp_ntz").alias("start_timestamp"),
        F.lit(None).cast("timestamp_ntz").alias("end_timestamp"),
    )
    closed = c.filter(F.col("c_mktsegment") == "AUTOMOBILE").select(
        "c_custkey",
        "c_name",
        (F.col("c_acctbal") - 100).alias("c_acctbal"),
        F.lit("1989-06-01 00:00:00").cast("timestamp_ntz").alias("modifiedon"),
        F.lit("1989-01-01 00:00:00").cast("timestamp_ntz").alias("start_timestamp"),
        F.lit("1990-01-01 00:00:00").cast("timestamp_ntz").alias("end_timestamp"),
    )
    return opened.unionByName(closed)


def scd2_incoming(spark, sf_dir) -> DataFrame:
    o = T(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("c_custkey"),
        F.concat(F.lit("Order#"), F.col("o_orderkey").cast("string")).alias("c_name"),
        F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderdate").alias("modifiedon"),
    )


SCD2_SQL = f"""
tgt AS (
  SELECT c_custkey, c_name, c_acctbal, CAST(DATE '1998-01-01' + c_nationkey * 30 AS TIMESTAMP) AS modifiedon,
         TIMESTAMP '1990-01-01 00:00:00' AS start_timestamp, CAST(NULL AS TIMESTAMP) AS end_timestamp
  FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
  UNION ALL
  SELECT c_custkey, c_name, c_acctbal - 100, TIMESTAMP '1989-06-01 00:00:00', TIMESTAMP '1989-01-01 00:00:00',
         TIMESTAMP '1990-01-01 00:00:00'
  FROM customer WHERE c_mktsegment = 'AUTOMOBILE'),
inc AS (
  SELECT * FROM (
    SELECT o_custkey AS c_custkey, 'Order#' || CAST(o_orderkey AS VARCHAR) AS c_name, o_totalprice AS c_acctbal,
           o_orderdate AS modifiedon,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, 'Order#' || CAST(o_orderkey AS VARCHAR) DESC,
                              o_totalprice DESC) AS rn
    FROM orders WHERE o_custkey IS NOT NULL) WHERE rn = 1),
op AS (SELECT * FROM tgt WHERE end_timestamp IS NULL),
j AS (SELECT t.c_custkey AS tid, t.c_name AS tname, t.c_acctbal AS tbal, t.modifiedon AS tmod, t.start_timestamp AS tstart,
             i.c_custkey AS iid, i.c_name AS iname, i.c_acctbal AS ibal, i.modifiedon AS imod,
             coalesce(i.modifiedon > t.modifiedon, false) AS newer
      FROM op t FULL JOIN inc i ON t.c_custkey = i.c_custkey)"""


SCD2_MERGE_SQL = f"""WITH {SCD2_SQL}
SELECT * FROM tgt WHERE end_timestamp IS NOT NULL
UNION ALL
SELECT tid, tname, tbal, tmod, tstart, CASE WHEN newer THEN TIMESTAMP '{SCD2_NOW}' END FROM j WHERE tid IS NOT NULL
UNION ALL
SELECT iid, iname, ibal, imod, TIMESTAMP '{SCD2_NOW}', CAST(NULL AS TIMESTAMP) FROM j
WHERE iid IS NOT NULL AND (tid IS NULL OR newer)"""


@register("scd2_merge", SCD2_MERGE_SQL)
def q_scd2_merge(spark, sf_dir):
    now = F.lit(SCD2_NOW).cast("timestamp_ntz")
    return scd2.scd2_merge(scd2_target(spark, sf_dir), scd2_incoming(spark, sf_dir), "c_custkey", "modifiedon", now)


@register("scd2_stream", SCD2_MERGE_SQL)
def q_scd2_stream(spark, sf_dir):
    """The same merge as a fold of a stream into snapshot state; a second
    run of the checkpoint finds nothing new and changes nothing."""
    root, _ = fresh(spark, "scd2-stream")
    scd2_incoming(spark, sf_dir).write.parquet(os.path.join(root, "drop"))
    now = F.lit(SCD2_NOW).cast("timestamp_ntz")
    fold, start = scd2.scd2_fold("c_custkey", "modifiedon", now), lambda spark: scd2_target(spark, sf_dir)
    state = os.path.join(root, "state")
    for _ in range(2):
        stream = stream_parquet(spark, os.path.join(root, "drop"), scd2_incoming(spark, sf_dir).schema)
        fold_stream(stream, fold, state, "scd2", os.path.join(root, "checkpoint"), start)
    return read_state(spark, state, start)


@register(
    "filter_current",
    f"""WITH {SCD2_SQL}
SELECT tid AS c_custkey, tname AS c_name, tbal AS c_acctbal, tmod AS modifiedon, tstart AS start_timestamp,
       CAST(NULL AS TIMESTAMP) AS end_timestamp FROM j WHERE tid IS NOT NULL AND NOT newer
UNION ALL
SELECT iid, iname, ibal, imod, TIMESTAMP '{SCD2_NOW}', CAST(NULL AS TIMESTAMP) FROM j
WHERE iid IS NOT NULL AND (tid IS NULL OR newer)""",
)
def q_filter_current(spark, sf_dir):
    return scd2.current_rows(q_scd2_merge(spark, sf_dir))


@register(
    "rename_map",
    f"""WITH {SCD2_SQL}
SELECT c_custkey AS c_custkey_incoming, c_name AS c_name_incoming, c_acctbal AS c_acctbal_incoming,
       modifiedon AS modifiedon_incoming FROM inc""",
)
def q_rename_map(spark, sf_dir):
    inc = latest_per_key(scd2_incoming(spark, sf_dir).filter(F.col("c_custkey").isNotNull()), ["c_custkey"], "modifiedon")
    return inc.withColumnsRenamed({c: f"{c}_incoming" for c in inc.columns})


@register(
    "left_join_aliased",
    f"""WITH {SCD2_SQL}
SELECT i.c_custkey AS c_custkey_incoming, i.modifiedon AS modifiedon_incoming,
       t.c_custkey AS target_custkey, t.modifiedon AS target_modifiedon
FROM inc i LEFT JOIN op t ON t.c_custkey = i.c_custkey""",
)
def q_left_join_aliased(spark, sf_dir):
    inc = latest_per_key(scd2_incoming(spark, sf_dir).filter(F.col("c_custkey").isNotNull()), ["c_custkey"], "modifiedon")
    inc = inc.withColumnsRenamed({c: f"{c}_incoming" for c in inc.columns}).alias("i")
    t = scd2.current_rows(scd2_target(spark, sf_dir)).alias("t")
    return inc.join(t, F.col("t.c_custkey") == F.col("i.c_custkey_incoming"), "left").select(
        F.col("i.c_custkey_incoming"),
        F.col("i.modifiedon_incoming"),
        F.col("t.c_custkey").alias("target_custkey"),
        F.col("t.modifiedon").alias("target_modifiedon"),
    )


# ---------------------------------------------------- marts and models --
@register(
    "orders_daily",
    f"""SELECT CAST(o_orderdate AS DATE) AS order_date, count(*) AS number_of_orders FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '{DAILY_RANGE[0]}' AND CAST(o_orderdate AS DATE) < DATE '{DAILY_RANGE[1]}'
GROUP BY 1""",
)
def q_orders_daily(spark, sf_dir):
    o = T(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("order_date"))
    return marts.orders_daily(o, DAILY_RANGE)


@register(
    "filter_date_range",
    f"""SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '{DAILY_RANGE[0]} 00:00:00' AND o_orderdate < TIMESTAMP '{DAILY_RANGE[1]} 00:00:00'""",
)
def q_filter_date_range(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    lo, hi = (F.lit(f"{d} 00:00:00").cast("timestamp_ntz") for d in DAILY_RANGE)
    return o.filter((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi)).select("o_orderkey", "o_orderdate")


def order_feed(spark, sf_dir, *extra: str) -> DataFrame:
    """Events as a JSON-like order feed with epoch text; errors carry bad
    text and views an empty string.  ``extra`` columns are carried along."""
    e = T(spark, sf_dir, "events")
    secs = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    return e.select(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("customer_name"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("bad"), F.col("event_id").cast("string")))
        .when(F.col("event_type") == "view", F.lit(""))
        .otherwise(secs)
        .alias("order_datetime"),
        F.col("event_id").alias("order_number"),
        *extra,
    )


ORDER_FEED_SQL = """
feed AS (SELECT 'user' || CAST(user_id AS VARCHAR) AS customer_name,
  CASE WHEN event_type = 'error' THEN 'bad' || CAST(event_id AS VARCHAR) WHEN event_type = 'view' THEN ''
       ELSE CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) END AS order_datetime,
  event_id AS order_number FROM events),
raw AS (SELECT customer_name, CAST(to_timestamp(TRY_CAST(order_datetime AS BIGINT)) AT TIME ZONE 'UTC' AS DATE) AS order_date,
        order_number FROM feed)"""


@register("epoch_to_date", f"WITH {ORDER_FEED_SQL} SELECT * FROM raw")
def q_epoch_to_date(spark, sf_dir):
    return marts.orders_raw(order_feed(spark, sf_dir))


@register(
    "model_ref",
    f"WITH {ORDER_FEED_SQL} SELECT order_date, count(*) AS number_of_orders FROM raw GROUP BY order_date",
)
def q_model_ref(spark, sf_dir):
    """``orders_raw`` as a view model, ``orders_daily`` built on it by name
    (production target: no date window)."""
    view = f"orders_raw_{uuid.uuid4().hex[:8]}"
    marts.orders_raw(order_feed(spark, sf_dir)).createOrReplaceTempView(view)
    return marts.orders_daily(spark.table(view), None)


@register(
    "orders_daily_stream",
    f"WITH {ORDER_FEED_SQL} SELECT order_date, count(*) AS number_of_orders FROM raw GROUP BY order_date",
)
def q_orders_daily_stream(spark, sf_dir):
    """The daily model kept by a streaming aggregate: the order feed lands
    as JSON files in two arrivals (before and after a cut time); each run
    adds the new files to the counts held in the state store."""
    root = work_dir(spark, "daily", uuid.uuid4().hex)
    land, out, ckpt = (os.path.join(root, p) for p in ("landing", "view", "checkpoint"))
    feed = order_feed(spark, sf_dir, "ts")
    cut = F.lit(CUT_TS).cast("timestamp_ntz")
    schema = "customer_name STRING, order_datetime STRING, order_number BIGINT"
    for name, part in (("a", feed.filter(F.col("ts") < cut)), ("b", feed.filter(F.col("ts") >= cut))):
        part.drop("ts").write.json(os.path.join(land, name))
        stream = spark.readStream.schema(schema).json(os.path.join(land, "*"))
        maintain_view(daily_counts_stream(stream), out, ckpt)
    return read_view(spark, out)


@register(
    "model_checks",
    f"""WITH {ORDER_FEED_SQL},
daily AS (SELECT order_date, count(*) AS number_of_orders FROM raw GROUP BY order_date)
SELECT 'orders_raw' AS table_name, 'not_null' AS check_name, 'customer_name' AS columns,
       count(*) FILTER (WHERE customer_name IS NULL) AS failing_rows FROM raw
UNION ALL
SELECT 'orders_raw', 'unique_key', 'customer_name', CAST(coalesce(sum(n), 0) AS BIGINT) FROM
  (SELECT customer_name, count(*) AS n FROM raw WHERE customer_name IS NOT NULL GROUP BY customer_name HAVING count(*) > 1)
UNION ALL
SELECT 'orders_daily', 'not_null', 'order_date', count(*) FILTER (WHERE order_date IS NULL) FROM daily
UNION ALL
SELECT 'orders_daily', 'unique_key', 'order_date', CAST(coalesce(sum(n), 0) AS BIGINT) FROM
  (SELECT order_date, count(*) AS n FROM daily WHERE order_date IS NOT NULL GROUP BY order_date HAVING count(*) > 1)""",
)
def q_model_checks(spark, sf_dir):
    """The column tests declared for the two order models: ``customer_name``
    unique and set in ``orders_raw`` (fails for repeat buyers, as noted),
    ``order_date`` unique and set in ``orders_daily`` (the NULL date of bad
    epoch text shows up as one failing row)."""
    raw = marts.orders_raw(order_feed(spark, sf_dir))
    daily = marts.orders_daily(raw, None)
    return quality.check_report(raw, "orders_raw", ["customer_name"], ["customer_name"]).unionByName(
        quality.check_report(daily, "orders_daily", ["order_date"], ["order_date"])
    )


@register(
    "dataset_view",
    "SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem WHERE l_quantity < 30",
)
def q_dataset_view(spark, sf_dir):
    view = f"lineitem_small_{uuid.uuid4().hex[:8]}"
    T(spark, sf_dir, "lineitem").filter(F.expr("l_quantity < 30")).createOrReplaceTempView(view)
    return spark.table(view).select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")


@register(
    "dataset_table",
    """SELECT l_returnflag, sum(l_quantity) AS sum_qty, count(*) AS line_count FROM lineitem
WHERE l_quantity < 30 GROUP BY l_returnflag""",
)
def q_dataset_table(spark, sf_dir):
    view = f"lineitem_small_{uuid.uuid4().hex[:8]}"
    T(spark, sf_dir, "lineitem").filter(F.expr("l_quantity < 30")).createOrReplaceTempView(view)
    _, table = fresh(spark, "dataset")
    overwrite_table(
        spark.table(view).groupBy("l_returnflag").agg(F.sum("l_quantity").alias("sum_qty"), F.count("*").alias("line_count")),
        table,
    )
    return spark.table(table)


@register(
    "filter_lt",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 30",
)
def q_filter_lt(spark, sf_dir):
    return T(spark, sf_dir, "lineitem").filter(F.expr("l_quantity < 30")).select("l_orderkey", "l_linenumber", "l_quantity")


@register(
    "filter_eq",
    "SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice FROM lineitem WHERE l_returnflag = 'R'",
)
def q_filter_eq(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem")
    return li.filter(F.col("l_returnflag") == F.lit("R")).select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")


@register(
    "sum_by_group",
    "SELECT l_suppkey, round(sum(l_extendedprice), 2) AS total_price FROM lineitem GROUP BY l_suppkey",
)
def q_sum_by_group(spark, sf_dir):
    s = marts.sum_by_group(T(spark, sf_dir, "lineitem"), "l_suppkey", "l_extendedprice", "total_price")
    return s.select("l_suppkey", F.round("total_price", 2).alias("total_price"))


@register(
    "count_by_two",
    "SELECT l_returnflag, l_linestatus, count(*) AS record_count FROM lineitem GROUP BY 1, 2",
)
def q_count_by_two(spark, sf_dir):
    return profile.count_by(T(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "record_count")


@register(
    "count_distinct",
    "SELECT count(DISTINCT l_orderkey) AS unique_orders, count(DISTINCT l_suppkey) AS unique_suppliers FROM lineitem",
)
def q_count_distinct(spark, sf_dir):
    return T(spark, sf_dir, "lineitem").agg(
        F.countDistinct("l_orderkey").alias("unique_orders"), F.countDistinct("l_suppkey").alias("unique_suppliers")
    )


@register("count_rows", "SELECT count(*) AS row_count FROM orders")
def q_count_rows(spark, sf_dir):
    return T(spark, sf_dir, "orders").agg(F.count("*").alias("row_count"))


@register("table_scan", "SELECT * FROM nation")
def q_table_scan(spark, sf_dir):
    return T(spark, sf_dir, "nation")


@register("select_cols", "SELECT o_orderkey, o_custkey FROM orders")
def q_select_cols(spark, sf_dir):
    return T(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")


@register("order_by", "SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey")
def q_order_by(spark, sf_dir):
    return T(spark, sf_dir, "nation").select("n_nationkey", "n_name").orderBy("n_nationkey")


@register("limit_n", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_orderkey LIMIT 10")
def q_limit_n(spark, sf_dir):
    return preview(T(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), 10, ["o_orderkey"])


@register(
    "ingest_status",
    """SELECT CASE WHEN event_type = 'error' THEN 'remove' ELSE 'add' END AS file_type,
       count(DISTINCT user_id) AS file_count, max(ts) AS last_processed
FROM events WHERE event_type IN ('signup', 'purchase', 'error') GROUP BY 1""",
)
def q_ingest_status(spark, sf_dir):
    e = T(spark, sf_dir, "events")
    added = e.filter(F.col("event_type").isin("signup", "purchase"))
    removed = e.filter(F.col("event_type") == "error")
    return marts.ingest_status(added, removed, "user_id", "ts")


@register(
    "now_and_dates",
    "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS batch_id, strftime(ts, '%Y-%m-%d') AS file_date FROM events",
)
def q_now_and_dates(spark, sf_dir):
    e = T(spark, sf_dir, "events")
    return e.select("event_id", batch_stamp(F.col("ts")).alias("batch_id"), F.date_format("ts", "yyyy-MM-dd").alias("file_date"))


@register(
    "inline_values",
    f"""WITH {FEED_SQL},
segs AS (SELECT * FROM (VALUES {_segments_values_sql()}) AS data(segment))
SELECT s.segment, count(m.email) AS active_members
FROM segs s LEFT JOIN membership m ON s.segment = m.segment AND m.is_active GROUP BY s.segment""",
)
def q_inline_values(spark, sf_dir):
    """Active members per listed segment, zero for a segment without any.
    Members are counted per segment first (combined map-side), so the join
    with the literal list sees one row per segment, however large a
    segment is."""
    segs = inline_values(spark, LISTED_SEGMENTS)
    counts = membership(spark, sf_dir).filter("is_active").groupBy("segment").agg(F.count("email").alias("n"))
    return segs.join(counts, "segment", "left").select(
        "segment", F.coalesce("n", F.lit(0).cast("bigint")).alias("active_members")
    )


@register(
    "literals_casts",
    f"""WITH {FEED_SQL}
SELECT email, segment, true AS is_active_default, CAST(NULL AS TIMESTAMP) AS end_timestamp, 'insert' AS change_type
FROM membership""",
)
def q_literals_casts(spark, sf_dir):
    m = membership(spark, sf_dir)
    return m.select(
        "email",
        "segment",
        F.lit(True).alias("is_active_default"),
        F.lit(None).cast("timestamp_ntz").alias("end_timestamp"),
        F.lit("insert").alias("change_type"),
    )


@register(
    "name_concat",
    f"""WITH {FEED_SQL}
SELECT DISTINCT segment, segment || '{EXPORT_DATE}' || '.csv' AS file_name FROM membership""",
)
def q_name_concat(spark, sf_dir):
    m = membership(spark, sf_dir).select("segment").distinct()
    return m.select("segment", export_file_name(F.col("segment"), F.lit(EXPORT_DATE)).alias("file_name"))


@register("path_part", "SELECT page_id, string_split(url, '/')[-3] AS part FROM pages")
def q_path_part(spark, sf_dir):
    return T(spark, sf_dir, "pages").select("page_id", path_part("url", -3).alias("part"))


@register("surrogate_id", f"SELECT c_custkey, {hash_id_sql('c_custkey')} AS random_id FROM customer")
def q_surrogate_id(spark, sf_dir):
    c = T(spark, sf_dir, "customer").select("c_custkey", hash_id(F.col("c_custkey")).alias("random_id"))
    return fix_collisions(c, "c_custkey", "random_id")


# ------------------------------------------------------------ overlap --
OVERLAP_SQL = """
weeks AS (SELECT date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) // 7 AS f, o_custkey AS k FROM orders),
d AS (SELECT DISTINCT f, k FROM weeks WHERE k IS NOT NULL AND f IS NOT NULL),
files AS (SELECT DISTINCT f FROM weeks WHERE f IS NOT NULL),
ap AS (SELECT a.f AS file_a, b.f AS file_b FROM files a JOIN files b ON a.f < b.f),
sh AS (SELECT a.f AS file_a, b.f AS file_b, count(*) AS n FROM d a JOIN d b ON a.k = b.k AND a.f < b.f GROUP BY 1, 2),
po AS (SELECT ap.file_a, ap.file_b, coalesce(sh.n, 0) AS shared_keys FROM ap LEFT JOIN sh
       ON ap.file_a = sh.file_a AND ap.file_b = sh.file_b)"""


def weekly_orders(spark, sf_dir) -> DataFrame:
    """The customers of each week's orders; the week names the file.  Some
    pairs of weeks share no customer."""
    day = F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1990-01-01").cast("date"))
    return T(spark, sf_dir, "orders").select(F.floor(day / 7).alias("f"), F.col("o_custkey").alias("k"))


def _pairs(spark, sf_dir):
    return overlap.pair_overlap(weekly_orders(spark, sf_dir), "f", "k")


@register("pair_overlap", f"WITH {OVERLAP_SQL} SELECT * FROM po")
def q_pair_overlap(spark, sf_dir):
    return _pairs(spark, sf_dir)


@register("all_pairs", f"WITH {OVERLAP_SQL} SELECT * FROM ap")
def q_all_pairs(spark, sf_dir):
    return overlap.all_pairs(weekly_orders(spark, sf_dir), "f")


@register(
    "overlap_stats",
    f"""WITH {OVERLAP_SQL}
SELECT min(shared_keys) AS min_shared, max(shared_keys) AS max_shared, avg(shared_keys) AS avg_shared,
       count(*) AS pair_count FROM po""",
)
def q_overlap_stats(spark, sf_dir):
    return overlap.pair_overlap_stats(weekly_orders(spark, sf_dir), "f", "k")


@register(
    "filter_min_shared",
    f"WITH {OVERLAP_SQL} SELECT * FROM po WHERE shared_keys >= 3",
)
def q_filter_min_shared(spark, sf_dir):
    """Pairs of weeks that share at least three customers."""
    return overlap.shared_at_least(weekly_orders(spark, sf_dir), "f", "k", 3)


@register(
    "overlap_summary",
    """WITH d AS (SELECT DISTINCT o_orderpriority AS f, o_custkey AS k FROM orders WHERE o_custkey IS NOT NULL AND o_orderpriority IS NOT NULL),
pk AS (SELECT k, count(*) AS nf FROM d GROUP BY k)
SELECT count(*) AS unique_keys, count(*) FILTER (WHERE nf >= 2) AS overlapping_keys,
       CAST(count(*) FILTER (WHERE nf >= 2) AS DOUBLE) * 100.0 / count(*) AS overlap_pct,
       CAST(sum(nf) AS DOUBLE) / (SELECT count(DISTINCT o_orderpriority) FROM orders) AS avg_keys_per_file
FROM pk""",
)
def q_overlap_summary(spark, sf_dir):
    return overlap.overlap_summary(T(spark, sf_dir, "orders"), "o_orderpriority", "o_custkey")


@register(
    "seen_before",
    """WITH d AS (SELECT DISTINCT o_orderpriority AS f, o_custkey AS k FROM orders WHERE o_custkey IS NOT NULL AND o_orderpriority IS NOT NULL),
fi AS (SELECT k, min(f) AS ff FROM d GROUP BY k)
SELECT d.f AS o_orderpriority, count(*) AS unique_keys, count(*) FILTER (WHERE d.f > fi.ff) AS seen_before
FROM d JOIN fi ON d.k = fi.k GROUP BY d.f""",
)
def q_seen_before(spark, sf_dir):
    return overlap.seen_before(T(spark, sf_dir, "orders"), "o_orderpriority", "o_custkey")


NULLED_ORDERS_SQL = """
o AS (SELECT o_orderkey, o_orderpriority,
             CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS o_custkey,
             NULLIF(o_orderstatus, 'F') AS o_orderstatus,
             CASE WHEN o_totalprice < 50000 THEN NULL ELSE o_totalprice END AS o_totalprice, o_orderdate
      FROM orders)"""


def nulled_orders(spark, sf_dir) -> DataFrame:
    o = T(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        "o_orderpriority",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"),
        F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("o_orderstatus"),
        F.when(F.col("o_totalprice") >= 50000, F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
    )


@register(
    "duplicate_rate",
    f"""WITH {NULLED_ORDERS_SQL}
SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM o)) AS distinct_keys,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM o)) AS DOUBLE) / count(*) AS duplicate_rate
FROM o""",
)
def q_duplicate_rate(spark, sf_dir):
    return overlap.duplicate_rate(nulled_orders(spark, sf_dir), "o_custkey")


@register(
    "null_profile",
    f"""WITH {NULLED_ORDERS_SQL}
SELECT o_orderpriority, count(*) AS records, count(o_custkey) AS non_null_o_custkey,
       count(*) FILTER (WHERE o_orderstatus IS NULL) AS null_o_orderstatus,
       count(*) FILTER (WHERE o_totalprice IS NULL) AS null_o_totalprice,
       count(*) FILTER (WHERE o_orderdate IS NULL) AS null_o_orderdate
FROM o GROUP BY o_orderpriority""",
)
def q_null_profile(spark, sf_dir):
    return profile.null_profile(
        nulled_orders(spark, sf_dir), "o_orderpriority", ["o_orderstatus", "o_totalprice", "o_orderdate"], key="o_custkey"
    )


@register(
    "not_null",
    f"WITH {NULLED_ORDERS_SQL} SELECT * FROM o WHERE o_custkey IS NULL OR o_totalprice IS NULL",
)
def q_not_null(spark, sf_dir):
    return quality.not_null(nulled_orders(spark, sf_dir), ["o_custkey", "o_totalprice"])


@register(
    "unique_key",
    "SELECT o_custkey, count(*) AS occurrences FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1",
)
def q_unique_key(spark, sf_dir):
    return quality.unique_key(T(spark, sf_dir, "orders"), ["o_custkey"])


@register(
    "table_checks",
    f"""WITH {NULLED_ORDERS_SQL}
SELECT 'orders' AS table_name, 'not_null' AS check_name, 'o_custkey' AS columns,
       count(*) FILTER (WHERE o_custkey IS NULL) AS failing_rows FROM o
UNION ALL
SELECT 'orders', 'not_null', 'o_totalprice', count(*) FILTER (WHERE o_totalprice IS NULL) FROM o
UNION ALL
SELECT 'orders', 'unique_key', 'o_custkey', CAST(coalesce(sum(n), 0) AS BIGINT) FROM
  (SELECT o_custkey, count(*) AS n FROM o WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1)""",
)
def q_table_checks(spark, sf_dir):
    """Check report: NULL counts and rows of repeated keys."""
    return quality.check_report(nulled_orders(spark, sf_dir), "orders", ["o_custkey", "o_totalprice"], ["o_custkey"])


# ------------------------------------------------------------ set ops --
@register(
    "frame_equal",
    """WITH l AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
           UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'),
r AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_custkey END AS o_custkey, o_orderstatus FROM orders),
b AS (SELECT *, 1 AS x, 0 AS y FROM l UNION ALL SELECT *, 0, 1 FROM r)
SELECT o_orderkey, o_custkey, o_orderstatus, sum(x) AS left_rows, sum(y) AS right_rows
FROM b GROUP BY ALL HAVING sum(x) <> sum(y)""",
)
def q_frame_equal(spark, sf_dir):
    """Two versions of ``orders``, columns in another order: urgent orders
    are there twice, orders of high priority have lost their customer."""
    o = T(spark, sf_dir, "orders")
    priority = F.col("o_orderpriority")
    left = o.unionByName(o.filter(priority == "1-URGENT")).select("o_orderkey", "o_custkey", "o_orderstatus")
    custkey = F.when(priority == "2-HIGH", F.lit(None)).otherwise(F.col("o_custkey")).alias("o_custkey")
    return quality.frame_difference(left, o.select("o_orderstatus", custkey, "o_orderkey"))


@register(
    "unseen_keys",
    """SELECT * FROM customer c WHERE NOT EXISTS
  (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')""",
)
def q_unseen_keys(spark, sf_dir):
    """Customers without an urgent order."""
    urgent = T(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return overlap.unseen_keys(T(spark, sf_dir, "customer"), urgent, "c_custkey", "o_custkey")


@register(
    "intersect_keys",
    "SELECT c_custkey AS custkey FROM customer INTERSECT SELECT o_custkey FROM orders",
)
def q_intersect_keys(spark, sf_dir):
    c = T(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))
    o = T(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"))
    return c.intersect(o)


@register(
    "union_distinct",
    "SELECT c_custkey AS custkey FROM customer UNION SELECT o_custkey FROM orders",
)
def q_union_distinct(spark, sf_dir):
    c = T(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))
    o = T(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"))
    return c.union(o).distinct()


@register(
    "union_all",
    "SELECT c_custkey AS custkey, 'customer' AS origin FROM customer UNION ALL SELECT o_custkey, 'orders' FROM orders",
)
def q_union_all(spark, sf_dir):
    c = T(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), F.lit("customer").alias("origin"))
    o = T(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), F.lit("orders").alias("origin"))
    return c.unionByName(o)


@register("distinct_values", "SELECT DISTINCT o_orderpriority FROM orders")
def q_distinct_values(spark, sf_dir):
    return T(spark, sf_dir, "orders").select("o_orderpriority").distinct()


# --------------------------------------------------- definition diff --
def definitions(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Two versions of a definition per customer name.

    Source: ``{acctbal, mktsegment, nation, tags}``.  Target: the same
    fields in another key order, the list ``tags`` in another order too; AUTOMOBILE customers have another balance, MACHINERY
    customers a nation written as text (type change), HOUSEHOLD customers
    text that does not parse, FURNITURE customers no target row; supplier
    names exist only in the target.
    """
    c = T(spark, sf_dir, "customer")
    src = c.select(
        F.col("c_name").alias("name"),
        F.to_json(
            F.struct(
                F.col("c_acctbal").alias("acctbal"),
                F.col("c_mktsegment").alias("mktsegment"),
                F.col("c_nationkey").alias("nation"),
                F.array("c_mktsegment", F.lit("all"), "c_name").alias("tags"),
            )
        ).alias("definition"),
    )
    seg = F.col("c_mktsegment")
    bal = F.when(seg == "AUTOMOBILE", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("acctbal")

    def doc(nation):
        tags = F.array(F.col("c_name"), seg, F.lit("all")).alias("tags")
        return F.to_json(F.struct(nation.alias("nation"), tags, seg.alias("mktsegment"), bal))

    tgt = c.filter(seg != "FURNITURE").select(
        F.col("c_name").alias("name"),
        F.when(seg == "HOUSEHOLD", F.concat(F.lit("{broken "), F.col("c_name")))
        .when(seg == "MACHINERY", doc(F.col("c_nationkey").cast("string")))
        .otherwise(doc(F.col("c_nationkey")))
        .alias("definition"),
    )
    sup = T(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.to_json(F.struct(F.col("s_acctbal").alias("acctbal"))).alias("definition")
    )
    return src, tgt.unionByName(sup)


DEFS_SQL = """
src AS (SELECT c_name AS name, c_acctbal AS acctbal, c_mktsegment AS mktsegment, c_nationkey AS nation FROM customer),
tgt AS (SELECT c_name AS name, c_mktsegment AS seg,
               CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN c_acctbal + 1 ELSE c_acctbal END AS acctbal,
               c_mktsegment AS mktsegment, c_nationkey AS nation
        FROM customer WHERE c_mktsegment <> 'FURNITURE'),
cmp AS (
  SELECT s.name, t.name AS tname, t.seg,
         CASE WHEN t.name IS NULL THEN NULL
              WHEN t.seg = 'HOUSEHOLD' THEN ['<entire policy definition>']
              ELSE list_sort(list_filter([
                 CASE WHEN s.acctbal IS DISTINCT FROM t.acctbal THEN 'acctbal' END,
                 CASE WHEN s.mktsegment IS DISTINCT FROM t.mktsegment THEN 'mktsegment' END,
                 CASE WHEN t.seg = 'MACHINERY' OR s.nation IS DISTINCT FROM t.nation THEN 'nation' END], lambda x: x IS NOT NULL))
         END AS fields
  FROM src s LEFT JOIN tgt t ON s.name = t.name)"""


@register(
    "definition_diff",
    f"""WITH {DEFS_SQL}
SELECT name,
       CASE WHEN tname IS NULL THEN 'CREATE' WHEN len(fields) > 0 THEN 'UPDATE' ELSE 'NO CHANGE' END AS action,
       CASE WHEN tname IS NOT NULL AND len(fields) > 0 THEN array_to_string(fields, ',') END AS changed_fields
FROM cmp""",
)
def q_definition_diff(spark, sf_dir):
    src, tgt = definitions(spark, sf_dir)
    d = dff.definition_diff(src, tgt)
    return d.select("name", "action", F.array_join("changed_fields", ",").alias("changed_fields"))


@register(
    "definition_lookup",
    f"WITH {DEFS_SQL} SELECT name, tname IS NOT NULL AS found FROM cmp",
)
def q_definition_lookup(spark, sf_dir):
    src, tgt = definitions(spark, sf_dir)
    j = src.alias("s").join(tgt.alias("t"), F.col("s.name") == F.col("t.name"), "left")
    return j.select(F.col("s.name").alias("name"), F.col("t.name").isNotNull().alias("found"))


@register(
    "json_field_diff",
    f"""WITH {DEFS_SQL}
SELECT name, array_to_string(fields, ',') AS changed_fields FROM cmp WHERE tname IS NOT NULL""",
)
def q_json_field_diff(spark, sf_dir):
    d = dff.definition_diff(*definitions(spark, sf_dir)).filter(F.col("action") != dff.CREATE)
    return d.select(
        "name", F.array_join(F.coalesce("changed_fields", F.array().cast("array<string>")), ",").alias("changed_fields")
    )


@register(
    "nested_definition_diff",
    """SELECT c_name AS name, CASE WHEN c_nationkey IN (7, 20) THEN 'NO CHANGE' ELSE 'UPDATE' END AS action,
       CASE WHEN c_nationkey < 5 THEN 'limits.cpu.max' WHEN c_nationkey < 7 THEN 'limits.cpu.max,limits.tags,owner'
            WHEN c_nationkey IN (7, 20) THEN NULL WHEN c_nationkey < 12 THEN 'limits'
            ELSE 'limits.cpu.max,limits.cpu.more,limits.cpu.note' END AS changed_fields FROM customer""",
)
def q_nested_definition_diff(spark, sf_dir):
    """Definitions of three levels: changes are named by their path.  Nation
    7 has a list in another order, below nation 12 the rest lose the whole
    object, from 12 on keys are only on one side; nation 20 is unchanged."""
    c, k = T(spark, sf_dir, "customer"), F.col("c_nationkey")

    def doc(limits, owner="c_name"):
        return F.to_json(F.struct(limits.alias("limits"), F.col(owner).alias("owner")))

    def limits(top, tags, *cpu):
        return F.struct(F.struct(top.alias("max"), F.lit(1).alias("min"), *cpu).alias("cpu"), F.array(*tags).alias("tags"))

    tags = [F.lit("a"), F.struct(k.alias("n")).cast("string"), F.col("c_name")]
    source = c.select(F.col("c_name").alias("name"), doc(limits(k, tags, F.lit("x").alias("note"))).alias("definition"))
    note = F.lit("x").alias("note")
    target = (
        F.when(k < 5, doc(limits(k + 1, tags, note)))
        .when(k < 7, doc(limits(k.cast("string"), tags[:2], note), "c_mktsegment"))
        .when(k == 7, doc(limits(k, tags[::-1], note)))
        .when(k < 12, doc(F.lit("none")))
        .when(k == 20, doc(limits(k, tags, note)))
        .otherwise(doc(limits(-k - 1, tags, F.lit(2).alias("more"))))
    )
    d = dff.definition_diff(source, c.select(F.col("c_name").alias("name"), target.alias("definition")))
    return d.select("name", "action", F.array_join("changed_fields", ",").alias("changed_fields"))


@register(
    "sorted_unique_list",
    f"""WITH {DEFS_SQL}
SELECT array_to_string(list_sort(list_distinct(flatten(list(fields)))), ',') AS all_changed_fields
FROM cmp WHERE tname IS NOT NULL""",
)
def q_sorted_unique_list(spark, sf_dir):
    d = dff.definition_diff(*definitions(spark, sf_dir)).filter(F.col("action") != dff.CREATE)
    # Distinct field names first (map-side), then one sorted list of them:
    # the list is bounded by the number of distinct field names.
    names = d.select(F.explode("changed_fields").alias("f")).distinct()
    return names.agg(F.array_join(F.array_sort(F.collect_list("f")), ",").alias("all_changed_fields"))


@register("preview", "SELECT n_nationkey, n_name, n_regionkey FROM nation ORDER BY n_nationkey LIMIT 5")
def q_preview(spark, sf_dir):
    """First rows for a look, ordered so the preview repeats."""
    return preview(T(spark, sf_dir, "nation"), 5, ["n_nationkey"])


@register("orders_raw", f"WITH {ORDER_FEED_SQL} SELECT customer_name, order_date, order_number FROM raw")
def q_orders_raw(spark, sf_dir):
    """The order model on its own: name, date from epoch text, number."""
    return marts.orders_raw(order_feed(spark, sf_dir)).select("customer_name", "order_date", "order_number")


# ------------------------------------------------------ the whole job --
def events_job(spark: SparkSession, sf_dir: str, state_buckets: int = 16) -> tuple[JobConfig, dict]:
    """Run the segment job on CSV drops made from ``events``.

    ``<landing>/<segment>/add`` gets the signups and purchases,
    ``<landing>/<segment>/remove`` the errors, in the five-column feed
    layout.  All add files are written before any remove file, so a remove
    is always newer than the adds of its segment.  Table names are unique
    per run.  Returns the configuration and the stage times."""
    import time

    run = uuid.uuid4().hex[:12]
    root = work_dir(spark, "segment-job", run)
    names = JobConfig(landing="", state="", export="").tables
    cfg = JobConfig(
        landing=os.path.join(root, "landing"),
        state=os.path.join(root, "state"),
        export=os.path.join(root, "export"),
        state_buckets=state_buckets,
        tables={k: f"sfjob_{run}_{k}" for k in names},
    )
    e = T(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    rows = e.select(
        F.concat(F.lit("seg"), F.pmod(k, F.lit(SEGMENT_COUNT)).cast("string")).alias("segment"),
        F.when(F.col("event_type") == "error", "remove").otherwise("add").alias("kind"),
        F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("Name"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("email"),
        F.date_add(F.lit("1970-01-01").cast("date"), F.col("user_id").cast("int")).alias("DOB"),
        F.col("event_type").alias("occupation"),
        F.col("event_id").cast("string").alias("phone_number"),
    ).filter(F.col("occupation").isin("signup", "purchase", "error"))
    t0 = time.perf_counter()
    # One pass over the events; each drop then reads its own partition.
    made = os.path.join(root, "rows")
    rows.write.partitionBy("kind", "segment").parquet(made)
    rows = spark.read.schema(rows.schema).parquet(made).select(*rows.columns)
    for kind in ("add", "remove"):
        for seg in [f"seg{i}" for i in range(SEGMENT_COUNT)]:
            part = rows.filter((F.col("segment") == seg) & (F.col("kind") == kind)).drop("segment", "kind")
            part.write.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(os.path.join(cfg.landing, seg, kind))
    t1 = time.perf_counter()
    segment_job.create_segments(spark, cfg, LISTED_SEGMENTS)
    segment_job.run_segment_pipeline(spark, cfg, date=EXPORT_DATE)
    t2 = time.perf_counter()
    return cfg, {"landing_write_sec": round(t1 - t0, 3), "job_sec": round(t2 - t1, 3)}


SEGMENT_JOB_SQL = f"""WITH f AS (
  SELECT 'user' || CAST(user_id AS VARCHAR) AS email,
         'seg' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % {SEGMENT_COUNT} AS VARCHAR) AS segment,
         event_type FROM events),
a AS (SELECT DISTINCT email, segment FROM f WHERE event_type IN ('signup', 'purchase')),
r AS (SELECT DISTINCT email, segment FROM f WHERE event_type = 'error'),
act AS (SELECT email, segment FROM a WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.email = a.email AND r.segment = a.segment)),
seglist AS (SELECT email, array_to_string(list_sort(list(segment)), ',') AS l FROM act GROUP BY email)
SELECT c.email, s.l AS list_of_segments FROM (SELECT DISTINCT email FROM a) c LEFT JOIN seglist s ON c.email = s.email"""


@register("segment_job", SEGMENT_JOB_SQL)
def q_segment_job(spark, sf_dir):
    """The whole job (CSV streams to bronze with lineage, contact and
    membership folds on bucketed state, main table, export) on drops made
    from ``events``; the main table's contacts and their segments."""
    cfg, _ = events_job(spark, sf_dir)
    return spark.table(cfg.table("main")).select("email", as_text())


@register("replay_all", SEGMENT_JOB_SQL)
def q_replay_all(spark, sf_dir):
    """The job's tables dropped and every landed file read again with a new
    state folder: the same main table."""
    cfg, _ = events_job(spark, sf_dir)
    again = segment_job.replay_all(spark, cfg, cfg.state + "-again")
    again = replace(again, export=cfg.export + "-again")
    segment_job.run_segment_pipeline(spark, again, date=EXPORT_DATE)
    return spark.table(again.table("main")).select("email", as_text())


# --------------------------------------------------------- file facts --
@register(
    "file_metadata",
    """SELECT o_orderkey, 'orders.parquet' AS source_name, true AS has_file_time, true AS has_ingestion_time FROM orders""",
)
def q_file_metadata(spark, sf_dir):
    """Lineage columns on every ``orders`` row: the name of its file, and
    whether modification and ingestion time are set and in order."""
    o = with_file_metadata(T(spark, sf_dir, "orders"))
    return o.select(
        "o_orderkey",
        path_part("source_file", -1).alias("source_name"),
        F.coalesce(F.col("file_modification_time") <= F.col("ingestion_timestamp"), F.lit(False)).alias("has_file_time"),
        F.col("ingestion_timestamp").isNotNull().alias("has_ingestion_time"),
    )


@register(
    "file_inventory",
    """SELECT 'part-' || CAST(l_linenumber AS VARCHAR) AS file_group, count(*) AS records, true AS has_size
FROM lineitem GROUP BY l_linenumber""",
)
def q_file_inventory(spark, sf_dir):
    """Rows and bytes per Parquet file, for ``lineitem`` written as one
    folder per line number; the folder's files are added up."""
    out = work_dir(spark, "inventory", uuid.uuid4().hex)
    T(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").write.partitionBy("l_linenumber").parquet(out)
    files = profile.file_inventory(spark.read.parquet(out))
    group = F.regexp_extract("file_path", "l_linenumber=([0-9]+)", 1)
    return files.groupBy(F.concat(F.lit("part-"), group).alias("file_group")).agg(
        F.sum("records").alias("records"), (F.min("size_bytes") > 0).alias("has_size")
    )


# ------------------------------------------- readers and writers alone --
FEED_ROWS_SQL = """SELECT c_name AS "Name", 'user' || CAST(c_custkey AS VARCHAR) AS email, c_mktsegment AS occupation, 'n' || CAST(c_nationkey AS VARCHAR) AS phone_number
FROM customer"""


def contact_drop(spark, sf_dir, root: str, fmt: str = "csv") -> str:
    """``customer`` as feed files (five columns) in a new folder."""
    c = T(spark, sf_dir, "customer")
    rows = c.select(
        F.col("c_name").alias("Name"),
        F.concat(F.lit("user"), F.col("c_custkey").cast("string")).alias("email"),
        F.lit("1990-01-01").alias("DOB"),
        F.col("c_mktsegment").alias("occupation"),
        F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("phone_number"),
    )
    path = os.path.join(root, "drop")
    if fmt != "csv":
        rows.write.format(fmt).save(path)
        return path
    # Two drops of different column orders, one with a column more.
    first = F.col("phone_number") < "n2"
    rows.filter(first).write.option("header", True).csv(path)
    other = rows.filter(~first).select("phone_number", "email", F.lit(1).alias("extra"), "occupation", "Name", "DOB")
    other.write.mode("append").option("header", True).csv(path)
    return path


def feed_rows(df: DataFrame) -> DataFrame:
    return df.select("Name", "email", "occupation", "phone_number")


def fresh(spark, name: str) -> tuple[str, str]:
    """A new folder and a new table name."""
    run = uuid.uuid4().hex[:12]
    return work_dir(spark, name, run), f"sf_{name}_{run}"


@register("csv_batch", FEED_ROWS_SQL)
def q_csv_batch(spark, sf_dir):
    """Files of different column orders, read by their headers."""
    root, _ = fresh(spark, "csv_batch")
    return feed_rows(aligned(read_lines(spark, contact_drop(spark, sf_dir, root)), FEED_SCHEMA))


@register("csv_stream_declared", FEED_ROWS_SQL)
def q_csv_stream_declared(spark, sf_dir):
    """CSV stream with a declared schema, one file per micro-batch, bound by
    each file's header; a second run adds nothing."""
    root, table = fresh(spark, "csv_stream")
    path = contact_drop(spark, sf_dir, root)
    for _ in range(2):
        lines = stream_lines(spark, path, max_files=1)
        land_feed(lines, FEED_SCHEMA, table, f"{table}_bad", "drop", os.path.join(root, "checkpoint")).awaitTermination()
    return feed_rows(spark.table(table))


BROKEN_SQL = """
lines AS (
  SELECT c_nationkey AS k, 'user' || CAST(c_custkey AS VARCHAR) AS email,
         CASE WHEN c_nationkey = 2 THEN '1990-13-45' ELSE '1990-01-01' END AS dob,
         CASE WHEN c_nationkey = 8 THEN '"' ELSE '' END || c_name AS name,
         CASE WHEN c_nationkey = 6 THEN ',more' ELSE '' END AS tail, c_mktsegment AS job FROM customer),
raws AS (
  SELECT k, CASE WHEN k = 4 THEN name || ',' || email
                 WHEN k < 12 THEN name || ',' || email || ',' || dob || ',' || job || ',n' || CAST(k AS VARCHAR) || tail
                 ELSE dob || ',' || job || ',' || email || ',' || name || ',n' || CAST(k AS VARCHAR) || tail END AS raw FROM lines)"""


@register(
    "corrupt_records",
    f"""WITH {BROKEN_SQL}
SELECT raw, k <> 2 AS rejected,
       CASE k WHEN 2 THEN 'bad DOB' WHEN 4 THEN 'too few values' WHEN 6 THEN 'too many values' WHEN 8 THEN 'unreadable line'
              ELSE 'no header with the declared columns' END AS reason
FROM raws WHERE k IN (2, 4, 6, 8, 20)""",
)
def q_corrupt_records(spark, sf_dir):
    """The feed quarantine after a stream over ``customer`` as three drops
    (one of another column order, one without a header), where a nation's
    lines are broken in one way each."""
    root, table = fresh(spark, "corrupt")
    k = F.col("c_nationkey")
    email = F.concat(F.lit("user"), F.col("c_custkey").cast("string"))
    dob = F.when(k == 2, "1990-13-45").otherwise("1990-01-01")
    name = F.concat(F.when(k == 8, '"').otherwise(""), "c_name")
    phone = F.concat(F.lit("n"), k.cast("string"), F.when(k == 6, ",more").otherwise(""))
    line = F.when(k == 4, F.concat_ws(",", name, email))
    line = line.when(k < 12, F.concat_ws(",", name, email, dob, "c_mktsegment", phone))
    line = line.otherwise(F.concat_ws(",", dob, "c_mktsegment", email, name, phone)).alias("value")
    c = T(spark, sf_dir, "customer")
    heads = [(k < 12, "Name,email,DOB,occupation,phone_number"), ((k >= 12) & (k != 20), "DOB,occupation,email,Name,phone_number"), (k == 20, None)]
    for i, (part, head) in enumerate(heads):
        lines = c.filter(part).select(line)
        if head:
            lines = spark.createDataFrame([(head,)], "value STRING").union(lines)
        lines.coalesce(1).write.mode("append").text(os.path.join(root, "drop", f"{i}"))
    lines = stream_lines(spark, os.path.join(root, "drop", "*"), max_files=2, glob="*.txt")
    land_feed(lines, FEED_SCHEMA, table, f"{table}_bad", "drop", os.path.join(root, "checkpoint")).awaitTermination()
    return spark.table(f"{table}_bad").select("raw", "reason", "rejected")


@register(
    "csv_stream_inferred",
    """SELECT 'user' || CAST(c_custkey AS VARCHAR) AS email, 'n' || CAST(c_nationkey AS VARCHAR) AS phone_number,
       CASE WHEN c_nationkey >= 12 THEN CAST(c_custkey AS INTEGER) END AS number,
       CASE WHEN c_nationkey >= 12 THEN DATE '1990-01-01' END AS since, c_acctbal AS balance FROM customer""",
)
def q_csv_stream_inferred(spark, sf_dir):
    """A feed without a declared schema in two arrivals: the second has two
    columns more, in another order, and widens the stored schema."""
    root, table = fresh(spark, "csv_inferred")
    path, k = os.path.join(root, "drop"), F.col("c_nationkey")
    c = T(spark, sf_dir, "customer")
    email = F.concat(F.lit("user"), F.col("c_custkey").cast("string")).alias("email")
    phone, balance = F.concat(F.lit("n"), k.cast("string")).alias("phone_number"), F.col("c_acctbal").alias("balance")
    more = [F.col("c_custkey").alias("number"), balance, F.lit("1990-01-01").alias("since"), phone, email]
    for part, columns in ((k < 12, [email, phone, balance]), (k >= 12, more)):
        c.filter(part).select(*columns).write.mode("append").option("header", True).csv(path)
        land_inferred(spark, path, os.path.join(root, "schema"), table, f"{table}_bad", "drop", os.path.join(root, "checkpoint")).awaitTermination()
    return spark.table(table).select("email", "phone_number", "number", "since", "balance")


@register("json_stream", FEED_ROWS_SQL)
def q_json_stream(spark, sf_dir):
    root, table = fresh(spark, "json_stream")
    path = contact_drop(spark, sf_dir, root, "json")
    append_available_now(stream_json(spark, path, FEED_SCHEMA, max_files=1), table, os.path.join(root, "checkpoint"))
    return feed_rows(spark.table(table))


@register("table_stream", FEED_ROWS_SQL)
def q_table_stream(spark, sf_dir):
    """A table that grows twice, read as a stream after each growth."""
    root, table = fresh(spark, "table_stream")
    c = aligned(read_lines(spark, contact_drop(spark, sf_dir, root)), FEED_SCHEMA).select(*FEED_SCHEMA.names)
    urban = F.col("occupation") == "BUILDING"
    for part in (c.filter(urban), c.filter(~urban)):
        part.write.mode("append").format("parquet").saveAsTable(table)
        append_available_now(stream_table(spark, table, max_files=1), f"{table}_copy", os.path.join(root, "checkpoint"))
    return feed_rows(spark.table(f"{table}_copy"))


@register(
    "additive_schema",
    "SELECT c_custkey, c_name, CASE WHEN c_nationkey >= 12 THEN c_acctbal END AS c_acctbal FROM customer",
)
def q_additive_schema(spark, sf_dir):
    """A stream into a catalog table that gains a column: the second arrival
    has one more."""
    root, table = fresh(spark, "additive")
    c, k = T(spark, sf_dir, "customer"), F.col("c_nationkey")
    for part, columns in ((k < 12, ["c_custkey", "c_name"]), (k >= 12, ["c_custkey", "c_name", "c_acctbal"])):
        arrival = c.filter(part).select(*columns)
        arrival.write.mode("append").parquet(os.path.join(root, "drop"))
        stream = stream_parquet(spark, os.path.join(root, "drop"), arrival.schema)
        stream_into_growing(stream, table, os.path.join(root, "checkpoint"))
    return spark.table(table).select("c_custkey", "c_name", "c_acctbal")


@register(
    "overwrite_table",
    "SELECT c_custkey, c_acctbal * 2 AS c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'",
)
def q_overwrite_table(spark, sf_dir):
    """A table replaced by a result computed from itself."""
    _, table = fresh(spark, "overwrite")
    overwrite_table(T(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), table)
    t = spark.table(table)
    overwrite_table(t.filter("c_mktsegment = 'BUILDING'").select("c_custkey", (F.col("c_acctbal") * 2).alias("c_acctbal")), table, cut_lineage=True)
    return spark.table(table)


@register(
    "drop_tables",
    "SELECT c_custkey, c_name, false AS other_exists FROM customer",
)
def q_drop_tables(spark, sf_dir):
    """One of two tables dropped, twice; the rows of the one that is left."""
    _, table = fresh(spark, "drop")
    c = T(spark, sf_dir, "customer").select("c_custkey", "c_name")
    overwrite_table(c, table)
    overwrite_table(c, f"{table}_other")
    for _ in range(2):
        drop_tables(spark, [f"{table}_other"])
    return spark.table(table).withColumn("other_exists", F.lit(spark.catalog.tableExists(f"{table}_other")))


@register("namespace", "SELECT o_orderkey, o_custkey FROM orders")
def q_namespace(spark, sf_dir):
    """A table written by its bare name in the schema that the parameters
    select, read back by its full name; the session's schema is restored."""
    _, table = fresh(spark, "namespace")
    before = spark.catalog.currentDatabase()
    use_namespace(spark, JobConfig(landing="", state="", export="", schema="segmentflow_namespace"))
    try:
        overwrite_table(T(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), table)
    finally:
        spark.catalog.setCurrentDatabase(before)
    return spark.table(f"segmentflow_namespace.{table}")


@register("insert_overwrite", "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey >= 12")
def q_insert_overwrite(spark, sf_dir):
    """``INSERT OVERWRITE`` by name: the source has its columns in another
    order, and the rows inserted before are replaced."""
    _, table = fresh(spark, "insert")
    create_if_missing(spark, table, "c_custkey BIGINT, c_name STRING, c_nationkey BIGINT")
    c = T(spark, sf_dir, "customer").select("c_nationkey", "c_name", F.col("c_custkey").cast("bigint").alias("c_custkey"))
    c = c.withColumn("c_nationkey", F.col("c_nationkey").cast("bigint"))
    insert_by_name(c.filter("c_nationkey < 12"), table)
    insert_by_name(c.filter("c_nationkey >= 12"), table)
    return spark.table(table)


# ------------------------------------------------- historic contacts --
HISTORIC_SQL = f"""
h AS (SELECT c_name AS name, CASE WHEN c_nationkey <> 3 THEN 'user' || CAST(c_custkey AS VARCHAR) END AS email,
             c_mktsegment AS occupation, CASE WHEN c_nationkey < 12 THEN 1 ELSE 2 END AS load, c_custkey,
             CASE WHEN c_nationkey IN (5, 15) THEN NULL WHEN c_nationkey IN (7, 13) THEN 'N7' WHEN c_nationkey = 14 THEN 'N14'
                  ELSE 'H' || CAST(c_custkey AS VARCHAR) END AS rid FROM customer),
live AS (SELECT DISTINCT 'user' || CAST(o_custkey AS VARCHAR) AS email FROM orders WHERE o_orderpriority = '1-URGENT'),
keyed AS (SELECT h.*, l.email IS NOT NULL AND load = 2 AS known FROM h LEFT JOIN live l ON h.email = l.email WHERE h.email IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY load, known, rid ORDER BY email) AS k FROM keyed),
checked AS (
  SELECT *, CASE WHEN rid IS NULL OR known THEN NULL
                 WHEN load = 2 AND rid IN (SELECT rid FROM keyed WHERE load = 1 AND rid IS NOT NULL) THEN 'taken random_id'
                 WHEN k > 1 THEN 'repeated random_id' END AS reason FROM ranked)"""


def historic_job(spark, sf_dir) -> JobConfig:
    """Historic load, drops, historic load: ``customer`` is the history (in
    two files by nation; nation 3 has no email, nations 5 and 15 have no id,
    7 and 13 share one, so do the rows of 14, and AUTOMOBILE rows are there
    twice), the customers of urgent orders are the drops.  The second load
    is run twice."""
    root, run = fresh(spark, "historic")
    names = JobConfig(landing="", state="", export="").tables
    cfg = JobConfig(
        landing=os.path.join(root, "landing"),
        state=os.path.join(root, "state"),
        export=os.path.join(root, "export"),
        state_buckets=8,
        tables={k: f"{run}_{k}" for k in names},
    )
    c = T(spark, sf_dir, "customer")
    email = F.concat(F.lit("user"), F.col("c_custkey").cast("string"))
    rows = c.select(
        F.col("c_name").alias("Name"),
        F.when(F.col("c_nationkey") != 3, email).alias("email"),
        F.lit(None).cast("date").alias("DOB"),
        F.col("c_mktsegment").alias("occupation"),
        F.lit(None).cast("string").alias("phone_number"),
        F.when(F.col("c_nationkey").isin(7, 13), "N7")
        .when(F.col("c_nationkey") == 14, "N14")
        .when(~F.col("c_nationkey").isin(5, 15), F.concat(F.lit("H"), F.col("c_custkey").cast("string")))
        .alias("random_id"),
        F.lit("#h").alias("list_keys"),
        (F.col("c_nationkey") < 12).alias("first"),
    )
    rows = rows.unionByName(rows.filter("occupation = 'AUTOMOBILE'"))
    drops = T(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select("o_custkey").distinct()
    drops = drops.select(
        F.lit(None).cast("string").alias("Name"),
        F.concat(F.lit("user"), F.col("o_custkey").cast("string")).alias("email"),
        F.lit(None).cast("string").alias("DOB"),
        F.lit("live").alias("occupation"),
        F.lit(None).cast("string").alias("phone_number"),
    )
    for part, name in ((rows.filter("first"), "h1"), (rows.filter("not first"), "h2")):
        part.drop("first").write.option("header", True).csv(os.path.join(root, name))
    drops.write.option("header", True).csv(os.path.join(cfg.landing, "seg0", "add"))
    segment_job.initial_load(spark, os.path.join(root, "h1"), cfg)
    os_dirs = os.path.join(cfg.landing, "seg0", "remove")
    drops.limit(0).coalesce(1).write.option("header", True).csv(os_dirs)
    segment_job.ingest(spark, cfg)
    segment_job.contacts(spark, cfg)
    # The bucket count changes, and the catalog forgets the state tables.
    for t in spark.catalog.listTables():
        if t.name.startswith("sf_state_"):
            spark.sql(f"DROP TABLE IF EXISTS {t.name}")
    cfg = replace(cfg, state_buckets=5)
    for _ in range(2):
        segment_job.initial_load(spark, os.path.join(root, "h2"), cfg)
    return cfg


@register(
    "initial_load",
    f"""WITH {HISTORIC_SQL}
SELECT coalesce(h.email, l.email) AS email, h.name AS "Name",
       CASE WHEN l.email IS NOT NULL THEN 'live' ELSE h.occupation END AS occupation,
       CASE WHEN h.email IS NULL OR h.known OR h.rid IS NULL THEN {hash_id_sql("coalesce(h.email, l.email)")}
            ELSE h.rid END AS random_id,
       CASE WHEN h.email IS NOT NULL THEN '#h' END AS list_keys
FROM (SELECT * FROM checked WHERE reason IS NULL) h FULL JOIN live l ON h.email = l.email""",
)
def q_initial_load(spark, sf_dir):
    """Contacts after load, run, reopen with other buckets, load: drops
    win over history, history fills what the drops left NULL, ids stay."""
    cfg = historic_job(spark, sf_dir)
    return spark.table(cfg.table("contact_silver")).select("email", "Name", "occupation", "random_id", "list_keys")


@register(
    "quarantine",
    f"""WITH {HISTORIC_SQL},
twice AS (SELECT * FROM h UNION ALL SELECT * FROM h WHERE occupation = 'AUTOMOBILE')
SELECT 'h' || CAST(load AS VARCHAR) AS source, 'missing email' AS reason, count(*) AS rejected_rows
FROM twice WHERE email IS NULL GROUP BY load
UNION ALL
SELECT 'h' || CAST(load AS VARCHAR), 'duplicate email', count(*) FROM h
WHERE email IS NOT NULL AND occupation = 'AUTOMOBILE' GROUP BY load
UNION ALL
SELECT 'h' || CAST(load AS VARCHAR), reason, count(*) FROM checked WHERE reason IS NOT NULL GROUP BY load, reason""",
)
def q_quarantine(spark, sf_dir):
    """Rejected historic rows per file and reason."""
    q = segment_job.quarantine(spark, historic_job(spark, sf_dir))
    return q.select(path_part("source", -1).alias("source"), "reason", "rejected_rows")


def queries() -> dict[str, QueryFn]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}

