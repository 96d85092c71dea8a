"""One key holding a third of all rows.

Each test checks the result against a brute-force answer and that the
physical plan reduces the hot key before it is shuffled (partial limit or
partial aggregate below the exchange), so no single task receives the
third of the data.
"""

import contextlib
import datetime as dt
import glob
import io
import os

import pytest
from pyspark.sql import functions as F

from segmentflow.operators import merge, overlap
from segmentflow.operators.dedup import latest_per_key
from segmentflow.operators.marts import segment_fanout
from segmentflow.sinks.export import export_segments
from tests.conftest import rows

N = 30_000
HOT = "hot@x.io"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def below_exchange(text: str, marker: str) -> bool:
    """``marker`` occurs in an operator under the first exchange."""
    i = text.find("Exchange")
    return i >= 0 and marker in text[i:]


def skewed(spark):
    """A third of the rows belong to one email; the rest are spread."""
    base = dt.datetime(2024, 1, 1)
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(HOT)).otherwise(F.concat(F.lit("u"), (F.col("id") % 997).cast("string"), F.lit("@x.io"))).alias("email"),
        F.concat(F.lit("f"), (F.col("id") % 10).cast("string")).alias("file"),
        (F.lit(base).cast("timestamp") + F.make_interval(secs=F.col("id").cast("int"))).alias("t"),
        F.col("id"),
    )


def test_latest_per_key_hot_key(spark):
    df = skewed(spark)
    for method, marker in (("aggregate", "partial_max"), ("window", "WindowGroupLimit")):
        out = latest_per_key(df, ["email"], "t", ["id"], method=method)
        got = {r.email: r.id for r in out.collect()}
        assert got[HOT] == max(i for i in range(N) if i % 3 == 0)
        assert len(got) == 1 + len({i % 997 for i in range(N) if i % 3 != 0})
        assert below_exchange(plan(out), marker)


def test_membership_events_hot_key(spark):
    df = skewed(spark).withColumnRenamed("t", "file_modification_time").withColumn("segment", F.col("file"))
    ev = merge.membership_events(df)
    hot = {r.segment: r.file_modification_time for r in ev.filter(F.col("email") == HOT).collect()}
    assert len(hot) == 10
    assert below_exchange(plan(ev), "partial_max")


def test_pair_counts_hot_key(spark):
    df = skewed(spark)
    got = rows(overlap.pair_overlap(df, "file", "email"))
    sets = {}
    for r in df.select("file", "email").collect():
        sets.setdefault(r.file, set()).add(r.email)
    files = sorted(sets)
    expect = sorted((a, b, len(sets[a] & sets[b])) for i, a in enumerate(files) for b in files[i + 1:])
    assert got == expect
    # the hot key is collapsed to one (file, key) pair per file before any
    # shuffle by key
    assert below_exchange(plan(overlap.file_keys(df, "file", "email")), "HashAggregate")


def test_seen_before_hot_key(spark):
    df = skewed(spark)
    got = rows(overlap.seen_before(df, "file", "email"))
    first = {}
    for r in df.select("file", "email").distinct().collect():
        first[r.email] = min(first.get(r.email, r.file), r.file)
    per_file = {}
    for r in df.select("file", "email").distinct().collect():
        n, s = per_file.get(r.file, (0, 0))
        per_file[r.file] = (n + 1, s + (1 if r.file > first[r.email] else 0))
    assert got == sorted((f, n, s) for f, (n, s) in per_file.items())


def test_upsert_hot_key_batch(spark):
    df = skewed(spark).select("email", F.col("file").alias("Name"), "t")
    tgt = spark.createDataFrame([(HOT, "old", "ID")], "email STRING, Name STRING, random_id STRING")
    out = merge.upsert_keep_non_null(tgt, df, "email", ["Name"], order_col="t")
    hot = out.filter(F.col("email") == HOT).collect()
    assert len(hot) == 1 and hot[0].random_id == "ID"
    assert hot[0].Name == f"f{max(i for i in range(N) if i % 3 == 0) % 10}"


def test_export_spreads_hot_segment(spark, tmp):
    main = skewed(spark).select(
        "email", F.when(F.col("email") == HOT, F.array(F.lit("big"))).otherwise(F.array(F.lit("small"))).alias("list_of_segments")
    ).dropDuplicates(["email"])
    main = main.unionByName(
        spark.range(3000).select(F.concat(F.lit("b"), F.col("id").cast("string")).alias("email"), F.array(F.lit("big")).alias("list_of_segments"))
    )
    segs = spark.createDataFrame([("big",), ("small",), ("none",)], "segment STRING")
    # A small advisory size stands in for a segment of many gigabytes.
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "16k")
    try:
        export_segments(main, segs, tmp, "2024-01-01")
    finally:
        spark.conf.set(key, old)
    big = glob.glob(os.path.join(tmp, "date=2024-01-01", "segment=big", "*.csv"))
    assert len(big) > 1  # written by several tasks
    none = glob.glob(os.path.join(tmp, "date=2024-01-01", "segment=none", "*.csv"))
    assert [open(p).read().strip() for p in none] == ["email"]


def million_of_one_segment(spark):
    ids = spark.range(0, 1_000_000, 1, 6)
    return ids.select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("email"), F.array(F.lit("big"), F.lit("big"), F.lit("other")).alias("list_of_segments"))


@pytest.mark.parametrize("kind", ["rows", "table", "over the limit"])
def test_export_of_a_hot_segment_follows_the_target_size(spark, tmp, kind):
    names = [("big",), ("none",), (None,), ("big",)]
    if kind == "over the limit":
        names += [(f"unused{i}",) for i in range(400)]
    segs = spark.createDataFrame(names, "segment STRING")
    if kind == "table":
        segs.write.mode("overwrite").saveAsTable("hot_segment_list")
        segs = spark.table("hot_segment_list")
    key, old = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if kind == "over the limit":
        spark.conf.set(key, "8b")
    try:
        fan = export_segments(million_of_one_segment(spark), segs, tmp, "d", file_bytes=1 << 20)
        text = plan(fan)
        joins = [x for x in text.splitlines() if "Join" in x]
        # Never the exploded rows as the side that is built or broadcast.
        assert joins and all("SortMergeJoin" in x if kind == "over the limit" else "BuildRight" in x for x in joins)
    finally:
        spark.conf.set(key, old)
    files = glob.glob(os.path.join(tmp, "date=d", "segment=big", "*.csv"))
    sizes = [os.path.getsize(f) for f in files]
    # 7.9 MB of text: eight files of a megabyte at least, none much larger.
    assert 8 <= len(files) <= 16 and max(sizes) < 1.2 * (1 << 20)
    assert spark.read.option("header", True).csv(os.path.join(tmp, "date=d", "segment=big")).distinct().count() == 1_000_000
    folders = {os.path.basename(f) for f in glob.glob(os.path.join(tmp, "date=d", "segment=*"))}
    assert len(folders) == (402 if kind == "over the limit" else 2) and "segment=other" not in folders
    assert os.path.exists(os.path.join(tmp, "date=d", "_SUCCESS"))
    (none,) = glob.glob(os.path.join(tmp, "date=d", "segment=none", "*.csv"))
    assert open(none).read() == "email\n"
    export_segments(million_of_one_segment(spark).limit(3), segs, tmp, "d")  # replaces the folder
    assert spark.read.option("header", True).csv(os.path.join(tmp, "date=d", "segment=big")).count() == 3
    spark.sql("DROP TABLE IF EXISTS hot_segment_list")


def test_fanout_with_a_salted_list_equals_the_broadcast_one(spark):
    main = spark.createDataFrame([("a", ["x", "y", "y"]), ("b", None), ("c", []), ("d", ["z", None])], "email STRING, list_of_segments ARRAY<STRING>")
    listed = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "segment STRING")
    want = [("a", "x"), ("a", "y")]
    assert rows(segment_fanout(main, listed)) == want
    key, old = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        assert rows(segment_fanout(main, listed)) == want
    finally:
        spark.conf.set(key, old)
