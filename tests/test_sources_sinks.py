"""Readers, writers and table lifecycle on fixtures in a temporary folder."""

import json
import os

import pytest
from pyspark.sql import functions as F

from segmentflow.sinks.tables import (
    append_path_available_now,
    create_if_missing,
    drop_tables,
    insert_by_name,
    overwrite_table,
    preview,
    read_additive,
)
from segmentflow.sources.files import FEED_SCHEMA, load_fixture, read_csv, stream_csv, stream_json, with_file_metadata
from segmentflow.sources.tables import inline_values, local_rows
from segmentflow.operators.marts import orders_daily, orders_raw
from segmentflow.operators.profile import file_inventory, inventory_totals
from tests.conftest import rows

BOATS = [{"harbour": "north", "hull": 71}, {"harbour": "south", "hull": 15}, {"harbour": "north", "hull": 42}]


def test_load_fixture_json_csv_and_bad_suffix(spark, tmp):
    p = os.path.join(tmp, "boats.json")
    with open(p, "w") as f:
        json.dump(BOATS, f, indent=2)
    df = load_fixture(spark, p)
    assert df.count() == 3
    assert df.filter(F.col("harbour") == "north").count() == 2
    c = os.path.join(tmp, "people.csv")
    with open(c, "w") as f:
        f.write("Name,Age\nAnn,30\nBo,40\nCy,50\n")
    people = load_fixture(spark, c)
    assert dict(people.dtypes) == {"Name": "string", "Age": "string"}
    with pytest.raises(ValueError):
        load_fixture(spark, os.path.join(tmp, "x.txt"))


def test_read_csv_inferred_and_declared(spark, tmp):
    p = os.path.join(tmp, "h.csv")
    with open(p, "w") as f:
        f.write("Name,email,DOB,occupation,phone_number\nAnn,a@x,1990-01-02,dev,1\nBo,,bad,ops,2\n")
    inferred = read_csv(spark, p)
    assert inferred.count() == 2
    typed = read_csv(spark, p, FEED_SCHEMA)
    got = rows(typed, "Name", "email", "DOB")
    assert got[0][0] == "Ann" and str(got[0][2]) == "1990-01-02"
    assert got[1][1] is None and got[1][2] is None  # NULL email, bad date


def test_remove_file_binds_by_position(spark, tmp):
    """A remove file shares the add layout: read all five, keep email."""
    d = os.path.join(tmp, "seg", "remove")
    os.makedirs(d)
    with open(os.path.join(d, "r.csv"), "w") as f:
        f.write("Name,email,DOB,occupation,phone_number\nAnn,a@x,,,\n")
    df = with_file_metadata(read_csv(spark, d, FEED_SCHEMA)).select("email", "source_file", "file_modification_time")
    r = df.first()
    assert r.email == "a@x" and r.source_file.endswith("seg/remove/r.csv") and r.file_modification_time is not None


def test_csv_stream_rate_limit_and_checkpoint(spark, tmp):
    land = os.path.join(tmp, "land")
    os.makedirs(land)
    for i in range(3):
        with open(os.path.join(land, f"f{i}.csv"), "w") as f:
            f.write(f"Name,email,DOB,occupation,phone_number\nP{i},p{i}@x,,,\n")
    out, ck = os.path.join(tmp, "out"), os.path.join(tmp, "ck")
    s = with_file_metadata(stream_csv(spark, land, FEED_SCHEMA, max_files=1))
    append_path_available_now(s, out, ck)
    first = spark.read.parquet(out)
    assert first.count() == 3
    # one file per micro-batch: three distinct ingestion batches in the sink
    assert len([n for n in os.listdir(os.path.join(ck, "commits")) if n.isdigit()]) == 3
    append_path_available_now(with_file_metadata(stream_csv(spark, land, FEED_SCHEMA, max_files=1)), out, ck)
    assert spark.read.parquet(out).count() == 3  # nothing new


def test_json_stream_orders_model(spark, tmp):
    land = os.path.join(tmp, "orders")
    os.makedirs(land)
    recs = [
        {"customer_name": "a", "order_datetime": "1564617600", "order_number": 1},
        {"customer_name": "b", "order_datetime": "1567296000", "order_number": 2},
        {"customer_name": "c", "order_datetime": "oops", "order_number": 3},
    ]
    with open(os.path.join(land, "o.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))
    schema = "customer_name STRING, order_datetime STRING, order_number BIGINT"
    out, ck = os.path.join(tmp, "raw"), os.path.join(tmp, "ck")
    append_path_available_now(orders_raw(stream_json(spark, land, schema)), out, ck)
    raw = spark.read.parquet(out)
    assert raw.count() == 3
    assert rows(orders_daily(raw, ("2019-08-01", "2019-09-01"))) == [(__import__("datetime").date(2019, 8, 1), 1)]


def test_additive_schema(spark, tmp):
    p = os.path.join(tmp, "t")
    spark.createDataFrame([(1,)], "a INT").write.parquet(os.path.join(p, "part=1"))
    spark.createDataFrame([(2, "x")], "a INT, b STRING").write.parquet(os.path.join(p, "part=2"))
    df = read_additive(spark, p)
    assert set(df.columns) == {"a", "b", "part"}
    assert rows(df, "a", "b") == [(1, None), (2, "x")]


def test_table_lifecycle(spark):
    drop_tables(spark, ["lc_t"])
    create_if_missing(spark, "lc_t", "email STRING, n INT")
    create_if_missing(spark, "lc_t", "email STRING, n INT")  # idempotent
    insert_by_name(spark.createDataFrame([(1, "a")], "n INT, email STRING"), "lc_t")
    assert rows(spark.table("lc_t")) == [("a", 1)]
    insert_by_name(spark.createDataFrame([(2, "b")], "n INT, email STRING"), "lc_t", overwrite=False)
    assert spark.table("lc_t").count() == 2
    # overwrite a table from a plan that reads it: lineage is cut first
    overwrite_table(spark.table("lc_t").withColumn("n", F.col("n") + 10), "lc_t", cut_lineage=True)
    assert rows(spark.table("lc_t")) == [("a", 11), ("b", 12)]
    drop_tables(spark, ["lc_t"])
    assert not spark.catalog.tableExists("lc_t")


def test_inline_values_local_rows_preview(spark):
    assert [r.segment for r in inline_values(spark).collect()] == ["blue", "green", "red"]
    people = local_rows(spark, [("Ann", 30), ("Bo", 40), ("Cy", 50)], "Name STRING, Age BIGINT")
    assert [r.Name for r in preview(people, 2, ["Age"]).collect()] == ["Ann", "Bo"]


def test_file_inventory(spark, tmp):
    p = os.path.join(tmp, "inv")
    spark.range(10).repartition(2).write.parquet(p)
    inv = file_inventory(spark.read.parquet(p))
    tot = inventory_totals(inv).first()
    assert tot.files == 2 and tot.total_records == 10 and tot.total_bytes > 0


def test_replay_all_with_new_checkpoint(spark, tmp):
    """Replay (``replay_all``): the same checkpoint reads nothing new; a new
    checkpoint into a fresh sink reads every file again.  (The file sink
    keeps its own commit log, so the old sink is dropped, as the reference
    drops its tables before a replay.)"""
    land = os.path.join(tmp, "land")
    os.makedirs(land)
    with open(os.path.join(land, "a.csv"), "w") as f:
        f.write("Name,email,DOB,occupation,phone_number\nA,a@x,,,\n")
    out = os.path.join(tmp, "out")
    append_path_available_now(stream_csv(spark, land, FEED_SCHEMA), out, os.path.join(tmp, "ck1"))
    append_path_available_now(stream_csv(spark, land, FEED_SCHEMA), out, os.path.join(tmp, "ck1"))
    assert spark.read.parquet(out).count() == 1
    out2 = os.path.join(tmp, "out2")
    append_path_available_now(stream_csv(spark, land, FEED_SCHEMA), out2, os.path.join(tmp, "ck2"))
    assert spark.read.parquet(out2).count() == 1


def test_namespace(spark, tmp):
    from segmentflow.config import JobConfig, use_namespace

    before = spark.catalog.currentDatabase()
    use_namespace(spark, JobConfig(landing=tmp, state=tmp, export=tmp, schema="sf_ns_test"))
    try:
        assert spark.catalog.currentDatabase() == "sf_ns_test"
    finally:
        spark.catalog.setCurrentDatabase(before)


def test_csv_stream_inferred_schema_is_kept(spark, tmp):
    from segmentflow.sources.files import stream_csv_inferred

    land = os.path.join(tmp, "rm")
    os.makedirs(land)
    with open(os.path.join(land, "r1.csv"), "w") as f:
        f.write("email,n\na@x,1\nb@x,2\n")
    loc, out, ck = (os.path.join(tmp, p) for p in ("schema", "out", "ck"))
    s1 = stream_csv_inferred(spark, land, loc)
    assert dict((f.name, f.dataType.simpleString()) for f in s1.schema.fields) == {"email": "string", "n": "int"}
    append_path_available_now(s1.select("email"), out, ck)
    # a later file with text in ``n`` does not change the stored schema
    with open(os.path.join(land, "r2.csv"), "w") as f:
        f.write("email,n\nc@x,many\n")
    s2 = stream_csv_inferred(spark, land, loc)
    assert s2.schema == s1.schema
    append_path_available_now(s2.select("email"), out, ck)
    assert rows(spark.read.parquet(out)) == [("a@x",), ("b@x",), ("c@x",)]


def test_scale_settings():
    from segmentflow.config import scale_settings, state_buckets_for

    big = scale_settings(100 * 10**12)
    assert big["spark.sql.shuffle.partitions"] == "372530"
    assert big["spark.sql.files.maxPartitionBytes"] == "256m"
    small = scale_settings(10**9)
    assert small["spark.sql.shuffle.partitions"] == "4"
    assert state_buckets_for(10 * 2**40) == 32768  # 10 TiB of state, 512 MB buckets -> 20480 -> 2^15
    assert state_buckets_for(0) == 8


def test_daily_view_is_maintained_incrementally(spark, tmp):
    import datetime as dt

    from segmentflow.streaming.views import daily_counts_stream, maintain_view, read_view

    land, out, ck = (os.path.join(tmp, p) for p in ("orders", "daily", "ck"))
    os.makedirs(land)
    schema = "customer_name STRING, order_datetime STRING, order_number BIGINT"

    def drop(name, recs):
        with open(os.path.join(land, name), "w") as f:
            f.write("\n".join(json.dumps(r) for r in recs))

    drop("a.json", [{"customer_name": "a", "order_datetime": "1564617600", "order_number": 1},
                    {"customer_name": "b", "order_datetime": "bad", "order_number": 2}])
    maintain_view(daily_counts_stream(stream_json(spark, land, schema)), out, ck)
    assert rows(read_view(spark, out)) == [(dt.date(2019, 8, 1), 1), (None, 1)]
    drop("b.json", [{"customer_name": "c", "order_datetime": "1564617601", "order_number": 3},
                    {"customer_name": "d", "order_datetime": "1567296000", "order_number": 4}])
    maintain_view(daily_counts_stream(stream_json(spark, land, schema)), out, ck)
    assert rows(read_view(spark, out)) == [(dt.date(2019, 8, 1), 2), (dt.date(2019, 9, 1), 1), (None, 1)]
    drop("c.json", [{"customer_name": "e", "order_datetime": "1567296001", "order_number": 5}])
    maintain_view(daily_counts_stream(stream_json(spark, land, schema)), out, ck)
    assert rows(read_view(spark, out)) == [(dt.date(2019, 8, 1), 2), (dt.date(2019, 9, 1), 2), (None, 1)]
    assert len(os.listdir(out)) == 2  # older versions are removed
