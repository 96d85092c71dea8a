"""Header-safe feeds, corrupt lines, growing schemas and sinks, and the id
constraint of the historic load."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from segmentflow.config import JobConfig
from segmentflow.plans import segment_job as job
from segmentflow.sinks.tables import add_missing_columns, append_growing, drop_tables
from segmentflow.sources.files import FEED_SCHEMA, aligned, grown_schema, read_csv, read_lines, stream_lines
from segmentflow.streaming.feeds import land_batch, land_feed, land_inferred
from tests.conftest import rows

HEAD = "Name,email,DOB,occupation,phone_number\n"


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_lines_bind_by_each_files_header(spark, tmp):
    put(tmp, "a.csv", "﻿" + HEAD + 'Ann,a@x,2000-01-02,"baker, head",1\n\n   \n' + HEAD + "Bob,b@x,oops,,\n")
    put(tmp, "b.csv", "email, phone_number ,more,DOB,occupation,Name\r\nc@x,3,!,2001-01-01,\"\",Cid\r\n")
    put(tmp, "c.csv", "Dan,d@x,2000-01-01,x,4\nEve,e@x,2000-01-01,x,5\n")  # no header
    put(tmp, "d.csv", HEAD + 'F,f@x\nG,g@x,,,,6\n"H,h@x,,,7\n')
    put(tmp, "e.csv", "")
    put(tmp, "f.csv", "email,DOB\nz@x,2000-01-01\n")  # lacks columns
    got = aligned(read_lines(spark, tmp), FEED_SCHEMA)
    kept = rows(got.where("not rejected"), "Name", "email", "DOB", "occupation", "phone_number", "reason")
    assert kept == [
        ("Ann", "a@x", dt.date(2000, 1, 2), "baker, head", "1", None),
        ("Bob", "b@x", None, None, None, "bad DOB"),
        ("Cid", "c@x", dt.date(2001, 1, 1), None, "3", None),
    ]
    bad = rows(got.where("rejected"), "raw", "reason", "email")
    none = "no header with the declared columns"
    assert bad == [('"H,h@x,,,7', "unreadable line", None), ("Dan,d@x,2000-01-01,x,4", none, None), ("Eve,e@x,2000-01-01,x,5", none, None), ("F,f@x", "too few values", None), ("G,g@x,,,,6", "too many values", None), ("email,DOB", none, None), ("z@x,2000-01-01", none, None)]
    with pytest.raises(Exception):  # a plain read by position refuses other headers
        read_csv(spark, os.path.join(tmp, "b.csv"), FEED_SCHEMA).collect()


def test_header_of_a_file_in_many_splits(spark, tmp):
    lines = "".join(f"{i},u{i}@x\n" for i in range(5000))
    put(tmp, "a.csv", "n,email\n" + lines)
    put(tmp, "b.csv", "email,n\n" + "".join(f"v{i}@x,{i}\n" for i in range(5000)))
    key, old = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(key, "4k")
    try:
        from pyspark.sql.types import StructType

        got = aligned(read_lines(spark, tmp), StructType.fromDDL("email STRING, n INT"))
        assert got.rdd.getNumPartitions() > 4
        assert got.where("rejected or reason is not null").count() == 0
        assert got.where("substring(email, 2) = n || '@x'").count() == 10_000
    finally:
        spark.conf.set(key, old)


def test_feed_repeats_nothing_and_replaces_a_repeated_batch(spark, tmp):
    land, ck = os.path.join(tmp, "land"), os.path.join(tmp, "ck")
    put(land, "a.csv", HEAD + "A,a@x,2000-01-01,,\n")
    put(land, "b.csv", "phone_number,occupation,DOB,email,Name\n7,cook,bad,b@x,B\nshort\n")
    tables = ("feed_t", "feed_bad")
    drop_tables(spark, list(tables))
    for _ in range(2):
        land_feed(stream_lines(spark, land, max_files=1), FEED_SCHEMA, *tables, "f", ck).awaitTermination()
    want = [("A", "a@x", "", ""), ("B", "b@x", "cook", "7")]
    got = lambda: [tuple(x or "" for x in r) for r in rows(spark.table("feed_t"), "Name", "email", "occupation", "phone_number")]
    assert got() == want
    assert rows(spark.table("feed_bad"), "raw", "reason", "rejected") == [("7,cook,bad,b@x,B", "bad DOB", False), ("short", "too few values", True)]
    # A batch that is tried again replaces its rows and its rejected lines.
    again = read_lines(spark, os.path.join(land, "b.csv"))
    batch = spark.table("feed_t").where("email = 'b@x'").first()["batch"]
    land_batch(again, batch, FEED_SCHEMA, None, *tables, "f")
    assert got() == want and spark.table("feed_bad").count() == 2
    drop_tables(spark, list(tables))


def test_inferred_feed_grows(spark, tmp):
    land, loc, ck = (os.path.join(tmp, p) for p in ("land", "schema", "ck"))
    drop_tables(spark, ["grow_t", "grow_bad"])

    def run():
        land_inferred(spark, land, loc, "grow_t", "grow_bad", "f", ck).awaitTermination()
        return spark.table("grow_t")

    put(land, "a.csv", "email,n\na@x,1\nb@x,\n")
    assert rows(run(), "email", "n") == [("a@x", 1), ("b@x", None)]
    time.sleep(0.05)
    put(land, "b.csv", "day,n,email,ok,big,empty\n2024-01-02,many,c@x,true,3000000000,\n")
    got = run()
    kinds = {f.name: f.dataType.simpleString() for f in got.schema}
    assert kinds["n"] == "int" and (kinds["day"], kinds["ok"], kinds["big"], kinds["empty"]) == ("date", "boolean", "bigint", "string")
    assert rows(got, "email", "n", "day", "ok", "big") == [("a@x", 1, None, None, None), ("b@x", None, None, None, None), ("c@x", None, dt.date(2024, 1, 2), True, 3000000000)]
    assert rows(spark.table("grow_bad"), "reason") == [("bad n",)]
    assert [f.name for f in grown_schema(spark, land, loc)] == ["email", "n", "day", "ok", "big", "empty"]
    drop_tables(spark, ["grow_t", "grow_bad"])


def test_catalog_sink_grows(spark):
    drop_tables(spark, ["sink_t"])
    one = spark.createDataFrame([(1,)], "a INT")
    two = spark.createDataFrame([(2, "x")], "a INT, b STRING")
    append_growing(one, 0, "sink_t")
    for _ in range(2):
        append_growing(two, 1, "sink_t")
    append_growing(one, 2, "sink_t")  # a later batch without the new column
    assert rows(spark.table("sink_t"), "a", "b") == [(1, None), (1, None), (2, "x")]
    with pytest.raises(ValueError):
        add_missing_columns(spark, "sink_t", spark.createDataFrame([("x",)], "a STRING").schema)
    drop_tables(spark, ["sink_t"])


def test_historic_ids_are_set_and_unique(spark, tmp):
    cfg = JobConfig(landing=f"{tmp}/l", state=f"{tmp}/s", export=f"{tmp}/e", state_buckets=2, tables={k: f"hid_{k}" for k in JobConfig("", "", "").tables})
    drop_tables(spark, list(cfg.tables.values()))
    head = "random_id,list_keys,Name,email,DOB,occupation,phone_number\n"  # an order of its own
    put(tmp, "h1.csv", head + "I1,#,A,a@x,,,\nI1,#,B,b@x,,,\n,#,C,c@x,,,\n  ,#,D,d@x,,,\nI5,#,E,e@x,1990-02-30,,\nI6,#,F,,,,\nbroken\n")
    put(tmp, "h2.csv", head + "I5,#,G,g@x,,,\nI7,#,H,h@x,,,\nI1,#2,A9,a@x,,baker,\nI7,#,K,k@x,,,\n")
    job.initial_load(spark, f"{tmp}/h1.csv", cfg)
    first = {r.email: r.random_id for r in spark.table("hid_contact_silver").collect()}
    assert set(first) == {"a@x", "c@x", "d@x", "e@x"} and first["a@x"] == "I1" and first["e@x"] == "I5"
    assert all(first.values()) and len(set(first.values())) == 4
    # A load that failed after its quarantine was written, and one that is run again.
    saved = job.apply_batch
    try:
        job.apply_batch = lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
        with pytest.raises(RuntimeError):
            job.initial_load(spark, f"{tmp}/h2.csv", cfg)
    finally:
        job.apply_batch = saved
    for _ in range(2):
        job.initial_load(spark, f"{tmp}/h2.csv", cfg)
    job.initial_load(spark, f"{tmp}/h1.csv", cfg)
    got = {r.email: (r.random_id, r.occupation) for r in spark.table("hid_contact_silver").collect()}
    assert got == {e: (i, None) for e, i in first.items()} | {"a@x": ("I1", "baker"), "h@x": ("I7", None)}
    bad = {(os.path.basename(r.source), r.reason): r.rejected_rows for r in job.quarantine(spark, cfg).collect()}
    assert bad == {
        ("h1.csv", "repeated random_id"): 1, ("h1.csv", "missing email"): 1, ("h1.csv", "too few values"): 1,
        ("h2.csv", "taken random_id"): 1, ("h2.csv", "repeated random_id"): 1,
    }
    drop_tables(spark, list(cfg.tables.values()))


def test_lines_are_cut_as_the_csv_parser_does(spark):
    """The cut of plain lines, and the narrow and wide parse of lines with
    quotes, against Spark's parser over all columns."""
    from segmentflow.sources.files import LINE_END, MOST_COLUMNS, with_cells

    raws = ["a,b,c", ",,", "a", ' a , "b,c" ,', '"a,b",c', 'a,"b', 'a,b"c,"', "  ", "a\\,b", 'x"\\"",y', "é,\t,-", "a,\ue000,b"]
    for n in (15, 16, 17, 18, 63, 64, 65, 66, 90):
        raws += [",".join("x" * (i % 2) for i in range(n)), '"q,r",' + ",".join("x" * (i % 2) for i in range(n - 1))]
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    parsed = F.from_csv(F.concat("raw", F.lit("," + LINE_END)), ", ".join(f"c{i} STRING" for i in range(MOST_COLUMNS + 1)))
    want = {}
    for r in df.filter("trim(raw) <> ''").select("raw", parsed.alias("p")).collect():
        cells = list(r.p)
        n = cells.index(LINE_END) if LINE_END in cells else -1
        want[r.raw] = (n, cells[:n] if n >= 0 else None)
    assert {r.raw: (r._n, r._cells) for r in with_cells(df).collect()} == want


def test_headers_cut_one_line_of_a_file(spark, tmp, monkeypatch):
    """Only the first line of each file is cut for its header (before: all)."""
    from segmentflow.sources import files

    os.makedirs(f"{tmp}/drop")
    for i in range(2):
        with open(f"{tmp}/drop/{i}.csv", "w") as f:
            f.write("\n" * i + f"email,c{i}\n" + "u,1\n" * 200)
    seen, cut = [], files.with_cells

    def counted(lines, *args):
        seen.append(lines.count())
        return cut(lines, *args)

    monkeypatch.setattr(files, "with_cells", counted)
    heads = {tuple(r._names) for r in files.file_headers(files.read_lines(spark, f"{tmp}/drop")).collect()}
    assert heads == {("email", "c0"), ("email", "c1")} and seen == [2]


def test_dates_by_cast_and_by_parser(spark):
    from pyspark.sql.types import DateType

    from segmentflow.sources.files import FEED_DATE_FORMAT, typed_text

    texts = ["1990-01-31", "1990-13-45", "1990-02-30", "2000-02-29", "1900-02-29", "9999-12-31", "user1", "1990", "1990-01", "555-123-4567", "", "-", "1990-01-01x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    parsed = F.try_to_timestamp("t", F.lit(FEED_DATE_FORMAT)).cast("date")
    assert df.filter(~typed_text(F.col("t"), DateType()).eqNullSafe(parsed)).count() == 0


def test_text_is_typed_as_by_a_cast(spark):
    from pyspark.sql.types import StructType

    from segmentflow.sources.files import INFERRED, typed_text

    texts = ["1", " 2 ", "-3", "+4", "2147483648", "9223372036854775808", "1.5", ".5", "5.", "1e3", "1d", "2F", "inf", "-Infinity", "+inf", "NaN", " nan"]
    texts += ["0x1p3", "T10:00", "10:00", "T", "t", "TRUE", "Yes", "n", "no", "off", "tru", "1990-01-01", " 1990-01-01 10:00:00 ", "1990", "+1990-1", "user1", "n7", "", " "]
    texts += ["\t7\n", "\x007", "\x7f1\x7f", "1990-01-01T00:00:00Z", "7\n8", "1,5", "1_000", "\u0661", "\u00a01"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for kind in INFERRED:
        if kind != "date":  # by its format
            kind = StructType.fromDDL(f"x {kind}")["x"].dataType
            other = df.filter(~typed_text(F.col("t"), kind).eqNullSafe(F.col("t").try_cast(kind)))
            assert [r.t for r in other.collect()] == []


def test_drops_are_made_in_one_pass_over_events(spark, monkeypatch):
    """Before: each of the drops scanned and parsed all events."""
    from pyspark.sql.readwriter import DataFrameWriter

    from segmentflow.plans import testdata

    read, write = [], DataFrameWriter.csv

    def recorded(self, path, *args, **kw):
        read.extend(self._df.inputFiles())
        return write(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "csv", recorded)
    monkeypatch.setattr(testdata.segment_job, "create_segments", lambda *a: None)
    monkeypatch.setattr(testdata.segment_job, "run_segment_pipeline", lambda *a, **k: None)
    cfg, _ = testdata.events_job(spark, "/root/testdata/sf0.001")
    assert read and not [f for f in read if f.endswith("events.parquet")]
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").filter("event_type in ('signup', 'purchase', 'error')")
    events = events.filter(F.get_json_object("props", "$.k").try_cast("int").isNotNull())
    drops = spark.read.option("header", True).csv(f"{cfg.landing}/*/*")
    assert rows(drops, "phone_number") == sorted([(str(r.event_id),) for r in events.collect()])
