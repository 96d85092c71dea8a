"""End-to-end run of the segment job on CSV drops in a temporary folder.

Covers: same email twice in one file and in two files; a newer row with
NULLs over an older full row; NULL email and bad DOB; removes older and
newer than the add, a remove without an add; a contact in no segment; a
segment without members (header-only export); a second run with no new
files; a late file with an older time.
"""

import datetime as dt
import glob
import os

import pytest

from segmentflow.config import JobConfig
from segmentflow.plans import segment_job as job
from tests.conftest import rows

HEADER = "Name,email,DOB,occupation,phone_number\n"


def drop(landing, segment, kind, name, lines, when):
    d = os.path.join(landing, segment, kind)
    os.makedirs(d, exist_ok=True)
    p = os.path.join(d, name)
    with open(p, "w") as f:
        f.write(HEADER + "".join(line + "\n" for line in lines))
    ts = when.replace(tzinfo=dt.timezone.utc).timestamp()
    os.utime(p, (ts, ts))
    return p


T = [dt.datetime(2024, 1, d, 12, 0) for d in range(1, 8)]


@pytest.fixture()
def cfg(spark, tmp):
    for t in ("bronze_add", "bronze_remove", "contact_silver", "contact_segment_table", "main_table", "segments", "contact_quarantine"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    c = JobConfig(
        landing=os.path.join(tmp, "landing"), state=os.path.join(tmp, "state"), export=os.path.join(tmp, "export"),
        state_buckets=4,
    )
    os.makedirs(c.landing)
    job.create_segments(spark, c, ["blue", "green", "red"])
    hist = os.path.join(tmp, "historic.csv")
    with open(hist, "w") as f:
        f.write("Name,email,DOB,occupation,phone_number,random_id,list_keys\n")
        f.write("Erin,erin@x.io,1990-02-03,pilot,555,HISTid000000001,#A07#B02\n")
        f.write("Al,alice@x.io,1980-01-01,chef,,HISTid000000002,\n")
    job.initial_load(spark, hist, c)
    return c


def test_segment_job_end_to_end(spark, cfg):
    L = cfg.landing
    drop(L, "blue", "add", "a1.csv", [
        "Alice,alice@x.io,1980-01-01,chef,111",
        "Alicia,alice@x.io,1980-01-01,cook,111",  # same email twice in one file
        "Bob,bob@x.io,1975-05-05,driver,222",
    ], T[1])
    drop(L, "blue", "add", "a2.csv", ["Alice,alice@x.io,,,999"], T[2])  # newer with NULLs
    drop(L, "green", "add", "g1.csv", [
        "Bob,bob@x.io,1975-05-05,driver,222",
        "Carol,carol@x.io,not-a-date,dev,333",
        "Nobody,,2000-01-01,none,000",
    ], T[1])
    drop(L, "blue", "remove", "r1.csv", ["Bob,bob@x.io,,,"], T[3])  # newer than add
    drop(L, "green", "remove", "r2.csv", ["Bob,bob@x.io,,,"], T[0])  # older than add
    drop(L, "red", "remove", "r3.csv", ["Dave,dave@x.io,,,"], T[3])  # no add

    fan = job.run_segment_pipeline(spark, cfg, date="2024-01-31")

    add = spark.table("bronze_add")
    assert add.count() == 7
    assert add.filter("source_file IS NULL OR file_modification_time IS NULL OR ingestion_timestamp IS NULL").count() == 0
    assert spark.table("bronze_remove").count() == 3

    c = {r.email: r for r in spark.table("contact_silver").collect()}
    assert set(c) == {"alice@x.io", "bob@x.io", "carol@x.io", "erin@x.io"}
    a = c["alice@x.io"]
    # One micro-batch holds a1 and a2: only the newest row per email (a2)
    # is merged.  Its NULLs keep the historic values; the historic id stays.
    assert (a.Name, a.occupation, a.phone_number, a.DOB) == ("Alice", "chef", "999", dt.date(1980, 1, 1))
    assert a.random_id == "HISTid000000002"
    assert c["carol@x.io"].DOB is None
    assert len(c["bob@x.io"].random_id) == 15
    assert c["erin@x.io"].list_keys == "#A07#B02"
    assert len({r.random_id for r in c.values()}) == 4

    m = rows(spark.table("contact_segment_table"), "email", "segment", "is_active")
    assert m == [
        ("alice@x.io", "blue", True),
        ("bob@x.io", "blue", False),
        ("bob@x.io", "green", True),
        ("carol@x.io", "green", True),
    ]

    main = {r.email: r.list_of_segments for r in spark.table("main_table").collect()}
    assert main == {"alice@x.io": ["blue"], "bob@x.io": ["green"], "carol@x.io": ["green"], "erin@x.io": None}

    assert rows(fan, "email", "segment") == [("alice@x.io", "blue"), ("bob@x.io", "green"), ("carol@x.io", "green")]
    out = os.path.join(cfg.export, "date=2024-01-31")
    red = glob.glob(os.path.join(out, "segment=red", "*.csv"))
    assert [open(p).read().strip() for p in red] == ["Name,email,DOB,occupation,phone_number,random_id,list_keys"]
    back = spark.read.option("header", True).csv(out)
    assert rows(back, "email", "segment") == [("alice@x.io", "blue"), ("bob@x.io", "green"), ("carol@x.io", "green")]

    prof = {os.path.basename(r.source_file): (r.records, r.non_null_email, r.null_DOB, r.null_occupation)
            for r in job.landing_profile(spark, cfg).collect()}
    assert prof == {"a1.csv": (3, 3, 0, 0), "a2.csv": (1, 1, 1, 1), "g1.csv": (3, 2, 1, 0)}

    status = {r.file_type: r.file_count for r in job.ingest_report(spark, cfg).collect()}
    assert status == {"add": 3, "remove": 3}

    report = {(r.table_name, r.check_name, r.columns): r.failing_rows for r in job.validate_tables(spark, cfg).collect()}
    assert report[("bronze_add", "not_null", "email")] == 1  # the row without an email stays in bronze
    assert report[("bronze_add", "not_null", "source_file")] == 0
    assert report[("contact_silver", "unique_key", "email")] == 0
    assert report[("contact_segment_table", "unique_key", "email,segment")] == 0

    # Second run, no new files: nothing changes.
    before = rows(spark.table("contact_segment_table"))
    job.run_segment_pipeline(spark, cfg, date="2024-01-31")
    assert spark.table("bronze_add").count() == 7
    assert rows(spark.table("contact_segment_table")) == before

    # A late file with an older time: contacts take its values (no time
    # guard), membership keeps the newer remove (late guard).
    drop(L, "blue", "add", "a0.csv", ["Robert,bob@x.io,,,777"], T[0])
    job.run_segment_pipeline(spark, cfg, date="2024-02-01")
    b = spark.table("contact_silver").filter("email = 'bob@x.io'").first()
    assert (b.Name, b.phone_number, b.occupation) == ("Robert", "777", "driver")
    bb = spark.table("contact_segment_table").filter("email = 'bob@x.io' AND segment = 'blue'").first()
    assert bb.is_active is False


def test_job_on_driver_tables(spark):
    """The job on CSV drops made from ``events`` (as in ``bench.py``).  All
    remove files of a segment land after its add files, so a (contact,
    segment) pair is active exactly when it has adds and no remove."""
    import duckdb

    import bench

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    got = bench.job_run(spark, sf)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf}/events.parquet')")
    active, total = con.sql("""
        WITH f AS (SELECT user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 AS seg, event_type FROM events),
        a AS (SELECT DISTINCT user_id, seg FROM f WHERE event_type IN ('signup', 'purchase')),
        r AS (SELECT DISTINCT user_id, seg FROM f WHERE event_type = 'error')
        SELECT (SELECT count(DISTINCT user_id) FROM a WHERE NOT EXISTS
                  (SELECT 1 FROM r WHERE r.user_id = a.user_id AND r.seg = a.seg)),
               (SELECT count(DISTINCT user_id) FROM a)""").fetchall()[0]
    assert (got["contacts"], got["with_segments"]) == (total, active)
