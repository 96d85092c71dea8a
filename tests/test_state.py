"""Safety of the keyed state, the historic load and the export names."""

import os

import pytest
from pyspark.sql import functions as F

from segmentflow.config import JobConfig
from segmentflow.operators.surrogate import fix_collisions, hash_id
from segmentflow.plans import segment_job as job
from segmentflow.sinks.export import export_segments
from segmentflow.streaming.fold import KEPT_SNAPSHOTS, Bucketing, apply_batch, read_state
from tests.conftest import rows

STATE = "k INT, v INT"


def init(spark):
    return spark.createDataFrame([], STATE)


def add(prev, batch):
    both = prev.alias("p").join(batch.alias("b"), "k", "full")
    return both.select("k", F.coalesce("b.v", "p.v").alias("v"))


def forget_state_tables(spark):
    for t in spark.catalog.listTables():
        if t.name.startswith("sf_state_"):
            spark.sql(f"DROP TABLE IF EXISTS {t.name}")


def test_state_survives_new_catalog_and_bucket_count(spark, tmp):
    first = spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit(0).alias("v"))
    apply_batch(first, 0, add, tmp, "s", init, Bucketing(("k",), 16))
    for n, buckets in enumerate((32, 8, 3), start=1):
        forget_state_tables(spark)
        apply_batch(first.withColumn("v", F.lit(n)), n, add, tmp, "s", init, Bucketing(("k",), buckets))
        forget_state_tables(spark)
        state = read_state(spark, tmp, init)
        assert state.count() == 1000 and state.select("v").distinct().collect()[0].v == n
        assert first.join(state, "k").count() == 1000


def test_old_snapshots_go(spark, tmp):
    one = spark.createDataFrame([(1, 1)], STATE)
    for n in range(5):
        apply_batch(one, n, add, tmp, "s", init, Bucketing(("k",), 2))
    left = sorted(os.listdir(os.path.join(tmp, "snap")))
    assert left == [f"seq={n}" for n in range(5 - KEPT_SNAPSHOTS, 5)]
    assert rows(read_state(spark, tmp, init)) == [(1, 1)]
    # One that a run cut off before its removal has left goes with the next.
    os.makedirs(os.path.join(tmp, "snap", "seq=0", "run=old"))
    apply_batch(one, 5, add, tmp, "s", init, Bucketing(("k",), 2))
    assert sorted(os.listdir(os.path.join(tmp, "snap"))) == [f"seq={n}" for n in range(6 - KEPT_SNAPSHOTS, 6)]


def test_unreadable_log_is_an_error(spark, tmp):
    apply_batch(spark.createDataFrame([(1, 1)], STATE), 0, add, tmp, "s", init)
    log = os.path.join(tmp, "_log")
    for name in os.listdir(log):
        if name.endswith(".parquet"):
            with open(os.path.join(log, name), "wb") as f:
                f.write(b"broken")
    with pytest.raises(Exception):
        apply_batch(spark.createDataFrame([(2, 2)], STATE), 1, add, tmp, "s", init)
    assert os.listdir(os.path.join(tmp, "snap")) == ["seq=0"]


def test_historic_load_before_and_after_a_run(spark, tmp):
    cfg = JobConfig(landing=f"{tmp}/l", state=f"{tmp}/s", export=f"{tmp}/e", state_buckets=2, tables={k: f"hist_{k}" for k in JobConfig("", "", "").tables})
    head = "Name,email,DOB,occupation,phone_number,random_id,list_keys\n"
    for name, text in (("h1", "A,a@x,,,1,IDA,\nB,b@x,,,2,IDB,\nB2,b@x,,,2,IDB2,\nN,,,,3,IDN,\n"), ("h2", "C,c@x,,,4,IDC,\nA9,a@x,,baker,9,IDX,\n")):
        with open(f"{tmp}/{name}.csv", "w") as f:
            f.write(head + text)
    job.initial_load(spark, f"{tmp}/h1.csv", cfg)
    job.create_segments(spark, cfg, ["blue", "x/y", "p=q"])
    for kind in ("add", "remove"):
        os.makedirs(f"{cfg.landing}/blue/{kind}")
    with open(f"{cfg.landing}/blue/add/a.csv", "w") as f:
        f.write("Name,email,DOB,occupation,phone_number\nLive,a@x,,,\nD,d@x,,,\n")
    job.run_segment_pipeline(spark, cfg, date="2024-01-01")
    job.initial_load(spark, f"{tmp}/h2.csv", cfg)
    job.run_segment_pipeline(spark, cfg, date="2024-01-02")
    got = {r.email: (r.Name, r.occupation, r.random_id) for r in spark.table("hist_contact_silver").collect()}
    assert set(got) == {"a@x", "b@x", "c@x", "d@x"}
    assert got["a@x"] == ("Live", "baker", "IDA") and got["b@x"][2] == "IDB" and got["c@x"][2] == "IDC"
    bad = {(os.path.basename(r.source), r.reason): r.rejected_rows for r in job.quarantine(spark, cfg).collect()}
    assert bad == {("h1.csv", "duplicate email"): 1, ("h1.csv", "missing email"): 1}
    # A replay reads the landed files again; the history is loaded again.
    again = job.replay_all(spark, cfg, f"{tmp}/s2")
    assert not spark.catalog.tableExists("hist_contact_silver")
    job.run_segment_pipeline(spark, again, date="2024-01-03")
    assert {r.email for r in spark.table("hist_contact_silver").collect()} == {"a@x", "d@x"}


def test_export_escapes_segment_names(spark, tmp):
    main = spark.createDataFrame([("a", ["x/y", "p=q"]), ("b", ["p=q"])], "email STRING, list_of_segments ARRAY<STRING>")
    segs = spark.createDataFrame([("x/y",), ("p=q",), ("empty/one",), ("e=2",)], "segment STRING")
    export_segments(main, segs, tmp, "2024-01-01")
    back = spark.read.option("header", True).csv(f"{tmp}/date=2024-01-01")
    assert rows(back, "email", "segment") == [("a", "p=q"), ("a", "x/y"), ("b", "p=q")]
    assert len([d for d in os.listdir(f"{tmp}/date=2024-01-01") if d.startswith("segment=")]) == 4


def test_id_length_and_repeated_keys(spark):
    one = spark.createDataFrame([("a",)], "k STRING")
    assert len(one.select(hash_id(F.col("k"), length=20).alias("i")).first().i) == 20
    with pytest.raises(ValueError):
        hash_id(F.col("k"), length=30)
    twice = one.union(one).withColumn("i", hash_id(F.col("k")))
    with pytest.raises(ValueError):
        fix_collisions(twice, "k", "i")


def test_checkpoint_folder_must_be_shared():
    from types import SimpleNamespace

    from segmentflow.config import ensure_checkpoint_dir

    fake = SimpleNamespace(
        conf=SimpleNamespace(get=lambda *a: None),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"),
    )
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(fake)


def test_epoch_milliseconds_give_a_far_date(spark):
    from segmentflow.functions.columns import epoch_to_date

    df = spark.createDataFrame([("1704067200",), ("1704067200000",), ("9223372036854775807",), ("x",)], "t STRING")
    got = [r.y for r in df.select(F.year(epoch_to_date("t")).alias("y")).collect()]
    assert got == [2024, 55969, None, None]
