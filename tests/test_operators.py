"""Single-operator tests on tiny fixtures (the cases of FIXTURES.md §3)."""

import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from segmentflow.functions.columns import changed_non_null, epoch_to_date, path_part, sorted_distinct
from segmentflow.operators import diff, marts, merge, overlap, profile, quality, scd2
from segmentflow.operators.dedup import deduplicate, latest_per_key
from segmentflow.operators.surrogate import ID_ALPHABET, fix_collisions, hash_id
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1, 0, 0)
T1 = dt.datetime(2024, 1, 2, 0, 0)
T2 = dt.datetime(2024, 1, 3, 0, 0)
T3 = dt.datetime(2024, 1, 4, 0, 0)

MEM = "email STRING, segment STRING, file_modification_time TIMESTAMP, is_active BOOLEAN"
EV = "email STRING, segment STRING, file_modification_time TIMESTAMP"


def test_latest_per_key_ties_are_repeatable(spark):
    df = spark.createDataFrame(
        [("a", T1, "f1", "x"), ("a", T1, "f1", "y"), ("a", T0, "f0", "z"), ("b", None, "f2", "n"), ("b", T0, "f2", "m")],
        "email STRING, t TIMESTAMP, source_file STRING, v STRING",
    )
    out = latest_per_key(df, ["email"], "t", ["source_file"])
    # same time and file: the larger remaining value wins; NULL time sorts last
    assert rows(out) == [("a", T1, "f1", "y"), ("b", T0, "f2", "m")]
    assert rows(latest_per_key(df, ["email"], "t", ["source_file"], method="window")) == rows(out)
    assert rows(deduplicate(df, "email", "t")) == rows(out)


def test_upsert_null_never_erases_and_keeps_id(spark):
    tgt = spark.createDataFrame(
        [("a", "Ann", "dev", "111", "ID_A", "#A01"), ("c", "Cy", None, None, "ID_C", None)],
        "email STRING, Name STRING, occupation STRING, phone STRING, random_id STRING, list_keys STRING",
    )
    src = spark.createDataFrame(
        [("a", None, "ops", None, T1), ("b", "Bo", None, "222", T1), (None, "Nobody", None, None, T1)],
        "email STRING, Name STRING, occupation STRING, phone STRING, t TIMESTAMP",
    )
    out = merge.upsert_keep_non_null(tgt, src, "email", ["Name", "occupation", "phone"], order_col="t")
    got = {r.email: r for r in out.collect()}
    assert set(got) == {"a", "b", "c"}  # NULL key rejected
    assert (got["a"].Name, got["a"].occupation, got["a"].phone, got["a"].random_id, got["a"].list_keys) == (
        "Ann", "ops", "111", "ID_A", "#A01")
    assert got["b"].random_id is not None and len(got["b"].random_id) == 15
    assert set(got["b"].random_id) <= set(ID_ALPHABET)
    assert got["b"].list_keys is None
    assert got["c"].Name == "Cy"


def test_upsert_later_batch_wins_even_with_older_file(spark):
    tgt = spark.createDataFrame([("a", "new", "ID")], "email STRING, Name STRING, random_id STRING")
    late_old = spark.createDataFrame([("a", "old", T0)], "email STRING, Name STRING, t TIMESTAMP")
    out = merge.upsert_keep_non_null(tgt, late_old, "email", ["Name"], order_col="t")
    assert rows(out) == [("a", "old", "ID")]


def test_upsert_replay_equals_fold(spark):
    batches = spark.createDataFrame(
        [
            ("a", "n1", "o1", T0, 0), ("a", None, "o2", T1, 1), ("a", "n3", None, T2, 2),
            ("b", None, None, T0, 0), ("b", "nb", None, T1, 2), ("a", "n0", "oX", T0, 1),
        ],
        "email STRING, Name STRING, occupation STRING, t TIMESTAMP, b INT",
    )
    closed = merge.upsert_replay(batches, "email", ["Name", "occupation"], "b", "t")
    state = spark.createDataFrame([], "email STRING, Name STRING, occupation STRING, random_id STRING")
    for b in range(3):
        state = merge.upsert_keep_non_null(
            state, batches.filter(F.col("b") == b), "email", ["Name", "occupation"], order_col="t"
        )
    assertDataFrameEqual(state.select(*closed.columns), closed)
    assert rows(closed, "email", "Name", "occupation") == [("a", "n3", "o2"), ("b", "nb", None)]


def test_membership_remove_older_equal_newer(spark):
    adds = spark.createDataFrame([("a", "s", T1), ("b", "s", T1), ("c", "s", T1)], EV)
    rems = spark.createDataFrame([("a", "s", T0), ("b", "s", T1), ("c", "s", T2), ("d", "s", T2)], EV)
    out = merge.segment_membership(adds, rems)
    assert rows(out) == [("a", "s", T1, True), ("b", "s", T1, True), ("c", "s", T2, False)]
    fold = merge.segment_deactivate(merge.segment_activate(merge.empty_membership(spark), adds), rems)
    assertDataFrameEqual(fold, out)


def test_membership_cross_run_remove_before_add(spark):
    """A remove with no add is dropped; an older add in a later run then
    becomes active (the closed form would say inactive)."""
    run1 = merge.segment_membership(
        spark.createDataFrame([], EV), spark.createDataFrame([("a", "s", T2)], EV), merge.empty_membership(spark)
    )
    assert run1.count() == 0
    run2 = merge.segment_membership(spark.createDataFrame([("a", "s", T1)], EV), spark.createDataFrame([], EV), run1)
    assert rows(run2) == [("a", "s", T1, True)]


def test_late_guard_older_add_does_not_revive(spark):
    tgt = spark.createDataFrame([("a", "s", T2, False)], MEM)
    out = merge.segment_activate(tgt, spark.createDataFrame([("a", "s", T1), ("a", "s", T2)], EV))
    assert rows(out) == [("a", "s", T2, False)]
    newer = merge.segment_activate(tgt, spark.createDataFrame([("a", "s", T3)], EV))
    assert rows(newer) == [("a", "s", T3, True)]


def test_main_table_null_list_and_fanout(spark):
    contacts = spark.createDataFrame([("a",), ("b",), ("c",)], "email STRING")
    mem = spark.createDataFrame(
        [("a", "red", T0, True), ("a", "blue", T0, True), ("b", "red", T0, False)], MEM
    )
    main = marts.main_table(contacts, mem)
    got = {r.email: r.list_of_segments for r in main.collect()}
    assert got == {"a": ["blue", "red"], "b": None, "c": None}
    segs = spark.createDataFrame([("red",), ("green",)], "segment STRING")
    fan = marts.segment_fanout(main, segs)
    assert rows(fan) == [("a", "red")]
    member = main.filter(F.array_contains("list_of_segments", "red"))
    assert [r.email for r in member.collect()] == ["a"]


def test_scd2_cases(spark):
    H = "id INT, v STRING, modifiedon TIMESTAMP, start_timestamp TIMESTAMP, end_timestamp TIMESTAMP"
    tgt = spark.createDataFrame(
        [
            (1, "old", T1, T0, None),  # incoming newer -> closed + new row
            (2, "same", T1, T0, None),  # incoming equal -> ignored
            (3, "keep", T2, T0, None),  # incoming older -> ignored
            (4, "gone", T0, T0, T1),  # closed history only -> new open row
        ],
        H,
    )
    inc = spark.createDataFrame(
        [(1, "new", T2), (1, "newer?", T1), (2, "same2", T1), (3, "older", T1), (4, "back", T2), (5, "fresh", T0)],
        "id INT, v STRING, modifiedon TIMESTAMP",
    )
    now = dt.datetime(2030, 1, 1)
    out = scd2.scd2_merge(tgt, inc, "id", "modifiedon", now)
    assert rows(out) == sorted(
        [
            (1, "old", T1, T0, now), (1, "new", T2, now, None), (2, "same", T1, T0, None), (3, "keep", T2, T0, None),
            (4, "gone", T0, T0, T1), (4, "back", T2, now, None), (5, "fresh", T0, now, None),
        ],
        key=lambda t: tuple(str(x) for x in t),
    )
    assert scd2.current_rows(out).count() == 5


def test_changed_non_null_truth_table(spark):
    df = spark.createDataFrame(
        [(1, None, "x"), (2, "x", "x"), (3, "y", "x"), (4, "y", None), (5, None, None)], "k INT, sv STRING, tv STRING"
    )
    j = df.select("k", F.struct(F.col("sv").alias("v")).alias("s"), F.struct(F.col("tv").alias("v")).alias("t"))
    out = j.select("k", changed_non_null(["v"]).alias("c"))
    assert rows(out) == [(1, False), (2, False), (3, True), (4, True), (5, False)]


def test_epoch_to_date_and_date_range(spark):
    df = spark.createDataFrame(
        [("c1", "1564617600", 1), ("c2", "1567295999", 2), ("c3", "1567296000", 3), ("c4", "abc", 4), ("c5", "", 5),
         ("c6", None, 6), ("c7", "100000000000000000", 7)],
        "customer_name STRING, order_datetime STRING, order_number BIGINT",
    )
    raw = marts.orders_raw(df)
    got = {r.customer_name: r.order_date for r in raw.collect()}
    assert got == {"c1": dt.date(2019, 8, 1), "c2": dt.date(2019, 8, 31), "c3": dt.date(2019, 9, 1),
                   "c4": None, "c5": None, "c6": None, "c7": None}
    daily = marts.orders_daily(raw, ("2019-08-01", "2019-09-01"))
    assert rows(daily) == [(dt.date(2019, 8, 1), 1), (dt.date(2019, 8, 31), 1)]
    assert marts.orders_daily(raw, None).count() == 4  # NULL date is a group too
    assert rows(df.select(epoch_to_date("order_datetime").alias("d")).filter("d is not null")) == [
        (dt.date(2019, 8, 1),), (dt.date(2019, 8, 31),), (dt.date(2019, 9, 1),)]


def test_path_part_short_path_is_null(spark):
    df = spark.createDataFrame([("/v/landing/blue/add/f.csv",), ("f.csv",), (None,)], "p STRING")
    assert [r.s for r in df.select(path_part("p").alias("s")).collect()] == ["blue", None, None]


def test_surrogate_ids_stable_and_collisions_fixed(spark):
    keys = spark.range(300).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("email"))
    a = keys.select("email", hash_id(F.col("email")).alias("random_id"))
    b = keys.select("email", hash_id(F.col("email")).alias("random_id"))
    assertDataFrameEqual(a, b)
    # 2-character ids collide with 300 keys; the loop must make them unique
    # and keep the ids of keys that held them before.
    short = keys.select("email", hash_id(F.col("email"), length=2).alias("random_id"))
    kept = short.limit(0)
    fixed = fix_collisions(short, "email", "random_id", keep_keys=kept.select("email"), length=2)
    assert fixed.count() == 300
    assert fixed.select("random_id").distinct().count() == 300


def test_fix_collisions_keeps_existing_ids(spark):
    state = spark.createDataFrame([("old", "X1"), ("new", "X1")], "email STRING, random_id STRING")
    prior = spark.createDataFrame([("old",)], "email STRING")
    out = {r.email: r.random_id for r in fix_collisions(state, "email", "random_id", prior).collect()}
    assert out["old"] == "X1" and out["new"] != "X1"


def test_pair_overlap_matches_brute_force(spark):
    data = [("f1", "a"), ("f1", "b"), ("f1", "b"), ("f2", "b"), ("f2", "c"), ("f3", "a"), ("f3", "b"), ("f4", None)]
    df = spark.createDataFrame(data, "file STRING, email STRING")
    sets = {}
    for f, e in data:
        sets.setdefault(f, set())
        if e is not None:
            sets[f].add(e)
    files = sorted(sets)
    expect = sorted((a, b, len(sets[a] & sets[b])) for i, a in enumerate(files) for b in files[i + 1:])
    got = rows(overlap.pair_overlap(df, "file", "email"))
    assert got == expect
    counts = [c for _, _, c in expect]
    for stats in (
        overlap.overlap_stats(overlap.pair_overlap(df, "file", "email")).first(),
        overlap.pair_overlap_stats(df, "file", "email").first(),
    ):
        assert (stats.min_shared, stats.max_shared, stats.pair_count) == (min(counts), max(counts), len(counts))
        assert abs(stats.avg_shared - sum(counts) / len(counts)) < 1e-9
    # all pairs share a key: no zero pair, the minimum is a real count
    full = spark.createDataFrame([("f1", "a"), ("f2", "a"), ("f3", "a"), ("f3", "b"), ("f2", "b")], "file STRING, email STRING")
    st = overlap.pair_overlap_stats(full, "file", "email").first()
    assert (st.min_shared, st.max_shared, st.pair_count, st.avg_shared) == (1, 2, 3, 4 / 3)
    one = spark.createDataFrame([("f1", "a")], "file STRING, email STRING")
    st = overlap.pair_overlap_stats(one, "file", "email").first()
    assert (st.min_shared, st.max_shared, st.avg_shared, st.pair_count) == (None, None, None, 0)
    summ = overlap.overlap_summary(df, "file", "email").first()
    assert (summ.unique_keys, summ.overlapping_keys) == (3, 2)
    assert abs(summ.avg_keys_per_file - (2 + 2 + 2 + 0) / 4) < 1e-9
    seen = rows(overlap.seen_before(df, "file", "email"))
    assert seen == [("f1", 2, 0), ("f2", 2, 1), ("f3", 2, 2)]


def test_duplicate_rate_counts_null_as_value(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "email STRING")
    r = overlap.duplicate_rate(df, "email").first()
    assert (r.total_rows, r.distinct_keys, r.duplicate_rate) == (4, 2, 0.5)


def test_unseen_keys(spark):
    new = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1), ("c", 1)], "email STRING, v INT")
    pool = spark.createDataFrame([("b",)], "email STRING")
    assert rows(overlap.unseen_keys(new, pool, "email")) == [("a", 1), ("c", 1)]
    assert rows(overlap.unseen_keys(new, pool, "email", order_col="v")) == [("a", 2), ("c", 1)]


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", None)], "email STRING, v INT")
    assert rows(quality.not_null(df, ["email", "v"])) == [(None, 3), ("b", None)]
    assert rows(quality.unique_key(df, ["email"])) == [("a", 2)]
    assert not quality.check_passes(quality.unique_key(df, ["email"]))


def test_null_profile(spark):
    df = spark.createDataFrame([("f", "a", None), ("f", None, None), ("g", "b", "x")], "file STRING, email STRING, n STRING")
    out = rows(profile.null_profile(df, "file", ["n"], key="email"))
    assert out == [("f", 2, 1, 2), ("g", 1, 1, 0)]


def test_definition_diff_cases(spark):
    src = spark.createDataFrame(
        [
            ("new", json.dumps({"a": 1})),
            ("same", json.dumps({"a": 1, "b": {"x": 1, "y": [1, 2]}})),
            ("changed", json.dumps({"a": 1, "b": 2})),
            ("typed", json.dumps({"a": 7})),
            ("broken", json.dumps({"a": 1})),
            ("added", json.dumps({"a": 1, "c": None})),
        ],
        "name STRING, definition STRING",
    )
    tgt = spark.createDataFrame(
        [
            ("same", '{"b": {"y": [1, 2], "x": 1}, "a": 1}'),
            ("changed", json.dumps({"b": 3, "a": 1})),
            ("typed", json.dumps({"a": "7"})),
            ("broken", "{not json"),
            ("added", json.dumps({"a": 1})),
            ("target_only", json.dumps({"a": 1})),
        ],
        "name STRING, definition STRING",
    )
    got = {r.name: (r.action, r.changed_fields) for r in diff.definition_diff(src, tgt).collect()}
    assert got == {
        "new": ("CREATE", None),
        "same": ("NO CHANGE", None),
        "changed": ("UPDATE", ["b"]),
        "typed": ("UPDATE", ["a"]),
        "broken": ("UPDATE", [diff.WHOLE_DEFINITION]),
        "added": ("UPDATE", ["c"]),
    }


def test_sorted_distinct(spark):
    df = spark.createDataFrame([(["b", "a", "b"],)], "l ARRAY<STRING>")
    assert df.select(sorted_distinct("l").alias("s")).first().s == ["a", "b"]


def test_sum_count_and_sorted_columns(spark):
    trips = spark.createDataFrame([(10.0, 1), (40.0, 1), (5.0, 2), (None, 2)], "fare_amount DOUBLE, pickup_zip INT")
    cheap = trips.filter("fare_amount < 30")
    assert cheap.count() == 2  # NULL dropped
    assert rows(marts.sum_by_group(trips, "pickup_zip", "fare_amount", "total")) == [(1, 50.0), (2, 5.0)]
    a = trips.select("pickup_zip", "fare_amount")
    b = trips.select("fare_amount", "pickup_zip")
    assertDataFrameEqual(a.select(sorted(a.columns)), b.select(sorted(b.columns)))


def test_fix_collisions_with_probe(spark):
    state = spark.createDataFrame(
        [("old", "X1"), ("new", "X1"), ("other", "Y"), ("o2", "Z"), ("o3", "Z")], "email STRING, random_id STRING"
    )
    prior = spark.createDataFrame([("old",), ("o2",), ("o3",)], "email STRING")
    probe = spark.createDataFrame([("X1",)], "random_id STRING")
    out = {r.email: r.random_id for r in fix_collisions(state, "email", "random_id", prior, check_ids=probe).collect()}
    # X1 is probed and fixed; Z is outside the probe and left alone
    assert out["old"] == "X1" and out["new"] != "X1" and out["o2"] == out["o3"] == "Z"


def test_fold_applies_a_retried_batch_once(spark, tmp):
    from segmentflow.streaming.fold import Bucketing, apply_batch, latest_snapshot, read_state

    state_dir = tmp + "/state"
    init = lambda s: merge.empty_membership(s)
    adds = spark.createDataFrame([("a", "s", T1), ("b", "s", T1)], EV)
    rems = spark.createDataFrame([("a", "s", T2)], EV)
    for bucketing in (None, Bucketing(("email", "segment"), 4)):
        d = f"{state_dir}-{bucketing is not None}"
        apply_batch(adds, 0, merge.segment_activate, d, "add", init, bucketing)
        apply_batch(adds, 0, merge.segment_activate, d, "add", init, bucketing)  # retry: skipped
        apply_batch(rems, 0, merge.segment_deactivate, d, "remove", init, bucketing)
        assert latest_snapshot(spark, d) == 1
        got = rows(read_state(spark, d, init))
        assert got == [("a", "s", T2, False), ("b", "s", T1, True)]


def test_scd2_as_stream_fold(spark, tmp):
    from segmentflow.streaming.fold import Bucketing, apply_batch, read_state

    H = "id INT, v STRING, modifiedon TIMESTAMP, start_timestamp TIMESTAMP, end_timestamp TIMESTAMP"
    init = lambda s: s.createDataFrame([], H)
    fold = scd2.scd2_fold("id", "modifiedon", dt.datetime(2030, 1, 1))
    inc = "id INT, v STRING, modifiedon TIMESTAMP"
    d, b = tmp + "/h", Bucketing(("id",), 4)
    apply_batch(spark.createDataFrame([(1, "a", T0), (2, "b", T0)], inc), 0, fold, d, "chg", init, b)
    apply_batch(spark.createDataFrame([(1, "a2", T1), (2, "old", T0)], inc), 1, fold, d, "chg", init, b)
    apply_batch(spark.createDataFrame([(1, "a2", T1)], inc), 1, fold, d, "chg", init, b)  # retried: skipped
    h = read_state(spark, d, init)
    assert h.count() == 3
    assert rows(scd2.current_rows(h), "id", "v") == [(1, "a2"), (2, "b")]


def test_assign_new_ids_avoids_taken_and_each_other(spark):
    from segmentflow.operators.surrogate import assign_new_ids

    keys = spark.range(150).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("email"))
    # existing ids: every 2-character id of 80 other keys
    taken = spark.range(80).select(hash_id(F.concat(F.lit("o"), F.col("id").cast("string")), length=2).alias("random_id"))
    got = assign_new_ids(keys, taken, "email", "random_id", length=2)
    ids = [r.random_id for r in got.collect()]
    assert got.count() == 150 and len(set(ids)) == 150
    assert not set(ids) & {r.random_id for r in taken.collect()}


def test_empty_inputs_give_null_ratios(spark):
    empty = spark.createDataFrame([], "file STRING, email STRING")
    r = overlap.overlap_summary(empty, "file", "email").first()
    assert (r.unique_keys, r.overlap_pct, r.avg_keys_per_file) == (0, None, None)
    d = overlap.duplicate_rate(empty, "email").first()
    assert (d.total_rows, d.duplicate_rate) == (0, None)


def test_upsert_optional_time_guard(spark):
    tgt = spark.createDataFrame(
        [("a", "new", T2, "IDA"), ("b", "old", T0, "IDB"), ("c", "cc", None, "IDC")],
        "email STRING, Name STRING, t TIMESTAMP, random_id STRING",
    )
    src = spark.createDataFrame(
        [("a", "late", T1), ("b", "fresh", T1), ("c", "cfresh", T1), ("d", "dd", T1)], "email STRING, Name STRING, t TIMESTAMP"
    )
    off = {r.email: (r.Name, r.t) for r in merge.upsert_keep_non_null(tgt, src, "email", ["Name"], order_col="t").collect()}
    assert off["a"] == ("late", T2)  # no guard: the older late file wins
    on = {
        r.email: (r.Name, r.t)
        for r in merge.upsert_keep_non_null(tgt, src, "email", ["Name"], order_col="t", time_guard="t").collect()
    }
    assert on == {"a": ("new", T2), "b": ("fresh", T1), "c": ("cfresh", T1), "d": ("dd", T1)}
