"""Fold equals closed form, on random inputs.

* Folding batches one after another with ``upsert_keep_non_null`` gives the
  same table as ``upsert_replay`` over all batches at once.
* One run of activations then deactivations gives the same membership as
  the closed form of ``segment_membership``.
* Both also equal a plain Python model of the rules.
"""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from segmentflow.operators import merge
from tests.conftest import rows

EMAILS = ["a", "b", "c", "d"]
TIMES = [dt.datetime(2024, 1, d) for d in range(1, 6)]

upsert_rows = st.lists(
    st.tuples(
        st.sampled_from(EMAILS),
        st.one_of(st.none(), st.sampled_from(["x", "y", "z"])),
        st.one_of(st.none(), st.sampled_from(["p", "q"])),
        st.sampled_from(TIMES),
        st.integers(0, 2),
        st.integers(0, 10**6),
    ),
    min_size=1,
    max_size=12,
)


def python_fold(data):
    """Per batch: newest row per email (ties: larger row id, then larger
    remaining values with NULL lowest); then each non-NULL value
    overwrites."""

    def rank(n, o, t, rid):
        return (t, rid, n is not None, n or "", o is not None, o or "")

    state = {}
    for b in range(3):
        latest = {}
        for e, n, o, t, bb, rid in data:
            if bb != b:
                continue
            if e not in latest or rank(n, o, t, rid) > rank(*latest[e]):
                latest[e] = (n, o, t, rid)
        for e, (n, o, _, _) in latest.items():
            old = state.get(e, (None, None))
            state[e] = (n if n is not None else old[0], o if o is not None else old[1])
    return sorted((e, v[0], v[1]) for e, v in state.items())


@settings(max_examples=12, deadline=None)
@given(upsert_rows)
def test_upsert_fold_equals_replay(spark, data):
    df = spark.createDataFrame(data, "email STRING, Name STRING, occupation STRING, t TIMESTAMP, b INT, rid BIGINT")
    cols = ["Name", "occupation"]
    closed = merge.upsert_replay(df, "email", cols, "b", "t", ["rid"], id_col=None)
    state = spark.createDataFrame([], "email STRING, Name STRING, occupation STRING")
    for b in range(3):
        state = merge.upsert_keep_non_null(
            state, df.filter(df.b == b), "email", cols, id_col=None, order_col="t", tie_cols=["rid"]
        )
    got_fold = sorted(tuple(r) for r in state.select("email", *cols).collect())
    got_closed = sorted(tuple(r) for r in closed.select("email", *cols).collect())
    expect = python_fold(data)
    assert [tuple(map(str, r)) for r in got_fold] == [tuple(map(str, r)) for r in expect]
    assert [tuple(map(str, r)) for r in got_closed] == [tuple(map(str, r)) for r in expect]


events = st.lists(
    st.tuples(st.sampled_from(EMAILS), st.sampled_from(["s1", "s2"]), st.sampled_from(TIMES), st.booleans()),
    min_size=1,
    max_size=14,
)


def python_membership(data):
    adds, rems = {}, {}
    for e, s, t, is_add in data:
        d = adds if is_add else rems
        d[(e, s)] = max(d.get((e, s), t), t)
    out = []
    for k, a in adds.items():
        r = rems.get(k)
        removed = r is not None and r > a
        out.append((k[0], k[1], r if removed else a, not removed))
    return sorted(out, key=lambda x: tuple(str(v) for v in x))


@settings(max_examples=12, deadline=None)
@given(events)
def test_membership_fold_equals_closed_form(spark, data):
    df = spark.createDataFrame(data, "email STRING, segment STRING, file_modification_time TIMESTAMP, is_add BOOLEAN")
    adds = df.filter("is_add").drop("is_add")
    rems = df.filter("NOT is_add").drop("is_add")
    closed = merge.segment_membership(adds, rems)
    fold = merge.segment_deactivate(merge.segment_activate(merge.empty_membership(spark), adds), rems)
    expect = python_membership(data)
    assert rows(closed) == expect
    assert rows(fold) == expect
