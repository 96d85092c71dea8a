"""Plan rules for every registered query (physical plan only, nothing is
executed except the writes some queries do to stage their input):

* no Python evaluation in any plan (built-in expressions only);
* no cartesian product;
* nested-loop joins only where the list of all file pairs is the output.
"""

import contextlib
import io

import pytest

from segmentflow.plans import testdata as entry

SF = "/root/testdata/sf0.001"
PAIR_LISTS = {"all_pairs", "pair_overlap"}
# These run their work (streams, writes) while building the DataFrame and
# return a read of what they wrote, so their final plan shows none of it;
# their results are checked by the oracle tests.
STAGED = {"segment_job", "replay_all", "scd2_stream", "foreach_batch_merge", "orders_daily_stream", "segment_export", "initial_load", "quarantine"}


def physical(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - STAGED))
def test_plan_rules(spark, name):
    import os

    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    p = physical(entry.queries()[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "CartesianProduct"):
        assert bad not in p, f"{name}: {bad}"
    if name not in PAIR_LISTS:
        assert "BroadcastNestedLoopJoin" not in p, name


@pytest.mark.parametrize(
    "name, pushed, read_schema",
    [
        ("filter_lt", "LessThan(l_quantity,30.0)", "struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>"),
        ("filter_eq", "EqualTo(l_returnflag,R)", None),
        ("select_cols", None, "struct<o_orderkey:bigint,o_custkey:bigint>"),
        ("filter_date_range", "GreaterThanOrEqual(o_orderdate", "struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>"),
        ("segment_membership", "event_type", "struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>"),
    ],
)
def test_pushdown_and_pruning(spark, name, pushed, read_schema):
    """Filters reach the Parquet scan and only the needed columns are read."""
    import os

    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    p = physical(entry.queries()[name](spark, SF))
    if pushed:
        assert "PushedFilters: [" in p and pushed in p.split("PushedFilters: [", 1)[1], p
    if read_schema:
        assert f"ReadSchema: {read_schema}" in p, p
