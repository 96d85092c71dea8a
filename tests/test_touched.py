"""The touched-partition merge: other partitions keep their files, and a
batch that is cut off at any step is applied exactly once."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from segmentflow.streaming.touched import PartitionedState
from tests.conftest import rows

STATE = "k BIGINT, n BIGINT"


def add(prev, batch):
    """Not idempotent: counts."""
    b = batch.groupBy("k").agg(F.sum("n").alias("_n"))
    return prev.join(b, "k", "full").select("k", (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n"))


def files(state):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{state.table}/_bucket=*/*.parquet")}


def test_untouched_partitions_keep_their_files(spark, tmp):
    state = PartitionedState(spark, tmp, StructType.fromDDL(STATE), ["k"], 16)
    assert rows(state.read()) == []
    state.apply(spark.range(200).select(F.col("id").alias("k"), F.lit(1).alias("n")), 0, add, "s")
    before = files(state)
    assert len({os.path.dirname(f) for f in before}) == 16
    state.apply(spark.createDataFrame([(7, 5), (7, 5), (1007, 1)], STATE), 1, add, "s")
    after = files(state)
    touched = {r[0] for r in spark.createDataFrame([(7,), (1007,)], "k BIGINT").select(state.bucket()).collect()}
    same = {f for f in before if int(os.path.basename(os.path.dirname(f)).split("=")[1]) not in touched}
    assert same and all(after.get(f) == before[f] for f in same) and not (set(before) - same) & set(after)
    got = dict(rows(state.read()))
    assert len(got) == 201 and got[7] == 11 and got[1007] == 1 and got[8] == 1
    state.apply(spark.createDataFrame([], STATE), 2, add, "s")  # an empty batch
    assert files(state) == after


@pytest.mark.parametrize("cut", ["pending written", "pending logged", "table half written", "table written"])
def test_a_batch_that_is_cut_off_is_applied_once(spark, tmp, cut):
    state = PartitionedState(spark, tmp, StructType.fromDDL(STATE), ["k"], 4)
    state.apply(spark.range(40).select(F.col("id").alias("k"), F.lit(1).alias("n")), 0, add, "s")
    batch = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("n"))
    logged = state._logged

    class Lost(Exception):
        pass

    def fail(stream, batch_id, step):
        if cut == "pending written" or (cut != "pending logged" and step == "done"):
            raise Lost
        logged(stream, batch_id, step)
        if cut == "pending logged":
            raise Lost

    state._logged = fail
    with pytest.raises(Lost):
        state.apply(batch, 1, add, "s")
    state._logged = logged
    if cut == "table half written":  # a partition was removed, not yet renamed
        for f in glob.glob(f"{state.table}/_bucket=2/*"):
            os.remove(f)
    for _ in range(2):
        state.apply(batch, 1, add, "s")
    assert rows(state.read()) == sorted(((i, 2 if i < 40 else 1) for i in range(50)), key=str)
