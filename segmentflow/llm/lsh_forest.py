"""Nearest neighbours by a hash-prefix forest (operator 9).

A tree is a sorted array of long hash strings: the signs of a vector's
projections on that tree's random directions.  A query descends in every
tree to its longest matching prefixes and then ascends in all trees at
once, one bit at a time, until the different rows below its prefixes are
enough: ``SPARE`` times what is asked for and ``share`` of the block's rows.
The candidates are scored in single precision, and those that can be among
the nearest exactly, in double precision on the original vectors.

For the largest inner product a vector gets one more component that makes
all lengths equal (the query's is 0), so the nearest by angle are the
nearest by product.

Spark deals the rows by a hash into blocks of about ``BLOCK`` rows, each
with a forest of its own, and the queries into groups of about ``GROUP``;
each cell of a block and a group is one task's work, and a query's best of
every block are ranked at the end.  Every row is in the index; nothing is
broadcast.  Vectors without structure need a large share for a recall of
0.9; where neighbours are closer, prefixes match deeper and a smaller share
will do.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK = 8192
GROUP = 4096
TREES = 128
BITS = 16
SHARE = 0.32
SPARE = 10
SEED = 11
BITMAP_BYTES = 48 << 20  # of the bitmaps of a depth of all trees


class Forest:
    """Trees over the rows of ``vectors`` (distinct, finite, not zero)."""

    def __init__(self, vectors: np.ndarray, longest: float, trees: int = TREES, bits: int = BITS):
        self.vectors, self.trees, self.bits, self.longest = vectors, trees, bits, longest
        self.single = vectors.astype(np.float32)
        dim = vectors.shape[1] + 1
        self.directions = np.random.default_rng(SEED).standard_normal((dim, trees * bits)).astype(np.float32)
        lift = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0))
        keys = np.ascontiguousarray(self._strings(np.column_stack([vectors, lift]) / longest).T)
        self.order = np.argsort(keys, axis=1, kind="stable").astype(np.int32)  # tree x row
        self.keys = np.take_along_axis(keys, self.order, axis=1)
        self.starts: dict[int, np.ndarray] = {}
        self.marks: dict[int, np.ndarray | None] = {}

    def _strings(self, lifted: np.ndarray) -> np.ndarray:
        """Row x tree of hash strings, the first bit highest."""
        signs = lifted.astype(np.float32) @ self.directions >= 0
        packed = np.packbits(signs.reshape(len(lifted), self.trees, self.bits), axis=2)
        out = np.zeros(packed.shape[:2], np.uint16 if self.bits <= 16 else np.int64)
        for byte in range(packed.shape[2]):
            out = (out << 8) | packed[:, :, byte]
        return out >> (8 * packed.shape[2] - self.bits)

    def _places(self, depth: int) -> np.ndarray | None:
        """Tree x prefix of ``depth`` bits: where its rows begin in the
        tree's order, and at the end where the last ones end; None where
        the prefixes outnumber the rows by far."""
        if depth not in self.starts:
            prefixes = 1 << depth
            if prefixes > max(8 * len(self.vectors), 1 << 10):
                return None
            starts = np.zeros((self.trees, prefixes + 1), np.int32)
            for t in range(self.trees):
                np.cumsum(np.bincount(self.keys[t] >> (self.bits - depth), minlength=prefixes), out=starts[t, 1:])
            self.starts = {depth: starts}  # the depths come in descending order
        return self.starts[depth]

    def _ranges(self, keys: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Tree x query: the places below the queries' prefixes."""
        prefix = (keys >> (self.bits - depth)).T.astype(np.int64)
        starts = self._places(depth)
        if starts is not None:
            return np.take_along_axis(starts, prefix, axis=1), np.take_along_axis(starts, prefix + 1, axis=1)
        own = self.keys >> (self.bits - depth)
        low = [np.searchsorted(own[t], prefix[t]) for t in range(self.trees)]
        high = [np.searchsorted(own[t], prefix[t], side="right") for t in range(self.trees)]
        return np.array(low), np.array(high)

    def _bitmaps(self, depth: int) -> np.ndarray | None:
        """Tree x prefix x 64-bit words: the rows below each prefix as a
        bitmap, at most ``BITMAP_BYTES`` of them, else None."""
        words = -(-len(self.vectors) // 64)
        if self.trees * words * 8 << depth > BITMAP_BYTES:
            return None
        if depth not in self.marks:
            deeper = self.marks.get(depth + 1)
            if deeper is not None:
                self.marks[depth] = deeper[:, 0::2] | deeper[:, 1::2]
            else:
                marks = np.empty((self.trees, 1 << depth, words * 8), np.uint8)
                for t in range(self.trees):
                    below = np.zeros((1 << depth, words * 64), np.uint8)
                    below[self.keys[t] >> (self.bits - depth), self.order[t]] = 1
                    marks[t] = np.packbits(below, axis=1, bitorder="little")
                self.marks[depth] = marks.view(np.uint64)
            self.marks.pop(depth + 2, None)
        return self.marks[depth]

    def candidates(self, queries: np.ndarray, enough: int):
        """For each query, in any order, its number and the rows under its
        prefixes at the first depth, going up in all trees at once, where
        they are ``enough`` different ones."""
        n, trees = len(self.vectors), np.arange(self.trees)
        unit = queries / np.sqrt((queries**2).sum(axis=1, keepdims=True))
        keys = self._strings(np.column_stack([unit, np.zeros(len(unit))]))
        open_ = np.arange(len(queries))
        for depth in range(self.bits, -1, -1):
            low, high = self._ranges(keys[open_], depth)
            # Fewer places than ``enough`` can't hold so many rows.
            full = ((high - low).sum(axis=0) >= enough) | (depth == 0)
            up = ~full
            # Bitmaps are made where enough queries are to use them.
            marks = self._bitmaps(depth) if np.count_nonzero(full) * 8 >= 1 << depth else None
            for i in np.flatnonzero(full):
                if marks is not None:
                    union = np.bitwise_or.reduce(marks[trees, keys[open_[i]] >> (self.bits - depth)], axis=0)
                    if depth and int(np.bitwise_count(union).sum()) < enough:
                        up[i] = True
                        continue
                    marked = np.unpackbits(union.view(np.uint8), count=n, bitorder="little").view(bool)
                else:
                    marked = np.zeros(n, bool)
                    marked[np.concatenate([self.order[t, low[t, i] : high[t, i]] for t in range(self.trees)])] = True
                    if depth and np.count_nonzero(marked) < enough:
                        up[i] = True
                        continue
                yield int(open_[i]), np.flatnonzero(marked)
            open_ = open_[up]
            if not len(open_):
                return

    def best(self, found: np.ndarray, query: np.ndarray, k: int) -> np.ndarray:
        """Those of ``found`` that can be among the ``k`` largest products."""
        if len(found) <= k:
            return found
        score = self.single.take(found, axis=0) @ query.astype(np.float32)
        cut = np.partition(score, len(score) - k)[len(score) - k]
        error = 4 * len(query) * 2.0**-23 * self.longest * float(np.sqrt((query**2).sum()))
        return found[score >= cut - error]


def usable(vector: str) -> Column:
    """True for vectors with finite components, not all of them zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    share: float = SHARE,
    block: int = BLOCK,
    group: int = GROUP,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k``
    nearest found of every row for which ``is_query`` holds, among all rows
    of another id; ties go to the smaller id.

    Rows with a null id or an unusable vector (null, empty, zero, or with a
    null or non-finite component) take no part.  Repeated rows count once;
    of several vectors of one id each is a candidate, and as a query the id
    takes the smallest.  Vectors of different lengths aren't compared.  An
    empty table gives an empty result; other columns are not read."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"), is_query.alias("q"))
    rows = rows.where(F.col("id").isNotNull() & usable("v")).groupBy("id", "v").agg(F.max("q").alias("q"))
    rows = rows.withColumn("dim", F.size("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    n, n_queries, longest = rows.agg(F.count(F.lit(1)), F.count_if("q"), F.max(norm)).first()
    blocks, groups = max(1, math.ceil(n / block)), max(1, math.ceil(n_queries / group))
    longest = float(longest or 1.0)
    queries = rows.where("q").groupBy("id", "dim").agg(F.min("v").alias("v"))
    hashed = lambda count, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(count)).cast("int")
    base = rows.select("dim", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"), "id", "v", F.lit(False).alias("asks"))
    asked = queries.select("dim", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), hashed(groups, 1).alias("grp"), "id", "v", F.lit(True).alias("asks"))

    def search(table: pa.Table) -> pa.Table:
        out = ([], [], [])
        asks = np.array(table.column("asks").to_pylist(), bool)
        ids = table.column("id").to_numpy()
        if asks.any() and not asks.all():
            dim = table.column("dim")[0].as_py()
            v = table.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)
            # Equal vectors are one row of the forest, with all their ids.
            distinct, of = np.unique(v[~asks], axis=0, return_inverse=True)
            order = np.lexsort((ids[~asks], of))
            members, bounds = ids[~asks][order], np.searchsorted(of[order], np.arange(len(distinct) + 1))
            forest = Forest(distinct, longest)
            for q, found in forest.candidates(v[asks], SPARE * (k + 1) + math.ceil(share * len(distinct))):
                query, vector = ids[asks][q], v[asks][q]
                found = forest.best(found, vector, k + 1)
                # The same sum for every row, so equal vectors tie.
                score = (distinct[found] * vector).sum(axis=1)
                # No more than k + 1 ids of a vector can be among the best.
                few = [members[bounds[f] : min(bounds[f + 1], bounds[f] + k + 1)] for f in found]
                near = np.concatenate(few)
                score = np.repeat(score, [len(f) for f in few])
                other = near != query
                near, score = near[other], score[other]
                best = np.lexsort((near, -score))[:k]
                out[0].append(np.full(len(best), query))
                out[1].append(near[best])
                out[2].append(score[best])
        arrays = [np.concatenate(x) if x else np.zeros(0) for x in out]
        return pa.table([pa.array(arrays[0].astype(np.int64)), pa.array(arrays[1].astype(np.int64)), pa.array(arrays[2].astype(np.float64))], names=["query_id", "vec_id", "score"])

    cells = base.union(asked).groupBy("dim", "block", "grp")
    found = cells.applyInArrow(search, "query_id BIGINT, vec_id BIGINT, score DOUBLE")
    # An id with several vectors counts with its best.
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
