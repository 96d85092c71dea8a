"""Embedding near duplicates by product quantisation (operator 11).

Two vectors are linked if their cosine is at least ``LINK``, so if their
unit vectors are at most ``RADIUS`` apart.

1. Equal vectors are one row from here on; the smallest id stands for them.
2. Index, fitted on a sample of at most ``SAMPLE`` rows (those of smallest
   hash): coarse centroids, about one for each ``LIST_ROWS`` rows and at
   most ``LISTS``, and a codebook for each of ``SUBSPACES`` pieces of the
   residual.  Every row is indexed: its nearest centroid is its inverted
   list, and it keeps its code and the length ``err`` of what the code
   leaves out.
3. Probes: a row asks every list that a vector within ``RADIUS`` of it may
   be in.  Such a vector lies beyond the plane halfway between the two
   centroids, so the row's distance to that plane is at most ``RADIUS``;
   lists beyond ``MARGIN`` standard deviations of a difference of that
   length in a random direction (in the sample's effective dimension) are
   left out, none if the dimension is below ``MARGIN`` squared.  That loses
   a link of the least cosine with a probability of 2e-4 a plane, closer
   ones with less.  Of two lists one asks the other, so each pair is looked
   at once.
4. In a list, a table of the row's distances to the codebooks' entries gives
   its distance ``d`` to every code.  ``d - err`` over the radius can't be a
   link and ``d + err`` under it must be one; for the rest the exact cosine
   in double precision decides.
5. A list is dealt to blocks of ``BLOCK`` rows and its questions to chunks
   of ``BLOCK``.  A cell of both returns the number of links of each row and
   the edges of a spanning forest, so what it returns is linear in its rows,
   however dense its links.  Nothing is broadcast but the index (bounded).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentflow.llm.common import staged
from segmentflow.llm.lsh_forest import usable
from segmentflow.llm.near_dup import components

LINK = 0.9
LISTS = 4096
LIST_ROWS = 2048
SAMPLE = 65_536
INDEX_BYTES = 32 << 20
SUBSPACES = 8
CODES = 256
ROUNDS = 8
MARGIN = 3.5
BLOCK = 2048
TOGETHER = 64  # asking rows whose look-ups fit in a core's cache
SLACK = 1e-6  # of float32 and rounding, on distances of unit vectors
SEED = 17


def unit_rows(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Unit vectors in double precision, shorter ones filled up with zeros
    (which changes no cosine)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(size), dim))
    out[np.arange(dim) < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    # Scaled first, so that no square overflows or vanishes.
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt((out**2).sum(axis=1, keepdims=True))


def squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centers."""
    out = (x**2).sum(axis=1)[:, None] + (centers**2).sum(axis=1) - 2 * (x @ centers.T)
    return np.maximum(out, 0)


def nearest_center(x: np.ndarray, centers: np.ndarray, cells: int = 1 << 22) -> np.ndarray:
    step = max(1, cells // len(centers))
    return np.concatenate([squares(x[at : at + step], centers).argmin(axis=1) for at in range(0, max(len(x), 1), step)])


def k_means(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centers = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        of = nearest_center(x, centers)
        order = np.argsort(of, kind="stable")
        n = np.bincount(of, minlength=len(centers))
        starts = np.concatenate([[0], np.cumsum(n)[:-1]])
        full = n > 0
        centers[full] = np.add.reduceat(x[order], starts[full], axis=0) / n[full, None]
    return centers


def fit_index(sample: np.ndarray, lists: int, link: float) -> dict:
    """Coarse centroids and residual codebooks of unit vectors, as plain
    values (for ``Index``)."""
    rng = np.random.default_rng(SEED)
    dim = sample.shape[1]
    centers = k_means(sample, lists, rng)
    residual = sample - centers[nearest_center(sample, centers)]
    cuts = np.linspace(0, dim, min(SUBSPACES, dim) + 1).astype(int).tolist()
    pieces = [slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]
    spread = np.linalg.eigvalsh(np.cov(sample.T).reshape(dim, dim)) if len(sample) > 1 else np.zeros(1)
    effective = spread.sum() ** 2 / max((spread**2).sum(), 1e-30)
    radius = math.sqrt(max(0.0, 2 - 2 * link))
    margin = radius * min(1.0, MARGIN / math.sqrt(max(effective, 1.0)))
    books = [k_means(residual[:, p], CODES, rng) for p in pieces]
    return {"centers": centers, "pieces": pieces, "books": books, "radius": radius, "margin": margin}


class Index:
    def __init__(self, fitted: dict):
        self.__dict__.update(fitted)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """List, code (a byte for each piece), ``err`` and the rows' mask of
        lists that they ask."""
        d2 = squares(x, self.centers)
        of = d2.argmin(axis=1)
        residual = x - self.centers[of]
        code = np.column_stack([squares(residual[:, p], b).argmin(axis=1) for p, b in zip(self.pieces, self.books, strict=True)])
        left = [residual[:, p] - b[code[:, i]] for i, (p, b) in enumerate(zip(self.pieces, self.books, strict=True))]
        err = np.sqrt((np.concatenate(left, axis=1) ** 2).sum(axis=1))
        rows = np.arange(len(x))
        apart = np.sqrt(squares(self.centers[of], self.centers))
        beyond = d2 - d2[rows, of][:, None] <= 2 * apart * self.margin + SLACK
        # Of two lists the lower asks if their sum is even, else the higher.
        every = np.arange(len(self.centers))
        asks = (of[:, None] < every) == ((of[:, None] + every) % 2 == 0)
        return of, code.astype(np.uint8), err, beyond & asks | (every == of[:, None])

    def distances(self, x: np.ndarray, center: int, codes: np.ndarray):
        """Squared distances of codes of a list to rows of ``x``, for
        ``TOGETHER`` rows at a time: table look-ups, summed."""
        residual = x - self.centers[center]
        tables = [squares(book, residual[:, p]).astype(np.float32) for p, book in zip(self.pieces, self.books, strict=True)]
        columns = [np.ascontiguousarray(c) for c in codes.T]
        for at in range(0, len(x), TOGETHER):
            total = np.zeros((len(codes), len(x[at : at + TOGETHER])), np.float32)
            taken = np.empty_like(total)
            for table, column in zip(tables, columns, strict=True):
                total += np.take(np.ascontiguousarray(table[:, at : at + TOGETHER]), column, axis=0, out=taken, mode="clip")
            yield at, total


def least_labels(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least id reachable from each row and column of ``linked``."""
    none = np.iinfo(np.int64).max
    a, b = rows.copy(), columns.copy()
    while True:
        near = np.where(linked, b, none).min(axis=1, initial=none)
        a2 = np.minimum(a, near)
        b2 = np.minimum(b, np.where(linked, a2[:, None], none).min(axis=0, initial=none))
        if (a2 == a).all() and (b2 == b).all():
            return a, b
        a, b = a2, b2


def cell_links(index: Index, link: float, center: int, x: dict, y: dict, own: np.ndarray) -> np.ndarray:
    """Mask of links of asking rows ``x`` with a block's rows ``y``."""
    codes, of = np.unique(np.column_stack([y["code"], y["dim"]]), axis=0, return_inverse=True)
    of = of.ravel()
    err = np.zeros(len(codes))
    np.maximum.at(err, of, y["err"])
    # Beyond ``far`` no row of a code is a link, below ``sure`` each is.
    far = ((index.radius + SLACK + err) ** 2).astype(np.float32)[:, None]
    sure = (np.maximum(index.radius - SLACK - err, 0) ** 2).astype(np.float32)[:, None]
    linked = np.zeros((len(x["id"]), len(y["id"])), bool)
    for at, d2 in index.distances(x["unit"], center, codes[:, :-1]):
        open_ = d2 <= far
        if not open_.any():
            continue
        part = slice(at, at + d2.shape[1])
        open_ &= codes[:, -1:] == x["dim"][part]
        certain = open_ & (d2 < sure)
        open_ &= ~certain
        out = certain[of]
        r, c = np.flatnonzero(open_.any(axis=1)[of]), np.flatnonzero(open_.any(axis=0))
        if len(r) and len(c):
            near = y["unit"][r] @ x["unit"][part][c].T >= link
            out[np.ix_(r, c)] |= near & open_[np.ix_(of[r], c)]
        linked[part] = out.T
    linked &= ~(own[:, None] & (x["id"][:, None] == y["id"]))
    return linked


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", link: float = LINK, block: int = BLOCK, list_rows: int = LIST_ROWS) -> DataFrame:
    """Per vector ``vec_id`` (the id column's name), ``n_links`` (other
    vectors linked directly), ``component_id`` (the least id reachable) and
    ``kept`` (the id is its component's).

    Vectors that are null, empty, zero, or hold a null or non-finite
    component link with nothing.  Vectors of different lengths aren't
    compared.  Rows of one id are one vector, the smallest usable one.
    Rows without an id come out as one row with no link, a null component,
    and kept.  An empty table gives an empty one; other columns are not
    read."""
    spark = df.sparkSession
    kind = df.schema[vector_col].dataType.simpleString()
    vector = F.col(f"`{vector_col}`").cast(kind if kind == "array<float>" else "array<double>")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("v"))
    rows = rows.select("id", F.when(usable("v") & F.col("id").isNotNull(), F.col("v")).alias("v")).groupBy("id").agg(F.min("v").alias("v"))
    rows = staged(rows, "vectors")

    reps = staged(rows.where("v is not null").groupBy("v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("m")), "distinct-vectors")
    n, dim = reps.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not n:
        return _result(rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")), id_col)
    lists = max(1, min(LISTS, math.ceil(n / list_rows), INDEX_BYTES // (8 * dim)))
    few = min(SAMPLE, max(64 * lists, 4 * CODES), max(lists, INDEX_BYTES // (8 * dim)))
    sample = reps.select("v").orderBy(F.xxhash64("v"), "v").limit(few).toArrow()
    model = spark.sparkContext.broadcast(fit_index(unit_rows(sample.column(0), dim), lists, link))

    def encode(batches):
        index = Index(model.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            of, code, err, asked = index.encode(unit_rows(batch.column("v"), dim))
            ends = np.concatenate([[0], np.cumsum(asked.sum(axis=1))]).astype(np.int32)
            probes = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.nonzero(asked)[1].astype(np.int32)))
            codes = pa.array([c.tobytes() for c in code], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("m"), batch.column("v"), pa.array(of.astype(np.int32)), codes, pa.array(err), probes],
                names=["rep", "m", "v", "list", "code", "err", "probes"],
            )

    vector_type = reps.schema["v"].dataType.simpleString()
    fields = f"rep BIGINT, m BIGINT, v {vector_type}, list INT, code BINARY, err DOUBLE, probes ARRAY<INT>"
    coded = staged(reps.select("rep", "m", "v").mapInArrow(encode, fields), "codes")

    # A list's blocks of rows and chunks of questions, by its counts (a row
    # for each list, at most LISTS, so small enough to broadcast).
    asked = coded.select("rep", "m", "v", F.col("list").alias("home"), F.explode("probes").alias("list"))
    held = coded.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    came = coded.select(F.explode("probes").alias("list")).groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("chunks"))
    cuts = F.broadcast(staged(held.join(came, "list"), "list-sizes"))
    part = lambda count, salt: F.pmod(F.xxhash64(F.lit(salt), "rep"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    stored = coded.join(cuts, "list").select("list", part("blocks", 1).alias("block"), every("chunks").alias("chunk"), "rep", "m", "v", "code", "err")
    asking = asked.join(cuts, "list").select("list", every("blocks").alias("block"), part("chunks", 2).alias("chunk"), "rep", "m", "v", "home")
    asking = asking.toDF(*asking.columns)  # columns of its own, not those of ``stored``

    def cell(key, left: pa.Table, right: pa.Table) -> pa.Table:
        index, center = Index(model.value), key[0].as_py()
        own = left.column("home").to_numpy() == center if left.num_rows else np.zeros(0, bool)
        out = [np.zeros((3, 0), np.int64)]
        if left.num_rows and right.num_rows:
            x, y = ({"id": t.column("rep").to_numpy(), "m": t.column("m").to_numpy(), "unit": unit_rows(t.column("v"), dim), "dim": np.array(t.column("v").combine_chunks().value_lengths())} for t in (left, right))
            y["code"] = np.frombuffer(b"".join(right.column("code").to_pylist()), np.uint8).reshape(right.num_rows, -1).astype(np.int64)
            y["err"] = right.column("err").to_numpy()
            linked = cell_links(index, link, center, x, y, own)
            r, c = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
            linked, own = linked[np.ix_(r, c)], own[r]
            x_id, y_id = x["id"][r], y["id"][c]
            # In its own list a row is asked and asks: each side counts once.
            count = np.concatenate([linked @ y["m"][c], (linked & ~own[:, None]).T @ x["m"][r]])
            ids = np.concatenate([x_id, y_id])
            least = np.concatenate(least_labels(linked, x_id, y_id))
            out.append(np.vstack([ids, np.full(len(ids), -1), count])[:, count > 0])
            out.append(np.unique(np.vstack([ids, least, np.zeros(len(ids), np.int64)])[:, ids != least], axis=1))
        a, b, n_ = np.concatenate(out, axis=1).astype(np.int64)
        edge = n_ == 0
        return pa.table({"a": pa.array(a), "b": pa.array(b, mask=~edge), "n": pa.array(n_)})

    keys = ["list", "block", "chunk"]
    found = staged(asking.groupBy(*keys).cogroup(stored.groupBy(*keys)).applyInArrow(cell, "a BIGINT, b BIGINT, n BIGINT"), "cells")
    counts = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    reached = components(found.where("b is not null").select("a", "b"), "vector-links").withColumnRenamed("id", "rep")
    groups = reps.join(counts, "rep", "left").join(reached, "rep", "left")
    groups = groups.select("v", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
    plain = rows.where("v is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    full = rows.where("v is not null").join(groups, "v").select("id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    return _result(plain.unionByName(full), id_col)


def _result(found: DataFrame, id_col: str) -> DataFrame:
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")
    return found.select(F.col("id").alias(id_col), "n_links", "component_id", kept)
