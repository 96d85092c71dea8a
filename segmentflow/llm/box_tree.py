"""Hard negatives from an STR-packed R-tree (operator 13).

Components are scaled to integers, so inner products are exact.  A row's
score for an anchor is their inner product; higher scores come first, ties
by the smaller id.  An anchor's positives are its first rows of its own
label; the hard negatives of a positive are the first rows of other labels
whose score lies in a window set by the positive's score.

Packing (sort-tile-recursive): rows are cut into slabs of equal size by one
coordinate, each slab by the next coordinate, and so on, at approximate
quantiles that Spark computes within each slab.  The tiles so made hold
about ``TILE`` rows; what ties leave larger is dealt to several tiles by a
hash of the id.  In its task a tile is packed further, by the label and two
coordinates, into leaves of ``LEAF`` rows below nodes of ``FANOUT``.

A box holds the least and greatest value of each coordinate and of the
label.  Each coordinate of an anchor then has an interval of products, and
their sums are the least and greatest score in the box.  A search takes the
boxes from a queue, that of the greatest possible score within its windows
first, and leaves out boxes with no score in a window, without a fitting
label, or strictly below the kth row already found.

Positives and negatives are two searches of two passes each: an anchor
first searches the tile it lies in, which gives it a kth score to begin
with, and then all tiles whose boxes can hold something better.  Anchors and
the tiles' boxes meet in blocks (a stated query set against an index); only
the anchors that a tile can't refuse are sent to it, dealt to chunks.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segmentflow.llm.common import staged

TILE = 2048
TILES = 1 << 16  # at most so many cuts are broadcast
LEVELS = 2
LEAF = 128
FANOUT = 8
ANCHORS = 2048  # of a chunk
BOXES = 1024  # of a block of the tiles' boxes
EXACT = 1 << 53  # integers that doubles hold
REQUEST = "anchor BIGINT, label BIGINT, v ARRAY<BIGINT>, windows ARRAY<STRUCT<w: BIGINT, low: BIGINT, high: BIGINT, kth: BIGINT>>"


def matrix(column, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def exactly(*parts: np.ndarray) -> list[np.ndarray]:
    """Integers as doubles, where those hold every sum of products."""
    top = max((int(np.abs(p).max()) for p in parts if p.size), default=0)
    if top * top * max(p.shape[-1] for p in parts) >= EXACT:
        return list(parts)
    return [p.astype(np.float64) for p in parts]


def score_bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each ``q`` with each box."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def packed(rows: np.ndarray, keys: list[np.ndarray], size: int) -> list[np.ndarray]:
    """Row numbers in groups of about ``size``: sort by a key, cut into
    slabs, and go on with the next key in each."""
    if len(rows) <= size or not keys:
        return [rows[i : i + size] for i in range(0, len(rows), size)]
    rows = rows[np.argsort(keys[0][rows], kind="stable")]
    slabs = math.ceil(math.ceil(len(rows) / size) ** (1 / len(keys)))
    return [g for s in np.array_split(rows, slabs) if len(s) for g in packed(s, keys[1:], size)]


class BoxTree:
    """An R-tree over one tile; ``search`` is its best-first queue."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray):
        spread = np.argsort(-(v.max(axis=0) - v.min(axis=0)), kind="stable") if len(v) else np.zeros(0, int)
        groups = packed(np.arange(len(ids)), [labels, *[v[:, c] for c in spread[:2]]], LEAF)
        order = np.concatenate(groups)
        # Rows of a leaf in the order of their ids, so ties come right.
        order = order[np.lexsort((ids[order], np.repeat(np.arange(len(groups)), [len(g) for g in groups])))]
        self.ids, self.labels, self.v = ids[order], labels[order], v[order]
        cuts = np.concatenate([[0], np.cumsum([len(g) for g in groups])])
        self.levels = []  # from the leaves up: (cuts, low, high, label low, label high, least id)
        low, high, l_low, l_high, least = self.v, self.v, self.labels, self.labels, self.ids
        while True:
            at = cuts[:-1]
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            l_low, l_high, least = np.minimum.reduceat(l_low, at), np.maximum.reduceat(l_high, at), np.minimum.reduceat(least, at)
            self.levels.append((cuts, low, high, l_low, l_high, least))
            if len(at) == 1:
                break
            cuts = np.append(np.arange(0, len(at), FANOUT), len(at))

    def search(self, anchor: int, label: int, q: np.ndarray, windows: list[dict], same: bool, k: int) -> list[list[tuple[int, int]]]:
        """For each window (``low`` to ``high``, ``kth`` a score that k rows
        are known to reach, or None) its first rows ``(-score, id)``."""
        best = [[] for _ in windows]
        floor = [w["low"] if w["kth"] is None else max(w["low"], w["kth"]) for w in windows]
        top = max(w["high"] for w in windows)

        def wanted(least: int, greatest: int, first_id: int) -> int | None:
            """The greatest score a box can add to a window that needs it."""
            key = None
            for i, w in enumerate(windows):
                reach = min(greatest, w["high"])
                if least <= w["high"] and reach >= floor[i]:
                    # A full window at that very score needs a smaller id.
                    if len(best[i]) < k or (-reach, first_id) < best[i][-1]:
                        key = reach if key is None else max(key, reach)
            return key

        queue: list = []

        def push(level: int, a: int, b: int) -> None:
            _, low, high, l_low, l_high, least_id = self.levels[level]
            down, up = score_bounds(q[None], low[a:b], high[a:b])
            fits = (l_low[a:b] <= label) & (label <= l_high[a:b]) if same else ~((l_low[a:b] == label) & (l_high[a:b] == label))
            for i in np.flatnonzero(fits).tolist():
                bounds = int(down[0, i]), int(up[0, i]), int(least_id[a + i])
                if (key := wanted(*bounds)) is not None:
                    heapq.heappush(queue, (-key, bounds[2], level, a + i, bounds))

        push(len(self.levels) - 1, 0, 1)
        while queue:
            _, _, level, node, bounds = heapq.heappop(queue)
            if wanted(*bounds) is None:
                continue
            a, b = self.levels[level][0][node : node + 2]
            if level:
                push(level - 1, a, b)
                continue
            score = self.v[a:b] @ q
            hit = np.flatnonzero((score >= min(floor)) & (score <= top))
            rows = [(-int(score[r]), int(self.ids[a + r])) for r in hit if (self.labels[a + r] == label) == same and self.ids[a + r] != anchor]
            for i, w in enumerate(windows):
                found = [r for r in rows if floor[i] <= -r[0] <= w["high"]]
                if found:
                    best[i] = heapq.nsmallest(k, best[i] + found)
                    if len(best[i]) == k:
                        floor[i] = max(floor[i], -best[i][-1][0])
        return best


def tiled(rows: DataFrame, dim: int, tile: int) -> DataFrame:
    """``rows`` with ``tile``, a number that stands for the slabs' path."""
    n = rows.count()
    slabs = max(1, math.ceil(min(TILES, math.ceil(n / tile)) ** (1 / LEVELS)))
    out = rows.withColumn("path", F.lit(0).cast("long"))
    for level in range(min(LEVELS, dim)):
        value = F.col("v")[level]
        if slabs > 1:
            # A row of cuts for each slab of the level above: all levels
            # together hold fewer than TILES + slabs numbers.
            points = [i / slabs for i in range(1, slabs)]
            cuts = out.groupBy("path").agg(F.percentile_approx(value, points, 1000).alias("cuts"))
            above = F.size(F.filter("cuts", lambda c: c < value))
            out = out.join(F.broadcast(cuts), "path").withColumn("path", F.col("path") * slabs + above).drop("cuts")
    out = staged(out, "slabs")
    sizes = out.groupBy("path").agg(F.ceil(F.count(F.lit(1)) / (2 * tile)).cast("int").alias("parts"))
    # A row for each slab, so bounded like the cuts.
    out = out.join(F.broadcast(sizes), "path")
    out = out.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    return staged(out.select("path", "part", "id", "label", "v", "asks"), "tiles")


def tile_boxes(tiles: DataFrame, dim: int) -> DataFrame:
    low = F.array(*[F.min(F.col("v")[i]) for i in range(dim)]).alias("low")
    high = F.array(*[F.max(F.col("v")[i]) for i in range(dim)]).alias("high")
    labels = [F.min("label").alias("l_low"), F.max("label").alias("l_high")]
    return staged(tiles.groupBy("path", "part").agg(low, high, *labels), "boxes")


def searched(tiles: DataFrame, visits: DataFrame, dim: int, same: bool, k: int, chunks: int) -> DataFrame:
    """``anchor``, ``w``, ``id``, ``score``: the first ``k`` of each tile
    that is visited, for each window."""
    chunk = F.pmod(F.xxhash64(F.lit(1), "anchor"), F.lit(chunks)).cast("int").alias("chunk")
    asked = visits.select("path", "part", chunk, "anchor", F.col("label").alias("own"), F.col("v").alias("q"), "windows")
    # Only the chunks in which a tile is asked get a copy of it.
    wanted = asked.select("path", "part", "chunk").distinct()
    stored = tiles.join(wanted, ["path", "part"]).select("path", "part", "chunk", "id", "label", "v")
    stored = stored.toDF(*stored.columns)

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [], [])
        if left.num_rows and right.num_rows:
            v, q = exactly(matrix(right.column("v"), dim), matrix(left.column("q"), dim))
            tree = BoxTree(right.column("id").to_numpy(), right.column("label").to_numpy(), v)
            asks = zip(left.column("anchor").to_pylist(), left.column("own").to_pylist(), q, left.column("windows").to_pylist(), strict=True)
            for anchor, label, vector, windows in asks:
                for w, best in zip(windows, tree.search(anchor, label, vector, windows, same, k), strict=True):
                    for minus, row in best:
                        for column, value in zip(out, (anchor, w["w"], row, -minus), strict=True):
                            column.append(value)
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["anchor", "w", "id", "score"])

    keys = ["path", "part", "chunk"]
    return asked.groupBy(*keys).cogroup(stored.groupBy(*keys)).applyInArrow(cell, "anchor BIGINT, w BIGINT, id BIGINT, score BIGINT")


def promising(requests: DataFrame, boxes: DataFrame, dim: int, same: bool, chunks: int) -> DataFrame:
    """Requests with each tile (other than their own) that can hold a row
    one of their windows needs."""
    n = boxes.count()
    blocks = max(1, math.ceil(n / BOXES))
    block = F.pmod(F.xxhash64("path", "part"), F.lit(blocks)).cast("int").alias("block")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    chunk = F.pmod(F.xxhash64(F.lit(1), "anchor"), F.lit(chunks)).cast("int").alias("chunk")
    asked = requests.select(every(blocks).alias("block"), chunk, "anchor", "label", "v", "windows", F.col("path").alias("own_path"), F.col("part").alias("own_part"))
    held = boxes.select(block, every(chunks).alias("chunk"), "path", "part", "low", "high", "l_low", "l_high")

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        take = of = np.zeros(0, np.int64)
        if left.num_rows and right.num_rows:
            q, low, high = exactly(matrix(left.column("v"), dim), matrix(right.column("low"), dim), matrix(right.column("high"), dim))
            down, up = score_bounds(q, low, high)
            label = left.column("label").to_numpy()[:, None]
            l_low, l_high = right.column("l_low").to_numpy(), right.column("l_high").to_numpy()
            fits = (l_low <= label) & (label <= l_high) if same else ~((l_low == label) & (l_high == label))
            fits &= ~((left.column("own_path").to_numpy()[:, None] == right.column("path").to_numpy()) & (left.column("own_part").to_numpy()[:, None] == right.column("part").to_numpy()))
            some = np.zeros_like(fits)
            for i, windows in enumerate(left.column("windows").to_pylist()):
                for w in windows:
                    floor = w["low"] if w["kth"] is None else max(w["low"], w["kth"])
                    some[i] |= (down[i] <= w["high"]) & (up[i] >= floor)
            take, of = np.nonzero(fits & some)
        columns = [right.column(c).take(pa.array(of)) for c in ("path", "part")] + [left.column(c).take(pa.array(take)) for c in ("anchor", "label", "v", "windows")]
        return pa.table(columns, names=["path", "part", "anchor", "label", "v", "windows"])

    keys = ["block", "chunk"]
    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(cell, f"path BIGINT, part INT, {REQUEST}")


def first(tiles: DataFrame, boxes: DataFrame, requests: DataFrame, dim: int, same: bool, k: int, chunks: int) -> DataFrame:
    """The first ``k`` of each window over all tiles, ``rank`` from 1."""
    own = staged(searched(tiles, requests, dim, same, k, chunks), "own-tile")
    kth = own.groupBy("anchor", "w").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).where(F.col("n") >= k)
    known = kth.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("w", "s"))).alias("kth"))
    windows = F.transform("windows", lambda w: F.struct(w["w"].alias("w"), w["low"].alias("low"), w["high"].alias("high"), F.try_element_at("kth", w["w"]).alias("kth")))
    seeded = requests.join(known, "anchor", "left").withColumn("windows", windows).drop("kth")
    seeded = staged(seeded, "seeded")
    visits = staged(promising(seeded, boxes, dim, same, chunks), "visits")
    both = own.union(searched(tiles, visits, dim, same, k, chunks))
    # At most k rows of each tile meet here.
    ranked = both.withColumn("rank", F.row_number().over(W.partitionBy("anchor", "w").orderBy(F.desc("score"), "id")))
    return staged(ranked.where(F.col("rank") <= k), "ranked")


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tile: int = TILE,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``,
    ``positive_score``, ``negative_score``.

    A negative's score is between ``least`` and ``most`` hundredths of the
    positive's.  ``label`` is the label's column or an expression (the
    column ``label`` if none); ``is_anchor`` is over the columns of ``df``.

    Rows with a null id or label, or a vector that is null, empty, or holds
    a null or non-finite component take no part.  Rows of one id are one
    row, that of the smallest label and vector.  Vectors of another length
    than the longest are filled up with zeros.  Components beyond
    2**24 after scaling are refused with an error, as their products may not
    fit a long.  An empty table gives an empty result."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    whole = F.size(v) > 0
    whole &= F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), (F.col("label") if label is None else label).cast("long").alias("label"), v.alias("v"), is_anchor.alias("asks"), whole.alias("whole"))
    rows = rows.where("id is not null and label is not null and whole")
    fits = lambda x: F.when(F.abs(x * scale) < (1 << 24), F.floor(x * scale)).otherwise(F.raise_error(F.lit("a component is out of range")).cast("long"))
    rows = rows.select("id", "label", F.transform("v", fits).alias("v"), "asks")
    rows = staged(rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"), F.max("asks").alias("asks")).select("id", "r.label", "r.v", "asks"), "rows")
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 1
    rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("v"))))
    tiles = tiled(rows, dim, tile)
    boxes = tile_boxes(tiles, dim)
    anchors = staged(tiles.where("asks").drop("asks").withColumnRenamed("id", "anchor"), "anchors")
    chunks = max(1, math.ceil(anchors.count() / ANCHORS))

    window = lambda w, low, high: F.struct(w.cast("long").alias("w"), low.cast("long").alias("low"), high.cast("long").alias("high"), F.lit(None).cast("long").alias("kth"))
    top = F.lit((1 << 62) - 1)
    requests = anchors.withColumn("windows", F.array(window(F.lit(0), -top, top)))
    near = first(tiles, boxes, requests, dim, True, positives, chunks)
    near = near.select("anchor", F.col("id").alias("w"), F.col("score").alias("positive_score"))

    # Integer bounds of least * p <= 100 * score <= most * p.
    p = F.col("positive_score")
    down = lambda x: F.expr(f"({x} - pmod({x}, 100)) div 100")
    low, high = -down(f"(-{least} * positive_score)"), down(f"({most} * positive_score)")
    open_ = near.select("anchor", window(F.col("w"), low, high).alias("window")).where("window.low <= window.high")
    lists = open_.groupBy("anchor").agg(F.collect_list("window").alias("windows"))  # at most ``positives`` each
    found = first(tiles, boxes, staged(anchors.join(lists, "anchor"), "windows"), dim, False, negatives, chunks)
    found = found.join(near, ["anchor", "w"])
    return found.select(F.col("anchor").alias("anchor_id"), F.col("w").alias("positive_id"), "rank", F.col("id").alias("negative_id"), p, F.col("score").alias("negative_score"))
