"""Near duplicates by MinHash with odd sketches (operator 5).

Words are the runs of bytes other than ASCII white space, A-Z lower-cased;
a document's set holds its distinct five-word shingles (64-bit hashes; a
shorter text is one shingle of all its words; no word, no shingle).  Two
documents are linked if ``100 * |A and B| >= 75 * |A or B|``.

1. Documents of equal sets share a fingerprint; the smallest id of each
   stands for them from here on.
2. Each representative gets ``HASHES`` MinHash samples.  Bands of ``ROWS``
   samples are its keys; all samples are also folded into an odd sketch, a
   bitmap of ``SKETCH_BITS`` in which sample ``(i, value)`` flips one bit.
   The population count of the XOR of two sketches gives the size of the
   difference of the samples, so the similarity, with small error where it
   is high.  A link of 0.75 misses all bands with probability 5e-6, and
   the sketch bound with less.
3. First round: every document meets one document of each band bucket, the
   one that shares buckets most (of many copies of one text, that is the
   text, to which they are nearer than to each other).  Pairs whose sizes
   or sketches exclude a link are left out, and of the rest each document
   verifies its nearest and its most shared.  That joins most of every
   group, however large, with a number of pairs linear in the documents.
4. Second round: within buckets whose members are in several components,
   the members outside the bucket's largest component meet all others of
   another component, so no pair of the buckets is left unexamined that
   could still join two components.  That is an equi-join on the bucket
   whose condition is the bound of a longer odd sketch (``LARGE`` samples,
   made for these documents alone), which tells pairs just below 0.75 from
   links, and that the pair shares no earlier band; so it gives each pair
   that has to be confirmed once.
5. Links are confirmed on the full sets, made again from the texts of the
   documents that are in some pair.  A bitmap of fixed size over their ids
   picks those texts where they are read, so no text is shuffled.
6. Components are the smallest reachable id, by min-label propagation with
   shortcuts until nothing changes.

Nothing of the documents passes the driver; each round is written to the
shared folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmentflow.llm.common import append_columns, bounded_batches, staged

WORDS = 5
LINK = 75  # hundredths
HASHES = 256
ROWS = 4
BANDS = 32  # of the first ROWS * BANDS samples
SKETCH_BITS = 1024
SKETCH_WORDS = SKETCH_BITS // 64
# Estimates below this can't be links: nearly five standard errors of the
# samples and the sketch under 0.75.
LEAST_ESTIMATE = 0.6
# Samples, bits and least estimate (4.6 standard errors under 0.75) of the
# second round's longer sketch.
LARGE = 4096
LARGE_BITS = 4096
LARGE_LEAST = 0.695


def most_bits(samples: int, bits: int, least: float) -> int:
    """XOR bits of two sketches at the similarity ``least``."""
    return int(np.ceil(bits / 2 * (1 - np.exp(-4 * samples * (1 - least) / bits))))


MOST_BITS = most_bits(HASHES, SKETCH_BITS, LEAST_ESTIMATE)
LARGE_MOST = most_bits(LARGE, LARGE_BITS, LARGE_LEAST)
SEED = 20240229
CELLS = 1 << 18  # of a chunk of shingles by samples
PICK_BITS = 17  # 64-bit words of the bitmap of picked ids, as a power of 2
CACHE_WORDS = 100_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads them (splitmix steps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of whole texts."""

    def __init__(self, words: int = WORDS):
        import xxhash

        self.words, self.hash = words, xxhash.xxh3_64_intdigest
        self.cache: dict[bytes, int] = {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.cache) > CACHE_WORDS:
            self.cache = {}
        cache, digest = self.cache, self.hash
        cache.update((w, digest(w)) for w in set(words) if w not in cache)
        h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
        k = min(self.words, len(h))
        out = np.full(len(h) - k + 1, k, np.uint64)
        for i in range(k):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i])
        return np.unique(out)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """MinHash samples: the least of ``a * x + b`` (mod 2**64) by hash."""
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    step = max(1, CELLS // len(a))
    for at in range(0, len(shingles), step):
        np.minimum(least, (shingles[at : at + step, None] * a + b).min(axis=0), out=least)
    return least


def _hashes(n: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    a = rng.integers(0, 1 << 63, n, np.uint64) << np.uint64(1) | np.uint64(1)
    return a, rng.integers(0, 1 << 63, n, np.uint64)


def odd_sketch(samples: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity bitmaps (rows of 64-bit words) of rows of samples."""
    rows, n = samples.shape
    at = mix(samples + np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(bits)
    flips = np.bincount((at.astype(np.int64) + np.arange(rows)[:, None] * bits).ravel(), minlength=rows * bits)
    return np.packbits((flips & 1).astype(np.uint8).reshape(rows, -1), axis=1, bitorder="little").view("<i8")


def band_keys(samples: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(samples), BANDS), np.uint64)
    for r in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + samples[:, r : ROWS * BANDS : ROWS])
    return mix(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def estimate(bits: Column) -> Column:
    """Similarity from the XOR population count of two sketches."""
    left = F.greatest(F.lit(1 - 1e-9) - bits * (2.0 / SKETCH_BITS), F.lit(1e-9))
    return 1 + F.log(left) * (SKETCH_BITS / (4.0 * HASHES))


def signatures(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """``n_shingles``, ``fingerprint`` of the set, ``bands`` and ``sketch``."""
    fields = [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("fingerprint", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("sketch", T.ArrayType(T.LongType())),
    ]

    def factory():
        import xxhash

        shingler, (a, b) = Shingler(), _hashes()

        def apply(texts):
            sets = [shingler(t) for t in texts]
            samples = np.array([signature(s, a, b) for s in sets], np.uint64).reshape(-1, HASHES)
            marks = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            flat = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
            return [len(s) for s in sets], marks, flat(band_keys(samples)), flat(odd_sketch(samples).astype(np.int64))

        return apply

    return append_columns(df, text_col, fields, factory, keep, as_bytes=True)


def large_sketches(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """``n``, the set's size, and ``large``, the longer sketch."""

    def factory():
        shingler, (a, b) = Shingler(), _hashes(LARGE)

        def apply(texts):
            sets = [shingler(t) for t in texts]
            sketches = [odd_sketch(signature(s, a, b)[None], LARGE_BITS)[0].tolist() for s in sets]
            return [len(s) for s in sets], sketches

        return apply

    fields = [T.StructField("n", T.LongType()), T.StructField("large", T.ArrayType(T.LongType()))]
    return append_columns(df, text_col, fields, factory, keep, as_bytes=True)


def full_sets(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    def factory():
        shingler = Shingler()
        return lambda texts: [[shingler(t).tobytes() for t in texts]]

    return append_columns(df, text_col, [T.StructField("shingles", T.BinaryType())], factory, keep, as_bytes=True)


def _bits(a: str, b: str, words: int = SKETCH_WORDS) -> Column:
    return sum((F.bit_count(F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))) for i in range(words)), F.lit(0))


def _sizes(a: str, b: str) -> Column:
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    return F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * LINK


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(id, component)`` of every end of the edges ``(a, b)``: the least
    id reachable.  Each pass takes the least label over neighbours and then
    over the label's own label, so a path shortens by more than half."""
    both = staged(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), f"{name}-edges")
    labels = staged(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), f"{name}-labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        step = labels.join(near, "id").select("id", F.least("component", "near").alias("at"), F.col("component").alias("was"))
        up = labels.select(F.col("id").alias("at"), F.col("component").alias("up"))
        step = staged(step.join(up, "at").select("id", F.least("at", "up").alias("component"), "was"), f"{name}-labels")
        if step.where("component <> was").isEmpty():
            return step.select("id", "component")
        labels = step.select("id", "component")


def _word(c: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(c), 64 - PICK_BITS).cast("int")


def _bit(c: str) -> Column:
    return F.xxhash64(c).bitwiseAND(F.lit(63)).cast("int")


def bitmap(ids: DataFrame) -> DataFrame:
    """``__w`` and ``__m``, the words of a bitmap of the ids (the first
    column) with some bit set: ``1 << PICK_BITS`` 64-bit words at most, 2 MB
    at any size of ``ids``, to be broadcast."""
    one = ids.select(F.col(ids.columns[0]).alias("i")).select(_word("i").alias("__w"), F.expr("shiftleft(1L, cast(xxhash64(i) & 63 as int))").alias("__m"))
    return F.broadcast(one.groupBy("__w").agg(F.bit_or("__m").alias("__m")))


def picked(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose id may be among ``ids``, by their bitmap
    (the more ids, the more other rows pass).  Repeats don't matter, and
    nothing of ``df`` is shuffled."""
    marked = df.join(bitmap(ids), _word(id_col) == F.col("__w"))
    return marked.where(F.getbit("__m", _bit(id_col)) == 1).select(*df.columns)


def without(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose id is not among ``ids`` (a small table that
    is read twice).  Rows that the bitmap of the ids clears stay where they
    are; only the others, those of the ids and the few that share a bit with
    one, are shuffled with their texts to be compared."""
    may = F.coalesce(F.getbit("__m", _bit(id_col)), F.lit(0)) == 1
    marked = df.join(bitmap(ids), _word(id_col) == F.col("__w"), "left")
    other = ids.select(F.col(ids.columns[0]).alias("__other"))
    # ``may`` again in the condition: without a column of the bitmap in it
    # Spark moves this join below that with the bitmap, to all rows.
    rest = marked.where(may).join(other, (F.col(id_col) == F.col("__other")) & may, "left_anti")
    return marked.where(~may).select(*df.columns).union(rest.select(*df.columns))


def confirmed(pairs: DataFrame, documents: DataFrame, text_col: str, repeated: bool) -> DataFrame:
    """The pairs ``(a, b)`` that are links by their full sets; with
    ``repeated`` ids, by some set of each."""
    sets = full_sets(picked(documents, "rep", pairs.select("a").union(pairs.select("b"))), text_col, ["rep"])
    sets = staged(sets.dropDuplicates() if repeated else sets, "sets")

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                # Both are sorted and distinct: equal neighbours are shared.
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= LINK * (len(both) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    bounded_batches(pairs.sparkSession)
    joined = pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x")), "a")
    joined = joined.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y")), "b")
    links = joined.select("a", "b", "x", "y").mapInArrow(run, "a BIGINT, b BIGINT")
    return links.distinct() if repeated else links


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``doc_id`` (the id column's name), ``n_shingles``,
    ``component_id`` and ``kept``.

    Null, empty and blank texts have no shingle, link with nothing and stay
    their own component.  Rows of one id are one document: repeated rows
    count once, and the links of all texts of an id are that id's links.
    Null ids are left out of groups: their component is null, and they are
    kept.  An empty table gives an empty one.  Other columns are not read."""
    documents = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    signed = staged(signatures(documents, "text", ["id"]), "signatures")

    # 1. One representative for each distinct set.
    groups = signed.where("fingerprint is not null and id is not null").groupBy("fingerprint").agg(F.min("id").alias("rep"))
    groups = staged(groups, "groups")
    reps = signed.where("id is not null").join(groups, (F.col("id") == F.col("rep")) & (signed.fingerprint == groups.fingerprint))
    reps = reps.select("rep", F.col("n_shingles").alias("n"), F.col("bands"), *[F.col("sketch")[i].alias(f"s{i}") for i in range(SKETCH_WORDS)])
    repeated = not signed.where("id is not null").groupBy("id").count().where("count > 1").isEmpty()
    if repeated:
        reps = reps.dropDuplicates()
    sketch = ["rep", "n", *[f"s{i}" for i in range(SKETCH_WORDS)]]

    # 2. Buckets of several members; ``lead`` is the member that shares
    # buckets with most others (the smallest id on ties).
    keyed = reps.select("rep", F.explode("bands").alias("band"))
    size = keyed.groupBy("band").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = staged(keyed.join(size, "band"), "shared")
    degree = staged(shared.groupBy("rep").agg(F.sum("members").alias("degree")), "degree")
    lead = shared.join(degree, "rep").groupBy("band").agg(F.max(F.struct("degree", (-F.col("rep")).alias("rep"))).alias("m"))
    buckets = staged(shared.join(lead.select("band", (-F.col("m.rep")).alias("lead")), "band").select("band", "rep", "lead"), "buckets")
    few = staged(reps.select(*sketch).join(degree, "rep"), "sketches")
    texts = documents.where("id is not null").select(F.col("id").alias("rep"), "text")

    # 3. First round: a document and its buckets' leads, the nearest ones.
    met = buckets.where("rep <> lead").select("rep", "lead").distinct()
    met = met.join(few.alias("l").withColumnRenamed("rep", "lead"), "lead").alias("l").join(few.alias("r"), F.col("l.rep") == F.col("r.rep"))
    met = met.where(_sizes("l", "r") & (_bits("l", "r") <= MOST_BITS)).select(F.col("r.rep").alias("a"), F.col("l.lead").alias("b"), _bits("l", "r").alias("bits"), F.col("l.degree").alias("degree"))
    best = met.groupBy("a").agg(F.min(F.struct("bits", "b")).alias("near"), F.max(F.struct("degree", "b")).alias("hub"))
    best = best.select("a", F.explode(F.array("near.b", "hub.b")).alias("b")).distinct()
    links = confirmed(staged(best, "nearest"), texts, "text", repeated)
    if repeated:
        # An id that stands for one set and has another set too.
        other = signed.join(groups, "fingerprint").where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
        links = links.union(other.join(groups.select(F.col("rep").alias("a")), "a", "left_semi").distinct())
    links = staged(links, "links")
    found = components(links, "first")

    # 4. Second round: pairs of buckets that span components.
    placed = buckets.select("band", "rep").join(found.select(F.col("id").alias("rep"), "component"), "rep", "left")
    placed = staged(placed.select("band", "rep", F.coalesce("component", "rep").alias("c")), "placed")
    parts = placed.groupBy("band", "c").agg(F.count(F.lit(1)).alias("k"))
    open_bands = parts.groupBy("band").agg(F.max(F.struct("k", "c")).alias("top"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    spanning = staged(placed.join(open_bands.select("band", F.col("top.c").alias("largest")), "band"), "spanning")
    longer = large_sketches(picked(texts, "rep", spanning.select("rep")), "text", ["rep"])
    longer = longer.select("rep", "n", *[F.col("large")[i].alias(f"s{i}") for i in range(LARGE_BITS // 64)])
    longer = staged(longer.dropDuplicates() if repeated else longer, "longer")
    # The bands of a document, to see which of them a pair shares first.
    own = spanning.groupBy("rep").agg(F.collect_set("band").alias("bands"))
    open_rows = staged(spanning.join(longer, "rep").join(own, "rep"), "open")
    minor = open_rows.where("c <> largest")
    # Of two minor members the one of smaller id asks.
    apart = (F.col("x.band") == F.col("y.band")) & (F.col("x.c") != F.col("y.c"))
    once = (F.col("y.c") == F.col("y.largest")) | (F.col("x.rep") < F.col("y.rep"))
    near = _sizes("x", "y") & (_bits("x", "y", LARGE_BITS // 64) <= LARGE_MOST)
    first = F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.band")
    pairs = minor.alias("x").join(open_rows.alias("y"), apart & once & near & first)
    pairs = staged(pairs.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct(), "pairs")
    more = confirmed(pairs, texts, "text", repeated)
    final = components(links.union(more), "second")

    # 5. Every document through its representative.
    of_rep = groups.join(final.withColumnRenamed("id", "rep"), "rep", "left")
    of_rep = of_rep.select("fingerprint", F.coalesce("component", "rep").alias("component_id"))
    out = signed.select("id", "n_shingles", "fingerprint").join(of_rep, "fingerprint", "left")
    component = F.coalesce("component_id", "id")
    if repeated:
        # All rows of an id are in one component: the least of theirs.
        least = final.select(F.col("id").alias("own"), F.col("component").alias("own_component"))
        out = out.join(least, F.col("id") == F.col("own"), "left").withColumn("component_id", F.coalesce("own_component", "component_id"))
        component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.when(F.col("id").isNotNull(), component).alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
