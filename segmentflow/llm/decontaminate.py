"""Benchmark decontamination by template canonicalisation (operator 10).

Words (runs of bytes other than ASCII white space, A-Z lower-cased, outer
punctuation dropped) become tokens: a number is ``<num>``, a unit after a
number ``<unit>``, and a run of capitalised words inside a sentence
``<name>``, so a question keeps its template when its numbers, units and
names are changed.  Every window of ``WINDOW`` tokens with at least
``LITERALS`` words that are no placeholder is hashed.  The windows of the
documents that a fixed-size bitmap of the benchmark's windows lets through
are hash-joined with the benchmark's windows in Spark (the bitmap only
saves the shuffle of windows that match nothing; its size is a parameter
and does not grow).

A document holds an item if windows along one alignment (document position
less item position) cover at least ``COVERAGE`` of the item's windows, and
the alignment's slots are consistent: a value of the item stands for one
value of the document wherever it occurs.  Alignments may drift by up to
``DRIFT`` tokens; of each item position the window nearest to the alignment
counts.  Every alignment that reaches the coverage is tested, with its
drifted windows and without them, and the best that passes is kept.  An item
too short for a window is one window of all its tokens, which matches a
document of the same template.

A template depends on the words around it (the word before a copy decides
whether its first word is a name, the next word may extend its last), and
some items have none: short ones, and those dense in numbers and names.  So
the items are looked for as they are, too, by windows of raw words (values
and names left in), ``WINDOW`` of them or all of a shorter item; documents
are hashed for just the lengths that the items have.  All of them have to be
found at one place, or ``COVERAGE`` of them if the item has no template
window: a verbatim copy of any item that has a word is found.

Hot windows: items may share a preamble that many documents hold, too, so
windows are not joined with all items that have them.  A document that has
``need`` of an item's windows has one of any set that leaves out fewer than
``need``: documents and items meet by the windows of each item that the
fewest items share (``rare_windows``), and only the pairs that met are
compared by all windows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segmentflow.llm.common import bounded_batches, staged, text_slices, worker_kept
from segmentflow.llm.near_dup import mix

WINDOW = 8
LITERALS = 5
COVERAGE = 0.5
DRIFT = 3
BITMAP_BITS = 23
CACHE_WORDS = 600_000
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64

# Units of measure and currency.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds oz "
    "ml l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month "
    "months year years usd eur gbp dollar dollars euro euros cent cents percent % $ mph kmh km/h hz khz mhz w kw v a j n pa bar "
    "degrees °c °f".split()
)
RAW = 100  # keeps the hashes of raw windows apart from the templates'
UNIT_BYTES = frozenset(u.encode() for u in UNITS)
NUM, UNIT, NAME = b"<num>", b"<unit>", b"<name>"
NUMBER = re.compile(rb"[+-]?[$\xc2\xa3]*[0-9]+(?:[.,:/][0-9]+)*%?")
EDGE = b".,;:!?\"'()[]{}"
CLOSING = b"\"')]}"
SENTENCE_END = (b".", b"!", b"?", b":")


def _token(word: bytes) -> tuple[int, bytes, bool, bool]:
    """Kind (0 word, 1 number, 2 capitalised, 3 unit), the bare lower-case
    word, whether it ends a sentence, whether it is empty when bare."""
    bare = word.strip(EDGE)
    ends = word.rstrip(CLOSING).endswith(SENTENCE_END)
    text = bare.decode("utf-8", "ignore")
    low = text.lower()
    if bare and NUMBER.fullmatch(bare):
        kind = 1
    elif low in UNITS:
        kind = 3
    else:
        kind = 2 if text[:1].isupper() and not text.isupper() else 0
    return kind, low.encode(), ends, not bare


class Templates:
    """Canonical tokens of many whole texts at once: arrays over all their
    tokens, with ``doc`` the text of each."""

    def __init__(self):
        import xxhash

        self.hash = xxhash.xxh3_64_intdigest
        self.index: dict[bytes, int] = {}
        self.fixed = [np.uint64(self.hash(p)) for p in (NUM, NAME, UNIT)]

    def _learn(self, new: list[bytes]) -> None:
        at, hashes, flags, digest = len(self.index), [], [], self.hash
        for w in new:
            bare = w.strip(EDGE)
            if bare.isalpha() or bare.isdigit():  # ASCII alone
                low = bare.lower()
                kind = 1 if bare.isdigit() else 3 if low in UNIT_BYTES else 2 if bare[:1].isupper() and not bare.isupper() else 0
                ends = len(bare) < len(w) and w.rstrip(CLOSING).endswith(SENTENCE_END)
                hashes.append(digest(low))
                flags.append(kind | ends << 2)
                continue
            kind, low, ends, blank = _token(w)
            hashes.append(digest(low))
            flags.append(kind | ends << 2 | blank << 3)
        self.hashes = np.concatenate([self.hashes[:at], np.array(hashes, np.uint64)]) if at else np.array(hashes, np.uint64)
        self.flags = np.concatenate([self.flags[:at], np.array(flags, np.uint8)]) if at else np.array(flags, np.uint8)
        self.index.update(zip(new, range(at, at + len(new)), strict=True))

    def __call__(self, texts: list[bytes | None] | pa.Array):
        """``value`` (hash), ``literal``, ``span`` (its words in ``words``),
        ``doc`` of every token, and ``words``."""
        return self.with_raw(texts)[0]

    def with_raw(self, texts: list[bytes | None] | pa.Array):
        """The tokens, and of every word that is not blank the hash, the
        text and the token it belongs to.  Words are cut and numbered by
        Arrow; only the different ones of a call reach Python."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary()).view(pa.string())
        split = pc.ascii_split_whitespace(pc.fill_null(column, ""))
        words = split.flatten()
        # White space at a text's ends leaves empty words.
        full = pc.greater(pc.binary_length(words), 0)
        owner = np.repeat(np.arange(len(split)), split.value_lengths().to_numpy())[full.to_numpy(zero_copy_only=False)]
        words = words.filter(full)
        coded = words.dictionary_encode()
        different = coded.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        words = words.view(pa.binary())
        if len(self.index) > CACHE_WORDS:
            self.index = {}
        self._learn([w for w in different if w not in self.index])
        n = len(words)
        at = np.fromiter(map(self.index.__getitem__, different), np.int64, len(different))[coded.indices.to_numpy()]
        value, flags = self.hashes[at], self.flags[at]
        kind, ends, blank = flags & 3, (flags & 4) > 0, (flags & 8) > 0
        same = np.zeros(n, bool)  # the word before is of the same text
        same[1:] = owner[1:] == owner[:-1]
        before = lambda x: np.concatenate([[False], x[:-1]]) & same
        first = ~same | before(ends)
        number = kind == 1
        unit = (kind == 3) & before(number)
        name = (kind == 2) & ~first
        # A run of capitalised words is one name; a bare mark is no token.
        follows = name & before(name & ~ends)
        value = np.where(number, self.fixed[0], np.where(name, self.fixed[1], np.where(unit, self.fixed[2], value)))
        keep = np.flatnonzero(~(follows | blank))
        limit = np.cumsum(np.bincount(owner, minlength=len(split)))[owner[keep]]
        stop = np.minimum(np.append(keep[1:], n), limit)
        tokens = value[keep], ~(number | name | unit)[keep], np.stack([keep, stop], 1), owner[keep], words
        bare = np.flatnonzero(~blank)
        raw = self.hashes[at][bare], owner[bare], np.searchsorted(keep, bare, side="right") - 1
        return tokens, raw


def window_hashes(value: np.ndarray, k: int, seed: int):
    """A function from starts to the hash of the ``k`` values from each: the
    values times powers of ``BASE`` as running sums modulo 2**64, so a window
    costs one difference, whatever its length."""
    power = np.full(len(value) + 1, BASE, np.uint64)
    power[0] = 1
    inverse = np.full(len(value) + 1, pow(BASE, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    power, inverse = np.multiply.accumulate(power), np.multiply.accumulate(inverse)
    total = np.concatenate([[np.uint64(0)], np.cumsum(value * power[:-1], dtype=np.uint64)])
    return lambda start: mix(mix((total[start + k] - total[start]) * inverse[start]) + np.uint64(seed))


def windows(value: np.ndarray, literal: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first token of every window that has enough literals and
    lies in one text.  A text of fewer tokens is one window."""
    out, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    size = np.bincount(doc) if len(doc) else np.zeros(0, np.int64)
    literals = np.concatenate([[0], np.cumsum(literal)])
    for k in range(1, WINDOW + 1):
        if k == WINDOW:
            start = np.flatnonzero(doc[: len(doc) - k + 1] == doc[k - 1 :]) if len(doc) >= k else np.zeros(0, np.int64)
        else:
            start = np.searchsorted(doc, np.flatnonzero(size == k))
        start = start[literals[start + k] - literals[start] >= min(LITERALS, k)]
        if len(start):
            out.append(window_hashes(value, k, k)(start))
            at.append(start)
    return np.concatenate(out), np.concatenate(at)


def raw_windows(value: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every window of ``k`` words of one text."""
    start = np.flatnonzero(doc[: len(doc) - k + 1] == doc[k - 1 :]) if len(doc) >= k else np.zeros(0, np.int64)
    return window_hashes(value, k, RAW + k)(start), start


def _slots(literal: np.ndarray, spans: np.ndarray, words: pa.Array, at: int, end: int) -> str:
    """The values of the placeholders of the window at ``at``, in order."""
    out = []
    for i in range(at, min(at + WINDOW, end)):
        if not literal[i]:
            kept = [w.strip(EDGE) for w in words[spans[i][0] : spans[i][1]].to_pylist()]
            out.append(b" ".join(w for w in kept if w).lower().decode("utf-8", "replace").replace("\x1f", " "))
    return "\x1f".join(out)


def template_windows(df: DataFrame, id_col: str, text_col: str, bitmap=None, lengths: tuple[int, ...] = (), coverage: float = COVERAGE) -> DataFrame:
    """``id``, ``hash``, ``pos``, ``slots`` of every window (those in the
    bitmap, if one is given), ``n``: the windows of the text, and ``need``:
    those that a copy has to hold.  ``raw`` is 0 for a template and the words
    of a raw window, ``token`` the token at ``pos``.  Raw windows are of the
    ``lengths`` if a bitmap is given, else of ``WINDOW`` words or all of a
    shorter text."""

    def run(batches):
        templates = worker_kept("templates", 0, Templates)
        marks = bitmap.value if bitmap is not None else None
        hits = lambda h: marks[(h >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)]
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids = part.column("id").to_numpy(zero_copy_only=False)
                (value, literal, spans, doc, words), (raw, text, token) = templates.with_raw(part.column("text"))
                h, at = windows(value, literal, doc)
                count = np.bincount(doc[at], minlength=len(ids))
                if marks is not None:
                    hit = hits(h)
                    h, at = h[hit], at[hit]
                owner = doc[at]
                ends = np.searchsorted(doc, owner, side="right").tolist()
                slots = [_slots(literal, spans, words, a, e) for a, e in zip(at.tolist(), ends, strict=True)]
                pos = at - np.searchsorted(doc, owner)
                rows = [(owner, h, pos, slots, count[owner], coverage * count[owner], np.zeros(len(at), np.int64), pos)]
                size = np.bincount(text, minlength=len(ids))
                own = np.minimum(size, WINDOW)
                for k in lengths if marks is not None else sorted({*own.tolist()} - {0}):
                    h, at = raw_windows(raw, text, k)
                    hit = hits(h) if marks is not None else own[text[at]] == k
                    h, at = h[hit], at[hit]
                    if k < WINDOW and len(at):  # one window is a whole item: the first place in a text will do
                        _, once = np.unique(np.stack([text[at].astype(np.uint64), h], 1), axis=0, return_index=True)
                        h, at = h[once], at[once]
                    owner = text[at]
                    pos = at - np.searchsorted(text, owner)
                    first = token[at] - np.searchsorted(doc, owner)
                    n = (size - k + 1)[owner]
                    rows.append((owner, h, pos, [""] * len(at), n, np.where(count[owner] > 0, 1.0, coverage) * n, np.full(len(at), k), first))
                for owner, h, pos, slots, n, need, k, first in rows:
                    columns = [pa.array(ids[owner], pa.int64()), pa.array(h.view(np.int64)), pa.array(pos), pa.array(slots, pa.string()), pa.array(n), pa.array(need), pa.array(k), pa.array(first)]
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "hash", "pos", "slots", "n", "need", "raw", "token"])

    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = rows.where("text is not null and id is not null")
    bounded_batches(df.sparkSession)
    return rows.mapInArrow(run, "id BIGINT, hash BIGINT, pos BIGINT, slots STRING, n BIGINT, need DOUBLE, raw BIGINT, token BIGINT")


def rare_windows(item_side: DataFrame) -> DataFrame:
    """``item``, ``raw`` and ``hash`` of the windows of which a document that
    holds the item must have one: all but the ``need - 1`` windows that most
    items share."""
    shared = item_side.groupBy("hash").agg(F.countDistinct("item").alias("items"))
    least = item_side.groupBy("item", "raw").agg(F.min("need").alias("least"))
    # Within one item, whose windows are no more than its words.
    order = W.partitionBy("item", "raw").orderBy(F.desc("items"), "hash", "item_pos")
    ranked = item_side.join(shared, "hash").join(least, ["item", "raw"]).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") >= F.ceil("least")).select("item", "raw", "hash").distinct()


def contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    coverage: float = COVERAGE,
) -> DataFrame:
    """One row for each document and item it holds: the id columns,
    ``n_windows`` (the item's windows found), ``coverage``, ``exact``
    (every slot has the item's own value) and ``start`` (the document's
    token where the item begins).

    Null and empty texts hold nothing, and null ids are left out, on both
    sides; an empty table on either side gives an empty result.  Repeated
    documents or items give one row for each pair of ids; ties between
    alignments go to the earliest.  Other columns are not read."""
    spark = df.sparkSession
    items = staged(template_windows(benchmark, item_col, item_text_col, coverage=coverage).dropDuplicates(), "benchmark-windows")
    marks = np.zeros(1 << BITMAP_BITS, bool)
    bits = items.select(F.shiftrightunsigned("hash", 64 - BITMAP_BITS).cast("int").alias("b")).distinct()
    marks[bits.toPandas()["b"].to_numpy(dtype=np.int64)] = True
    lengths = tuple(sorted(r.raw for r in items.where("raw > 0").select("raw").distinct().collect()))  # at most WINDOW
    found = template_windows(df, id_col, text_col, spark.sparkContext.broadcast(marks), lengths)
    found = staged(found.select("id", "hash", "pos", "slots", (F.col("raw") > 0).alias("raw"), "token"), "found-windows")
    item_side = items.select(F.col("id").alias("item"), "hash", (F.col("raw") > 0).alias("raw"), F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"), F.col("n").alias("item_n"), "need", F.col("token").alias("item_token"))

    # Pairs that share a rare window, then all windows of those pairs.
    met = found.select("id", "hash").join(rare_windows(item_side), "hash").select("id", "item", "raw").distinct()
    theirs = met.join(item_side, ["item", "raw"])
    joined = theirs.join(found.drop("raw"), ["id", "hash"])
    joined = joined.withColumn("shift", F.col("pos") - F.col("item_pos")).withColumn("begin", F.col("token") - F.col("item_token"))
    joined = staged(joined.select("id", "item", "raw", "shift", "begin", "item_pos", "item_n", "need", "slots", "item_slots"), "matches")

    # Alignments: shifts within DRIFT of each other are counted together, by
    # adding every window to the shifts around its own; raw windows don't
    # drift.  All steps group within a document and item, so one shuffle does.
    drift = F.when(F.col("raw"), F.lit(0)).otherwise(F.lit(DRIFT))
    near = joined.repartition("id", "item").withColumn("about", F.explode(F.sequence(F.col("shift") - drift, F.col("shift") + drift)))
    nearest = F.min(F.struct(F.abs(F.col("shift") - F.col("about")).alias("gap"), "shift", "begin", "slots", "item_slots"))
    near = near.groupBy("id", "item", "raw", "about", "item_pos").agg(F.max("item_n").alias("item_n"), F.max("need").alias("need"), nearest.alias("m"))
    near = near.select("id", "item", "raw", "about", "item_pos", "item_n", "need", "m.*")
    # With the drifted windows, and without them.
    near = near.withColumn("strict", F.explode(F.when(F.col("gap") > 0, F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))))
    sums = near.groupBy("id", "item", "raw", "about", "strict").agg(
        F.count(F.lit(1)).alias("n_windows"),
        F.sum((F.col("gap") == 0).cast("int")).alias("at"),
        F.max("item_n").alias("item_n"),
        F.max("need").alias("need"),
        F.min(F.struct("item_pos", "begin")).alias("first"),
        F.collect_list(F.when(F.col("slots") != "", F.struct("item_slots", "slots"))).alias("slots"),
    )
    sums = sums.where(F.col("n_windows") >= F.col("need"))

    # Slots of each alignment: one document value for each item value.
    mark = "\x1f"
    pair = lambda p: F.zip_with(F.split(p["item_slots"], mark), F.split(p["slots"], mark), lambda i, d: F.concat(i, F.lit(mark), d))
    pairs = F.array_distinct(F.flatten(F.transform("slots", pair)))
    values = F.array_distinct(F.flatten(F.transform("slots", lambda p: F.split(p["item_slots"], mark))))
    passed = sums.where(F.size(pairs) == F.size(values)).select(
        "id",
        "item",
        F.struct(
            (F.col("n_windows") / F.col("item_n")).alias("coverage"),
            (F.col("at") / F.col("item_n")).alias("at"),
            (-F.when(F.col("raw"), F.col("first.begin")).otherwise(F.col("about"))).alias("early"),
            F.forall("slots", lambda p: p["item_slots"] == p["slots"]).alias("exact"),
            (~F.col("raw")).alias("template"),
            "n_windows",
        ).alias("m"),
    )
    best = passed.groupBy("id", "item").agg(F.max("m").alias("m"))
    return best.select(
        F.col("id").alias(id_col),
        F.col("item").alias(item_col),
        "m.n_windows",
        F.least(F.col("m.coverage"), F.lit(1.0)).alias("coverage"),
        "m.exact",
        (-F.col("m.early")).alias("start"),
    )
