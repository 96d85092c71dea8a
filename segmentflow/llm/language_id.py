"""Language identification (operator 8).

A text is the average of the embeddings of its hashed subwords (character
n-grams of its lower-cased words, and the words); a linear softmax over
that average gives the languages.  Embeddings and output weights are
trained together by mini-batch stochastic gradient descent in numpy, on a
bounded sample of the labelled training fold (``per_language`` documents
of each language, the smallest by hash of their id; the sample's subword
counts are made on the executors, so the driver holds at most ``buckets``
counts for each sampled document).

A held-back tenth of the sample calibrates the scores by temperature, and
sets the rejection threshold by text length: the held-back documents and
passages of ``PASSAGES`` words of them are put in groups of like length, and
of each group the ``reject_share`` quantile of the score's log odds is taken,
by a normal fit where that is lower (a group is too small for its own tail).
Between the groups' lengths the threshold is interpolated, and it is at least
``REJECT_LEAST`` times the score of a guess.  Texts without a letter are
``und`` and rejected.

By linearity a subword adds a fixed vector of class logits, so scoring adds
up per-word logit sums (cached) and divides by the number of subwords: the
same result as averaging the embeddings first.
"""

from __future__ import annotations

from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from segmentflow.llm.common import append_columns, small, staged
from segmentflow.llm.ngrams import hashed_ngrams

SIZES = (2, 3, 4)
BITS = 16
DIM = 16
CACHE_WORDS = 100_000
LEARNT_AT_ONCE = 4096  # words; their subwords' logits are some 100 times their text
UNDETERMINED = "und"
REJECT_LEAST = 1.1
PASSAGES = (1, 2, 10, 25)  # and the five words that are trained on
GROUP = 100  # calibration texts of like length
SAMPLE_BYTES = 16 << 20  # of text, in a group's training sample


@dataclass
class Model:
    languages: list[str]
    logits: np.ndarray  # bucket x language, temperature included
    lengths: np.ndarray  # logarithm of the subwords, ascending
    limits: np.ndarray  # log odds of the least score kept at each length


def bounded_sample(
    df: DataFrame, key: str, group: str, per_group: int, text: str = "text", most_bytes: int = SAMPLE_BYTES, groups: DataFrame | None = None
) -> DataFrame:
    """Rows of up to ``per_group`` different keys of each group, those whose
    keys have the smallest hashes, and of those as many as fit in
    ``most_bytes`` of text a group; texts longer than a 32nd of that are
    left out, so that no few of them take the place of the others.  A key's repeated rows count once, and rows without a key are told
    apart by their text.

    With ``groups`` the group is that table's column, joined by the key:
    only the texts' keys, sizes and hashes are shuffled for that.

    Keys whose hash is surely too large, by the number of different keys in
    the group, are left out before the ranking, so it sees a few times
    ``per_group`` rows of a group of any size.  The groups' sizes and the
    chosen keys are broadcast if they are measured to be small."""
    rows = df.select(F.col(key).alias("__k"), *([] if groups is not None else [F.col(group).alias("__g")]), F.octet_length(text).alias("__s"), F.xxhash64(text).alias("__t"))
    if groups is not None:
        rows = rows.join(groups.select(F.col(key).alias("__k"), F.col(group).alias("__g")), "__k")
    rows = rows.withColumn("__h", F.when(F.col("__k").isNull(), F.col("__t")).otherwise(F.xxhash64("__k")))
    # One row for each key and group (the smallest text), combined map-side.
    once = rows.groupBy("__g", "__h").agg(F.min(F.struct(F.col("__s").alias("size"), F.col("__t").alias("th"))).alias("t"))
    once = staged(once.select("__g", "__h", "t.size", "t.th"), "sample-keys")
    sizes = once.groupBy("__g").agg(F.count(F.lit(1)).alias("__n"))
    share = F.col("__h") / 2.0**64 + 0.5
    few = once.join(small(sizes.withColumnRenamed("__g", "__group")), F.col("__g") == F.col("__group"))
    few = few.where((share * F.col("__n") <= 2 * per_group + 100) & (F.col("size") <= most_bytes // 32))
    order = W.partitionBy("__g").orderBy("__h")
    few = few.withColumn("__r", F.row_number().over(order)).withColumn("__b", F.sum("size").over(order))
    chosen = few.where((F.col("__r") <= per_group) & (F.col("__b") <= most_bytes)).select("__g", "__h", "th")
    chosen = small(staged(chosen, "sample"))
    hashed = F.when(F.col(key).isNull(), F.xxhash64(F.col(text))).otherwise(F.xxhash64(F.col(key)))
    matched = (hashed == F.col("__h")) & (F.xxhash64(F.col(text)) == F.col("th"))
    if groups is not None:
        # A row of ``chosen`` is a key in one of its groups.
        return df.join(chosen, matched).select(*[c for c in df.columns if c != group], F.col("__g").alias(group)).dropDuplicates([key, group, text])
    return df.join(chosen, matched & (F.col(group) == F.col("__g")), "left_semi").dropDuplicates([key, group, text])


def _counts(words: list[str], bits: int) -> tuple[bytes, bytes]:
    buckets, _ = hashed_ngrams(words, SIZES, bits)
    ids, n = np.unique(buckets, return_counts=True)
    return ids.astype("<u4").tobytes(), n.astype("<f4").tobytes()


def training_counts(df: DataFrame, text_col: str, label_col: str, bits: int = BITS) -> DataFrame:
    """Per document the subword counts of its whole text, and of a passage
    of five of its words, so that short texts are learned too; then of the
    calibration's passages."""
    names = ["ids", "n", "short_ids", "short_n", *[f"{c}_{k}" for k in PASSAGES for c in ("ids", "n")]]
    fields = [T.StructField(c, T.BinaryType()) for c in names]

    def factory():
        def apply(texts):
            out = []
            for text in texts:
                words = (text or "").lower().split()
                at = len(text or "") * 7919 % max(1, len(words) - 4)
                passages = [words[at : at + 5], *(words[at : at + k] for k in PASSAGES)]
                out.append([x for w in (words, *passages) for x in _counts(w, bits)])
            return [list(c) for c in zip(*out, strict=True)] if out else [[] for _ in names]

        return apply

    return append_columns(df, text_col, fields, factory, [label_col])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(rows: list, bits: int = BITS, epochs: int = 8, rate: float = 0.5, reject_share: float = 0.001, seed: int = 7) -> Model:
    """SGD over (language, ids, n, short ids, short n) examples, which may
    go on with passages for the calibration; see the module text."""
    languages = sorted({r[0] for r in rows})
    if not languages:
        return Model([], np.zeros((1 << bits, 0), np.float32), np.zeros(1), np.zeros(1))
    rng = np.random.default_rng(seed)
    rows = sorted(rows, key=lambda r: (r[0], bytes(r[1]), bytes(r[2])))
    rows = [rows[i] for i in rng.permutation(len(rows))]
    y = np.array([languages.index(r[0]) for r in rows])
    held = np.arange(len(rows)) % 10 == 0
    examples = []  # (ids, weights, label, held back)
    for r, label, back in zip(rows, y, held, strict=True):
        for ids, n in ((r[1], r[2]), (r[3], r[4])):
            ids, n = np.frombuffer(ids, "<u4"), np.frombuffer(n, "<f4")
            if len(ids):
                examples.append((ids, n / n.sum(), label, back))
            if back:
                break
    train = [e for e in examples if not e[3]] or examples
    seen = np.zeros(1 << bits, bool)
    for e in train:
        seen[e[0]] = True
    emb = rng.normal(0, 1 / DIM, (1 << bits, DIM)).astype(np.float32)
    out = rng.normal(0, 1 / DIM, (DIM, len(languages))).astype(np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(len(train))
        for at in range(0, len(order), 32):
            part = [train[i] for i in order[at : at + 32]]
            ids = np.concatenate([e[0] for e in part])
            w = np.concatenate([e[1] for e in part])
            doc = np.repeat(np.arange(len(part)), [len(e[0]) for e in part])
            rows_of = emb[ids] * w[:, None]
            mean = np.zeros((len(part), DIM), np.float32)
            for d in range(DIM):
                mean[:, d] = np.bincount(doc, rows_of[:, d], len(part))
            error = _softmax(mean @ out)
            error[np.arange(len(part)), [e[2] for e in part]] -= 1
            back = error @ out.T
            out -= step * mean.T @ error
            # Subwords share the step of their text; the factor makes up
            # for the average's small weights.
            np.add.at(emb, ids, -(step * 20) * w[:, None] * back[doc])
    emb[~seen] = 0
    logits = emb @ out
    test = [e for e in examples if e[3]] or train
    raw = np.array([(logits[e[0]] * e[1][:, None]).sum(0) for e in test])
    gold = np.array([e[2] for e in test])
    scales = np.geomspace(0.25, 16, 25)
    loss = [-np.log(_softmax(raw * s)[np.arange(len(gold)), gold] + 1e-9).mean() for s in scales]
    scale = float(scales[int(np.argmin(loss))])
    logits = (logits * scale).astype(np.float32)
    size, odds = [], []
    for r in [r for r, back in zip(rows, held, strict=True) if back] or rows:
        for ids, n in zip(r[1::2], r[2::2], strict=True):
            ids, n = np.frombuffer(ids, "<u4"), np.frombuffer(n, "<f4")
            if len(ids):
                size.append(float(n.sum()))
                odds.append(_odds(_softmax((logits[ids] * n[:, None]).sum(0)[None] / n.sum()).max()))
    return Model(languages, logits, *_limits(np.array(size), np.array(odds), reject_share, len(languages)))


def _odds(p):
    p = np.clip(np.asarray(p, np.float64), 1e-12, 1 - 1e-12)
    return np.log(p / (1 - p))


def _limits(size: np.ndarray, odds: np.ndarray, share: float, languages: int) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of the least score kept, at the logarithms of some lengths."""
    least = float(_odds(min(REJECT_LEAST / languages, 1.0)))
    if not len(size):
        return np.zeros(1), np.full(1, least)
    groups = np.array_split(np.argsort(size, kind="stable"), max(1, len(size) // GROUP))
    at = np.array([np.log(size[g]).mean() for g in groups])
    limit = np.array([min(np.quantile(odds[g], share), odds[g].mean() + NormalDist().inv_cdf(share) * odds[g].std()) for g in groups])
    # No text is held to a higher score than a longer one.
    return at, np.maximum(np.minimum.accumulate(limit[::-1])[::-1], least)


def train(
    df: DataFrame, training: Column, key: str = "doc_id", text_col: str = "text", label_col: str = "lang", per_language: int = 300
) -> Model:
    """Fit on the rows where ``training`` holds; null texts and labels are
    left out.  No such row gives a model of no language."""
    rows = df.where(training & F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    rows = bounded_sample(rows.select(key, text_col, label_col), key, label_col, per_language, text_col)
    table = training_counts(rows, text_col, label_col).toArrow()
    return fit([tuple(r.values()) for r in table.to_pylist()])


class Scorer:
    def __init__(self, model: dict):
        self.logits, self.languages = model["logits"], model["languages"]
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.sums = np.zeros((1024, len(self.languages) + 1), np.float64)

    def _learn(self, new: list[str]) -> None:
        at, need = len(self.index), len(self.index) + len(new)
        if need > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros((max(need - len(self.sums), len(self.sums) // 2), self.sums.shape[1]))])
        self.index.update(zip(new, range(at, need), strict=True))
        for first in range(0, len(new), LEARNT_AT_ONCE):
            words = new[first : first + LEARNT_AT_ONCE]
            buckets, n = hashed_ngrams(words, SIZES, BITS)
            rows = self.sums[at + first : at + first + len(words)]
            rows[:, :-1] = np.add.reduceat(self.logits[buckets], np.cumsum(n) - n, axis=0, dtype=np.float64)
            rows[:, -1] = n

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        return self.sized(texts)[:2]

    def sized(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, score and number of subwords of each text."""
        if len(self.index) > CACHE_WORDS:
            self._clear()
        words = [t.lower().split() if t and any(map(str.isalpha, t)) else None for t in texts]
        index = self.index
        new = [w for w in set().union(*(w for w in words if w)) if w not in index]
        if new and self.languages:
            self._learn(new)
        label, score, size = [], [], []
        for w in words:
            if not w or not self.languages:
                label.append(UNDETERMINED)
                score.append(0.0)
                size.append(1.0)
                continue
            total = self.sums[np.fromiter(map(self.index.__getitem__, w), np.int64, len(w))].sum(axis=0)
            p = _softmax(total[None, :-1] / total[-1])[0]
            best = int(p.argmax())
            label.append(self.languages[best])
            score.append(float(p[best]))
            size.append(float(total[-1]))
        return label, score, size


def identify(df: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` (0 to 1) and ``lang_rejected``.

    Null texts and texts without a letter are ``und``, score 0, rejected;
    texts of no known subword score as a guess and are rejected.  On equal
    scores the alphabetically first language wins.  Repeated rows get equal
    results; an empty table gives an empty one; input columns named like
    an output are replaced."""
    plain = df.sparkSession.sparkContext.broadcast({"logits": model.logits, "languages": model.languages})
    lengths, limits = model.lengths, model.limits

    def factory():
        scorer = Scorer(plain.value)

        def apply(texts):
            label, score, size = scorer.sized(texts)
            low = _odds(score) < np.interp(np.log(size), lengths, limits) if size else []
            return label, score, [x == UNDETERMINED or bool(b) for x, b in zip(label, low, strict=True)]

        return apply

    fields = [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("lang_rejected", T.BooleanType()),
    ]
    return append_columns(df, text_col, fields, factory, keep)
