"""Toxicity (operator 4): a linear classifier over character n-grams scaled
by naive Bayes log-count ratios.

Features are the distinct hashed character n-grams of a text's lower-cased
words (binary).  On the labelled training fold, the log ratio of each
feature's smoothed share in toxic and in other texts scales that feature;
a logistic regression with L2 penalty is fitted on the scaled features.
Both use a bounded sample: ``per_class`` documents of each class, the
smallest by hash of their id, read as feature sets made on the executors.
The intercept is shifted so that 0.5 is the best cut (F1) on a held-back
fifth of the sample, weighted back to the class shares of all labels.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmentflow.llm.common import append_columns
from segmentflow.llm.language_id import bounded_sample
from segmentflow.llm.ngrams import hashed_ngrams

SIZES = (3, 4, 5, 6)
BITS = 18
SMOOTHING = 1.0
CACHE_WORDS = 150_000


class Features:
    """Distinct n-gram buckets of a text, with a bounded cache by word."""

    def __init__(self):
        self.cache: dict[str, bytes] = {}
        self.seen = np.zeros(1 << BITS, np.int64)

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.cache) > CACHE_WORDS:
            self.cache = {}
        words = [set((t or "").lower().split()) for t in texts]
        new = [w for w in set().union(*words) if w not in self.cache]
        buckets, n = hashed_ngrams(new, SIZES, BITS)
        raw, ends = buckets.astype("<u4").tobytes(), (np.cumsum(n) * 4).tolist()
        self.cache.update(zip(new, (raw[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))
        out = []
        for w in words:
            found = np.frombuffer(b"".join(map(self.cache.__getitem__, w)), "<u4")
            # One of each bucket stays: the last to write its place.
            place = np.arange(len(found))
            self.seen[found] = place
            out.append(found[self.seen[found] == place])
        return out


def _margin(docs: list[np.ndarray], weights: np.ndarray, bias: float) -> np.ndarray:
    return np.array([weights[d].sum() / np.sqrt(len(d) or 1) for d in docs]) + bias


def fit(docs: list[np.ndarray], y: np.ndarray, share: float, epochs: int = 8, seed: int = 3) -> tuple[np.ndarray, float]:
    """Weights per bucket (ratio times coefficient) and the intercept."""
    size = 1 << BITS
    if len(docs) == 0 or y.min() == y.max():
        p = float(np.clip(y.mean() if len(docs) else 0.5, 0.01, 0.99))
        return np.zeros(size), float(np.log(p / (1 - p)))
    held = np.arange(len(docs)) % 5 == 0
    held &= bool(len(set(y[held])) == 2 and len(set(y[~held])) == 2)
    train = [d for d, h in zip(docs, held, strict=True) if not h]
    ty = y[~held].astype(float)
    count = [np.full(size, SMOOTHING), np.full(size, SMOOTHING)]
    for d, label in zip(train, ty, strict=True):
        count[int(label)][d] += 1
    ratio = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
    rng = np.random.default_rng(seed)
    coef, bias, grad2 = np.zeros(size), 0.0, np.full(size, 1e-6)
    class_weight = np.where(ty == 1, 0.5 / ty.mean(), 0.5 / (1 - ty.mean()))
    for _ in range(epochs):
        order = rng.permutation(len(train))
        for at in range(0, len(order), 32):
            part = order[at : at + 32]
            ids = np.concatenate([train[i] for i in part])
            lens = np.array([len(train[i]) for i in part])
            row = np.repeat(np.arange(len(part)), lens)
            x = ratio[ids] / np.sqrt(np.maximum(lens, 1))[row]
            z = np.bincount(row, x * coef[ids], len(part)) + bias
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - ty[part]) * class_weight[part]
            touched, inverse = np.unique(ids, return_inverse=True)
            g = np.bincount(inverse, x * error[row], len(touched)) / len(part) + 1e-5 * coef[touched]
            grad2[touched] += g * g
            coef[touched] -= 0.5 * g / np.sqrt(grad2[touched])
            bias -= 0.1 * error.mean()
    weights = ratio * coef
    if held.any():
        margin = _margin([d for d, h in zip(docs, held, strict=True) if h], weights, bias)
        gold = y[held] == 1
        weight = np.where(gold, share / max(1, gold.sum()), (1 - share) / max(1, (~gold).sum()))
        order = np.argsort(margin)
        above = weight[order][::-1].cumsum()[::-1]
        hit = (weight * gold)[order][::-1].cumsum()[::-1]
        f1 = 2 * hit / (above + share)
        best = np.flatnonzero(f1 >= f1.max() - 1e-9)
        at = int(best[len(best) // 2])
        cut = (margin[order][at] + (margin[order][at - 1] if at else margin[order][at] - 1)) / 2
        bias -= float(cut)
    return weights, float(bias)


def train(
    df: DataFrame,
    training: Column,
    key: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_class: int = 3000,
    labels: DataFrame | None = None,
) -> tuple[np.ndarray, float]:
    """Fit on rows where ``training`` holds, with a text and a label of 0
    or 1; other labels and nulls are left out.  ``labels`` is the table of
    ``key`` and label, if ``df`` has no label: the texts are then read where
    they are, and only those of the sample leave their place."""
    rows = df.where(training & F.col(text_col).isNotNull())
    if labels is None:
        rows = rows.where(F.col(label_col).isin(0, 1)).select(key, text_col, label_col)
        labelled = rows
    else:
        rows, labels = rows.select(key, text_col), labels.where(F.col(label_col).isin(0, 1))
        labelled = rows.select(key).join(labels, key)
    share = labelled.agg(F.avg(label_col)).first()[0] or 0.0
    sample = bounded_sample(rows, key, label_col, per_class, text_col, groups=labels)

    def factory():
        features = Features()
        return lambda texts: [[np.sort(f).astype("<u4").tobytes() for f in features(texts)]]

    table = append_columns(sample, text_col, [T.StructField("ids", T.BinaryType())], factory, [label_col]).toArrow()
    rows = sorted((bytes(r["ids"]), int(r[label_col])) for r in table.to_pylist())
    rows = [rows[i] for i in np.random.default_rng(5).permutation(len(rows))]
    return fit([np.frombuffer(r[0], "<u4") for r in rows], np.array([r[1] for r in rows]), float(share))


def score_documents(
    df: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``df`` with ``score`` (0 to 1, higher: likelier toxic) and
    ``predicted`` (1 if ``score >= 0.5``).  Null and empty texts have no
    feature and get the intercept's score.  Repeated rows get equal scores;
    an empty table gives an empty one; input columns named like an output
    are replaced; texts of any length are scored whole."""
    plain = df.sparkSession.sparkContext.broadcast({"weights": model[0].astype(np.float32), "bias": model[1]})

    def factory():
        features, weights, bias = Features(), plain.value["weights"], plain.value["bias"]

        def apply(texts):
            margin = np.clip(_margin(features(texts), weights, bias), -500, 500).astype(np.float64)
            score = 1 / (1 + np.exp(-margin))
            return score, (score >= 0.5).astype(np.int32)

        return apply

    return append_columns(
        df, text_col, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())], factory, keep
    )
