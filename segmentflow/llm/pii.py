"""Personal data by a skip-chain conditional random field (operator 1).

Base mentions are the matches of four patterns with their checks (email,
ip, card, phone); they always stay.  The field's nodes are the mentions of
a document: the base mentions, whose labels are known, and candidates
(other digit groups of ``LEAST_DIGITS`` digits, the digits of a base mention
repeated beside other numbers, and words that equal the local part of an
email of the document).  Words that are neither are
outside every entity, so they need no node.  Its factors are

* a unary factor of each node's shape (digits, dots, letters, separators,
  the card checksum), a multinomial model;
* chain factors between nodes next to each other in the text;
* skip factors between distant nodes of one document that repeat each
  other: equal digits (their last ``KEY_DIGITS``), or one local part.  Each
  node is joined to the previous and to the first of its kind, so the edges
  are linear in the nodes.  A skip factor holds the evidence of both ends:
  it favours equal labels.

Loopy sum-product message passing gives the marginals; a candidate whose
best label is an entity becomes a mention.  So a phone number that is
repeated without its plus sign is found, and the same digits alone aren't.

Training: the shape and the label of every base mention and candidate of
all documents, as counts (at most a few thousand distinct shapes, summed by
Spark), fit the unary model in numpy; chain and skip factors are smoothed
log ratios of the pair counts.  Candidates that repeat another mention are
left out of the counts, as their labels are unknown.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmentflow.llm.common import append_columns, bounded_batches, text_slices

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = len(KINDS)
LABELS = OUTSIDE + 1
LEAST_DIGITS = 7
KEY_DIGITS = 7
LEAST_LOCAL = 5
NEAR = 40  # characters between chain neighbours
ROUNDS = 12
# Pair counts added before smoothing: repeats agree far more often than not.
SKIP_PRIOR = (2000.0, 1.0)
# Weight of all shapes of ``background`` against that of all entities.
BACKGROUND = 2.0

# The four base patterns.  They are anchored so that a match starts only
# where a leftmost search would find one: inside a run that failed at its
# start, later starts fail too.
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9])[+(]{0,2}[0-9](?:[().\x20/-]{0,2}[0-9])*+(?![A-Za-z0-9])")
GROUP = re.compile(r"(?<![A-Za-z0-9])[0-9]++(?![A-Za-z0-9])")
JOINT = re.compile(r"[().\x20/-]{1,2}")
LOCAL_WORD = re.compile(r"[A-Za-z0-9._%+-]++")


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_mentions(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` by kind, then start; code points, end
    exclusive; leftmost matches that don't overlap, per kind."""
    out = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := EMAIL_DOMAIN.match(text, at + 1)):
            end = m.end()
            out.append((0, start, end))
        at = text.find("@", max(at + 1, end))
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append((3, *m.span()))
    return out


def shape(s: str) -> tuple[int, ...]:
    """Small numbers that describe a mention: digits, dots, letters, @,
    separators, checksum."""
    d = _digits(s)
    n = min(len(d), 20)
    card = 0 if not 13 <= len(d) <= 19 else 2 if luhn(d) else 1
    return (n, min(s.count("."), 4), int(any(c.isalpha() for c in s)), int("@" in s), min(sum(c in " -/" for c in s), 4), int("(" in s), card)


SHAPE_SIZES = (21, 5, 2, 2, 5, 2, 3)


def key(kind: int, s: str) -> str:
    """What mentions that repeat each other have in common."""
    if "@" in s:
        return "@" + s[: s.index("@")].lower()
    if kind == 0 or any(c.isalpha() for c in s):
        return "@" + s.lower()
    d = _digits(s)
    return "#" + (d[-KEY_DIGITS:] if len(d) >= KEY_DIGITS else s)


def repeats(text: str, gaps: list[tuple[int, int]], numbers: list[str]) -> list[tuple[int, int]]:
    """Spans of whole digit groups of a run that are one of the numbers, or
    its end of at least ``KEY_DIGITS`` digits, in text order; of overlapping
    ones that of the most digits."""
    ends = {d[i:] for d in numbers for i in range(len(d) - KEY_DIGITS + 1)}
    most = max(map(len, ends), default=0)
    fits = []
    for a, b in gaps if ends else []:
        groups = [m.span() for m in GROUP.finditer(text, a, b)]
        for j, (_, end) in enumerate(groups):
            digits = ""
            for i in range(j, -1, -1):
                if i < j and not JOINT.fullmatch(text, groups[i][1], groups[i + 1][0]):
                    break
                digits = text[slice(*groups[i])] + digits
                if len(digits) > most:
                    break
                if digits in ends:
                    fits.append((-len(digits), groups[i][0], end))
    out: list[tuple[int, int]] = []
    for _, s, e in sorted(fits):
        at = bisect_left(out, (s, e))
        if (at == 0 or out[at - 1][1] <= s) and (at == len(out) or e <= out[at][0]):
            out.insert(at, (s, e))
    return out


@dataclass
class Nodes:
    """The mentions of one document in text order."""

    base: list[tuple[int, int, int]]
    label: list[int]  # the base kind, -1 for a candidate
    span: list[tuple[int, int]]
    shape: list[tuple[int, ...]]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def mentions(text: str | None) -> Nodes:
    text = text or ""
    base = base_mentions(text)
    found = [(s, e, k) for k, s, e in base]
    covered = sorted((s, e) for _, s, e in base)
    # Candidates are looked for in the gaps between base mentions.
    gaps, at = [], 0
    for s, e in covered:
        if s > at:
            gaps.append((at, s))
        at = max(at, e)
    gaps.append((at, len(text)))
    local = {text[s : text.index("@", s)].lower() for k, s, e in base if k == 0}
    local = {w for w in local if len(w) >= LEAST_LOCAL}
    if DIGIT.search(text):
        again = repeats(text, gaps, [_digits(text[s:e]) for k, s, e in base if k])
        at = 0
        for a, b in gaps:
            for m in CANDIDATE.finditer(text, a, b):
                while at < len(again) and again[at][1] <= m.start():
                    found.append((*again[at], -1))
                    at += 1
                inside = []
                while at < len(again) and again[at][0] < m.end():
                    inside.append(again[at])
                    at += 1
                spans = [m.span()]
                # A repeat beside other numbers is a node of its own, and so
                # is what is left; one that ends the group is the group.
                if len(inside) > 1 or inside and inside[0][1] < m.end():
                    found += [(*x, -1) for x in inside]
                    cuts = [m.start(), *(x for span in inside for x in span), m.end()]
                    spans = [r.span() for c, d in zip(cuts[::2], cuts[1::2], strict=True) for r in CANDIDATE.finditer(text, c, d)]
                found += [(c, d, -1) for c, d in spans if len(_digits(text[c:d])) >= LEAST_DIGITS]
        found += [(*x, -1) for x in again[at:]]
    if local:
        for a, b in gaps:
            for m in LOCAL_WORD.finditer(text, a, b):
                word = m[0].rstrip(".-%")
                # Digits alone are candidates of their own above.
                if word.lower() in local and any(c.isalpha() for c in word):
                    found.append((m.start(), m.start() + len(word), -1))
    found.sort()
    chain, skip, first, last = [], [], {}, {}
    for i, (s, e, k) in enumerate(found):
        if i and 0 <= s - found[i - 1][1] <= NEAR:
            chain.append((i - 1, i))
        name = key(k, text[s:e])
        if name in first:
            skip.append((last[name], i))
            if first[name] != last[name]:
                skip.append((first[name], i))
        first.setdefault(name, i)
        last[name] = i
    return Nodes(base, [k for _, _, k in found], [(s, e) for s, e, _ in found], [shape(text[s:e]) for s, e, _ in found], chain, skip)


OFFSETS = np.cumsum((0, *SHAPE_SIZES[:-1]))
WIDTH = sum(SHAPE_SIZES) + 1  # and a constant


def _rows(shapes: list[tuple[int, ...]]) -> np.ndarray:
    """Indices of the features of each shape, the constant last."""
    x = np.array(shapes, np.int64).reshape(-1, len(SHAPE_SIZES)) + OFFSETS
    return np.concatenate([x, np.full((len(x), 1), WIDTH - 1)], axis=1)


def background() -> list[tuple[int, ...]]:
    """Plain digit groups and words of every length, as outside: numbers of
    a shape that no entity of the corpus has are no entity by themselves."""
    out = []
    for n in range(21):
        for dots in range(3):
            for letters in (0, 1):
                for marks in range(5):
                    out.append((n, dots, letters, 0, marks, 0, int(13 <= n <= 19)))
    return out


@dataclass
class Field:
    unary: np.ndarray  # feature x label
    chain: np.ndarray  # label x label
    skip: float


def fit(shapes: list[tuple[tuple[int, ...], int, float]], chain: np.ndarray, agree: float, disagree: float) -> Field:
    """The unary model by gradient ascent on the counts (L2 penalty), and
    the pair factors by smoothed log ratios."""
    weights = np.zeros((WIDTH, LABELS))
    if shapes:
        rows = _rows([s for s, _, _ in shapes])
        y = np.array([k for _, k, _ in shapes])
        # Counts enter by their logarithm: a frequent shape teaches more
        # than a rare one, but doesn't drown it.
        n = np.log1p(np.array([c for _, _, c in shapes]))
        entities = n[y != OUTSIDE].sum()
        plain = background()
        rows = np.concatenate([rows, _rows(plain)])
        y = np.append(y, np.full(len(plain), OUTSIDE))
        n = np.append(n, np.full(len(plain), BACKGROUND * (1 + entities) / len(plain)))
        for _ in range(400):
            z = weights[rows].sum(axis=1)
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            gradient = np.zeros_like(weights)
            for f in range(rows.shape[1]):
                np.add.at(gradient, rows[:, f], n[:, None] * p)
            weights -= 0.5 * (gradient / n.sum() + 0.002 * weights)
    pair = chain + 1.0
    expected = pair.sum(axis=1, keepdims=True) * pair.sum(axis=0, keepdims=True) / pair.sum()
    good, bad = SKIP_PRIOR
    return Field(weights, 0.5 * np.log(pair / expected), float(np.log((agree + good) / (disagree + bad))))


def marginals(field: Field, docs: list[Nodes]) -> np.ndarray:
    """Label probabilities of all nodes of many documents (one graph of
    separate parts), by damped loopy sum-product in log space."""
    sizes = [len(d.label) for d in docs]
    base = np.cumsum([0, *sizes])
    label = np.array([k for d in docs for k in d.label], np.int64)
    unary = field.unary[_rows([s for d in docs for s in d.shape])].sum(axis=1) if len(label) else np.zeros((0, LABELS))
    known = label >= 0
    unary[known] = -50.0
    unary[known, label[known]] = 0.0
    edges = [(a + o, b + o, 0) for d, o in zip(docs, base, strict=False) for a, b in d.chain]
    edges += [(a + o, b + o, 1) for d, o in zip(docs, base, strict=False) for a, b in d.skip]
    belief = unary
    if edges:
        e = np.array(edges)
        # Each edge in both directions; the reverse of message m is m ^ 1.
        source = np.stack([e[:, 0], e[:, 1]], 1).ravel()
        target = np.stack([e[:, 1], e[:, 0]], 1).ravel()
        skip = np.eye(LABELS) * field.skip
        forward = np.where(e[:, 2, None, None] == 1, skip, field.chain)
        factor = np.stack([forward, forward.transpose(0, 2, 1)], 1).reshape(-1, LABELS, LABELS)
        message = np.zeros((len(source), LABELS))
        swap = np.arange(len(source)) ^ 1
        for _ in range(ROUNDS):
            belief = unary.copy()
            np.add.at(belief, target, message)
            out = belief[source] - message[swap]
            out = np.logaddexp.reduce(out[:, :, None] + factor, axis=1)
            out -= np.logaddexp.reduce(out, axis=1, keepdims=True)
            message = 0.5 * message + 0.5 * out
        belief = unary.copy()
        np.add.at(belief, target, message)
    return np.exp(belief - np.logaddexp.reduce(belief, axis=1, keepdims=True)) if len(belief) else belief


def train(df: DataFrame, text_col: str = "text") -> Field:
    """Fit on all rows; the driver gets the count table alone."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                counts: dict[tuple, int] = {}
                for text in part.column("text").to_pylist():
                    d = mentions(text)
                    # A candidate that repeats another mention may be an
                    # entity: it teaches nothing.
                    unsure = {i for pair in d.skip for i in pair if d.label[i] < 0}
                    label = [OUTSIDE if k < 0 else k for k in d.label]
                    names = [("shape", *s, k) for i, (s, k) in enumerate(zip(d.shape, label, strict=True)) if i not in unsure]
                    names += [("chain", label[a], label[b]) for a, b in d.chain if not {a, b} & unsure]
                    names += [("skip", int(label[a] == label[b])) for a, b in d.skip if not {a, b} & unsure]
                    for x in names:
                        counts[x] = counts.get(x, 0) + 1
                rows = [(x[0], ",".join(map(str, x[1:])), n) for x, n in counts.items()]
                columns = list(zip(*rows, strict=True)) or [[], [], []]
                kinds = (pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["what", "of", "n"])

    texts = df.select(F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null")
    bounded_batches(df.sparkSession)
    counts = texts.mapInArrow(run, "what STRING, of STRING, n BIGINT").groupBy("what", "of").agg(F.sum("n").alias("n")).collect()
    parsed = sorted((r.what, tuple(map(int, r.of.split(","))), r.n) for r in counts)
    shapes = [(of[:-1], of[-1], float(n)) for what, of, n in parsed if what == "shape"]
    chain = np.zeros((LABELS, LABELS))
    for what, of, n in parsed:
        if what == "chain":
            chain[of] += n
    skip = {of[0]: n for what, of, n in parsed if what == "skip"}
    return fit(shapes, chain, skip.get(1, 0), skip.get(0, 0))


MENTION = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())])
)


def label_texts(field: Field, texts: list[str | None]) -> list[list[dict]]:
    docs = [mentions(t) for t in texts]
    p = marginals(field, docs)
    out, at = [], 0
    for d in docs:
        spans = [(k, s, e, True) for k, s, e in d.base]
        best = p[at : at + len(d.label)].argmax(axis=1).tolist()
        at += len(d.label)
        spans += [(b, s, e, False) for b, k, (s, e) in zip(best, d.label, d.span, strict=True) if k < 0 and b != OUTSIDE]
        out.append([{"kind": KINDS[k], "start": s, "end": e, "base": base} for k, s, e, base in sorted(spans)])
    return out


def find_pii(df: DataFrame, field: Field, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``pii``: the mentions (kind, start, end in code points,
    end exclusive, whether a base mention), by kind as listed, then start.

    Null and empty texts have none.  Repeated rows get equal results; an
    empty table gives an empty one; an input column named ``pii`` is
    replaced; texts of any length are read whole.  Base mentions of
    different kinds may overlap, all stay; an added one overlaps none."""
    plain = vars(field)

    def factory():
        own = Field(**plain)
        return lambda texts: [label_texts(own, texts)]

    return append_columns(df, text_col, [T.StructField("pii", MENTION)], factory, keep)


def redact(df: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """``df`` with every mention in the text replaced by ``[KIND]``
    (overlapping mentions by the kind of the first); the text column moves
    to the end.  Null texts stay null."""
    plain = vars(field)

    def factory():
        own = Field(**plain)

        def apply(texts):
            out = []
            for text, spans in zip(texts, label_texts(own, texts), strict=True):
                if not spans:
                    out.append(text)
                    continue
                parts, at = [], 0
                for m in sorted(spans, key=lambda m: (m["start"], m["end"])):
                    if m["start"] >= at:
                        parts += [text[at : m["start"]], f"[{m['kind'].upper()}]"]
                    at = max(at, m["end"])
                out.append("".join([*parts, text[at:]]))
            return [out]

        return apply

    return append_columns(df, text_col, [T.StructField(text_col, T.StringType())], factory)
