"""Spelling variants by FM-index search schemes (operator 12).

Words are near if one inserted, deleted or replaced code point turns one
into the other.  Such an edit leaves one half of a word untouched: a search
matches that half exactly and extends across the other, allowing one error.

1. Spark counts the words of all texts.
2. A word asks twice: with its left half, for words that start with it, and
   with its right half, for words that end with it.  Every word is stored
   under the prefixes and suffixes with which a word of its length or one
   more or less would ask.  Halves are dealt to cells by a hash, about
   ``CELL_CHARS`` characters a cell; a half that more than ``HOT`` words
   share is split over several cells.
3. In a cell the stored words form one text ``$word$word$``, with a
   bidirectional FM-index: an interval of ranks among the suffixes and one
   among the reversed prefixes are kept in step, so a pattern can be extended
   at either end.  All questions of a cell advance together.  Where errors
   are allowed, a pattern branches over the letters that continue it in the
   text (replaced or inserted) and over its own next letter left out; a
   branch goes on exactly, up to the word's closing ``$``.
4. A cell returns for each question the number of near words and the most
   frequent one, never the pairs.  A word that has the left half in common
   is left to the question with that half, so each is counted once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentflow.llm.common import staged

LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 7
LEAST_COUNT = 2
TIMES = 10
TYPO = 31
CELL_CHARS = 1 << 16
HOT = 4096
QUESTIONS = 4096  # that advance together
END, MARK = 0, 1  # codes below the letters': the text's end, a word's border


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Prefix doubling; ``text`` ends with its only least code."""
    rank, k, n = text.astype(np.int64), 1, len(text)
    while True:
        after = np.zeros(n, np.int64)
        after[: n - k] = rank[k:] + 1 if k < n else 0
        key = rank * (n + 2 + int(rank.max())) + after
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        step = np.concatenate([[0], np.cumsum(sorted_[1:] != sorted_[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = step
        if step[-1] == n - 1 or k >= n:
            return order
        k *= 2


class Ranks:
    """The Burrows-Wheeler transform of a text as counts: ``less[c, i]`` is
    the number of codes below ``c`` among its first ``i``."""

    def __init__(self, text: np.ndarray, codes: int):
        self.suffixes = suffix_array(text)
        bwt = text[self.suffixes - 1]
        self.less = np.zeros((codes + 1, len(text) + 1), np.int32)
        for c in range(codes):
            self.less[c + 1] = self.less[c]
            self.less[c + 1, 1:] += np.cumsum(bwt == c, dtype=np.int32)
        self.first = self.less[:, -1].astype(np.int64)  # rank of the first suffix with a code

    def extend(self, at, other, size, c):
        """Intervals of a pattern (``at`` here, ``other`` in the text's
        reverse) after code ``c`` is put in front of it."""
        below_low, below_high = self.less[c, at], self.less[c, at + size]
        low = self.less[c + 1, at] - below_low
        return self.first[c] + low, other + (below_high - below_low), self.less[c + 1, at + size] - below_high - low


class WordIndex:
    """Bidirectional FM-index over distinct words, sorted."""

    def __init__(self, words: list[str]):
        joined = "$".join(["", *words, ""])
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        border = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])]) if words else np.zeros(1, np.int64)
        self.letters = np.unique(np.delete(points, border))
        text = np.searchsorted(self.letters, points) + MARK + 1
        text[border] = MARK
        self.codes = len(self.letters) + MARK + 1
        self.border = border
        self.forward = Ranks(np.append(text, END), self.codes)
        self.backward = Ranks(np.append(text[::-1], END), self.codes)

    def near(self, words: list[str], left_exact: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of the question, number of the stored word) at one
        edit, which lies in the half that isn't held exact."""
        # A pattern is read from its exact end: by the reversed text's ranks
        # from the left, by the text's own ranks from the right.
        side = self.backward if left_exact else self.forward
        size = np.array([len(w) for w in words])
        exact = size // 2 if left_exact else size - size // 2
        width = int(size.max()) + 2
        pattern = np.full((len(words), width), MARK, np.int32)
        points = np.frombuffer("".join(words if left_exact else [w[::-1] for w in words]).encode("utf-32-le"), np.uint32)
        code = np.searchsorted(self.letters, points)
        known = self.letters[np.minimum(code, len(self.letters) - 1)] == points if len(self.letters) else np.zeros(len(points), bool)
        # A letter that no stored word has: no interval, but it may be the edit.
        code = np.where(known, code + MARK + 1, self.codes)
        inside = (np.arange(width) >= 1) & (np.arange(width) <= size[:, None])
        pattern[inside] = code
        n = len(side.suffixes)
        zero = [np.arange(len(words)), *(np.zeros(len(words), np.int64) for _ in range(2)), np.full(len(words), n)]
        one = [np.zeros(0, np.int64)] * 4
        letters = np.arange(MARK + 1, self.codes)
        out = []
        for j in range(width):
            # Errors are allowed behind the exact half, at its word's letters
            # (and, for one put in, before the closing mark).
            q, at, other, count = zero
            open_ = (j > exact[q]) & (j <= size[q] + 1)
            branch = [x[open_] for x in zero]
            letter = branch[0], np.broadcast_to(letters, (len(branch[0]), len(letters)))
            b = side.extend(branch[1][:, None], branch[2][:, None], branch[3][:, None], letter[1])
            some = b[2] > 0
            to = [np.broadcast_to(branch[0][:, None], some.shape)[some], *(x[some] for x in b)]
            replaced = (letter[1][some] != pattern[to[0], j]) & (j <= size[to[0]])
            skip = j <= size[branch[0]]
            # Edits made here go on from the next place, or for a letter put
            # in from this one.
            later = [np.concatenate([x[replaced], y[skip]]) for x, y in zip(to, branch, strict=True)]
            one = [np.concatenate([x, y]) for x, y in zip(one, to, strict=True)]
            one = self._step(side, one, pattern[one[0], j])
            last = j == size[one[0]] + 1
            out.append([x[last] for x in one])
            one = [np.concatenate([x[~last], y]) for x, y in zip(one, later, strict=True)]
            zero = self._step(side, zero, pattern[q, j])
            zero = [x[j <= size[zero[0]]] for x in zero]
        q, at, other = (np.concatenate([x[i] for x in out]) for i in range(3))
        start = self.forward.suffixes[other if left_exact else at]
        found = np.unique(np.column_stack([q, np.searchsorted(self.border, start)]), axis=0)
        return found[:, 0], found[:, 1]

    def _step(self, side: Ranks, state: list, code: np.ndarray) -> list:
        some = code < self.codes
        state, code = [x[some] for x in state], code[some]
        at, other, size = side.extend(*state[1:], code)
        some = size > 0
        return [state[0][some], at[some], other[some], size[some]]


def word_counts(df: DataFrame, id_col: str, text_col: str, typo: int | None = TYPO) -> DataFrame:
    """``word`` and ``n``: words of at least ``LEAST_LENGTH`` letters that
    occur ``LEAST_COUNT`` times.  A run of letters of which ``typo`` divides
    the crc32 of ``<id>:<run>`` loses one letter (None: none does)."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # Shorter runs can't become words.
    runs = F.regexp_extract_all(F.col(f"`{text_col}`").cast("string"), F.lit(f"{LETTERS}{{{LEAST_LENGTH},}}"), F.lit(0))
    rows = df.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    run = F.translate("run", upper, upper.lower())
    word = run
    if typo is not None:
        rows = rows.select(run.alias("run"), F.crc32(F.concat("id", F.lit(":"), run).cast("binary")).alias("h"))
        at = (F.col("h") % F.length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        word = F.when(F.col("h") % typo == 0, cut).otherwise(F.col("run"))
    words = rows.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def halves(vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Questions (``word``, ``left``, ``key``) and stored words (``word``,
    ``n``, ``left``, ``key``)."""
    size = F.length("word")
    half = lambda n: F.floor(n / 2).cast("int")
    begin = lambda n: F.struct(F.lit(True).alias("left"), F.substring("word", F.lit(1), n).alias("key"))
    end = lambda n: F.struct(F.lit(False).alias("left"), F.expr("word").substr(size - n + 1, n).alias("key"))
    asked = F.array(begin(half(size)), end(size - half(size)))
    kept = [begin(half(size + d)) for d in (-1, 0, 1)] + [end(size + d - half(size + d)) for d in (-1, 0, 1)]
    questions = vocabulary.select("word", F.explode(asked).alias("k")).select("word", "k.left", "k.key")
    stored = vocabulary.select("word", "n", F.explode(F.array_distinct(F.array(*kept))).alias("k"))
    return questions, stored.select("word", "n", "k.left", "k.key")


def cells(vocabulary: DataFrame, cell_chars: int, hot: int) -> tuple[DataFrame, DataFrame]:
    """Questions and stored words with the ``cell`` they are dealt to."""
    questions, stored = halves(vocabulary)
    crowded = stored.groupBy("left", "key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > hot)
    crowded = staged(crowded.select(F.col("left").alias("l"), F.col("key").alias("k"), F.ceil(F.col("c") / hot).cast("int").alias("p")), "hot-halves")
    chars = vocabulary.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    count = max(1, math.ceil(4 * chars / cell_chars))
    parts = F.coalesce("p", F.lit(1))
    share = F.pmod(F.xxhash64("word"), parts).cast("int")
    every = F.explode(F.sequence(F.lit(0), parts - 1))
    place = F.pmod(F.xxhash64("left", "key", "salt", "chunk"), F.lit(count)).alias("cell")
    split = lambda df: df.join(crowded, (F.col("left") == F.col("l")) & (F.col("key") == F.col("k")), "left")
    asked = split(questions).select("word", "left", "key", parts.alias("parts"), share.alias("chunk"), every.alias("salt"))
    held = split(stored).select("word", "n", "left", "key", share.alias("salt"), every.alias("chunk"))
    return asked.select("word", "left", "parts", "salt", place), held.select("word", "n", F.xxhash64("word").alias("h"), place)


def near_counts(vocabulary: DataFrame, cell_chars: int = CELL_CHARS, hot: int = HOT) -> DataFrame:
    """``word``, ``n_near``, ``best_n`` and ``best``: the most frequent near
    word, the first in code-point order on ties."""
    asked, held = cells(vocabulary, cell_chars, hot)
    asked = asked.toDF("asked", "left", "parts", "salt", "cell")

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"word": [], "n_near": [], "best_n": [], "best": []}
        if left.num_rows and right.num_rows:
            stored = {w: (n, h) for w, n, h in zip(*(right.column(c).to_pylist() for c in ("word", "n", "h")), strict=True)}
            words = sorted(stored)
            n, h = np.array([stored[w] for w in words], np.int64).T
            index = WordIndex(words)
            for side in (True, False):
                mine = left.filter(pc.equal(left.column("left"), side))
                for at in range(0, mine.num_rows, QUESTIONS):
                    part = mine.slice(at, QUESTIONS)
                    questions = part.column("asked").to_pylist()
                    q, y = index.near(questions, side)
                    # A half split over cells: only the words of this part.
                    fits = h[y] % part.column("parts").to_numpy()[q] == part.column("salt").to_numpy()[q]
                    if not side:
                        fits &= np.array([not words[b].startswith(questions[a][: len(questions[a]) // 2]) for a, b in zip(q.tolist(), y.tolist(), strict=True)], bool)
                    q, y = q[fits], y[fits]
                    order = np.lexsort((y, -n[y], q))
                    who, first, count = np.unique(q[order], return_index=True, return_counts=True)
                    best = y[order][first]
                    out["word"] += [questions[i] for i in who.tolist()]
                    out["n_near"] += count.tolist()
                    out["best_n"] += n[best].tolist()
                    out["best"] += [words[i] for i in best.tolist()]
        return pa.table({k: pa.array(v, pa.int64() if "n_" in k or "_n" in k else pa.string()) for k, v in out.items()})

    found = asked.groupBy("cell").cogroup(held.groupBy("cell")).applyInArrow(cell, "word STRING, n_near BIGINT, best_n BIGINT, best STRING")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), "best")).alias("b")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of its chain of ``form``s.  Each pass
    doubles the steps; a chain's counts grow ``TIMES``-fold at each step, so
    its length is the logarithm of the largest count."""
    reached = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = staged(reached.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        reached = step.select("word", "root")
        if step.where("moved").isEmpty():
            return reached


def spelling_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo: int | None = None, cell_chars: int = CELL_CHARS, hot: int = HOT) -> DataFrame:
    """Per word ``word``, ``form`` (its near word of largest ``n``, if that
    is at least ``TIMES`` its own; else null), ``root`` (the last form of
    the chain, the word itself without one), ``n``, ``n_near`` and
    ``form_n``.

    Null and empty texts have no words; a null id counts as an empty text in
    the typing errors that ``typo`` asks for.  Repeated rows count each
    time.  Of near words of the same ``n`` the first in code-point order is
    the form.  Texts and words of any length are taken whole.  An empty table
    gives an empty result; other columns are not read."""
    vocabulary = staged(word_counts(df, id_col, text_col, typo), "vocabulary")
    near = near_counts(vocabulary, cell_chars, hot)
    full = vocabulary.join(near, "word", "left")
    is_form = F.col("best_n") >= TIMES * F.col("n")
    full = full.select("word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n"))
    full = staged(full, "forms")
    root = roots(full.where("form is not null"))
    return full.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
