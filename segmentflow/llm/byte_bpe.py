"""Byte-level BPE encoding and decoding (operator 3).

Texts are cut into the matches of the tokenizer's pattern.  Each match is
encoded by itself: a match that is a token gives that token; otherwise its
bytes become one row of a padded integer matrix.  Rows are bucketed by
length.  In each round every row merges its leftmost pair of lowest rank;
pair ranks come from an open-addressing hash table of (left id, right id),
looked up for whole columns at once.  A round removes one column from every
row; rows with no pair left are written out and the matrix is compacted.
Rows beyond the widest bucket use a heap over a linked list with the same
rule (lowest rank first, leftmost on ties), in n log n.

Repeated matches are encoded once per task (bounded cache).  To find the
matches cheaply, a text is first cut where white space follows other text;
every match of the pattern ends at such a place, so the pieces can be
encoded apart.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from segmentflow.llm.common import append_columns, vocabulary_bytes

WIDTHS = (4, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64, 96, 128, 256, 512, 1024)
WIDTH_OF = [next(w for w in WIDTHS if n <= w) for n in range(WIDTHS[-1] + 1)]
CELLS = 1 << 18
MARKS = (".", ",", "!", "?", ":", ";")
CACHE_ENTRIES = 250_000
CACHE_CHARS = 16 << 20
NO_RANK = np.iinfo(np.int32).max
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """(left id, right id) -> merged id in an open-addressing hash table."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, bits: int, probes: int):
        self.keys, self.values, self.bits, self.probes = keys, values, bits, probes

    @classmethod
    def build(cls, pairs: np.ndarray, merged: np.ndarray) -> PairTable:
        bits = max(4, int(len(pairs) * 4).bit_length())
        size = 1 << bits
        table = cls(np.full(size, -1, np.int64), np.full(size, NO_RANK, np.int32), bits, 0)
        slot = table._slot(pairs)
        left = np.arange(len(pairs))
        while len(left):
            table.probes += 1
            first = np.zeros(len(left), bool)
            free = np.flatnonzero(table.keys[slot[left]] == -1)
            first[free[np.unique(slot[left[free]], return_index=True)[1]]] = True
            won = left[first]
            table.keys[slot[won]], table.values[slot[won]] = pairs[won], merged[won]
            left = left[~first]
            slot[left] = (slot[left] + 1) & (size - 1)
        return table

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * MULTIPLIER) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, ``NO_RANK`` where the pair merges to no token; an id
        of -1 (padding) never merges."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = -2
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.values[slot], NO_RANK).astype(np.int32)
        rest = np.flatnonzero((held != keys) & (held != -1) & (keys != -2))
        for _ in range(self.probes):
            if not len(rest):
                break
            slot[rest] = (slot[rest] + 1) & (len(self.keys) - 1)
            held = self.keys[slot[rest]]
            hit = held == keys[rest]
            out[rest[hit]] = self.values[slot[rest[hit]]]
            rest = rest[~hit & (held != -1)]
        return out


def vocabulary_tables(data: bytes) -> dict:
    """Plain tables of a rank file (``base64 rank`` per line), built once on
    the driver to be broadcast: token bytes and the pair table."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the vocabulary lacks the single bytes {missing[:5]}")
    tokens = [b""] * (max(ranks.values()) + 1)
    get, pairs, merged = ranks.get, [], []
    for token, rank in ranks.items():
        tokens[rank] = token
        for cut in range(1, len(token)):
            left, right = get(token[:cut]), get(token[cut:])
            if left is not None and right is not None:
                pairs.append(left << 32 | right)
                merged.append(rank)
    return {"tokens": tokens, "pairs": vars(PairTable.build(np.array(pairs, np.int64), np.array(merged, np.int32)))}


class Vocabulary:
    def __init__(self, tables: dict):
        self.tokens = tables["tokens"]
        self.pairs = PairTable(**tables["pairs"])
        self.ranks = {t: i for i, t in enumerate(self.tokens) if t}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)

    def merge_rows(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Ids (little-endian int32 bytes) of pieces no longer than
        ``width``, by rounds over a matrix."""
        out = [b""] * len(pieces)

        def finish(rows: np.ndarray, values: np.ndarray) -> None:
            raw, step = values.astype("<i4").tobytes(), 4 * values.shape[1]
            ends = 4 * (values >= 0).sum(axis=1)
            for k, (r, n) in enumerate(zip(rows.tolist(), ends.tolist(), strict=True)):
                out[r] = raw[k * step : k * step + n]

        raw = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), np.uint8).reshape(-1, width)
        ids = self.byte_ids[raw]
        ids[np.arange(width) >= np.array([*map(len, pieces)])[:, None]] = -1
        row = np.arange(len(pieces))
        rank = self.pairs(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(pieces), width - 1)
        while len(row):
            every = np.arange(len(row))
            at = rank.argmin(axis=1)
            best = rank[every, at]
            done = best == NO_RANK
            if done.any():
                finish(row[done], ids[done])
                going = ~done
                row, ids, rank, at, best = row[going], ids[going], rank[going], at[going], best[going]
                every = np.arange(len(row))
                if not len(row):
                    break
            # Every row loses one column: the right half of its merged pair.
            ids[every, at] = best
            keep = np.ones(ids.shape, bool)
            keep[every, at + 1] = False
            ids = ids[keep].reshape(len(row), -1)
            last = ids.shape[1] - 1
            if not last:
                finish(row, ids)
                break
            rank = rank[keep[:, 1:]].reshape(len(row), -1)
            rows = every[at > 0]
            rank[rows, at[rows] - 1] = self.pairs(ids[rows, at[rows] - 1], best[rows])
            rows = every[at < last]
            rank[rows, at[rows]] = self.pairs(best[rows], ids[rows, at[rows] + 1])
        return out

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece: a heap of (rank, position)
        over a linked list."""
        n = len(piece)
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        follow = [*range(1, n), -1]
        prior = [*range(-1, n - 1)]
        first = self.pairs(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i) for i, r in enumerate(first) if r != NO_RANK]
        heapq.heapify(heap)
        tokens, get = self.tokens, self.ranks.get

        def push(i: int) -> None:
            if i >= 0 and (j := follow[i]) >= 0:
                r = get(tokens[ids[i]] + tokens[ids[j]])
                first[i] = NO_RANK if r is None else r
                if r is not None:
                    heapq.heappush(heap, (r, i))
            elif i >= 0:
                first[i] = NO_RANK

        first.append(NO_RANK)
        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or first[i] != r:
                continue
            j = follow[i]
            ids[i], ids[j], first[j] = r, -1, NO_RANK
            follow[i] = follow[j]
            if follow[j] >= 0:
                prior[follow[j]] = i
            push(i)
            push(prior[i])
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian int32 bytes."""
        out = [b""] * len(pieces)
        get, buckets = self.ranks.get, {}
        for i, p in enumerate(pieces):
            whole = get(p)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif p:
                n = len(p)
                buckets.setdefault(WIDTH_OF[n] if n <= WIDTHS[-1] else 0, []).append(i)
        for i in buckets.pop(0, ()):
            out[i] = self.merge_long(pieces[i]).astype("<i4").tobytes()
        for width, members in buckets.items():
            step = max(1, CELLS // width)
            for at in range(0, len(members), step):
                part = members[at : at + step]
                for i, ids in zip(part, self.merge_rows([pieces[i] for i in part], width), strict=True):
                    out[i] = ids
        return out


class Encoder:
    """Whole texts to ids, with bounded caches of repeated words.

    A cache has two generations: when the young one is full it becomes the
    old one, and words met again move back, so frequent words stay."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex

        self.vocabulary = vocabulary
        self.match = regex.compile(pattern).findall
        self.words = regex.compile(r"\s*\S+|\s+").findall
        self.uneven = regex.compile(r"\s ").search
        self.young: dict[str, dict[str, bytes]] = {"": {}, " ": {}}
        self.old: dict[str, dict[str, bytes]] = {"": {}, " ": {}}
        self.chars = 0

    def _learn(self, lead: str, words: set[str]) -> None:
        """Put ``lead + word`` into the cache for each word."""
        cache, old = self.young[lead], self.old[lead]
        new = {w for w in words if w not in cache}
        again = {w for w in new if w in old}
        cache.update((w, old[w]) for w in again)
        # Letters, or letters and one mark, are one or two matches of any
        # pattern of this family; the rest is cut by the pattern itself.
        letters, marked, other = set(), [], []
        for w in new - again:
            if w.isalpha():
                letters.add(w)
            elif w[-1:] in MARKS and w[:-1].isalpha():
                letters.add(w[:-1])
                marked.append(w)
            else:
                other.append(w)
        cuts = [self.match(lead + w) for w in other]
        known = [w for w in letters if w not in cache]
        pieces = list({p for cut in cuts for p in cut})
        coded = self.vocabulary.encode_pieces([p.encode() for p in [*[lead + w for w in known], *pieces, *MARKS]])
        cache.update(zip(known, coded, strict=False))
        of = dict(zip([*pieces, *MARKS], coded[len(known) :], strict=True))
        cache.update((w, cache[w[:-1]] + of[w[-1]]) for w in marked)
        get = of.__getitem__
        cache.update((w, b"".join(map(get, cut))) for w, cut in zip(other, cuts, strict=True))
        self.chars += sum(map(len, new))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; None and the empty text give none."""
        if self.chars > CACHE_CHARS or sum(map(len, self.young.values())) > CACHE_ENTRIES:
            self.old, self.young, self.chars = self.young, {"": {}, " ": {}}, 0
        cut = []
        plain: set[str] = set()
        spaced: set[str] = set()
        for text in texts:
            if not text:
                cut.append(((), ()))
            elif self.uneven(text):
                words = self.words(text)
                plain.update(words)
                cut.append((words, ()))
            else:
                head, *rest = text.split(" ")
                plain.add(head)
                spaced.update(rest)
                cut.append(((head,), rest))
        self._learn("", plain)
        self._learn(" ", spaced)
        of_plain, of_spaced = self.young[""].__getitem__, self.young[" "].__getitem__
        return [np.frombuffer(b"".join([*map(of_plain, a), *map(of_spaced, b)]), "<i4") for a, b in cut]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


def encode_documents(
    df: DataFrame, vocabulary_path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``df`` with ``ids`` (array of int) and ``decoded`` (the bytes those
    ids decode to).  A null text counts as empty: no ids, empty bytes.
    Equal rows give equal results, each on its own row; an empty table
    gives an empty one; an input column named like an output is replaced.
    Texts of any length are encoded whole."""
    tables = df.sparkSession.sparkContext.broadcast(vocabulary_tables(vocabulary_bytes(vocabulary_path)))

    def factory():
        encoder = Encoder(Vocabulary(tables.value), pattern)

        def apply(texts):
            ids = [x.tolist() for x in encoder.encode(texts)]
            return ids, [encoder.decode(x) for x in ids]

        return apply

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())]
    return append_columns(df, text_col, fields, factory, keep)


def token_digests(
    df: DataFrame, vocabulary_path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``encode_documents`` reduced inside the task to ``n_tokens``,
    ``ids_sha256`` (decimal ids joined by a space) and ``decoded_sha256``
    (of the decoded bytes), so whole token lists don't leave it."""
    tables = df.sparkSession.sparkContext.broadcast(vocabulary_tables(vocabulary_bytes(vocabulary_path)))

    def factory():
        encoder = Encoder(Vocabulary(tables.value), pattern)
        decimal = [str(i) for i in range(len(encoder.vocabulary.tokens))]

        def apply(texts):
            n, ids_sha, decoded_sha = [], [], []
            for ids in encoder.encode(texts):
                values = ids.tolist()
                n.append(len(values))
                ids_sha.append(hashlib.sha256(" ".join(map(decimal.__getitem__, values)).encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(encoder.decode(values)).hexdigest())
            return n, ids_sha, decoded_sha

        return apply

    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    return append_columns(df, text_col, fields, factory, keep)
