"""Hashed character n-grams of words, for many words at once in numpy."""

from __future__ import annotations

import numpy as np

PRIME = np.uint32(0x01000193)
MIX = np.uint32(0x9E3779B1)


def hashed_ngrams(words: list[str], sizes: tuple[int, ...], bits: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Buckets (below ``1 << bits``) of the character n-grams of each word,
    the word standing between two boundary marks, grouped by word; and the
    number of n-grams per word.  The whole marked word counts as one more."""
    if not words:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    text = "".join(["\x02" + w + "\x03" for w in words])
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    length = np.array([*map(len, words)], np.int64) + 2
    start = np.cumsum(length) - length
    left = np.repeat(start + length, length) - np.arange(len(codes))  # characters to the word's end
    word = np.repeat(np.arange(len(words)), length)
    owners, buckets = [], []
    rolling = np.full(len(codes), np.uint32(salt * 2654435761 & 0xFFFFFFFF), np.uint32)
    for n in range(1, max(sizes) + 1):
        rolling = rolling[: len(codes) - n + 1] * PRIME ^ codes[n - 1 :]
        if n in sizes:
            at = np.flatnonzero(left[: len(rolling)] >= n)
            owners.append(word[at])
            buckets.append(((rolling[at] ^ np.uint32(n)) * MIX) >> np.uint32(32 - bits))
    # The whole word: a polynomial over all of its codes.
    step = np.arange(len(codes)) - np.repeat(start, length)
    power = np.ones(int(length.max()), np.uint32)
    power[1:] = PRIME
    power = np.multiply.accumulate(power, dtype=np.uint32)
    whole = np.add.reduceat((codes + np.uint32(0x51ED27)) * power[step], start, dtype=np.uint32)
    owners.append(np.arange(len(words)))
    buckets.append((((whole ^ (whole >> np.uint32(15))) * MIX) ^ np.uint32(salt)) * MIX >> np.uint32(32 - bits))
    owner, bucket = np.concatenate(owners), np.concatenate(buckets)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.bincount(owner, minlength=len(words))
