"""Hashed word shingles of many texts at once (NumPy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WIDTH = 5
CACHE_WORDS = 300_000
RUN_BYTES = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, kept while there is room (what is kept changes no result)."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(word) < 64:
            self[word] = h
        return h

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words (A-Z lower-cased, between ASCII white space) and their number per text."""
        if len(self) > CACHE_WORDS:
            self.clear()
        words = [t.encode().lower().split() if t else [] for t in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        get = self.__getitem__
        flat = np.fromiter((h for w in words for h in map(get, w)), np.uint64, int(sizes.sum()))
        return flat, sizes


def shingles(words: np.ndarray, sizes: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every ``width``-word shingle; a shorter text is one shingle, an empty one none."""
    starts = np.cumsum(sizes) - sizes
    hashes, owners = [], []
    for n in range(1, width + 1):
        own = np.flatnonzero(sizes == n if n < width else sizes >= width)
        count = sizes[own] - n + 1  # 1 for the short ones
        at = np.repeat(starts[own] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        x = np.full(len(at), n, np.uint64)
        for j in range(n):
            x = x * _STEP + words[at + j]
        hashes.append(mix64(x))
        owners.append(np.repeat(own, count))
    owner = np.concatenate(owners)
    return np.concatenate(hashes), owner


def chunked(texts: list[str | None], limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """[start, end) of runs of texts of about ``limit`` characters; a longer text is a run of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def text_runs(texts: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, int, list[str | None]]]:
    """(start, end, texts) of runs of about ``limit`` bytes of a column; a longer text is a run of its own.

    Only one run at a time is there as Python strings, however many rows a batch has.
    """
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = done = 0
    while start < len(ends):
        end = min(int(np.searchsorted(ends, done + limit)) + 1, len(ends))
        yield start, end, texts.slice(start, end - start).to_pylist()
        start, done = end, int(ends[end - 1])
