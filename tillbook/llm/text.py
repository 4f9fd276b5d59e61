"""Small text helpers that run inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

# The white space that separates words, as bytes.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

# Words remembered by one task; a word met beyond this is hashed again.
CACHED_WORDS = 400_000

MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """UTF-8 words as they stand; bytes.split() splits on exactly SPACES."""
    return text.encode().split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case; bytes.lower() leaves every other letter alone."""
    return text.encode().lower().split() if text else []


class WordHashes(dict):
    """64-bit hash of a word, remembered for the words met first."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = value
        return value

    def array(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), dtype=np.uint64, count=len(found))


def mixed(a: np.ndarray) -> np.ndarray:
    """Bijective scramble of 64-bit values (the finaliser of a 64-bit mixing function)."""
    a = a.astype(np.uint64, copy=True)
    a ^= a >> np.uint64(32)
    a *= MIX
    a ^= a >> np.uint64(29)
    a *= np.uint64(0xD6E8FEB86659FD93)
    a ^= a >> np.uint64(32)
    return a


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k neighbours; the order inside the run counts."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= MIX
        out += hashes[j : j + n]
    return mixed(out)


def shingle_set(found: list[bytes], k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of k-word shingles; a shorter text is one shingle, an empty text none."""
    if not found:
        return np.empty(0, dtype=np.uint64)
    return np.unique(runs(hashes.array(found), min(k, len(found))))


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches, a few at a time, so that a batch of long texts is not copied whole."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
