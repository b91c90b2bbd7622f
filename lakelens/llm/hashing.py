"""64-bit hashes of words and n-grams, vectorised over a text."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import xxhash

M1, M2, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)

#: Words that a worker remembers, and the bytes of the longest of them.
MEMO_WORDS, MEMO_BYTES = 100_000, 64


def mix(x: np.ndarray) -> np.ndarray:
    x = x + STEP
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        got = xxhash.xxh64_intdigest(word)
        if len(word) <= MEMO_BYTES:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = got
        return got


WORDS = WordHashes()


def word_hashes(text: str | None) -> np.ndarray:
    """Of the words of a text with A-Z in lower case; words are runs of anything but ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    return np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n words, in order."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = mix(words[:m] + np.uint64(n))
    for k in range(1, n):
        out = mix(out + words[k : k + m])
    return out


#: Fixed values of glibc's mallopt: the size from which memory is mapped, and so given back when freed, and the number of arenas.
M_MMAP_THRESHOLD, M_ARENA_MAX = -3, -8


def give_back() -> None:
    """Freed memory of this worker goes back to the system. Glibc only; elsewhere Arrow's part alone."""
    WORDS.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(task: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A task's function over Arrow batches. Its worker, which stages share, gives memory back before and after, as the
    stage before may have been another kind of task; large arrays are mapped apart, so that they go when they are freed."""

    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        option = getattr(ctypes.CDLL(None), "mallopt", None)
        if option:
            option(M_MMAP_THRESHOLD, 4 << 20)
            option(M_ARENA_MAX, 2)
        pa.set_memory_pool(pa.system_memory_pool())
        give_back()
        try:
            yield from task(batches)
        finally:
            give_back()

    return run
