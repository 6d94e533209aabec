"""Word shingles of a text as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE_WORDS = 5
_FACTORS = (np.random.default_rng(11).integers(1, 1 << 63, 64, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads them evenly."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    """Runs of what is neither a space nor a control character of white space, with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingles of a text; fewer words than ``size`` make one shingle, no words none."""
    words = words_of(text or "")
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    count = len(hashes) - size + 1
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total += hashes[k:k + count] * _FACTORS[k]
    return np.unique(mixed(total))
