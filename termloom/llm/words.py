"""Words of many texts at a time, as hashes."""

from __future__ import annotations

import numpy as np

#: Words in a shingle.
SHINGLE = 5
_ODD = np.uint64(0x9E3779B97F4A7C15)
# Fixed random numbers for the bytes, and an odd base with its inverse modulo 2^64.
_BYTE = np.random.default_rng(5).integers(0, 2**64, 256, np.uint64)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 2**64)
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers; no two give the same."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    found = np.ones(max(1, n), np.uint64)
    found[1:] = np.uint64(base)
    return np.multiply.accumulate(found)[:n]


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of each text, and the number of words of each text.

    A word is a run of bytes other than ASCII white space; A-Z count as a-z.
    """
    raw = np.frombuffer(b"\n".join(text or b"" for text in texts) + b"\n", np.uint8)
    space = _SPACES[raw]
    # Polynomial hashes of all prefixes; that of a word is a difference of two.
    value = _BYTE[_LOWER[raw]] * powers(_BASE, len(raw))
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
    start = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    end = np.flatnonzero(space & np.concatenate([[False], ~space[:-1]]))
    hashes = mixed((prefix[end] - prefix[start]) * powers(_INVERSE, len(raw))[start] + (end - start).astype(np.uint64))
    text_end = np.cumsum([len(text or b"") + 1 for text in texts])
    counts = np.diff(np.searchsorted(start, text_end), prepend=0)
    return hashes, counts


def shingle_sets(texts: list[bytes | None], size: int = SHINGLE) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted hashes.

    A text with fewer words than a shingle is one shingle; one without has none.
    """
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    rolled = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        rolled = mixed(rolled * _ODD + words[k : k + len(rolled)])
    found = []
    for end, count in zip(ends.tolist(), counts.tolist()):
        if count >= size:
            found.append(np.unique(rolled[end - count : end - size + 1]))
        elif count:
            one = np.array([count], np.uint64)
            for word in words[end - count : end]:
                one = mixed(one * _ODD + word)
            found.append(one)
        else:
            found.append(np.empty(0, np.uint64))
    return found
