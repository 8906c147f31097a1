"""Vectorised hashing of words, word shingles and character n-grams."""

from __future__ import annotations

import hashlib
import re

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[c for c in range(128) if chr(c).isalnum() or c == ord("_")]] = True
_WORD_BYTE[128:] = True
#: Signs outside ASCII that are no part of a word.
_OTHER = re.compile(r"[^\w\x00-\x7f]+")

#: Powers are put together from two tables of this many entries at most, which a worker keeps.
_STEP = 1 << 16


def _table(base: np.uint64) -> np.ndarray:
    steps = np.full(_STEP, base)
    steps[0] = 1
    return np.cumprod(steps)


_LOW, _LOW_INVERSE = _table(BASE), _table(BASE_INVERSE)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2^64."""
    if n <= _STEP:
        return _LOW[:n], _LOW_INVERSE[:n]
    out = []
    for low, base in ((_LOW, BASE), (_LOW_INVERSE, BASE_INVERSE)):
        leap = low[-1:] * base
        high = np.full(-(-n // _STEP), leap)
        high[0] = 1
        out.append(np.multiply.outer(np.cumprod(high), low).ravel()[:n])
    return out[0], out[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit value scrambled by a fixed permutation."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def normal(text: str) -> str:
    """Lower case; signs that belong to no word become spaces."""
    text = text.lower()
    return text if text.isascii() else _OTHER.sub(" ", text)


def words(text: str) -> list[str]:
    """The words that ``word_hashes`` hashes: runs of letters, digits and underscores."""
    return re.findall(r"\w+", normal(text))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every ``values[start:end]``, from one running sum."""
    power, inverse = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    return mixed((total[ends] - total[starts]) * inverse[starts])


def word_hashes(text: str) -> np.ndarray:
    data = np.frombuffer(normal(text).encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _WORD_BYTE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return span_hashes(data, edges[::2], edges[1::2])


def shingles(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles of a text.

    A text of one to ``n - 1`` words has one shingle, all its words; one without words has none.
    """
    w = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(w):
        return w
    n = min(n, len(w))
    size = len(w) - n + 1
    h = np.full(size, np.uint64(n))
    for k in range(n):
        h = h * BASE + w[k : k + size]
    return np.unique(mixed(h))


def set_key(values: np.ndarray) -> bytes:
    """128 bits that identify a sorted set."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
