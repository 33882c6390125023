"""Words of a batch of texts as 64-bit hashes, computed on code-point arrays without a Python loop over words.

A word is a maximal run of letters and digits (``str.isalnum``), lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LIMIT = 0x40000
CHUNK_CHARS = 400_000
_tables: dict[str, np.ndarray] = {}


def chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about CHUNK_CHARS characters together, so that arrays stay in the cache."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "") + 1
        if size >= CHUNK_CHARS or i - start >= 1 << 16:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _char_tables() -> tuple[np.ndarray, np.ndarray]:
    if "alnum" not in _tables:
        chars = [chr(i) for i in range(_LIMIT)]
        alnum = np.fromiter((c.isalnum() for c in chars), bool, _LIMIT)
        low = np.arange(_LIMIT, dtype=np.uint64)
        for i, c in enumerate(chars):
            if alnum[i] and (o := c.lower()) != c and len(o) == 1:
                low[i] = ord(o)
        _tables["alnum"] = alnum
        _tables["code"] = mix((low + np.uint64(1)) * np.uint64(_BASE))
    return _tables["alnum"], _tables["code"]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _tables or len(_tables["up"]) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _tables[name] = np.multiply.accumulate(p)
    return _tables["up"], _tables["down"]


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the offsets by text (one more than texts). A null text has no words."""
    alnum, code = _char_tables()
    texts = [t or "" for t in texts]
    chars = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    chars = np.minimum(chars, _LIMIT - 1)
    inside = alnum[chars]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = powers(len(chars) + 1)
    total = np.zeros(len(chars) + 1, np.uint64)
    np.cumsum(code[chars] * up[: len(chars)], out=total[1:])
    hashes = mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64))
    return hashes, np.searchsorted(first, begins)


def shingles(hashes: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word sequences within each text, and the text each belongs to."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    counts = np.diff(offsets)
    owner = np.repeat(np.arange(len(counts)), counts)
    keep = owner[:n] == owner[k - 1 :]
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * np.uint64(0xD6E8FEB86659FD93) + hashes[j : j + n]
    return mix(h[keep]), owner[:n][keep]


def bags(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct sequences of each text with their multiplicity: (sequence as 44 bits, text, count).

    At most 2**20 texts a call; they are told apart by the upper bits of one sorted key.
    """
    key = (owner.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20))
    key.sort()
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    key = key[first]
    return key & np.uint64((1 << 44) - 1), (key >> np.uint64(44)).astype(np.int64), count
