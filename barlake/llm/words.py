"""64-bit hashes of all words of whole texts, computed on byte arrays.

A word is a run without blanks (0x20, 0x09-0x0D) after lower-casing A-Z; its
hash is a polynomial of random values of its bytes, mixed.  Equal words have
equal hashes everywhere; two of n different words share one with probability
about n*n / 2**65 (below one in a million for 5 million words).
"""

from __future__ import annotations

import numpy as np

SLICE = 1 << 20
_RANDOM = np.random.default_rng(640_001).integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_RANDOM[_BLANK] = 0
_BASE = 0x9E3779B97F4A7C17
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hash(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of each word."""
    a = np.frombuffer(data, dtype=np.uint8)
    edge = np.diff(np.concatenate([[True], _BLANK[a], [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _power(len(a) + 1)
    total = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum(_RANDOM[a] * up[:len(a)], out=total[1:])
    h = (total[end] - total[start]) * down[start]
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), start


def _slices(data: bytes):
    """Parts of at most SLICE bytes, or one word, that cut no word."""
    at = 0
    while at < len(data):
        end = at + SLICE
        if end < len(data):
            near = np.flatnonzero(_BLANK[np.frombuffer(data, dtype=np.uint8, count=SLICE, offset=at)])
            if len(near):
                end = at + int(near[-1]) + 1
            else:
                rest = np.flatnonzero(_BLANK[np.frombuffer(data, dtype=np.uint8, offset=end)])
                end = end + int(rest[0]) + 1 if len(rest) else len(data)
        yield data[at:end]
        at = end


def word_hashes(texts) -> list[np.ndarray]:
    """The hashes of the words of each text, in order; null has none."""
    out: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0

    def flush():
        if not held:
            return
        bounds = np.cumsum([len(d) + 1 for d in held])
        h, start = _hash(b" ".join(held))
        out.extend(np.split(h, np.searchsorted(start, bounds[:-1])))

    for t in texts:
        data = (t or "").encode("utf-8", "surrogatepass").lower()
        if len(data) > SLICE:
            flush()
            held, size = [], 0
            out.append(np.concatenate([_hash(s)[0] for s in _slices(data)]))
            continue
        if size + len(data) + 1 > SLICE:
            flush()
            held, size = [], 0
        held.append(data)
        size += len(data) + 1
    flush()
    return out


def shingle_set(words: np.ndarray, width: int = 3) -> np.ndarray:
    """Sorted distinct hashes of ``width`` consecutive words; of the whole
    sequence when there are fewer words, empty without words."""
    if not len(words):
        return words
    k = min(width, len(words))
    n = len(words) - k + 1
    h = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        h = mix(h * np.uint64(0xA0761D6478BD642F) + words[i:i + n])
    h.sort()
    return h[np.concatenate([[True], h[1:] != h[:-1]])]
