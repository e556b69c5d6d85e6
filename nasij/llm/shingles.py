"""Word shingles of whole texts as sets of 64-bit numbers, and their minhashes.

Words are maximal runs of bytes other than ASCII white space, with A-Z
lower-cased. A set holds the distinct runs of ``size`` words; a text of fewer
words has its whole sequence as one; a text without words has none.
"""

from __future__ import annotations

import numpy as np

WINDOW = 1 << 16
_rng = np.random.default_rng(20240229)
_VALUE = _rng.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_M1, _M2, _S = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(29)
_power = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_power[0]) < n:
        m = max(n, WINDOW)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(m, base, np.uint64)
            steps[0] = 1
            _power[k] = np.multiply.accumulate(steps)
    return _power[0], _power[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S)) * _M1
    return (x ^ (x >> _S)) * _M2


def _windows(raw: np.ndarray):
    """Parts that end at white space, so that no word is cut."""
    at = 0
    while at < len(raw):
        end = min(at + WINDOW, len(raw))
        if end < len(raw):
            blank = np.flatnonzero(_BLANK[raw[at:end]])
            while not len(blank) and end < len(raw):
                end = min(at + 2 * (end - at), len(raw))
                blank = np.flatnonzero(_BLANK[raw[at:end]])
            if end < len(raw):
                end = at + int(blank[-1]) + 1
        yield raw[at:end]
        at = end


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word, by differences of running polynomial sums."""
    parts = []
    for b in _windows(np.frombuffer(text, np.uint8)):
        inside = ~_BLANK[b]
        edges = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        if len(starts):
            up, down = _powers(len(b))
            sums = np.zeros(len(b) + 1, np.uint64)
            np.cumsum(_VALUE[b] * up[: len(b)], out=sums[1:])
            parts.append(_mix((sums[ends] - sums[starts]) * down[starts]))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """The sorted distinct shingles."""
    h = word_hashes(text)
    if not len(h):
        return h
    width = min(size, len(h))
    out = h[: len(h) - width + 1] * _M2 + np.uint64(width if len(h) < size else 0)
    for k in range(1, width):
        out = _mix(out) + h[k : len(h) - width + 1 + k]
    return np.unique(_mix(out))


class Minhash:
    """``n`` minhashes of a set."""

    def __init__(self, n: int, seed: int = 6):
        rng = np.random.default_rng(seed)
        self.mul = (rng.integers(1, 2**63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
        self.xor = rng.integers(1, 2**63, size=n, dtype=np.uint64)[:, None]

    def __call__(self, s: np.ndarray) -> np.ndarray:
        best = np.full(len(self.mul), np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(s), 2048):
            v = (s[None, i : i + 2048] ^ self.xor) * self.mul
            v ^= v >> np.uint64(32)
            np.minimum(best, (v * _M1).min(axis=1), out=best)
        return best
