"""Hashes of words and byte runs of whole texts, in numpy.

The hash of a run is a polynomial in its bytes modulo 2^64. Prefix sums give the
hash of any run by one subtraction and one multiplication, so no Python object is
made per word.
"""

import re
from collections.abc import Iterator

import numpy as np

#: Bytes of a text that are hashed at a time.
STRETCH = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    held = _powers.get(base)
    if held is None or len(held) < n:
        size = max(n, STRETCH + 64)
        held = _powers[base] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]), dtype=np.uint64)
    return held[:n]


_SPACE = re.compile(rb"[\x00-\x20]")


def stretches(data: bytes) -> Iterator[tuple[np.ndarray, int]]:
    """Parts of ``data``, each with the few bytes that follow it, and the length without them.

    A part ends at white space where there is some within another ``STRETCH`` bytes; a longer word is several.
    """
    start = 0
    while start < len(data):
        end = min(len(data), start + STRETCH)
        if end < len(data):
            most = min(len(data), end + STRETCH)
            space = _SPACE.search(data, end, most)
            end = space.start() if space else most
        yield np.frombuffer(data, np.uint8, min(len(data), end + 8) - start, start), end - start
        start = end


class Runs:
    """Hashes of runs of one stretch."""

    def __init__(self, data: np.ndarray):
        values = (data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        self.back = _power(_INVERSE, len(data) + 1)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        mixed = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return mixed ^ mixed >> np.uint64(32)


def runs_where(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of true."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    return edges[::2], edges[1::2]
