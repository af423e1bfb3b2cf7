"""64-bit hashes of byte spans, computed for whole blocks of bytes at once.

Every byte value has a random 64-bit number, and a span's hash is the polynomial of these numbers, modulo 2 ** 64. Prefix
sums give the hash of any span from its two ends. The constants are drawn from a fixed seed, so all tasks agree.
"""

from __future__ import annotations

import numpy as np

_DRAWN = np.random.Generator(np.random.PCG64(20_240_117)).integers(1, 2 ** 63, 260, dtype=np.uint64)
BYTE_CODES = _DRAWN[:256] * np.uint64(2) + np.uint64(1)
BASE = np.uint64((int(_DRAWN[256]) * 8 + 5) % 2 ** 64)  # odd, so that it has an inverse, and of the longest period
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2 ** 64))
M1, M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mixed(x: np.ndarray) -> np.ndarray:
    """All bits depend on all bits; different numbers stay different."""
    x = x ^ (x >> np.uint64(33))
    x = x * M1
    x ^= x >> np.uint64(33)
    x *= M2
    x ^= x >> np.uint64(33)
    return x


class Powers:
    """Powers of the base and of its inverse, as far as they have been asked for."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) <= n:
            step = len(self.up)
            for name, base in (("up", BASE), ("down", BASE_INVERSE)):
                held = getattr(self, name)
                factor = np.uint64(pow(int(base), step, 2 ** 64))
                setattr(self, name, np.concatenate([held, held * factor]))


class Spans:
    """Hashes of spans of one block of bytes."""

    def __init__(self, block: np.ndarray, powers: Powers):
        powers.reach(len(block) + 1)
        self.powers = powers
        self.codes = BYTE_CODES[block]
        self.sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(self.codes * powers.up[:len(block)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.powers.down[start])


def grams(codes: np.ndarray, length: int) -> np.ndarray:
    """Polynomial of every run of ``length`` codes, by doubling: as many entries as runs, not yet mixed."""
    held, reach, made, done = codes, 1, None, 0
    left = length
    while left:
        if left & 1:
            # the runs so far, followed by the next power of two
            if made is None:
                made, done = held, reach
            else:
                n = len(codes) - done - reach + 1
                factor = np.uint64(pow(int(BASE), reach, 2 ** 64))
                made = made[:n] * factor + held[done:done + n]
                done += reach
        left >>= 1
        if left:
            n = len(held) - reach
            factor = np.uint64(pow(int(BASE), reach, 2 ** 64))
            held = held[:max(n, 0)] * factor + held[reach:reach + max(n, 0)]
            reach *= 2
    return made


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by doubling."""
    held, reach = values, 1
    while reach * 2 <= width:
        held = np.minimum(held[:-reach], held[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(held[:len(held) - rest], held[rest:]) if rest else held
