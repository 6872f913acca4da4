"""64-bit hashes of byte strings, for many of them at once.

A string is hashed as a polynomial of per-byte random numbers in an odd base, modulo 2**64, through
running sums: any window costs two look-ups. ``mix`` spreads the result over all bits.
"""

import numpy as np

_RANDOM = np.random.Generator(np.random.PCG64(2024))
#: A random number for every byte value, and the base of the polynomial with its inverse.
BYTE_VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of the base and of its inverse, kept as far as they were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if count > len(self.up):
            size = max(count, 2 * len(self.up))
            both = []
            for base in (BASE, INVERSE):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                both.append(np.cumprod(steps))
            self.up, self.down = both
        return self.up[:count], self.down[:count]


def running_sums(raw: np.ndarray, powers: Powers) -> np.ndarray:
    """The polynomial's sum over the bytes before each place, for any number of windows."""
    up, _ = powers.get(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[raw] * up[: len(raw)], out=sums[1:])
    return sums


def hashes_between(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """``window_hashes`` from the running sums of the bytes."""
    _, down = powers.get(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hashes_of_width(sums: np.ndarray, width: int, powers: Powers) -> np.ndarray:
    """The hash of the ``width`` bytes from each place on."""
    _, down = powers.get(len(sums))
    return mix((sums[width:] - sums[:-width]) * down[: len(sums) - width] + np.uint64(width))


def window_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """Hash of raw[start:end] for each window; equal strings have equal hashes wherever they stand."""
    return hashes_between(running_sums(raw, powers), starts, ends, powers)
