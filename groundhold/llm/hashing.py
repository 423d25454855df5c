"""Words of a text and their hashes, for whole texts at once in numpy."""

from __future__ import annotations

import numpy as np

PRIME = 0x9E3779B97F4A7C15 | 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A full-avalanche finisher for 64-bit numbers."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class Polynomial:
    """Hashes of stretches of a sequence: differences of prefix sums of value times power.

    Arithmetic is modulo 2^64, where odd factors have inverses, so a stretch's hash
    does not depend on where it begins.
    """

    def __init__(self, base: int = PRIME):
        self.steps = base, pow(base, -1, 1 << 64)
        self.powers, self.inverse = (np.ones(1, np.uint64) for _ in range(2))

    def __call__(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(values) + 1
        if n > len(self.powers):
            tables = []
            for step in self.steps:
                row = np.full(2 * n, step, np.uint64)
                row[0] = 1
                tables.append(np.multiply.accumulate(row))
            self.powers, self.inverse = tables
        total = np.zeros(n, np.uint64)
        np.cumsum(values * self.powers[: n - 1], out=total[1:])
        return (total[ends] - total[starts]) * self.inverse[starts]


class Words:
    """Byte places and hashes of a text's words, A-Z lower-cased, parted by blanks and the controls 9 to 13."""

    def __init__(self) -> None:
        self.polynomial = Polynomial()
        self.space = np.zeros(256, bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, starts, ends, hashes)."""
        raw = np.frombuffer(("" if text is None else text).encode().lower(), np.uint8)
        edge = np.flatnonzero(np.diff(np.concatenate(([True], self.space[raw], [True])).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        if not len(starts):
            return raw, starts, ends, np.empty(0, np.uint64)
        hashes = self.polynomial(raw.astype(np.uint64) + np.uint64(1), starts, ends)
        return raw, starts, ends, mixed(hashes + (ends - starts).astype(np.uint64))
