"""Texts of a batch as one array of code points, with properties of code points from tables that fill themselves.

Python touches each different character once; everything else is array arithmetic over all texts of a batch."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


class CodeTable:
    """Columns of values per code point; `fill` gives a character's row when it is first met."""

    def __init__(self, columns: dict[str, type], fill: Callable[[str], tuple]):
        self.fill, self.names = fill, list(columns)
        self.known = np.zeros(0x110000, bool)
        self.columns = {name: np.zeros(0x110000, kind) for name, kind in columns.items()}

    def meet(self, codes: np.ndarray) -> None:
        fresh = codes[~self.known[codes]]
        for code in np.unique(fresh) if len(fresh) else ():
            for name, value in zip(self.names, self.fill(chr(code))):
                self.columns[name][code] = value
            self.known[code] = True

    def __getitem__(self, name: str) -> np.ndarray:
        return self.columns[name]


def code_points(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """All texts as one string and as code points, each with a line break behind it, and their lengths without it."""
    whole = "\n".join([*texts, ""])
    return whole, np.frombuffer(whole.encode("utf-32-le", "replace"), np.uint32), np.fromiter(map(len, texts), np.int64, len(texts))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP ** k and its inverse for k = 0 … n."""
    if len(_POWERS[0]) <= n:
        size = max(2 * n, 1 << 16)
        for k, base in enumerate((STEP, _BACK)):
            with np.errstate(over="ignore"):
                _POWERS[k] = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, base)]))
    return _POWERS[0], _POWERS[1]


class Rolling:
    """Hashes of any stretch of an array of values: the same values give the same hash wherever they stand."""

    def __init__(self, values: np.ndarray):
        self.power, self.back = powers(len(values))
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values.astype(np.uint64) * self.power[: len(values)], dtype=np.uint64)])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[end] - self.sums[begin]) * self.back[begin]


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


def text_hash(text: str) -> int:
    """A hash of a short name that is the same on every machine."""
    value = 0xCBF29CE484222325
    for byte in text.encode():
        value = (value ^ byte) * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
    return value


def spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of true flags begin and end; the last flag must be false."""
    before = np.concatenate([np.zeros(1, bool), flags[:-1]])
    return np.flatnonzero(flags & ~before), np.flatnonzero(~flags & before)
