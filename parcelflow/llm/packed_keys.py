"""Counted 64-bit keys that travel packed: one row per hash range, sorted and delta-coded.

A row of single keys costs many times the key in a shuffle.  Here a task's distinct keys of one range
of the key space are one row of two compressed arrays; ``totals`` adds up the rows that met in a range.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard


def _planes(numbers: np.ndarray) -> bytes:
    """Byte by byte from the lowest: the high bytes of small numbers are zeros."""
    return zstandard.compress(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()


def packed(sorted_keys: np.ndarray) -> bytes:
    """Sorted unsigned keys, by their steps."""
    return _planes(np.diff(sorted_keys, prepend=np.uint64(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(_numbers(data).astype(np.uint64), dtype=np.uint64)


def small(numbers: np.ndarray) -> bytes:
    """Non-negative integers, most of them small."""
    return _planes(numbers)


def unsmall(data: bytes) -> np.ndarray:
    return _numbers(data).view("<i8")


def edges(ranges: int, bits: int) -> np.ndarray:
    """First key of each range but the first: the space of keys of ``bits`` bits in equal parts."""
    return np.array([(i << bits) // ranges for i in range(1, ranges)], np.uint64)


def borders(keys: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Where each range begins in the sorted keys, and where the last one ends."""
    return np.r_[0, np.searchsorted(keys, cuts, "left"), len(keys)]


def rows(keys: np.ndarray, times: np.ndarray, cuts: np.ndarray) -> pd.DataFrame:
    """(range, keys, times): one row per range that some sorted key lies in."""
    at = borders(keys, cuts)
    some = np.flatnonzero(np.diff(at)).tolist()
    return pd.DataFrame({"range": some, "keys": [packed(keys[at[r]:at[r + 1]]) for r in some],
                         "times": [small(times[at[r]:at[r + 1]]) for r in some]})


def totals(met: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(distinct keys, their sums, and for every row the places of its keys among them)."""
    keys = [unpacked(x) for x in met["keys"]]
    every, number = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(every), np.int64)
    np.add.at(total, number, np.concatenate([unsmall(x) for x in met["times"]]))
    return every, total, np.split(number, np.cumsum([len(k) for k in keys])[:-1])


def cut_bits(distinct: int, spare: int = 5) -> int:
    """Bits that tell about ``distinct`` hashes apart, but for one in 2 ** ``spare``."""
    return min(64, max(16, distinct.bit_length() + spare))
