"""Hashes of words and of runs of words, for whole Arrow batches at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa

ODD = np.uint64(0x9E3779B97F4A7C15)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def words_of(text: pa.Scalar, lower: bool = False) -> list[bytes]:
    """Runs of anything but ASCII white space, which is what bytes.split() parts at."""
    buffer = text.as_buffer() if text.is_valid else None
    if buffer is None:
        return []
    raw = buffer.to_pybytes()
    return (raw.lower() if lower else raw).split()


def hashed(words: list[bytes]) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    column = np.empty(len(words), dtype=object)
    column[:] = words
    return pd.util.hash_array(column, categorize=False)


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of `length` words; empty if there are fewer."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(count, np.uint64(length))
    for i in range(length):
        total = total * ODD + hashes[i:i + count]
    return mixed(total)
