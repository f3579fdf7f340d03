"""Words and hashes of many texts at once, as numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes between words: space and the five controls from tab to carriage return.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_rng = np.random.default_rng(20250131)
_BYTE_CODE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (multiply and shift rounds)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column and the n+1 offsets of its values; a null has no bytes."""
    if pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        column, width = column.cast(pa.binary()), np.int32
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, dtype=width, count=n + 1 + column.offset)[column.offset :].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


@dataclass
class Words:
    """Words of several texts: ``data[start:end]`` each, ``doc`` the row; ``first`` has n+1 word offsets by row."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of the bytes of each word, the same wherever the word stands."""
        n = len(self.start)
        if n == 0:
            return np.zeros(0, np.uint64)
        length = self.end - self.start
        begin = np.cumsum(length) - length
        offset = np.arange(int(length.sum())) - np.repeat(begin, length)
        taken = self.data[np.repeat(self.start, length) + offset]
        with np.errstate(over="ignore"):
            value = _BYTE_CODE[taken] * powers(int(length.max()))[offset]
        return mix(np.add.reduceat(value, begin) + length.astype(np.uint64))


def words(column: pa.Array, lower: bool = False) -> Words:
    data, at = buffers(column)
    if lower:
        data = _LOWER[data]
    n = len(at) - 1
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    gap = np.concatenate(([True], _SPACE[data], [True])) if len(data) else np.ones(2, bool)
    inside = ~gap[1:-1]
    start = np.flatnonzero(inside & (gap[:-2] | edge[:-1])) if len(data) else np.zeros(0, np.int64)
    end = np.flatnonzero(inside & (gap[2:] | edge[1:])) + 1 if len(data) else np.zeros(0, np.int64)
    doc = np.searchsorted(at, start, side="right") - 1
    return Words(data, start, end, doc, np.searchsorted(start, at) if n else np.zeros(1, np.int64))


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` values (64-bit codes), by doubling; shorter input has none."""
    if len(values) < width:
        return np.zeros(0, np.uint64)
    base = 0xD6E8FEB86659FD93
    out, have = values, 1
    with np.errstate(over="ignore"):
        for bit in bin(width)[3:]:
            weight = np.uint64(pow(base, have, 1 << 64))
            out, have = out[: len(out) - have] * weight + out[have:], 2 * have
            if bit == "1":
                out, have = out[:-1] * np.uint64(base) + values[have : have + len(out) - 1], have + 1
    return mix(out)


class Segments:
    """Hashes of any stretches of a sequence of 64-bit codes, from one pass over it."""

    def __init__(self, values: np.ndarray):
        base = 0xC2B2AE3D27D4EB4F
        with np.errstate(over="ignore"):
            self.total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * powers(len(values), np.uint64(base)))))
            self.back = powers(len(values) + 1, np.uint64(pow(base, -1, 1 << 64)))

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            found = (self.total[end] - self.total[start]) * self.back[start]
        return mix(found ^ mix((end - start).astype(np.uint64)))


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Smallest or largest of each run of ``width`` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out
