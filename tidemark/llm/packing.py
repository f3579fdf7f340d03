"""Number arrays as compressed bytes, for rows that carry many numbers through a shuffle or a staged table."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

_CODEC = "zstd"
_LEVEL = 5


def planes(numbers: np.ndarray) -> bytes:
    """First bytes of all numbers, then their second bytes, and so on: this compresses better than the numbers."""
    numbers = np.ascontiguousarray(numbers)
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T).tobytes()


def pack(*arrays: np.ndarray) -> bytes:
    head = struct.pack("<B", len(arrays)) + b"".join(struct.pack("<3sQ", a.dtype.str.encode(), len(a)) for a in arrays)
    return head + pa.Codec(_CODEC, _LEVEL).compress(b"".join(map(planes, arrays)), asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    count, at = data[0], 1
    kinds = []
    for _ in range(count):
        name, n = struct.unpack_from("<3sQ", data, at)
        kinds.append((np.dtype(name.decode()), n))
        at += 11
    size = sum(kind.itemsize * n for kind, n in kinds)
    body = pa.decompress(memoryview(data)[at:], size, _CODEC, asbytes=True)
    out, at = [], 0
    for kind, n in kinds:
        part = np.frombuffer(body, np.uint8, kind.itemsize * n, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(part.T).view(kind).ravel())
        at += kind.itemsize * n
    return out


def pair_steps(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in ascending order as steps: of ``left`` to the one before, of ``right`` within an equal ``left``."""
    new = np.ones(len(left), bool)
    new[1:] = left[1:] != left[:-1]
    return np.diff(left, prepend=0), right - np.where(new, 0, np.concatenate(([0], right[:-1])))


def pairs_from(left_steps: np.ndarray, right_steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    new = left_steps != 0
    new[:1] = True
    total = np.cumsum(right_steps)
    first = np.flatnonzero(new)
    before = total[first] - right_steps[first]
    return np.cumsum(left_steps), total - np.repeat(before, np.diff(np.append(first, len(new))))
