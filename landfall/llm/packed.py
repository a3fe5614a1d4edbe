"""Sorted numbers in few bytes, for shuffles of very many hashes.

A sorted array of hashes goes as the differences between neighbours, in as many
bytes as the largest needs, byte by byte rather than number by number: first all
lowest bytes, then all second ones. Numbers that go with them are packed alike.
Of a million hashes of 40 bits each takes three bytes instead of eight.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

HASH_BITS = 40


def planes(numbers: np.ndarray) -> bytes:
    """The least number of bytes that holds each value, then the bytes by place."""
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    raw = np.ascontiguousarray(numbers, "<u8").view(np.uint8).reshape(-1, 8)
    return bytes([width]) + raw[:, :width].T.tobytes()


def values(raw: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    """What ``planes`` was given, n numbers, and where they end."""
    width = raw[at]
    found = np.frombuffer(raw, np.uint8, width * n, at + 1).reshape(width, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = found.T
    return out.view("<u8")[:, 0], at + 1 + width * n


def pack(ordered: np.ndarray, *more: np.ndarray) -> bytes:
    """Ascending numbers, and others that go with each."""
    steps = np.diff(ordered.astype(np.uint64), prepend=np.uint64(0))
    return len(ordered).to_bytes(4, "little") + b"".join(map(planes, (steps, *more)))


def unpack(raw: bytes, more: int = 0) -> list[np.ndarray]:
    """What ``pack`` was given, as unsigned 64-bit numbers."""
    n = int.from_bytes(raw[:4], "little")
    out, at = [], 4
    for _ in range(1 + more):
        found, at = values(raw, at, n)
        out.append(found)
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def short(h: np.ndarray, bits: int = HASH_BITS) -> np.ndarray:
    """The upper bits of 64-bit hashes."""
    return h.astype(np.uint64) >> np.uint64(64 - bits)


def part_of(h: np.ndarray, parts: int, bits: int = HASH_BITS) -> np.ndarray:
    """Which of ``parts`` equal ranges a hash of so many bits lies in; ascending."""
    return (h * np.uint64(parts) >> np.uint64(bits)).astype(np.int64)


def groups(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str]
) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """The rows of each key, one key after the other, out of sorted batches."""
    now, held = None, []
    for batch in batches:
        columns = [batch[k].to_pylist() for k in keys]
        at = 0
        for k, key in enumerate(zip(*columns)):
            if key != now:
                if k > at:
                    held.append(batch.slice(at, k - at))
                if held:
                    yield now, held
                now, held, at = key, [], k
        if batch.num_rows > at:
            held.append(batch.slice(at))
    if held:
        yield now, held
