"""Vectorised tokenising of Arrow text columns: all documents of a batch are handled as one byte buffer."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, 1 << 20)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[int(base)] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offset of each (one more than rows); null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if raw[2] is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(raw[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def byte_table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


#: A-Z to a-z, all other bytes as they are.
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
#: Lower-case ASCII letters, digits and every byte of a non-ASCII character (after lower-casing).
ALNUM_OR_WIDE = byte_table(bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100)))
#: Everything but space and the ASCII controls tab to carriage return.
NOT_BLANK = ~byte_table(b" \t\n\x0b\x0c\r")


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of `mask` within a row, and the index of each row's first run."""
    n = len(mask)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = mask[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = mask[1:]
    starts = np.flatnonzero(mask & (~before | first[:-1]))
    ends = np.flatnonzero(mask & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash modulo 2**64; see span_hash."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power_table(_BASE, len(data)), out=out[1:])
    return out


def inverse_powers(n: int) -> np.ndarray:
    """Factors that make a difference of prefix sums independent of its place, for the first n places."""
    return _power_table(_BASE_INVERSE, n)


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for many spans; equal spans have equal hashes wherever they stand."""
    inverse = _power_table(_BASE_INVERSE, len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hash(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words; as many as words, the last k - 1 are padding of value 2**64 - 1."""
    n = len(words)
    out = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    if n >= k:
        acc = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            acc = acc * np.uint64(0x100000001B3) + words[j : n - k + 1 + j]
        out[: n - k + 1] = mix(acc)
    return out


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values[bounds[i]:bounds[i+1]] for each row."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts as UTF-32 code points, and the offset of each row in them."""
    lead = (data & 0xC0) != 0x80
    count = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=count[1:])
    return np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32), count[offsets]
