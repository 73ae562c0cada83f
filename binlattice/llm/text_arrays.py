"""Hashes of words and n-grams of Arrow text batches, by NumPy over their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_FACTOR = 0x9E3779B97F4A7C15 | 1
_BASE = np.uint64(_FACTOR)
_BASE_INVERSE = np.uint64(pow(_FACTOR, -1, 1 << 64))
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)

WHITE_CLASS = np.ones(256, np.uint8)
WHITE_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
#: 0 white space, 1 letters, digits and all bytes beyond ASCII, 2 other ASCII characters.
RUN_CLASS = np.full(256, 2, np.uint8)
RUN_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
RUN_CLASS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _grown(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        n = max(n, 1 << 21)
        _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, _BASE)]))
        _inverses = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, _BASE_INVERSE)]))


def chunks(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of a string column, about ``limit`` bytes or one longer row at a time."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        end = min(end, len(column))
        yield at, end, raw[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


#: Bytes that are hashed at a time.
PIECE = 1 << 20


def run_hashes(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of bytes of one class other than 0, index of the first run of each row and the end).

    Works on ``piece`` bytes at a time, and a run that goes on in the next piece is carried over, so that a
    very long text takes memory for its runs but not many times its bytes.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    carried: tuple[int, int, int, int] | None = None  # kind, start, sum, length of the run that is still open
    for at in range(0, len(data), piece):
        kind, starts, sums, lengths = _runs(data[at : at + piece], offsets, at, classes)
        if carried and starts[0] == at and kind[0] == carried[0] and offsets[np.searchsorted(offsets, at)] != at:
            _, start, before, n = carried
            starts[0], lengths[0] = start, lengths[0] + n
            sums[0] = np.uint64((before + int(sums[0]) * pow(_FACTOR, n, 1 << 64)) % (1 << 64))
        elif carried:
            starts, kind = np.append(np.int64(carried[1]), starts), np.append(np.uint8(carried[0]), kind)
            sums, lengths = np.append(np.uint64(carried[2]), sums), np.append(np.int64(carried[3]), lengths)
        carried = (int(kind[-1]), int(starts[-1]), int(sums[-1]), int(lengths[-1]))
        starts, kind, sums, lengths = starts[:-1], kind[:-1], sums[:-1], lengths[:-1]
        if at + piece >= len(data):
            starts, kind = np.append(starts, np.int64(carried[1])), np.append(kind, np.uint8(carried[0]))
            sums, lengths = np.append(sums, np.uint64(carried[2])), np.append(lengths, np.int64(carried[3]))
        inside = kind != 0
        found.append((starts[inside], mix(sums[inside] + lengths[inside].astype(np.uint64))))
    if not found:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    starts = np.concatenate([s for s, _ in found])
    return np.concatenate([h for _, h in found]), np.searchsorted(starts, offsets)


def _runs(data: np.ndarray, offsets: np.ndarray, at: int, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(class, start, polynomial sum, length) of the runs of a piece that begins at byte ``at``."""
    n = len(data)
    kind = classes[data]
    edge = np.empty(n, bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    rows = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, at + n)] - at
    edge[rows] = True
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], n)
    _grown(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[:n], out=sums[1:])
    return kind[starts], starts + at, (sums[ends] - sums[starts]) * _inverses[starts], ends - starts


def ngrams(words: np.ndarray, k: int) -> np.ndarray:
    """Order-sensitive hash of each run of k neighbouring words."""
    out = words[: max(0, len(words) - k + 1)].copy()
    for j in range(1, k):
        out = mix(out) + words[j : len(words) - k + 1 + j]
    return mix(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """For each row the sorted distinct k-word shingles; of fewer words, one for the whole row; none without words."""
    words, first = run_hashes(ASCII_LOWER[data], offsets, WHITE_CLASS)
    grams = ngrams(words, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            out.append(ngrams(words[a:b], b - a))
        else:
            out.append(np.empty(0, np.uint64))
    return out
