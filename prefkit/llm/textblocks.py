"""Vectorised passes over blocks of texts: code points, chunks, word hashes.

Everything here works on one Arrow batch inside a task, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Characters (or bytes) that one block holds, unless a single text is longer.
BLOCK = 1 << 20
#: Bytes that one block of bytes holds, unless a single text is longer: each costs some 80 bytes of arrays.
BYTE_BLOCK = 1 << 18
_U = np.uint64
_SEED = np.random.Generator(np.random.PCG64(20240601))
#: Random 64-bit value per byte, for word hashes.
_BYTE = _SEED.integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_GOLDEN = _U(0x9E3779B97F4A7C15)

#: Whether a byte separates words: space and 0x09 to 0x0D.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z lower-cased, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def weights(n: int) -> np.ndarray:
    """An odd pseudo-random 64-bit number for each of the positions 0 .. n - 1."""
    global _weights
    if len(_weights) >= n:
        return _weights[:n]
    made = mixed((np.arange(n, dtype=np.uint64) + _U(1)) * _GOLDEN ^ _U(0x2545F4914F6CDD1D)) | _U(1)
    if n <= BLOCK:
        _weights = made
    return made


_weights = np.zeros(0, np.uint64)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end) of ``values`` (uint64); ascending, not overlapping.

    A value is multiplied by the random number of its place in the span (no powers of one base: a
    polynomial modulo 2 ** 64 maps certain texts of two letters to one number, whatever its base)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    longest = int((ends - starts).max())
    begin = np.zeros(len(values), np.int64)
    begin[starts[1:]] = np.diff(starts)
    begin[starts[0]] += starts[0]
    place = np.arange(len(values))
    place -= np.cumsum(begin, out=begin)
    weighted = weights(longest)[np.clip(place, 0, longest - 1, out=place)]
    weighted *= values
    del begin, place
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(weighted, out=sums[1:])
    return mixed(sums[ends] - sums[starts] ^ (ends - starts).astype(np.uint64) * _GOLDEN)


def text_blocks(column: pa.Array, block: int = BLOCK) -> Iterator[tuple[int, list[str]]]:
    """(index of the first, texts) of runs of texts that hold about ``block`` characters; null: ''."""
    out, size, first = [], 0, 0
    for i, text in enumerate(column):
        text = text.as_py() or ""
        out.append(text)
        size += len(text)
        if size >= block:
            yield first, out
            out, size, first = [], 0, i + 1
    if out:
        yield first, out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and their n + 1 offsets (null: no bytes)."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_blocks(column: pa.Array, block: int = BYTE_BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, offsets) of runs of texts of about ``block`` bytes."""
    data, offsets = text_bytes(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + block, "right")) - 1)
        yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block, and the index of each word's text."""
    part = ~SEPARATOR[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], part[:-1]]) if len(part) else part
    after = np.concatenate([part[1:], [False]]) if len(part) else part
    starts = np.flatnonzero(part & (~before | edge[:-1]))
    ends = np.flatnonzero(part & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words with A-Z lower-cased."""
    return span_hashes(_BYTE[LOWER[data]], starts, ends)
