"""Word shingles of texts as sets of 64-bit hashes, many texts at a time."""

from __future__ import annotations

import numpy as np

from prefkit.llm.textblocks import mixed, word_hashes, word_spans

_U = np.uint64


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``n`` words of each text of a block: (hashes, n + 1 bounds by text).

    Words are runs of characters other than space and 0x09 to 0x0D, A-Z lower-cased. A text of fewer
    words has its whole sequence as one shingle; a text without words has none. The hashes of a text
    are in ascending order.
    """
    texts = len(offsets) - 1
    starts, ends, owner = word_spans(data, offsets)
    words = word_hashes(data, starts, ends)
    count = np.bincount(owner, minlength=texts)
    first = np.cumsum(count) - count
    hashes, owners = [], []
    for k in range(1, n + 1):
        if k < n:
            at = first[count == k]
        else:
            at = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :]) if len(owner) >= n else first[:0]
        h = mixed(words[at] + _U(k))
        for j in range(1, k):
            h = mixed(h * _U(0x9E3779B97F4A7C15) ^ words[at + j])
        hashes.append(h)
        owners.append(owner[at])
    h, o = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((h, o))
    h, o = h[order], o[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    h, o = h[new], o[new]
    return h, np.searchsorted(o, np.arange(texts + 1))


def set_prints(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of each set (0 for an empty one)."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(hashes ^ _U(0x5851F42D4C957F2D)))])
    size = np.diff(bounds).astype(np.uint64)
    return np.where(size > 0, mixed(sums[bounds[1:]] - sums[bounds[:-1]] + size), _U(0))
