"""Word-shingle sets of whole texts, computed inside tasks over Arrow batches.

Words are runs of bytes other than ASCII white space, A-Z lowered.  A word is
hashed by a polynomial over its bytes, a shingle by a combination of its words'
hashes; both are 64 bits and mixed.  Everything is arithmetic on whole batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

K = 5
_SLICE = 2_000_000  # bytes hashed at a time; a longer text is cut between words

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))[_LOWER]
_TURN = mixed(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def _word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document number of every word; ``bounds``: where documents begin and end."""
    n = len(data)
    word = ~_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    edges = bounds[(bounds > 0) & (bounds < n)]
    first[edges] = word[edges]
    last[edges - 1] = word[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _power_tables(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * power, out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    documents = np.searchsorted(bounds, starts, "right") - 1
    return mixed(hashes + (ends - starts).astype(np.uint64)), documents


def _long_text(data: np.ndarray) -> np.ndarray:
    parts, at = [], 0
    while at < len(data):
        end = at + _SLICE
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        end = min(end, len(data))
        parts.append(_word_hashes(data[at:end], np.array([0, end - at]))[0])
        at = end
    return np.concatenate(parts)


def _combined(words: np.ndarray, k: int) -> np.ndarray:
    n = len(words) - k + 1
    total = np.full(n, k, np.uint64)
    for j in range(k):
        total += words[j : j + n] * _TURN[j]
    return mixed(total)


def shingle_sets(texts: pa.Array, k: int = K) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order.

    A text with fewer than ``k`` words has its whole sequence as one shingle;
    NULL and texts without words have none.
    """
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _SLICE, "right")) - 1)
        part = data[offsets[at] : offsets[end]]
        if len(part) > _SLICE:
            yield _one(_long_text(part), k)
        elif len(part) == 0:
            yield from (np.zeros(0, np.uint64) for _ in range(at, end))
        else:
            words, documents = _word_hashes(part, offsets[at : end + 1] - offsets[at])
            cuts = np.searchsorted(documents, np.arange(end - at + 1))
            whole = _combined(words, k) if len(words) >= k else np.zeros(0, np.uint64)
            for a, b in zip(cuts[:-1], cuts[1:]):
                yield np.unique(whole[a : b - k + 1]) if b - a >= k else _one(words[a:b], k)
        at = end


def _one(words: np.ndarray, k: int) -> np.ndarray:
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    return np.unique(_combined(words, min(k, len(words))))


def signature(tokens: np.ndarray) -> int:
    """A signed 64-bit name of a set; equal sets have equal names."""
    total = np.sum(mixed(tokens ^ np.uint64(0x2545F4914F6CDD1D)), dtype=np.uint64)
    return int(mixed(np.array([total + np.uint64(len(tokens))]))[0].view(np.int64))
