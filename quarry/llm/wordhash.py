"""Vectorised word hashing of Arrow text columns, used inside Spark tasks.

A text column is cut into buffers of a few megabytes at word boundaries; one
pass of numpy over a buffer gives a 64-bit hash for every word of every text
in it (a polynomial over the bytes modulo 2^64 with a random table per byte,
then mixed).  Whole texts are always read: a text longer than a buffer is
continued in the next one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text hashed at once; bounds the memory of a task, not the result
BUFFER_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on a uint64 array."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))

#: ASCII white space: 0x20 and 0x09-0x0D
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: A-Z to a-z, all other bytes unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_LOWERED_TABLE = _TABLE[LOWER]

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        p = np.full(max(n, BUFFER_BYTES + 1), base, dtype=np.uint64)
        p[0] = 1
        have = _powers[base] = np.multiply.accumulate(p)
    return have[:n]


_INVERSE = pow(_BASE, -1, 1 << 64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text is an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def buffers(raw: np.ndarray, offsets: np.ndarray, size: int | None = None, gap: np.ndarray = SPACE):
    """Ranges of ``raw`` of about ``size`` bytes that end at a text's end or
    at a byte in ``gap``, so that no word is cut."""
    size = size or BUFFER_BYTES
    start, total = 0, len(raw)
    while start < total:
        end = min(start + size, total)
        if end < total:
            k = np.searchsorted(offsets, end, side="right") - 1
            if offsets[k] > start:
                end = int(offsets[k])
            else:  # one long text: cut before the next gap
                while end < total and not gap[raw[end]] and end < offsets[k + 1]:
                    end += 1
        yield start, end
        start = end


def words(raw: np.ndarray, offsets: np.ndarray,
          gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of the text it is in), in reading order.
    Words are runs without a byte in ``gap``, A-Z lower-cased."""
    hashes, texts = [], []
    for start, end in buffers(raw, offsets, gap=gap):
        part = raw[start:end]
        solid = ~gap[part]
        edge = np.zeros(len(part) + 1, dtype=bool)
        inner = offsets[(offsets > start) & (offsets < end)] - start
        edge[inner] = True
        edge[0] = edge[-1] = True
        before = np.empty(len(part), dtype=bool)
        before[0] = True
        before[1:] = ~solid[:-1]
        first = np.flatnonzero(solid & (before | edge[:-1]))
        after = np.empty(len(part), dtype=bool)
        after[-1] = True
        after[:-1] = ~solid[1:]
        last = np.flatnonzero(solid & (after | edge[1:])) + 1
        if not len(first):
            continue
        total = np.empty(len(part) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(_LOWERED_TABLE[part] * _power(_BASE, len(part)), out=total[1:])
        h = (total[last] - total[first]) * _power(_INVERSE, len(part) + 1)[first]
        hashes.append(mix(h + (last - first).astype(np.uint64)))
        texts.append(np.searchsorted(offsets, first + start, side="right") - 1)
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(texts)


def slices(column: pa.Array, size: int | None = None):
    """(first row, rows after the last, bytes, offsets) of a column, a few
    megabytes of text at a time (at least one whole text)."""
    size = size or BUFFER_BYTES
    raw, offsets = text_bytes(column)
    n, row = len(offsets) - 1, 0
    while row < n:
        to = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        to = min(max(to, row + 1), n, row + 100_000)
        yield row, to, raw[offsets[row]:offsets[to]], offsets[row:to + 1] - offsets[row]
        row = to
    pa.default_memory_pool().release_unused()


def shingles(hashes: np.ndarray, texts: np.ndarray, n_texts: int,
             width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, texts, counts): the distinct ``width``-word shingles of each
    text, sorted by text, then hash.  A text of fewer words has its whole
    sequence as one shingle; one without words has none."""
    n_words = np.bincount(texts, minlength=n_texts)
    begin = np.concatenate(([0], np.cumsum(n_words)))
    parts, owner = [], []
    if len(hashes) >= width:
        whole = texts[:-(width - 1)] == texts[width - 1:] if width > 1 else np.ones(len(texts), bool)
        at = np.flatnonzero(whole)
        h = np.full(len(at), np.uint64(width), dtype=np.uint64)
        for k in range(width):
            h = mix(h * np.uint64(_BASE) + hashes[at + k])
        parts.append(h)
        owner.append(texts[at])
    for t in np.flatnonzero((n_words > 0) & (n_words < width)):
        h = np.array([n_words[t]], dtype=np.uint64)
        for k in range(begin[t], begin[t + 1]):
            h = mix(h * np.uint64(_BASE) + hashes[k:k + 1])
        parts.append(h)
        owner.append(np.array([t]))
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(n_texts, np.int64)
    h, o = np.concatenate(parts), np.concatenate(owner)
    order = np.lexsort((h, o))
    h, o = h[order], o[order]
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    h, o = h[fresh], o[fresh]
    return h, o, np.bincount(o, minlength=n_texts)
