"""Tokens without stop words of whole Arrow text columns.

The same tokens as ML ``RegexTokenizer(pattern="\\\\W")`` and
``StopWordsRemover`` give, found by one pass over the bytes: a word is a run
of ASCII letters, digits and underscores, lower-cased; every other character
parts words.  Two characters outside ASCII have a lower case with an ASCII
letter, the Kelvin sign (k) and the dotted capital I (i and a combining dot).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text whose words are found at once (or one text that is longer)
TEXT_BYTES = 1 << 21

_WORD = np.zeros(256, bool)
_LOWER = np.arange(256, dtype=np.uint8)
for _first, _last in ("09", "AZ", "az", "__"):
    _WORD[ord(_first):ord(_last) + 1] = True
_LOWER[0x41:0x5B] += 0x20


def stop_set(stopwords) -> pa.Array:
    return pa.array(sorted({w.lower() for w in stopwords}), pa.string())


def slices(column: pa.Array):
    """(row, rows) of runs of texts of some TEXT_BYTES."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, seen = 0, 0
    while at < len(column):
        to = max(int(np.searchsorted(ends, seen + TEXT_BYTES, side="right")), at + 1)
        yield at, column.slice(at, to - at)
        at, seen = to, int(ends[to - 1])


def kept_words(texts: pa.Array, stops: pa.Array) -> pa.ListArray:
    """The words of each text that aren't in ``stops``; a null text has a null
    list."""
    texts = texts.cast(pa.large_string())
    for char, lower in (("\u212a", "k"), ("\u0130", "i\u0307")):
        if pc.any(pc.match_substring(texts, char)).as_py():
            texts = pc.replace_substring(texts, char, lower)
    texts_ = pc.fill_null(texts, "")
    off = np.frombuffer(texts_.buffers()[1], np.int64)[texts_.offset:texts_.offset + len(texts_) + 1]
    data = texts_.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.empty(0, np.uint8)
    off = off - off[0]
    word = _WORD[raw]
    edge = np.ones(len(raw) + 1, bool)  # between two bytes: a word can't go on
    edge[1:-1] = ~(word[1:] & word[:-1])
    edge[off] = True
    first, last = np.flatnonzero(word & edge[:-1]), np.flatnonzero(word & edge[1:])
    ends = np.concatenate(([0], np.cumsum(last + 1 - first)))
    found = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(ends.astype(np.int64)),
                                                                 pa.py_buffer(_LOWER[raw[word]])])
    keep = pc.invert(pc.is_in(found, value_set=stops.cast(pa.large_string())))
    before = np.concatenate(([0], np.cumsum(keep.to_numpy(zero_copy_only=False))))
    at = before[np.searchsorted(first, off)]
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), found.filter(keep).cast(pa.string()),
                                    mask=pc.is_null(texts) if texts.null_count else None)
