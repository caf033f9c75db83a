"""Token ids, packed by best-fit decreasing into fixed-width matrices.

Every task tokenises its documents with a public byte-level vocabulary (its
path is a parameter), cuts documents longer than a row without loss, and
packs windows of about ``window`` tokens: pieces in the order of decreasing
size each go to the fullest open row that still has room.  A segment tree
over capacities (leaf r: the open rows with r free ids) finds that row in
the logarithm of the row's width.  Rows that are not nearly full are carried
into the next window of the same task, so only a task's last rows have much
padding.

A packed row holds the ids (little-endian uint16 or uint32, by the size of
the vocabulary), the cumulative segment lengths (int32, from 0), a bit per id
that is 1 where positions start again from 0, and the documents and their
first token in the document, so every document can be put together again.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import write_table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: the pre-tokeniser that belongs to the vocabulary (a fixed value)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WIDTH, WINDOW = 2048, 1 << 21


#: the pattern's white space (Unicode), in runs that its look-ahead would backtrack over
_LONG_GAP = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2000,}")


@lru_cache(maxsize=2)
def encoding(vocabulary: bytes, pattern: str = PATTERN) -> tiktoken.Encoding:
    """Encoder of a vocabulary file's bytes."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("ids", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encoder(path: str, pattern: str = PATTERN) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        return encoding(f.read(), pattern)


def encode(enc: tiktoken.Encoding, text: str) -> np.ndarray:
    """The ids of a whole text, as the plain encoder gives them.

    In a run of white space the pattern takes all but the last character as
    one piece, or all of them where the text ends; long runs are cut out that
    way here, since the pattern itself fails on them."""
    out, at = [], 0
    for m in _LONG_GAP.finditer(text):
        last = m.end() if m.end() == len(text) else m.end() - 1
        if m.start() > at:
            out.append(enc.encode_to_numpy(text[at:m.start()], disallowed_special=()))
        out.append(np.array(enc._encode_single_piece(text[m.start():last]), dtype=np.uint32))
        at = last
    if at < len(text):
        out.append(enc.encode_to_numpy(text[at:], disallowed_special=()))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


class CapacityTree:
    """Open rows by free ids; ``tightest(size)`` takes the one with the least
    room that is enough."""

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def put(self, row: int, free: int):
        self.rows[free].append(row)
        at = self.leaves + free
        while at:
            self.count[at] += 1
            at >>= 1

    def tightest(self, size: int):
        """(row, free) or None; the row is taken out."""
        at = self.leaves + size
        while not self.count[at]:
            while at & 1:  # go up to the next subtree on the right
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at if self.count[2 * at] else 2 * at + 1
        free = at - self.leaves
        row = self.rows[free].pop()
        while at:
            self.count[at] -= 1
            at >>= 1
        return row, free


def best_fit_decreasing(sizes, width: int, free=()) -> list[int]:
    """Row of each piece; rows 0.. are the open ones of ``free``, new rows
    follow.  Sizes are 1..width."""
    tree, n = CapacityTree(width), 0
    for room in free:
        if room:
            tree.put(n, room)
        n += 1
    out = [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        got = tree.tightest(sizes[k])
        if got is None:
            row, room, n = n, width, n + 1
        else:
            row, room = got
        out[k] = row
        if room > sizes[k]:
            tree.put(row, room - sizes[k])
    return out


def _row(pieces, width: int, dtype) -> tuple:
    """One packed row of [(id, first token, ids)]."""
    ids = np.zeros(width, dtype=dtype)
    ends = np.concatenate(([0], np.cumsum([len(p[2]) for p in pieces]))).astype("<i4")
    resets = np.zeros(width, dtype=np.uint8)
    resets[ends[:-1]] = 1
    for p, a in zip(pieces, ends.tolist(), strict=False):
        ids[a:a + len(p[2])] = p[2]
    return (int(ends[-1]), [p[0] for p in pieces], [p[1] for p in pieces], ids.tobytes(), ends.tobytes(),
            np.packbits(resets).tobytes())


_PACKED = pa.schema([("row_id", pa.int64()), ("n_tokens", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                     ("first_tokens", pa.list_(pa.int64())), ("ids", pa.binary()), ("cu_seqlens", pa.binary()),
                     ("resets", pa.binary())])
_PACKED_DDL = ("row_id bigint, n_tokens int, doc_ids array<bigint>, first_tokens array<bigint>, ids binary, "
               "cu_seqlens binary, resets binary")


def _pack_task(vocabulary, width: int, window: int):
    def run(batches):
        enc = encoding(vocabulary.value)
        dtype = "<u2" if enc.n_vocab <= 1 << 16 else "<u4"
        part, made = TaskContext.get().partitionId(), 0
        open_rows: list[list] = []
        held: list = []

        def emit(rows):
            nonlocal made
            for a in range(0, len(rows), 512):
                packed = [((part << 32) | (made + k), *_row(r, width, dtype)) for k, r in enumerate(rows[a:a + 512])]
                made += len(packed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*packed, strict=True), _PACKED, strict=True)],
                    schema=_PACKED)

        def settle(last):
            nonlocal open_rows, held
            at = best_fit_decreasing([len(p[2]) for p in held], width,
                                     [width - sum(len(p[2]) for p in r) for r in open_rows])
            rows = open_rows + [[] for _ in range(max(at, default=-1) + 1 - len(open_rows))]
            for p, k in zip(held, at, strict=True):
                rows[k].append(p)
            held = []
            # nearly full rows are done; the others wait for smaller pieces
            full = lambda r: sum(len(p[2]) for p in r) > 0.98 * width
            open_rows = [] if last else [r for r in rows if not full(r)][:4 * window // width]
            waiting = {id(r) for r in open_rows}
            yield from emit([r for r in rows if id(r) not in waiting])

        total = 0
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                some = batch.slice(a, 256)
                for doc, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    if not text:
                        continue
                    ids = encode(enc, text).astype(dtype)
                    held += [(doc, k, ids[k:k + width]) for k in range(0, len(ids), width)]
                    total += len(ids)
                    if total >= window:
                        yield from settle(False)
                        total = 0
        yield from settle(True)
    return run


def packed_ids(docs: DataFrame, vocabulary: str = VOCABULARY, width: int = WIDTH, window: int = WINDOW,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table of packed rows: ``row_id, n_tokens, doc_ids,
    first_tokens, ids, cu_seqlens, resets``.  The driver reads ``vocabulary``
    and broadcasts its bytes (a fixed size), so executors need no file.

    Edge cases: texts may be of any length, also long runs of white space or
    of one letter; null and empty texts have no ids and are in no row; a null id
    stays null in ``doc_ids``; repeated rows are packed each; other columns
    aren't read; an empty table gives an empty result."""
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    with open(vocabulary, "rb") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())
    return write_table(src.mapInArrow(_pack_task(shipped, width, window), _PACKED_DDL), "packed-ids")
