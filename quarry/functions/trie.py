"""A dictionary of byte strings as a double-array trie, and the greedy walk of
many strings through it at once.

State ``s`` has a child on byte ``b`` at ``base[s] + b`` if ``check`` there is
``s``; so a step is two array reads, whatever the size of the dictionary.  The
trie is built level by level from the sorted words with numpy; states with
several children are placed by first fit, the many states with one child fill
the gaps.  Words are bytes of UTF-8 text, and a match of whole words in valid
text begins and ends between characters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: free places tried for a state's children before the search moves on for good
TRIES = 32


@dataclass
class Trie:
    base: np.ndarray    # int32 by state; shifted so that no index is negative
    check: np.ndarray   # int32 by state: the parent's state, -1 where free
    accept: np.ndarray  # bool by state: a word ends here

    @property
    def nbytes(self) -> int:
        return self.base.nbytes + self.check.nbytes + self.accept.nbytes


def _levels(words: list[bytes]):
    """(parent, byte, word ends here) of every node of the plain trie, the
    root first, level by level; nodes with one parent stand together."""
    size = np.array([len(w) for w in words], np.int64)
    first = np.concatenate(([0], np.cumsum(size)))[:-1]
    data = np.frombuffer(b"".join(words), np.uint8)
    at, live = np.zeros(len(words), np.int64), np.flatnonzero(size > 0)
    parents, bytes_, ends, n = [np.array([-1])], [np.zeros(1, np.uint8)], [np.zeros(1, bool)], 1
    for depth in range(int(size.max(initial=0))):
        live = live[size[live] > depth]
        b, up = data[first[live] + depth], at[live]
        new = np.ones(len(live), bool)
        new[1:] = (up[1:] != up[:-1]) | (b[1:] != b[:-1])
        node = n + np.cumsum(new) - 1
        end = np.zeros(int(new.sum()), bool)
        end[node[size[live] == depth + 1] - n] = True
        parents.append(up[new])
        bytes_.append(b[new])
        ends.append(end)
        at[live] = node
        n += len(end)
    return np.concatenate(parents), np.concatenate(bytes_), np.concatenate(ends)


def build(words) -> Trie:
    """Trie of the distinct non-empty words (bytes)."""
    parent, byte, end = _levels(sorted({w for w in words if w}))
    n = len(parent)
    children = np.bincount(parent[1:], minlength=n)
    first = np.concatenate(([1], 1 + np.cumsum(children)))[:n]
    # nodes are numbered level by level, so the children of node k start behind those of k - 1
    slot = np.zeros(n, np.int64)
    base = np.zeros(n, np.int64)
    used = bytearray(n + 512)
    used[0] = 1
    free = 1
    for k in np.flatnonzero(children > 1).tolist():
        codes = byte[first[k]:first[k] + children[k]].tolist()
        at, tries = used.find(0, free), 0
        free = at
        while True:
            start = at - codes[0]
            if start + codes[-1] + 1 >= len(used):
                used.extend(bytes(len(used) // 4 + 512))
            tries += 1
            if not any(used[start + c] for c in codes[1:]):
                break
            at = used.find(0, at + 1)
        if tries > TRIES:  # what is passed over is left to the states with one child
            free = at
        base[k] = start
        for j, c in enumerate(codes):
            used[start + c] = 1
            slot[first[k] + j] = start + c
    single = np.flatnonzero(children == 1)
    gaps = np.flatnonzero(np.frombuffer(bytes(used), np.uint8) == 0)[:len(single)]
    more = np.arange(len(used), len(used) + len(single) - len(gaps))
    place = np.concatenate((gaps, more))
    slot[first[single]] = place
    base[single] = place - byte[first[single]]
    # bytes lead at most 255 places before or behind a child's own
    total = int(slot.max()) + 512
    trie = Trie(np.zeros(total, np.int32), np.full(total, -1, np.int32), np.zeros(total, bool))
    trie.base[slot + 255] = base + 255
    trie.check[slot[1:] + 255] = slot[parent[1:]] + 255
    trie.accept[slot + 255] = end
    trie.base[:255] = trie.base[-256:] = 255
    # a state without children leads nowhere: all its places belong to others
    leaf = slot[children == 0] + 255
    trie.base[leaf] = 0
    return trie


_ROOT = 255


def greedy(trie: Trie, data: np.ndarray, start: np.ndarray, end: np.ndarray, backward: bool = False):
    """Cut every string ``data[start:end]`` into words, the longest at each
    place, from the left (``backward``: from the right, through a trie of the
    reversed words).  (covered, row, begin, stop): whether the words cover the
    string, and the pieces of all strings in the order they were found."""
    pos = end.copy() if backward else start.copy()
    goal = start if backward else end
    row = np.flatnonzero(start < end)
    at, node = pos[row].copy(), np.full(len(row), _ROOT, np.int64)
    last = np.full(len(row), -1, np.int64)
    covered = start < end
    rows, begins, stops = [], [], []
    step = -1 if backward else 1
    while len(row):
        inside = at != goal[row]
        b = data[np.where(inside, at - backward, 0)]
        to = trie.base[node] + b
        go = inside & (trie.check[to] == node)
        node = np.where(go, to, node)
        at = np.where(go, at + step, at)
        last = np.where(go & trie.accept[node], at, last)
        done = ~go  # the longest word from this place is known
        if not done.any():
            continue
        stuck, cut = done & (last < 0), done & (last >= 0)
        covered[row[stuck]] = False
        r = row[cut]
        rows.append(r)
        begins.append(last[cut] if backward else pos[r])
        stops.append(pos[r] if backward else last[cut])
        pos[r] = last[cut]
        at = np.where(cut, last, at)
        node = np.where(cut, _ROOT, node)
        last = np.where(cut, -1, last)
        keep = ~stuck & ~(cut & (at == goal[row]))
        row, at, node, last = row[keep], at[keep], node[keep], last[keep]
    join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
    return covered, join(rows), join(begins), join(stops)


def segment(column: pa.Array, forward: Trie, backward: Trie | None) -> tuple[pa.Array, pa.Array]:
    """(pieces, pass) of a column of strings: from the left, and where that
    gets stuck from the right (if given); null where both do, or for a null
    or empty string."""
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0 or column.null_count == n:
        return pa.nulls(n, pa.list_(pa.string())), pa.nulls(n, pa.string())
    _, off, raw = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(1, np.uint8)
    valid = np.array(column.is_valid())
    start, end = off[:-1].copy(), np.where(valid, off[1:], off[:-1])
    ok, row, begin, stop = greedy(forward, data, start, end)
    how = np.where(ok, 1, 0)
    keep = ok[row]
    row, begin, stop = row[keep], begin[keep], stop[keep]
    if backward is not None:
        again = ~ok
        ok2, row2, begin2, stop2 = greedy(backward, data, np.where(again, start, 0), np.where(again, end, 0), True)
        how = np.where(ok2 & again, 2, how)
        keep = ok2[row2]
        row, begin, stop = (np.concatenate(p) for p in ((row, row2[keep]), (begin, begin2[keep]), (stop, stop2[keep])))
    order = np.lexsort((begin, row))
    row, begin, stop = row[order], begin[order], stop[order]
    size = stop - begin
    ends = np.concatenate(([0], np.cumsum(size)))
    take = np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])
    words = pa.Array.from_buffers(pa.large_string(), len(row), [None, pa.py_buffer(ends.astype(np.int64)),
                                                                pa.py_buffer(data[take].tobytes())]).cast(pa.string())
    counts = np.bincount(row, minlength=n)
    lists = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    offsets = pa.array(lists, mask=np.append(how == 0, False))
    names = pa.array(["forward", "reverse"]).take(pa.array(np.maximum(how - 1, 0), mask=how == 0))
    return pa.ListArray.from_arrays(offsets, words), names
