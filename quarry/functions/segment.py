"""Greedy tag segmentation as regex expressions.

A glued tag string such as ``javascriptjquery`` is cut into dictionary tags:

* forward pass - from the left, at each position take the *longest*
  dictionary tag that starts there; no backtracking; stuck => pass fails;
* reverse pass (only when forward failed) - the same from the right end,
  taking the longest tag that ends at the current position;
* both fail => no segmentation (null).

The dictionary is compiled into one trie-shaped Java regex, anchored with
``\\G`` so that successive matches of ``regexp_extract_all`` must be
contiguous.  At each trie node longer continuations are tried before the
word ending at that node, so the first match found is the longest tag at that
position.  Matching cost per position is the tag length, not the dictionary
size.  The segmentation succeeds iff the matched pieces cover the string.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_END = ""


def _trie(words):
    root: dict = {}
    for w in words:
        node = root
        for ch in w:
            node = node.setdefault(ch, {})
        node[_END] = {}
    return root


def _node_regex(root: dict) -> str:
    """The trie as a regex, without recursion: a tag may be of any length."""
    out: list[str] = []
    todo: list = [root]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            out.append(node)
            continue
        children = [ch for ch in sorted(node) if ch != _END]
        if not children:
            continue
        # a word that ends here: what follows is a greedy option, so longer words are tried first
        opened = "(?:" if len(children) > 1 or _END in node else ""
        parts: list = [opened]
        for k, ch in enumerate(children):
            parts += ["|"] * (k > 0) + [re.escape(ch), node[ch]]
        parts.append((")" if opened else "") + ("?" if _END in node else ""))
        todo.extend(reversed(parts))
    return "".join(out)


def dictionary_regex(words, reverse: bool = False) -> str:
    """Trie regex matching exactly one dictionary word, longest first.

    Null and empty words are ignored (an empty tag would never advance).
    """
    clean = sorted({(w[::-1] if reverse else w) for w in words if w})
    if not clean:
        return r"\G(?!)"
    return r"\G" + "(?:" + _node_regex(_trie(clean)) + ")"


def _covered(pieces: Column, s: Column) -> Column:
    return F.length(F.array_join(pieces, "")) == F.length(s)


def forward_pieces(s: Column, pattern: str) -> Column:
    return F.regexp_extract_all(s, F.lit(pattern), 0)


def reverse_pieces(s: Column, reverse_pattern: str) -> Column:
    raw = F.regexp_extract_all(F.reverse(s), F.lit(reverse_pattern), 0)
    return F.reverse(F.transform(raw, lambda z: F.reverse(z)))


def segment_tags(s: Column, words, with_pass: bool = False):
    """Return the array of tags (null when both passes fail, or ``s`` is
    null/empty); with ``with_pass`` also a column naming the pass used."""
    fwd = forward_pieces(s, dictionary_regex(words))
    rev = reverse_pieces(s, dictionary_regex(words, reverse=True))
    empty = s.isNull() | (F.length(s) == 0)
    out = (F.when(empty, F.lit(None).cast("array<string>"))
           .when(_covered(fwd, s), fwd)
           .when(_covered(rev, s), rev))
    if not with_pass:
        return out
    how = (F.when(empty, F.lit(None))
           .when(_covered(fwd, s), F.lit("forward"))
           .when(_covered(rev, s), F.lit("reverse")))
    return out, how
