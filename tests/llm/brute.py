"""Plain versions of the operators' contracts, for small tables."""

import hashlib
import re
from collections import defaultdict

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_set(text, width):
    w = (text or "").encode().translate(LOWER).split()
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def components(links):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(up)}


def near_duplicates(rows, width, num=80, den=100):
    """[(id, n_shingles, component)] of (id, text) rows."""
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    links = [(i, j) for k, (i, a) in enumerate(sets) for j, b in sets[:k]
             if i is not None and j is not None and i != j and a and b
             and den * len(a & b) >= num * len(a | b)]
    comp = components(links)
    return [(i, len(s), None if i is None else comp.get(i, i)) for i, s in sets]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def contamination(rows, bench):
    win = defaultdict(set)
    for i, t in bench:
        w = WORD.findall((t or "").translate(UPPER))
        for s in range(max(len(w) - 9, 1)):
            if w and i is not None:
                win[tuple(w[s:s + 10])].add(str(i))
    out = []
    for i, t in rows:
        w, hit, items = WORD.findall((t or "").translate(UPPER)), set(), set()
        for n in {len(k) for k in win}:
            for s in range(len(w) - n + 1):
                if got := win.get(tuple(w[s:s + n])):
                    hit |= set(range(s, s + n))
                    items |= got
        out.append((i, len(w), len(hit), len(items),
                    hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return out


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += sum(map(int, str(2 * d))) if k % 2 else d
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, p in PATTERNS.items():
        if kind == "email" and "@" not in (text or ""):
            continue
        for m in re.finditer(p, text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 9 <= len(digits) <= 15):
                out.append((kind, *m.span()))
    return out


def key(row):
    return tuple((x is not None, x) if not isinstance(x, list) else (True, str(x)) for x in row)
