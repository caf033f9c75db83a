"""Personal data: base patterns and a skip-chain conditional random field.

The base spans are fixed patterns (email, ip, card, phone).  The field adds
what the patterns miss: its nodes are the tokens with a digit or an ``@``;
tokens inside a base span are observed, the others have a label to be
inferred.  Neighbouring tokens share a chain potential; occurrences of the
same token (same digits, or same letters in lower case), however far apart,
share a skip potential, and so, with one of its own, do tokens one edit apart;
loopy message passing spreads the labels over the document.

Everything is learned from the corpus in one pass over all documents.  It
counts labels per token shape (hashed into a fixed number of buckets) and
label pairs per kind of edge; only those bounded tables reach the driver.  How
much each kind of potential weighs is fitted on tokens of the base spans of
held-out documents: each is hidden, and so is, in half of these documents, its
shape, and its label is to be told from its neighbours' labels.  Tokens that
the patterns leave out although their shape may hold personal data are no
examples of either side.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import drop_table, write_table

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
#: buckets that token shapes are hashed into
SHAPES = 4096
#: an unobserved token is marked when its belief in one kind reaches this
BELIEF = 0.9
#: keys of as many characters may have near ones, a single edit away
NEAR_LENGTH = 8
#: one document in as many is held out of the counts that weights are fitted with
FOLDS = 4
#: pull of the weights towards 1, steps of their fit
RIDGE, STEPS = 10.0, 12

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"\S+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_EDGES = ".,;:!?\"'()[]{}<>*#$%&|"


def _emails(text: str) -> list[tuple[int, int]]:
    out, low, at = [], 0, text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
        low = m.end() if m else at + 1
        at = text.find("@", low)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, in the order of ``KINDS``,
    then by start; code points, end exclusive."""
    out = [("email", *s) for s in _emails(text)] if "@" in text else []
    if not _MARK.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text)
                if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def _shape(core: str) -> int:
    """Bucket of a token's shape: digits, letters and other signs with run
    lengths, and whether its digits pass the card checksum."""
    out, last, run = [], "", 0
    for c in core:
        k = "9" if "0" <= c <= "9" else "a" if c.isalpha() else c
        if k == last:
            run += 1
        else:
            out.append(f"{last}{min(run, 20)}")
            last, run = k, 1
    out.append(f"{last}{min(run, 20)}")
    digits = _NOT_DIGIT.sub("", core)
    flag = 13 <= len(digits) <= 19 and luhn(digits)
    return zlib.crc32(f"{flag}{len(core) > 64}{''.join(out)}".encode()) % SHAPES


def _key(core: str) -> str:
    digits = _NOT_DIGIT.sub("", core)
    return digits if len(digits) >= 6 and "@" not in core else core.lower()


def nodes(text: str, spans) -> tuple[list, np.ndarray, np.ndarray]:
    """Tokens with a digit or ``@``: [(start, end, shape, key, number)], the
    label that the base spans give each (0: none), and its chain links."""
    marks = sorted((a, b, LABELS.index(k)) for k, a, b in spans)
    out, label, chain, at = [], [], [], 0
    for number, m in enumerate(_TOKEN.finditer(text)):
        if not _MARK.search(m[0]):
            continue
        left = m[0].lstrip(_EDGES)
        core = left.rstrip(_EDGES)
        if not core:
            continue
        start = m.end() - len(left)
        end = start + len(core)
        while at < len(marks) and marks[at][1] <= start:
            at += 1
        k = next((x[2] for x in marks[at:at + 4] if x[0] < end and x[1] > start), 0)
        if out and out[-1][4] == number - 1:
            chain.append((len(out) - 1, len(out)))
        out.append((start, end, _shape(core), _key(core), number))
        label.append(k)
    return out, np.array(label, dtype=np.int64), np.array(chain, dtype=np.int64).reshape(-1, 2)


def skip_links(tokens) -> np.ndarray:
    """Each occurrence of a repeated or similar token to the one before."""
    last, out = {}, []
    for i, t in enumerate(tokens):
        if t[3] in last:
            out.append((last[t[3]], i))
        last[t[3]] = i
    return np.array(out, dtype=np.int64).reshape(-1, 2)


def _deletions(key: str) -> tuple[int, list[int]]:
    """Hash of the key, and of the key without each of its characters."""
    codes = np.frombuffer(key.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    terms = codes * np.cumprod(np.full(len(codes), _BASE, np.uint64))
    sums = np.cumsum(terms)
    return int(sums[-1]), (sums - terms + (sums[-1] - sums) * _INVERSE).tolist()


def one_edit(a: str, b: str) -> bool:
    """Whether one character put in, left out or replaced turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:] and len(b) - len(a) < 2 and a != b


def near_links(tokens) -> np.ndarray:
    """The first occurrence of each key of NEAR_LENGTH characters or more to
    that of the last key before that a replaced character gives, for each
    place, that a character left out gives, for each place, and that has one
    character more.  Time and memory are linear in the keys' length."""
    whole, cut, replaced, known, out = {}, {}, {}, set(), []
    for i, t in enumerate(tokens):
        key = t[3]
        if len(key) < NEAR_LENGTH or key in known:
            continue
        known.add(key)
        total, less = _deletions(key)
        found = {cut.get(total), *map(whole.get, less), *map(replaced.get, zip(less, range(len(less)), strict=True))}
        out += [(j, i) for j in sorted(found - {None}) if one_edit(tokens[j][3], key)]
        whole[total] = i
        cut.update(dict.fromkeys(less, i))
        replaced.update(dict.fromkeys(zip(less, range(len(less)), strict=True), i))
    return np.array(out, dtype=np.int64).reshape(-1, 2)


_BASE = np.uint64(6364136223846793005)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2 ** 64))
_L = len(LABELS)
#: tables of label pairs, below those of the shapes: chain, skip, near
_EDGES_AT = [SHAPES + k * _L for k in range(3)]
_ROWS = SHAPES + 3 * _L


def _context(text: str):
    """(tokens, labels of the base spans, links per kind of edge)"""
    tokens, label, chain = nodes(text, base_spans(text))
    return tokens, label, (chain, skip_links(tokens), near_links(tokens))


def _count_task(batches):
    """Counts per cell: (fold, row, label) of the tables, fold 0 being held
    out, and, of the held-out documents' tokens, (shape, whether it is hidden,
    label, number of neighbours per kind of edge and label)."""
    total = np.zeros((2, _ROWS, _L), dtype=np.int64)
    seen: Counter = Counter()

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.list_(pa.int64())), pa.array(seen.values(), pa.int64())],
                                         names=["cell", "n"])
        seen.clear()
        return out

    for batch in batches:
        for text in batch.column(0):
            text = text.as_py()
            if not text or not _MARK.search(text):
                continue
            tokens, label, edges = _context(text)
            fold = zlib.crc32(text.encode("utf-8", "surrogatepass"))
            held = fold % FOLDS == 0
            table = total[int(not held)]
            around = np.zeros((len(tokens), 3 * _L), np.int64)
            np.add.at(table, ([t[2] for t in tokens], label), 1)
            for k, links in enumerate(edges):
                for a, b in (links.T, links.T[::-1]):
                    np.add.at(table, (_EDGES_AT[k] + label[a], label[b]), 1)
                    np.add.at(around, (a, k * _L + label[b]), 1)
            if held:
                hide = fold // FOLDS % 2
                for t, k, row in zip(tokens, label.tolist(), around.tolist(), strict=True):
                    seen[(t[2], hide, k, *row)] += 1
                if len(seen) > 20_000:
                    yield flush()
    at = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.stack(at, axis=1).tolist(), pa.list_(pa.int64())), pa.array(total[at])],
                                     names=["cell", "n"])
    yield flush()


class Field:
    """Log potentials: ``unary`` (shape, label) and ``edges`` (label, label)
    of the kinds chain, skip, near; ``weights`` of unary and edges."""

    def __init__(self, counts: np.ndarray, weights=(1.0, 1.0, 1.0, 1.0)):
        shapes = counts[:SHAPES].astype(float)
        self.prior = (shapes.sum(axis=0) + 1) / (shapes.sum() + _L)
        plain = np.log((shapes + 2 * self.prior) / (shapes.sum(axis=1, keepdims=True) + 2))
        #: shapes with a real chance of personal data; tokens of others stay unmarked
        self.open = 1 - np.exp(plain[:, 0]) >= 1e-3
        self.weights = np.array(weights, float)
        self.unary = self.weights[0] * plain
        self.edges = [w * self._affinity(counts[at:at + _L]) for w, at in zip(self.weights[1:], _EDGES_AT, strict=True)]

    @staticmethod
    def _affinity(n: np.ndarray) -> np.ndarray:
        p = (n + 0.5 + 2.0 * np.eye(_L)) / (n.sum() + 0.5 * _L * _L + 2.0 * _L)
        side = p.sum(axis=1)
        return np.clip(np.log(p / (side[:, None] * side[None, :])), -4, 4)

    def examples(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(features per label: unary, chain, skip, near; usable rows) of
        hidden tokens: personal data, and others of shapes that aren't open."""
        shape, hide, label, around = cells[:, 0], cells[:, 1], cells[:, 2], cells[:, 3:].reshape(-1, 3, _L)
        own = np.where(hide[:, None] == 1, np.log(self.prior), self.unary[shape])
        return np.stack([own, *(around[:, k] @ e for k, e in enumerate(self.edges))], axis=1), (label > 0) | ~self.open[shape]

    def beliefs(self, tokens, label, edges, rounds: int = 30) -> np.ndarray:
        """Loopy sum-product on the document's graph, damped by half; a label
        of -1 is to be inferred, others are observed."""
        own = self.unary[[t[2] for t in tokens]].copy()
        seen = label >= 0
        own[seen] = -50
        own[seen, label[seen]] = 0
        links = np.concatenate(edges)
        if len(links):
            pot = np.concatenate([np.repeat(e[None], len(x), 0) for e, x in zip(self.edges, edges, strict=True)])
            src = np.concatenate([links[:, 0], links[:, 1]])
            dst = np.concatenate([links[:, 1], links[:, 0]])
            pot = np.concatenate([pot, pot.transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(links)) + len(links), np.arange(len(links))])
            msg = np.zeros((len(src), _L))
            for _ in range(rounds):
                total = own.copy()
                np.add.at(total, dst, msg)
                x = (total[src] - msg[back])[:, :, None] + pot
                top = x.max(axis=1)
                new = top + np.log(np.exp(x - top[:, None, :]).sum(axis=1))
                new -= new.max(axis=1, keepdims=True)
                moved = np.abs(new - msg).max()
                msg = 0.5 * msg + 0.5 * new
                if moved < 1e-4:
                    break
            np.add.at(own, dst, msg)
        own -= own.max(axis=1, keepdims=True)
        p = np.exp(own)
        return p / p.sum(axis=1, keepdims=True)

    def added(self, text: str, spans) -> list[tuple[str, int, int]]:
        """Spans of unobserved tokens that the field marks."""
        if not _MARK.search(text):
            return []
        tokens, label, chain = nodes(text, spans)
        open_ = (label == 0) & self.open[[t[2] for t in tokens]] if tokens else np.zeros(0, bool)
        if not tokens or not (open_.any() or (label > 0).any()):
            return []
        edges = (chain, skip_links(tokens), near_links(tokens))
        held = label > 0
        for links in edges[1:]:  # a token can also be drawn in by an observed twin
            pulled = np.concatenate([links[held[links[:, 0]], 1], links[held[links[:, 1]], 0]])
            open_[pulled] |= label[pulled] == 0
        if not open_.any():
            return []
        # all other tokens are observed: only links to open ones carry messages
        edges = [x[open_[x].any(axis=1)] for x in edges]
        used = np.unique(np.concatenate([np.flatnonzero(open_), *(x.ravel() for x in edges)]))
        tokens = [tokens[i] for i in used]
        p = self.beliefs(tokens, np.where(open_, -1, label)[used], [np.searchsorted(used, x) for x in edges])
        best = p.argmax(axis=1)
        return sorted((LABELS[best[i]], tokens[i][0], tokens[i][1]) for i in np.flatnonzero(open_[used])
                      if best[i] and p[i, best[i]] >= BELIEF)


def _slope_task(field: Field, weights: np.ndarray):
    """Sums over the examples: gradient and curvature of their log likelihood
    by the weights, cell by cell."""
    def run(batches):
        total = np.zeros((4, 5))
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            f, use = field.examples(cells)
            f, n, y = f[use], batch.column(1).to_numpy()[use], cells[use, 2]
            z = np.einsum("k,ikl->il", weights, f)
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            mean = np.einsum("il,ikl->ik", p, f)
            total[:, 0] += n @ (f[np.arange(len(f)), :, y] - mean)
            total[:, 1:] += np.einsum("i,il,ikl,iml->km", n, p, f, f) - np.einsum("i,ik,im->km", n, mean, mean)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(20)), pa.array(total.reshape(-1))], names=["at", "v"])
    return run


def fit_weights(field: Field, examples: DataFrame) -> np.ndarray:
    """Weights of the potentials, from 0 to 3, that tell the examples' labels
    best, by Newton steps with a pull towards 1; each step sums 20 numbers
    over the table.  Without examples they are 1."""
    weights = np.ones(4)
    for _ in range(STEPS):
        total = np.zeros(20)
        for r in examples.mapInArrow(_slope_task(field, weights), "at bigint, v double").groupBy("at").agg(F.sum("v")).collect():
            total[r[0]] = r[1]
        total = total.reshape(4, 5)
        slope, bend = total[:, 0] - RIDGE * (weights - 1), total[:, 1:] + RIDGE * np.eye(4)
        free = ~((weights == 0) & (slope < 0) | (weights == 3) & (slope > 0))
        step = np.zeros(4)
        step[free] = np.linalg.solve(bend[np.ix_(free, free)], slope[free])
        moved = np.clip(weights + np.clip(step, -0.5, 0.5), 0, 3)
        done = np.abs(moved - weights).max() < 1e-4
        weights = moved
        if done:
            break
    return weights.round(4)  # sums of doubles come in any order


def learn(docs: DataFrame, text_col: str = "text") -> Field:
    """Potentials from all documents (null texts count nothing), their weights
    from the held-out ones against the counts of the others; an empty table
    gives a field that adds nothing."""
    cells = write_table(docs.select(F.col(text_col).cast("string").alias("text"))
                        .mapInArrow(_count_task, "cell array<bigint>, n bigint")
                        .groupBy("cell").agg(F.sum("n").alias("n")), "pii_cells")
    counts = np.zeros((2, _ROWS, _L), dtype=np.int64)
    for r in cells.where(F.size("cell") == 3).collect():  # 2 x (SHAPES + 15) rows of 5 at most
        counts[tuple(r["cell"])] = r["n"]
    weights = fit_weights(Field(counts[1]), cells.where(F.size("cell") > 3))
    drop_table(cells)
    return Field(counts.sum(axis=0), weights)


def _joined(spans) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (order[s[0]], s[1], s[2])))


def _find_task(field: Field):
    def run(batches):
        for whole in batches:
            for row in range(0, whole.num_rows, 1000):
                batch = whole.slice(row, 1000)
                counts, shas, spans, more = [], [], [], []
                for text in batch.column(1):
                    text = text.as_py() or ""
                    base = base_spans(text)
                    extra = field.added(text, base)
                    counts.append([sum(s[0] == k for s in base) for k in KINDS])
                    shas.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                    spans.append(_joined(base + extra))
                    more.append(len(extra))
                n = np.array(counts, dtype=np.int64).reshape(-1, len(KINDS))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(n[:, k]) for k in range(len(KINDS))), pa.array(shas),
                     pa.array(spans), pa.array(more, pa.int64())],
                    names=["id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])
    return run


def find(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, base counts per kind, ``base_sha256``, ``spans``
    (base and added ones) and ``n_added``.

    Edge cases: a null text is an empty one, without spans; a null id keeps
    its row; repeated rows are judged each; other columns aren't read; an
    empty table gives an empty result."""
    cols = ", ".join(f"n_{k} bigint" for k in KINDS)
    return (docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(_find_task(field), f"id bigint, {cols}, base_sha256 string, spans string, n_added bigint")
            .withColumnRenamed("id", id_col))


def masked(text: str, spans) -> str:
    """The text with every span, or run of overlapping spans, replaced by
    its kind in brackets (of the one that starts first)."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _mask_task(field: Field, at: int):
    def run(batches):
        for whole in batches:
            for row in range(0, whole.num_rows, 1000):
                batch = whole.slice(row, 1000)
                texts = []
                for text in batch.column(at):
                    text = text.as_py()
                    if text:
                        base = base_spans(text)
                        text = masked(text, base + field.added(text, base))
                    texts.append(text)
                yield batch.set_column(at, batch.schema.field(at),
                                       pa.array(texts, batch.schema.field(at).type))
    return run


def mask(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with the personal data in ``text_col`` masked;
    a null text stays null."""
    return docs.mapInArrow(_mask_task(field, docs.columns.index(text_col)), docs.schema)
