"""Quality classifier: a generalised additive model with pairwise terms.

Every feature is cut into bins; the score of a text is an intercept plus one
table entry per feature plus one per chosen pair of features.  The tables
are learned by cyclic boosting: in turn, each feature gets one shallow tree
over its bins fitted to the current residuals; then the pairs that explain
the remaining residuals best get their turn on a coarser grid.

Fitting reads a bounded sample of labelled rows (``max_rows``, default
20,000, the rows with the smallest hash of their id) on the driver; its
features are computed on Spark.  Scoring is a vectorised sum of table
lookups inside Spark tasks, over whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import wordhash as W

#: rows the model is fitted on at most
MAX_TRAIN_ROWS = 20_000

_CLASSES = {
    "upper": range(0x41, 0x5B), "lower": range(0x61, 0x7B), "digit": range(0x30, 0x3A),
    "blank": [0x20, 0x09], "newline": [0x0A, 0x0D], "stop": b".,;:", "shout": b"!?",
    "bar": b"|/\\", "symbol": b"#$%&*@^~=+<>_", "bracket": b"()[]{}\"'`-",
    "control": [*range(0, 9), 0x0B, 0x0C, *range(0x0E, 0x20), 0x7F], "wide": range(0x80, 0x100),
}
_COUNTED = np.zeros((256, len(_CLASSES)))
for _k, _v in enumerate(_CLASSES.values()):
    _COUNTED[list(_v), _k] = 1

_LINE = np.zeros(256, dtype=bool)
_LINE[[0x0A, 0x0D]] = True

FEATURES = ["log_bytes", "log_words", "word_bytes", "words_per_line", "distinct_words",
            "distinct_lines", "distinct_pairs", *_CLASSES]


def _distinct(h: np.ndarray, t: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((h, t))
    h, t = h[order], t[order]
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    return np.bincount(t[fresh], minlength=n)


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, len(FEATURES)) of the texts in ``raw``; only shares, counts
    and lengths of the whole text.  An empty text has zeros."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    hist = np.zeros((n, 256))
    for start, end in W.buffers(raw, offsets):
        text = np.searchsorted(offsets, np.arange(start, end), side="right") - 1
        first = int(text[0])
        k = int(text[-1]) - first + 1
        hist[first:first + k] += np.bincount((text - first) * 256 + raw[start:end],
                                             minlength=k * 256).reshape(k, 256)
    wh, wt = W.words(raw, offsets)
    lh, lt = W.words(raw, offsets, _LINE)
    n_words, n_lines = np.bincount(wt, minlength=n), np.bincount(lt, minlength=n)
    same = wt[1:] == wt[:-1]
    ph, pt = W.mix(wh[1:] * np.uint64(3) + wh[:-1])[same], wt[1:][same]
    n_pairs = np.bincount(pt, minlength=n)
    some = lambda x: np.maximum(x, 1)
    cols = [np.log1p(size), np.log1p(n_words), size / some(n_words), n_words / some(n_lines),
            _distinct(wh, wt, n) / some(n_words), _distinct(lh, lt, n) / some(n_lines),
            _distinct(ph, pt, n) / some(n_pairs)]
    return np.column_stack([*cols, (hist @ _COUNTED) / some(size)[:, None]])


@dataclass
class Additive:
    """edges: bin edges per feature; tables: one row of entries per feature;
    pairs: (feature, feature, coarse edges, coarse edges, table)."""
    base: float = 0.0
    edges: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pairs: list = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for k, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += t[np.searchsorted(e, x[:, k], side="right")]
        for i, j, ei, ej, t in self.pairs:
            out += t[np.searchsorted(ei, x[:, i], side="right"), np.searchsorted(ej, x[:, j], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _cut(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """(gain, number of bins to the left) of the best cut of ordered bins."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _leaf(g, h, ridge):
    return g.sum() / (h.sum() + ridge)


def _tree(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """A tree of two levels over ordered bins, as an entry per bin."""
    out = np.zeros(len(g))
    _, mid = _cut(g, h, ridge)
    for a, b in ((0, mid), (mid, len(g))):
        _, k = _cut(g[a:b], h[a:b], ridge)
        for c, d in ((a, a + k), (a + k, b)):
            if d > c:
                out[c:d] = _leaf(g[c:d], h[c:d], ridge)
    return out


def _tree2(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """(gain, table): a cut on the first axis, then one on the second in each
    half; the other order if that gains more."""
    best = (-1.0, np.zeros_like(g))
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        for mid in range(1, len(a)):
            gain, out = 0.0, np.zeros_like(a)
            for part in (slice(0, mid), slice(mid, len(a))):
                ga, ha = a[part].sum(axis=0), b[part].sum(axis=0)
                more, k = _cut(ga, ha, ridge)
                gain += more + ga.sum() ** 2 / (ha.sum() + ridge)
                out[part, :k] = _leaf(ga[:k], ha[:k], ridge) if k else 0
                out[part, k:] = _leaf(ga[k:], ha[k:], ridge)
            if gain > best[0] + 1e-9:
                best = (gain, out.T.copy() if turned else out)
    return best


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 120, pair_bins: int = 8,
        n_pairs: int = 6, pair_rounds: int = 30, rate: float = 0.15, ridge: float = 5.0) -> Additive:
    """Cyclic boosting of the logistic loss.  Without rows of both labels the
    model is the smoothed share of label 1."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Additive(base=float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    model.edges = [_edges(x[:, k], bins) for k in range(x.shape[1])]
    codes = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    margin = np.full(len(y), model.base)

    def slopes():
        p = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for c, t in zip(codes, model.tables, strict=True):
            g, h = slopes()
            step = rate * _tree(np.bincount(c, g, len(t)), np.bincount(c, h, len(t)), ridge)
            t += step
            margin += step[c]
    coarse = [_edges(x[:, k], pair_bins) for k in range(x.shape[1])]
    small = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(coarse)]

    def sums(i, j):
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        at = small[i] * shape[1] + small[j]
        g, h = slopes()
        return at, *(np.bincount(at, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))

    gains = sorted(((_tree2(*sums(i, j)[1:], ridge)[0], i, j) for i in range(x.shape[1])
                    for j in range(i) if len(coarse[i]) and len(coarse[j])), reverse=True)
    model.pairs = [(i, j, coarse[i], coarse[j], np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)))
                   for _, i, j in gains[:n_pairs]]
    for _ in range(pair_rounds):
        for i, j, _, _, t in model.pairs:
            at, g, h = sums(i, j)
            step = rate * _tree2(g, h, ridge)[1]
            t += step
            margin += step.reshape(-1)[at]
    return model


def held_out(id_col: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id's text modulo 3 is 1."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def _feature_task(batches):
    for batch in batches:
        for row, to, raw, off in W.slices(batch.column(1)):
            x = features(raw, off)
            ends = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, to - row), batch.column(2).slice(row, to - row),
                 batch.column(3).slice(row, to - row), pa.ListArray.from_arrays(pa.array(ends), pa.array(x.reshape(-1)))],
                names=["id", "y", "h", "x"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_rows: int = MAX_TRAIN_ROWS) -> Additive:
    """Fit on at most ``max_rows`` labelled rows that are not held out (null
    ids and null labels are left out), the first by a hash of id and text.
    A label that repeats counts once, as does a document that repeats whole;
    labels of one id that differ count each; a label without a document is
    not used."""
    known = (labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("int").alias("y"))
             .where("id IS NOT NULL AND y IN (0, 1)").where(~held_out("id")).distinct()
             .orderBy(F.xxhash64("id"), "id", "y").limit(max_rows))
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    # the sample is bounded by max_rows fixed-width rows
    found = (src.join(F.broadcast(known), "id").select("id", "text", "y", F.xxhash64("text").alias("h"))
             .mapInArrow(_feature_task, "id bigint, y int, h bigint, x array<double>").dropDuplicates(["id", "y", "h"]))
    rows = sorted(found.orderBy(F.xxhash64("id", "h"), "id", "h", "y").limit(max_rows).collect(),
                  key=lambda r: (r.id, r.y, r.h))
    if not rows:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    return fit(np.array([r.x for r in rows]), np.array([r.y for r in rows], dtype=float))


def _score_task(model: Additive):
    def run(batches):
        for batch in batches:
            for row, to, raw, off in W.slices(batch.column(1)):
                s = np.round(model.score(features(raw, off)), 12)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, to - row), pa.array(s)], names=["id", "score"])
    return run


def score(docs: DataFrame, model: Additive, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, score, predicted`` per row of ``docs``.

    Edge cases: a null text is scored as the empty one; a null id keeps its
    row and counts as held out; repeated rows are scored each; other columns
    are not read; an empty table gives an empty result."""
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return (src.mapInArrow(_score_task(model), "id bigint, score double")
            .select(F.col("id").alias(id_col), F.coalesce(held_out("id"), F.lit(True)).alias("held_out"),
                    "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def _verdict_task(model: Additive, at: int):
    def run(batches):
        for batch in batches:
            keep = [model.score(features(raw, off)) >= 0.5 for _, _, raw, off in W.slices(batch.column(at))]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))
    return run


def keep_good(docs: DataFrame, model: Additive, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the model doesn't reject."""
    return docs.mapInArrow(_verdict_task(model, docs.columns.index(text_col)), docs.schema)
