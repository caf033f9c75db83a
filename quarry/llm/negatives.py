"""Hard negatives by inverted multi-index search with certified windows.

Vectors are dealt by a hash into shards of bounded size, and every shard is a
multi-index: two codebooks, one per half of the dimensions, whose pairs of
centroids are its cells.  A search of a shard scores the centroids of both
halves, each with its radius added (the largest share a row of that centroid
can add to the inner product), and a heap walks the two sorted lists jointly,
so cells come by falling bound of their sum.  It stops when the bound of the
next cell is below what is asked for: the last of the best rows found so far,
or the lower end of a window of scores.  So a shard's answer is exact, and the
best of all shards' answers is the answer over all rows.  Anchors of near
cells share a heap, whose bounds hold for each of them, and the cells it
visits are scored for all of them by one matrix product.

First every anchor's positives are searched (best rows of its label), then,
for each positive's score, the best rows of other labels within the window
from a share of that score up to the score.  Anchors meet shards in tiles of
a shard and a group of anchors: both have a bounded size.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.batches import by_key
from quarry.operators.joins import broadcast_if_small
from quarry.session import drop_table, write_table

#: rows of a shard, less where vectors are long (bytes of a shard's vectors)
SHARD_ROWS, SHARD_BYTES = 8192, 1 << 25
#: anchors of a tile, in shards' worth of rows
GROUP_SHARDS = 2
#: centroids of a half's codebook, rounds of its training
CENTROIDS, ROUNDS, SEED = 24, 6, 20240301
#: rows scored before the next look at the bounds
STEP = 512
#: squared norm (of the integer vectors) above which scores might not fit a long
NORM_LIMIT = 2.0 ** 60
#: queries that share a heap and its scores
QUERIES = 256
#: below and above every score
LOWEST, HIGHEST = -2 ** 63, 2 ** 63 - 1


def _clean_task(scale: int):
    def run(batches):
        for batch in batches:
            keep, vecs, dims = [], [], []
            for i, v in enumerate(batch.column("v")):
                if not v.is_valid or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all():
                    continue
                with np.errstate(over="ignore"):
                    q = np.floor(scale * x)
                    small = (q * q).sum() <= NORM_LIMIT
                if small:
                    keep.append(i)
                    vecs.append(q.astype(np.int32).tobytes())
                    dims.append(len(q))
            rest = batch.select(["id", "label", "anchor"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(dims, pa.int32()), pa.array(vecs, pa.binary())],
                                             names=["id", "label", "anchor", "dim", "vec"])
    return run


def _vectors(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(len(column), dim).astype(np.float64)


def codebook(x: np.ndarray) -> np.ndarray:
    """The nearest of at most CENTROIDS trained centroids of every row."""
    rng = np.random.default_rng(SEED)
    center = x[np.sort(rng.choice(len(x), min(CENTROIDS, len(x)), replace=False))]
    code = np.zeros(len(x), np.int64)
    for _ in range(ROUNDS):
        code = ((center * center).sum(axis=1) - 2 * (x @ center.T)).argmin(axis=1)
        size = np.bincount(code, minlength=len(center))
        total = np.zeros_like(center)
        np.add.at(total, code, x)
        center = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], center)
    return code


def _cell_task(batches):
    for (dim, _), held in by_key(batches, ("dim", "shard")):
        part = pa.Table.from_batches(held)
        x, half = _vectors(part.column("vec"), int(dim)), int(dim) // 2
        for name, half_x in (("c1", x[:, :half]), ("c2", x[:, half:])):
            part = part.append_column(name, pa.array(codebook(half_x).astype(np.int32)))
        yield from part.to_batches()


class Shard:
    """A shard's rows, in the order of their cells, and its two codebooks."""

    def __init__(self, x: np.ndarray, ids, labels, rows, c1, c2):
        self.x, self.ids, self.labels, self.rows = x, ids, labels, rows
        self.half = x.shape[1] // 2
        self.names1, k1 = np.unique(c1, return_inverse=True)
        self.names2, k2 = np.unique(c2, return_inverse=True)
        self.halves = [self._book(x[:, :self.half], k1, len(self.names1)),
                       self._book(x[:, self.half:], k2, len(self.names2))]
        cell = k1 * len(self.names2) + k2
        self.first = np.searchsorted(cell, np.arange(len(self.names1) * len(self.names2) + 1))
        self.longest = np.sqrt((x * x).sum(axis=1).max())
        self.scored = 0  # rows that searches looked at

    @staticmethod
    def _book(x, code, n):
        """(centroids, radii) of a half, of the rows as they are."""
        center = np.zeros((n, x.shape[1]))
        np.add.at(center, code, x)
        center /= np.bincount(code, minlength=n)[:, None]
        far = np.zeros(n)
        np.maximum.at(far, code, np.sqrt(((x - center[code]) ** 2).sum(axis=1)))
        return center, far

    def nearest(self, a: np.ndarray) -> np.ndarray:
        """The cell of every row's highest scoring centroids."""
        (mid1, _), (mid2, _) = self.halves
        best1, best2 = (a[:, :self.half] @ mid1.T).argmax(axis=1), (a[:, self.half:] @ mid2.T).argmax(axis=1)
        return best1 * len(self.names2) + best2

    def cells(self, a: np.ndarray):
        """(upper bound, lower bound, cell) by falling upper bound; bounds of
        the scores of all rows of ``a``."""
        ends = []
        for part, (center, far) in zip((a[:, :self.half], a[:, self.half:]), self.halves, strict=True):
            long = np.sqrt((part * part).sum(axis=1))[:, None]
            mid, reach = part @ center.T, long * far
            # far above the rounding of the sums
            slack = 1e-6 + 1e-9 * long * (np.sqrt((center ** 2).sum(axis=1)) + far)
            up, low = (mid + reach + slack).max(axis=0), (mid - reach - slack).min(axis=0)
            order = np.argsort(-up, kind="stable")
            ends.append((up[order].tolist(), low[order].tolist(), order.tolist()))
        (up1, low1, at1), (up2, low2, at2) = ends
        # (i, j) is put on the heap once, by (i, j - 1) or, in the first column, by (i - 1, 0)
        heap, width = [(-(up1[0] + up2[0]), 0, 0)], len(self.names2)
        while heap:
            bound, i, j = heapq.heappop(heap)
            yield -bound, low1[i] + low2[j], at1[i] * width + at2[j]
            if j + 1 < len(up2):
                heapq.heappush(heap, (-(up1[i] + up2[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(up1):
                heapq.heappush(heap, (-(up1[i + 1] + up2[0]), i + 1, 0))

    def scores(self, at: np.ndarray, a: np.ndarray) -> np.ndarray:
        """Scores of the rows ``at`` (columns) with the rows of ``a``."""
        self.scored += len(at) * len(a)
        if self.longest * np.sqrt((a * a).sum(axis=1).max()) < 2.0 ** 52:  # every partial sum is an integer that a double holds
            return (a @ self.x[at].T).astype(np.int64)
        return a.astype(np.int64) @ self.x[at].astype(np.int64).T

    def steps(self, a: np.ndarray, wanted: np.ndarray, most: int):
        """(rows, bound of all that follow): the wanted rows, some at a time;
        cells whose lower bound is above ``most`` are passed over."""
        got, size, bound = [], 0, None
        for bound, low, cell in self.cells(a):
            if size >= STEP:
                yield np.concatenate(got), bound
                got, size = [], 0
            lo, hi = self.first[cell], self.first[cell + 1]
            if hi > lo and low <= most:
                at = lo + np.flatnonzero(wanted[lo:hi])
                got.append(at)
                size += len(at)
        yield np.concatenate([np.empty(0, np.int64), *got]), -np.inf

    def search(self, a: np.ndarray, ids: np.ndarray, labels: np.ndarray, same: bool, who: np.ndarray,
               least: np.ndarray, most: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of the ``top`` best rows of every query, best
        first, ties by id and row.  Query k asks for rows of the same label
        as anchor ``who[k]`` (a row of ``a``), or of other labels, whose score
        is from ``least[k]`` to ``most[k]``.  One heap serves all anchors; a
        query is closed once no cell to come can reach its window or its
        ``top``-th row, and anchors without open queries are scored no more."""
        floor, open_ = least.copy(), np.arange(len(who))
        held = np.empty((3, 0), np.int64)  # query, row, score
        wanted = np.isin(self.labels, labels) if same else np.ones(len(self.labels), bool)
        for at, bound in self.steps(a, wanted, int(most.max())):
            used, place = np.unique(who[open_], return_inverse=True)
            fits = (self.ids[at] != ids[used, None]) & ((self.labels[at] == labels[used, None]) == same)
            s = self.scores(at, a[used])[place]
            ok = fits[place] & (s >= floor[open_, None]) & (s <= most[open_, None])
            if len(at) > top and ok.sum() > 4 * top * len(open_):
                # all that tie with the last place stay
                ok &= s >= np.partition(np.where(ok, s, LOWEST), -top, axis=1)[:, -top, None]
            q, k = np.nonzero(ok)
            held = np.concatenate([held, [open_[q], at[k], s[q, k]]], axis=1)
            held = held[:, np.lexsort((self.rows[held[1]], self.ids[held[1]], -held[2], held[0]))]
            begin = np.searchsorted(held[0], np.arange(len(who)))
            held = held[:, np.arange(held.shape[1]) - begin[held[0]] < top]
            ends = np.searchsorted(held[0], np.arange(len(who)), side="right")
            full = np.flatnonzero(np.bincount(held[0], minlength=len(who)) == top)
            floor[full] = held[2, ends[full] - 1]
            open_ = np.flatnonzero(floor <= bound)
            if not len(open_):
                break
        return held[0], held[1], held[2]


def _tile_task(top: int, num: int, den: int):
    def run(batches):
        for (dim, _, _), held in by_key(batches, ("dim", "shard", "grp")):
            part = pa.Table.from_batches(held)
            role = part.column("role").to_numpy()
            n = int((role == 0).sum())  # the shard's rows come first
            if n in (0, len(role)):
                continue
            mine = {k: part.column(k).to_numpy()[:n] for k in ("id", "label", "row", "c1", "c2")}
            shard = Shard(_vectors(part.column("vec")[:n], int(dim)), mine["id"], mine["label"], mine["row"],
                          mine["c1"], mine["c2"])
            anchors = part.slice(n)
            x = _vectors(anchors.column("vec"), int(dim))
            ids, labels, named = (anchors.column(k).to_numpy() for k in ("id", "label", "row"))
            targets = anchors.column("targets").to_pylist()
            same = targets[0] is None  # all anchors ask for positives, or all for negatives
            asked = [[HIGHEST]] * len(x) if same else targets
            order = np.lexsort((shard.nearest(x), labels)) if same else np.argsort(shard.nearest(x), kind="stable")
            block = max(1, QUERIES // max(map(len, asked)))
            for k in range(0, len(order), block):
                some = order[k:k + block]
                who = np.repeat(np.arange(len(some)), [len(asked[i]) for i in some])
                most = np.array([t for i in some for t in asked[i]], np.int64)
                least = np.full(len(most), LOWEST) if same else np.array([-(-num * t // den) for t in most.tolist()], np.int64)
                q, at, s = shard.search(x[some], ids[some], labels[some], same, who, least, most, top)
                cols = [named[some][who[q]], s if same else most[q], shard.ids[at], shard.rows[at], s]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 names=["anchor", "target", "id", "row", "score"])
    return run


def _search(index: DataFrame, anchors: DataFrame, top: int, num: int, den: int) -> DataFrame:
    """``anchor, target, id, row, score`` of every tile's answers."""
    cols = ["dim", "shard", "grp", "role", "c1", "c2", "row", "id", "label", "vec", "targets"]
    none = F.lit(None).cast("array<bigint>")
    zero = F.lit(0).cast("int")
    rows = (index.withColumn("grp", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("groups") - 1)))
            .withColumn("role", zero).withColumn("targets", none))
    asked = (anchors.withColumn("grp", F.pmod(F.xxhash64("row"), F.col("groups")))
             .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)))
             .withColumn("role", F.lit(1)).withColumn("c1", zero).withColumn("c2", zero))
    tiles = (rows.select(cols).unionByName(asked.select(cols)).repartition("dim", "shard", "grp")
             .sortWithinPartitions("dim", "shard", "grp", "role", "c1", "c2"))
    return tiles.mapInArrow(_tile_task(top, num, den), "anchor bigint, target bigint, id bigint, row bigint, score bigint")


def _first(found: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def hard_negatives(vectors: DataFrame, anchors: Column, n_positives: int = 5, n_negatives: int = 5,
                   share: tuple[int, int] = (80, 100), scale: int = 256, id_col: str = "vec_id",
                   vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per anchor and positive the best ``n_negatives`` rows of other labels
    whose score is at least ``share`` of the positive's and not above it:
    ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``.  ``anchors`` is a condition on the rows of ``vectors``;
    an anchor's positives are the best ``n_positives`` rows of its label.
    Scores are inner products of the vectors ``floor(scale * x)``; higher
    ones come first, ties by smaller id.

    Edge cases: rows with a null id, label or vector, or with any null or
    non-finite component, take no part, nor do those whose integer vector has
    a squared norm above 2**60 (its scores might not fit a long); vectors of
    different length have no score; rows repeated whole are one row; of rows
    that share an id each takes part, but none is another's positive or
    negative; an anchor without positives, or a positive without negatives,
    has no rows; a negative positive score has an empty window; other columns
    aren't read; an empty table gives an empty result."""
    src = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
                         F.coalesce(anchors, F.lit(False)).alias("anchor"), F.col(vec_col).alias("v"))
    usable = (src.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
              .mapInArrow(_clean_task(scale), "id bigint, label bigint, anchor boolean, dim int, vec binary").distinct())
    rows = write_table(usable.withColumn("row", F.monotonically_increasing_id()), "rows")
    size = F.greatest(F.lit(256), F.least(F.lit(SHARD_ROWS), F.floor(SHARD_BYTES / (8 * (F.col("dim") + 1)))))
    plan = write_table(rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("m"))
                       .select("dim", F.ceil(F.col("n") / size).alias("shards"),
                               F.greatest(F.lit(1), F.ceil(F.col("m") / (GROUP_SHARDS * size))).alias("groups")), "plan")
    dealt = rows.join(broadcast_if_small(plan), "dim").withColumn("shard", F.pmod(F.xxhash64("row"), F.col("shards")))
    types = "id bigint, label bigint, anchor boolean, row bigint, shards bigint, groups bigint, dim int, shard bigint, vec binary"
    cols = ["id", "label", "anchor", "row", "shards", "groups", "dim", "shard", "vec"]
    index = write_table(dealt.repartition("dim", "shard").sortWithinPartitions("dim", "shard").select(cols)
                        .mapInArrow(_cell_task, f"{types}, c1 int, c2 int"), "index")
    asked = index.where("anchor").drop("anchor", "shard", "c1", "c2")
    num, den = share
    found = _search(index, asked.withColumn("targets", F.lit(None).cast("array<bigint>")), n_positives, num, den)
    positives = write_table(_first(found, ["anchor"], n_positives)
                            .select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("target")), "positives")
    targets = positives.groupBy(F.col("anchor").alias("row")).agg(F.collect_set("target").alias("targets"))
    found = _search(index, asked.join(broadcast_if_small(targets), "row"), n_negatives, num, den)
    best = write_table(_first(found, ["anchor", "target"], n_negatives), "negatives")
    names = asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    out = write_table(
        positives.join(best, ["anchor", "target"]).join(broadcast_if_small(names), "anchor")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                F.col("target").alias("positive_score"), F.col("score").alias("negative_score")), "hard_negatives")
    drop_table(rows, plan, index, positives, best)
    return out
