"""Embedding near-dedup by collision-counting projections.

Every vector is projected on ``PROJECTIONS`` random directions.  In a block
of vectors each projection is sorted; two vectors collide on a projection
when the second lies in the window of half-width ``w`` centred on the first.
Pairs that collide on at least ``need`` projections are verified by their
cosine in double precision.  For a pair at the similarity asked for, the
difference of two projections is normal with the pair's distance as its
deviation, so the count is binomial; ``need`` is its quantile that loses one
pair in 100,000 at that similarity (fewer above it).

One window alone holds a constant share of all vectors, so counting over the
whole table would touch all pairs.  Blocks bound that: a table of ``bits``
projections of its own, each cut at zero, names a block; two vectors are on one side of a
cut with a probability that only their angle decides, whatever the data look
like, and enough tables are used for a pair at the similarity asked for to
share a block with probability ``recall`` (more above it).  ``bits`` grows
with the logarithm of the number of vectors, the number of tables with a power
below 0.25 of it.  A pair is counted in its first shared block only, so link counts are
sums over blocks and no pairs are written.  Blocks above ``TILE`` vectors are
cut into tiles of two chunks each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.graph import connected_components
from quarry.llm.wordhash import mix
from quarry.operators.joins import broadcast_if_small
from quarry.session import drop_table, write_table

PROJECTIONS, SEED, TILE = 64, 20240229, 512
#: blocks up to this size are compared without sorting
SMALL = 96


class Plan:
    """Directions, windows, blocks and thresholds; small, sent to tasks."""

    def __init__(self, n: int, similarity: float, recall: float, block: int = 64):
        self.similarity = similarity
        self.bits = max(2, min(round(math.log2(max(n, 1) / block)) if n > block else 2, 40))
        agree = 1 - math.acos(similarity) / math.pi
        self.tables = max(4, math.ceil(math.log(1 - recall) / math.log(1 - agree ** self.bits)))
        # windows: 1.5 deviations of a pair's projections at the similarity
        self.window = 1.5 * math.sqrt(2 - 2 * similarity)
        self.directions: dict[int, np.ndarray] = {}
        self.cuts: dict[int, np.ndarray] = {}
        p = math.erf(1.5 / math.sqrt(2))
        below, self.need = 0.0, 0
        while True:  # largest count that loses fewer than one pair in 100,000
            below += math.comb(PROJECTIONS, self.need) * p ** self.need * (1 - p) ** (PROJECTIONS - self.need)
            if below > 1e-5:
                break
            self.need += 1

    def project(self, unit: np.ndarray) -> np.ndarray:
        d = unit.shape[1]
        if d not in self.directions:
            self.directions[d] = np.random.default_rng(SEED + d).standard_normal((d, PROJECTIONS))
        return unit @ self.directions[d]

    def sides(self, unit: np.ndarray, tables: int) -> np.ndarray:
        """(vectors, tables) sides of the first tables' cuts, as bits; no two
        tables share a cut, so they are independent for a pair."""
        d = unit.shape[1]
        if d not in self.cuts:
            self.cuts[d] = np.random.default_rng((SEED, d)).standard_normal((d, self.tables * self.bits))
        weight = np.uint64(1) << np.arange(self.bits, dtype=np.uint64)
        above = unit @ self.cuts[d][:, :tables * self.bits] > 0
        return (above.reshape(len(unit), tables, self.bits) * weight).sum(axis=2, dtype=np.uint64)

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """(vectors, tables) block names."""
        d, raw = unit.shape[1], self.sides(unit, self.tables)
        table = np.arange(1, self.tables + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix(mix(raw + np.uint64(d * 0xD1B54A32D192ED03 % (1 << 64))) ^ table)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _clean_task(batches):
    """(id, vec): the vector's doubles as bytes; null unless it can link."""
    for batch in batches:
        vecs = []
        for v in batch.column(1):
            x = None
            if v.is_valid and len(v.values) and v.values.null_count == 0:
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                top = np.abs(x).max()
                # vectors of extreme length are scaled by a power of two, which is exact
                if np.isfinite(top) and top > 0 and not 1e-100 < top < 1e100:
                    x = np.ldexp(x, -int(np.frexp(top)[1]))
                x = x + 0.0 if np.isfinite(top) and top > 0 else None
            vecs.append(None if x is None else x.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vecs, pa.binary())], names=["id", "vec"])


def _by_length(column) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """[(dimension, rows, vectors)] of a column of bytes."""
    raw = [v.as_buffer() for v in column]
    size = np.array([len(r) // 8 for r in raw])
    return [(int(d), rows, np.array([np.frombuffer(raw[i], np.float64) for i in rows]))
            for d in np.unique(size) for rows in [np.flatnonzero(size == d)]]


def _code_task(plan: Plan):
    def run(batches):
        for batch in batches:
            for _, rows, x in _by_length(batch.column(1)):
                for a in range(0, len(rows), 2000):
                    k = rows[a:a + 2000]
                    codes = plan.codes(_unit(x[a:a + 2000])).view(np.int64)
                    ends = np.arange(0, codes.size + 1, plan.tables, dtype=np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(k)),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(codes.reshape(-1)))],
                        names=["id", "codes"])
    return run


def collisions(proj: np.ndarray, rows: slice, window: float) -> np.ndarray:
    """(rows, all) number of projections on which the second vector lies in
    the window centred on the first, by ranks in the sorted projections."""
    if len(proj) <= SMALL:  # the same windows, all projections at once
        return (np.abs(proj[rows, None, :] - proj[None, :, :]) <= window).sum(axis=2)
    out = np.zeros((len(proj[rows]), len(proj)), dtype=np.uint8)
    rank = np.empty(len(proj), dtype=np.int32)
    for j in range(proj.shape[1]):
        order = np.argsort(proj[:, j], kind="stable")
        line = proj[order, j]
        rank[order] = np.arange(len(order), dtype=np.int32)
        low = np.searchsorted(line, proj[rows, j] - window, side="left").astype(np.int32)
        high = np.searchsorted(line, proj[rows, j] + window, side="right").astype(np.int32)
        out += (rank[None, :] >= low[:, None]) & (rank[None, :] < high[:, None])
    return out


def links_in(plan: Plan, table: int, ids, chunk, x, i: int, j: int):
    """Links of tile (i, j): (first, second) as row numbers."""
    unit = _unit(x)
    proj, sides = plan.project(unit), None
    out = []
    for start in range(0, len(x), 256):
        rows = slice(start, min(start + 256, len(x)))
        a, b = np.nonzero(collisions(proj, rows, plan.window) >= plan.need)
        a = a + start
        keep = ids[a] < ids[b]
        if i != j:
            keep &= chunk[a] != chunk[b]
        a, b = a[keep], b[keep]
        dot = np.einsum("ij,ij->i", x[a], x[b])
        norm = np.sqrt((x[a] ** 2).sum(axis=1)) * np.sqrt((x[b] ** 2).sum(axis=1))
        near = dot / norm >= plan.similarity
        a, b = a[near], b[near]
        # counted in the first block that the two share
        first = np.ones(len(a), dtype=bool)
        if table and len(a):
            sides = plan.sides(unit, table) if sides is None else sides
            for t in range(table):
                first &= sides[a, t] != sides[b, t]
        out.append((a[first], b[first]))
    return tuple(np.concatenate(z) for z in zip(*out, strict=True))


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    up: dict[int, int] = {}

    def root(v):
        while up.get(v, v) != v:
            up[v] = v = up.get(up[v], up[v])
        return v

    out = []
    for p, q in zip(a.tolist(), b.tolist(), strict=True):
        r, s = root(p), root(q)
        if r != s:
            up[max(r, s)] = min(r, s)
            out.append((p, q))
    return out


def _tile_task(plan: Plan):
    def tile(part: pa.Table):
        x = np.array([np.frombuffer(v.as_buffer(), np.float64) for v in part.column("vec")])
        ids, copies = part.column("id").to_numpy(), part.column("copies").to_numpy()
        i, j = part.column("i")[0].as_py(), part.column("j")[0].as_py()
        a, b = links_in(plan, part.column("t")[0].as_py(), ids, part.column("mine").to_numpy(), x, i, j)
        n = np.zeros(len(ids), dtype=np.int64)
        np.add.at(n, a, copies[b])
        np.add.at(n, b, copies[a])
        some = np.flatnonzero(n)
        tree = _forest(a, b)
        yield ids[some], np.full(len(some), -1), n[some]
        yield ids[[p for p, _ in tree]], ids[[q for _, q in tree]], np.zeros(len(tree), np.int64)

    def run(batches):
        held: list = []

        def flush():
            part = pa.Table.from_batches(held)
            held.clear()
            if part.num_rows > 1:
                for a, b, n in tile(part):
                    if len(a):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(a), pa.array(b, mask=b < 0), pa.array(n)], names=["a", "b", "n"])

        last = None
        for batch in batches:
            key = np.stack([batch.column(k).to_numpy() for k in ("code", "i", "j")], axis=1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(key)], strict=True):
                if hi == lo:
                    continue
                if last is not None and (key[lo] != last).any():
                    yield from flush()
                last = key[lo]
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield from flush()
    return run


def near_duplicates(vectors: DataFrame, similarity: float = 0.9, recall: float = 0.999,
                    id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per row: ``id_col, n_links, component_id, kept``: links are pairs with
    a cosine of ``similarity`` or more.

    Edge cases: vectors that are null, empty, zero or hold null or
    non-finite components, and rows without id, link with nothing (their
    component is their own id, they are kept); vectors of different length
    don't link; rows that repeat a vector link with each other, also under
    one id; other columns aren't read; an empty table gives an empty result."""
    src = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("v"))
    rows = write_table(src.mapInArrow(_clean_task, "id bigint, vec binary")
                       .withColumn("same", F.md5("vec")), "vectors")
    usable = rows.where("vec IS NOT NULL AND id IS NOT NULL")
    classes = write_table(usable.groupBy("same").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")),
                          "classes")
    many = classes.where("copies > 1")
    reps = write_table(usable.join(many, "same", "left").where("rep IS NULL OR rep = id")
                       .select("id", "vec", F.coalesce("copies", F.lit(1)).alias("copies"), "same")
                       .dropDuplicates(["same"]).drop("same"), "reps")
    plan = Plan(reps.count(), similarity, recall)
    codes = write_table(reps.select("id", "vec").mapInArrow(_code_task(plan), "id bigint, codes array<bigint>")
                        .select("id", F.posexplode("codes").alias("t", "code")), "codes")
    shared = write_table(codes.groupBy("code").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                         .select("code", F.ceil(F.col("n") / TILE).alias("k")), "shared")
    mine = F.pmod(F.xxhash64("id", F.lit(3)), F.col("k"))
    placed = (codes.join(broadcast_if_small(shared), "code").withColumn("mine", mine)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
              .select("id", "t", "code", "mine", F.least("mine", "other").alias("i"),
                      F.greatest("mine", "other").alias("j")))
    tiles = (write_table(placed, "tiles").join(reps, "id")
             .repartition("code", "i", "j").sortWithinPartitions("code", "i", "j", "id"))
    found = write_table(tiles.mapInArrow(_tile_task(plan), "a bigint, b bigint, n bigint"), "found")
    counts = write_table(found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("n")), "counts")
    comp = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    final = write_table(
        classes.join(counts, classes["rep"] == counts["a"], "left")
        .join(comp, F.col("rep") == F.col("node"), "left").where("copies > 1 OR a IS NOT NULL")
        .select("same", F.coalesce("component", "rep").alias("component"),
                (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")), "final")
    drop_table(classes, reps, codes, shared, found, counts, comp)
    same = F.when(F.col("id").isNotNull(), F.col("same")).alias("same")
    out = rows.select("id", same).join(final, "same", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
