"""MinHash near-deduplication by fast similarity sketching.

A document's set is its distinct word shingles.  The sketch throws every
shingle into one of ``t`` coordinates, round by round, each round with its
own hash; a coordinate keeps the smallest (round, hash).  Rounds 0..t-1 pick
the coordinate at random, round t+i writes coordinate i, so every coordinate
is filled after 2t rounds at most, long sets stop after one or two, and the
share of equal coordinates is concentrated about the Jaccard similarity.

Documents with equal sets are one class.  The sketch is cut into ``bands``
of ``rows`` coordinates; classes that agree on a band share a bucket.  Links
between classes are confirmed on their full sets.  A bucket's pairs are
never written out: each member is compared with one hub, components of the
confirmed links are formed, and only buckets that still hold several
components are compared whole, in tiles of a bounded number of sets: a task
counts a tile's intersections as a matrix product and returns a spanning
forest of the links it found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import wordhash as W
from quarry.llm.graph import connected_components, fresh
from quarry.operators.joins import broadcast_if_small
from quarry.session import drop_table, write_table

#: 32 bands of 5: a pair at 0.8 is missed with probability 3e-6
BANDS, ROWS = 32, 5
#: sets, and shingles in them, on either side of a tile (about: they are dealt by hash)
TILE_SETS, TILE_SHINGLES = 512, 400_000


def sketch(hashes: np.ndarray, owner: np.ndarray, n_texts: int, t: int) -> np.ndarray:
    """(n_texts, t) uint64 sketches of the sets; an empty set keeps the
    largest value everywhere."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n_texts * t, empty, dtype=np.uint64)
    h, o = hashes, owner
    for i in range(2 * t):
        if not len(h):
            break
        v = W.mix(h + np.uint64((0xA24BAED4963EE407 * (i + 1)) & 0xFFFFFFFFFFFFFFFF))
        if i < t:
            at = o * t + ((v >> np.uint64(32)) % np.uint64(t)).astype(np.int64)
        else:
            at = o * t + (i - t)
        # coordinates filled in an earlier round hold smaller values
        np.minimum.at(out, at, (np.uint64(i) << np.uint64(48)) | (W.mix(v) >> np.uint64(16)))
        open_ = (out.reshape(n_texts, t) == empty).any(axis=1)
        keep = open_[o]
        if not keep.all():
            h, o = h[keep], o[keep]
    return out.reshape(n_texts, t)


def _band_hashes(sk: np.ndarray, bands: int, rows: int) -> np.ndarray:
    g = sk.reshape(len(sk), bands, rows)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sk), bands)).copy()
    for r in range(rows):
        h = W.mix(h * np.uint64(0x9E3779B97F4A7C15) + g[:, :, r])
    return h


def _sets(column, width):
    for row, to, raw, off in W.slices(column):
        h, t = W.words(raw, off)
        yield row, to, *W.shingles(h, t, to - row, width)


def _signature_task(width, bands, rows):
    def run(batches):
        for batch in batches:
            for row, to, h, o, n in _sets(batch.column(1), width):
                k = to - row
                d1, d2 = np.zeros(k, np.uint64), np.zeros(k, np.uint64)
                np.add.at(d1, o, W.mix(h + np.uint64(11)))
                np.add.at(d2, o, W.mix(h ^ np.uint64(0x5851F42D4C957F2D)))
                b = _band_hashes(sketch(h, o, k, bands * rows), bands, rows).view(np.int64)
                flat = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, (k + 1) * bands, bands, dtype=np.int32)),
                    pa.array(b.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, k), pa.array(n.astype(np.int64)),
                     pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), flat],
                    names=["id", "n_shingles", "d1", "d2", "bands"])
    return run


def _set_task(width):
    def run(batches):
        for batch in batches:
            for row, to, h, _, n in _sets(batch.column(1), width):
                ends = np.concatenate(([0], np.cumsum(n))) * 8
                data = pa.py_buffer(h.tobytes())
                sets = pa.Array.from_buffers(pa.large_binary(), to - row,
                                             [None, pa.py_buffer(ends.astype(np.int64).tobytes()), data])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, to - row), sets.cast(pa.binary())], names=["id", "set"])
    return run


def _overlap_task(num, den):
    def run(batches):
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            ok = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                x = np.frombuffer(a[i].as_buffer(), np.uint64)
                y = np.frombuffer(b[i].as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                if den * len(x) < num * len(y):
                    continue
                at = np.searchsorted(y, x)
                at[at == len(y)] = len(y) - 1
                both = int((y[at] == x).sum())
                ok[i] = den * both >= num * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))],
                names=["a", "b"])
    return run


def forest(linked: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph ``linked`` (a boolean matrix)
    between nodes of which those of one label are known to be connected."""
    n = len(linked)
    first = {}
    up = [first.setdefault(c, i) for i, c in enumerate(label.tolist())]

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    out = []
    roots = np.array([root(i) for i in range(n)])
    for i in range(n):
        for k in np.flatnonzero(linked[i] & (roots != roots[i])):
            a, b = root(i), root(int(k))
            if a != b:
                up[max(a, b)] = min(a, b)
                out.append((i, int(k)))
    return out


def overlaps(sets: list[np.ndarray], block: int = 4096) -> np.ndarray:
    """Matrix of intersection sizes of sorted uint64 sets: a product of 0/1
    matrices over the shingles that two sets share, a block of them at a time."""
    n = len(sets)
    sizes = np.array([len(x) for x in sets])
    values, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes)
    keep = count[at] > 1
    number = np.cumsum(count > 1) - 1
    row, col = row[keep], number[at[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((n, n), dtype=np.float32)
    for start in range(0, int((count > 1).sum()), block):
        lo, hi = np.searchsorted(col, (start, start + block))
        m = np.zeros((n, block), dtype=np.float32)
        m[row[lo:hi], col[lo:hi] - start] = 1
        out += m @ m.T
    np.fill_diagonal(out, sizes)
    return out


def _tile_task(num, den):
    def run(table: pa.Table) -> pa.Table:
        # a repeated id (rows that share it) keeps each of its sets
        ids = table.column("id").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("set")]
        both = overlaps(sets).astype(np.int64)
        sizes = both.diagonal()
        linked = den * both >= num * (sizes[:, None] + sizes[None, :] - both)
        found = forest(linked, table.column("c").to_numpy())
        a = np.array([min(ids[i], ids[k]) for i, k in found], dtype=np.int64)
        b = np.array([max(ids[i], ids[k]) for i, k in found], dtype=np.int64)
        return pa.table({"a": a, "b": b})
    return run


def _confirm(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose sets have ``den * intersection >= num * union``."""
    pairs = write_table(pairs, "pairs")
    x = sets.select(F.col("id").alias("a"), F.col("set").alias("sa"))
    y = sets.select(F.col("id").alias("b"), F.col("set").alias("sb"))
    j = pairs.join(x, "a").join(y, "b").select("a", "b", "sa", "sb")
    links = write_table(j.mapInArrow(_overlap_task(num, den), "a bigint, b bigint"), "links")
    drop_table(pairs)
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    similarity: tuple[int, int] = (80, 100), bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_shingles, component_id, kept``.

    ``similarity`` is (p, q): documents are linked when q * intersection >=
    p * union.  ``component_id`` is the smallest id reachable by links.

    Edge cases: a null or empty text (or one without words) has no shingles
    and links with nothing; a row without id can't be linked and is kept with
    a null ``component_id``; rows that share an id are one document (linked if
    any of their texts is); other columns of ``docs`` are not read, so
    clashing names don't matter; an empty table gives an empty result.
    """
    num, den = similarity
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    sig = write_table(src.mapInArrow(
        _signature_task(width, bands, rows),
        "id bigint, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>"), "signatures")
    linkable = sig.where("n_shingles > 0 AND id IS NOT NULL")
    classes = write_table(linkable.groupBy("n_shingles", "d1", "d2")
                          .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    # class representatives: singletons are recognised without a join on the hot classes
    reps = (linkable.join(classes.where("copies > 1").drop("copies"), ["n_shingles", "d1", "d2"], "left")
            .where("rep IS NULL OR rep = id").select("id", F.col("n_shingles").alias("size"), "bands"))
    buckets = write_table(reps.select("id", "size", F.explode("bands").alias("bucket")), "buckets")
    shared = write_table(buckets.groupBy("bucket")
                         .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("hub"),
                              F.max("id").alias("last"))
                         .where("hub <> last").select("bucket", "n", "hub"), "shared")
    members = write_table(buckets.join(broadcast_if_small(shared), "bucket")
                          .select("bucket", "id", "size", "n", "hub"), "members")
    drop_table(buckets, shared)
    wanted = write_table(members.select("id").distinct(), "wanted")
    sets = write_table(src.join(broadcast_if_small(wanted), "id", "left_semi")
                       .mapInArrow(_set_task(width), "id bigint, set binary"), "sets")
    if sets.count() > wanted.count():  # rows that share an id; counts come from the files' footers
        sets = write_table(sets.distinct(), "sets")
        # one member for each, or an id that stands twice in a bucket cancels out of its fingerprint
        again, members = members, write_table(members.distinct().groupBy("bucket", "id", "n", "hub")
                                              .agg(F.sum("size").alias("size")), "members")
        drop_table(again)
    links = _confirm(members.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b"))
                     .distinct(), sets, num, den)
    # buckets of two are settled by their hub; of the others, those in one component are, too
    first = connected_components(links).withColumnRenamed("node", "id")
    tagged = write_table(members.where("n > 2").join(first, "id", "left")
                         .select("bucket", "id", "size", F.coalesce("component", "id").alias("c")), "tagged")
    open_ = (tagged.groupBy("bucket")
             .agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.count(F.lit(1)).alias("n"),
                  F.sum("size").alias("total"), F.bit_xor(F.xxhash64("id")).alias("x1"),
                  F.bit_xor(F.xxhash64("id", F.lit(1))).alias("x2")).where("c0 <> c1")
             # bands often hold the same members: one of them is enough
             .groupBy("n", "x1", "x2").agg(F.min("bucket").alias("bucket"), F.max("total").alias("total"))
             .select("bucket", F.greatest(F.ceil(F.col("n") / TILE_SETS),
                                          F.ceil(F.col("total") / TILE_SHINGLES)).alias("k")))
    open_ = write_table(open_, "open")
    mine = F.pmod(F.xxhash64("id", F.lit(7)), F.col("k"))
    tiles = write_table(
        tagged.join(broadcast_if_small(open_), "bucket").withColumn("mine", mine)
        .select("bucket", "id", "c", "mine", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
        .select("bucket", "id", "c", F.least("mine", "other").alias("i"),
                F.greatest("mine", "other").alias("j")), "tiles")
    found = write_table(tiles.join(sets, "id").groupBy("bucket", "i", "j")
                        .applyInArrow(_tile_task(num, den), "a bigint, b bigint"), "links")
    links = write_table(links.unionByName(found).distinct(), "links")
    drop_table(tagged, open_, tiles, found, first)
    comp = connected_components(links).select(F.col("node").alias("rep"), "component")
    final = write_table(classes.join(comp, "rep", "left")
                        .select("n_shingles", "d1", "d2", "rep", "component")
                        .where("component IS NOT NULL OR copies > 1")
                        .select("n_shingles", "d1", "d2", F.coalesce("component", "rep").alias("component")),
                        "final")
    drop_table(members, wanted, sets, links, classes)
    out = (sig.select("id", "n_shingles", "d1", "d2")
           .join(final, ["n_shingles", "d1", "d2"], "left")
           .select(F.col("id").alias(id_col), "n_shingles",
                   F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns: of every group of near-duplicates
    the document with the smallest id.  Of rows that share that id one stays
    (the one with the smallest hash of all columns); rows without id stay."""
    other, row = fresh(docs, "other_id"), fresh(docs, "one_row")
    marks = write_table(near_duplicates(docs, id_col, text_col, **options)
                        .select(F.col(id_col).alias(other), "kept"), "marks")
    gone = write_table(marks.where("NOT kept").select(other).distinct(), "gone")
    same = F.col(id_col) == F.col(other)
    out = docs.join(broadcast_if_small(gone), same, "left_anti")
    again = write_table(marks.where("kept").where(F.col(other).isNotNull()).groupBy(other)
                        .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(other), "again")
    if again.isEmpty():
        return out
    again = broadcast_if_small(again)
    cols = [F.col(c) for c in out.columns]
    one = (out.join(again, same, "left_semi").groupBy(F.col(id_col).alias(other))
           .agg(F.min_by(F.struct(*cols), F.xxhash64(*cols)).alias(row)).select(f"{row}.*"))
    return out.join(again, same, "left_anti").unionByName(one)
