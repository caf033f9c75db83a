"""Conflict-constrained best-fit packing of documents into bins.

Documents are cut into pieces of at most ``capacity`` words, losslessly.  A
bin holds no two pieces of one source and no two of one duplicate cluster.
Open bins stand in the order of their residual, each with a bitmap of its
sources and one of its clusters; a piece goes to the successor of its size,
and the search goes on to the next larger residual until the tightest
compatible bin is found; else it opens a bin.

Spark deals the documents by a hash of id and words into groups of about
``group_rows`` rows, so a hot source or cluster is spread over all groups;
each group is packed by itself (decreasing size, then id), which leaves at
most a few half-empty bins per group.  Only (id, size, source, cluster)
travel, never texts.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import wordhash as W
from quarry.operators.joins import broadcast_if_small
from quarry.session import write_table

CAPACITY = 1024
GROUP_ROWS = 5000


def best_fit(pieces, capacity: int):
    """pieces: [(size, source, cluster)], in packing order; sources and
    clusters are hashable or None (no conflict).  Bin number and offset of
    each piece.  A piece of size 0 gets none (-1, 0)."""
    bits: dict = {}
    residuals: list[tuple[int, int]] = []  # (residual, bin), ascending
    used, sources, clusters = [], [], []
    out = []
    for size, source, cluster in pieces:
        if size == 0:
            out.append((-1, 0))
            continue
        s = 0 if source is None else 1 << bits.setdefault(("s", source), len(bits))
        c = 0 if cluster is None else 1 << bits.setdefault(("c", cluster), len(bits))
        k = bisect_left(residuals, (size, -1))
        while k < len(residuals):
            b = residuals[k][1]
            if not (sources[b] & s or clusters[b] & c):
                break
            k += 1
        if k < len(residuals):
            left, b = residuals.pop(k)
        else:
            left, b = capacity, len(used)
            used.append(0)
            sources.append(0)
            clusters.append(0)
        out.append((b, used[b]))
        used[b] += size
        sources[b] |= s
        clusters[b] |= c
        if left > size:
            insort(residuals, (left - size, b))
    return out


def _pack_task(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        pieces = []
        for r in rows:
            n = r["n_words"]
            cuts = range(0, n, capacity) if n else [0]
            pieces += [(min(capacity, n - a), r["id"], k, a, r) for k, a in enumerate(cuts)]
        # nulls last; equal rows in any order are equal
        pieces.sort(key=lambda p: (-p[0], p[1] is None, p[1] or 0, p[2], p[4]["cluster"], p[4]["source"] or ""))
        seen: dict = {}
        for p in pieces:
            seen[p[4]["cluster"]] = seen.get(p[4]["cluster"], 0) + 1
        at = best_fit([(p[0], p[4]["source"], p[4]["cluster"] if seen[p[4]["cluster"]] > 1 else None)
                       for p in pieces], capacity)
        group = rows[0]["grp"]
        return pa.table({
            "id": pa.array([p[1] for p in pieces], pa.int64()),
            "piece": pa.array([p[2] for p in pieces], pa.int64()),
            "first_word": pa.array([p[3] for p in pieces], pa.int64()),
            "n_words": pa.array([p[0] for p in pieces], pa.int64()),
            "source": pa.array([p[4]["source"] for p in pieces], pa.string()),
            "cluster": pa.array([p[4]["cluster"] for p in pieces], pa.int64()),
            "bin_id": pa.array([None if b < 0 else (group << 32) | b for b, _ in at], pa.int64()),
            "bin_offset": pa.array([o for _, o in at], pa.int64())})
    return run


def _measure_task(batches):
    for batch in batches:
        for row, to, raw, off in W.slices(batch.column(1)):
            h, t = W.words(raw, off)
            n = np.bincount(t, minlength=to - row)
            place = np.arange(len(t)) - np.concatenate(([0], np.cumsum(n)))[t]
            whole = np.zeros(to - row, np.uint64)
            np.add.at(whole, t, W.mix(h + W.mix(place.astype(np.uint64))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, to - row), pa.array(n.astype(np.int64)),
                 batch.column(2).slice(row, to - row), batch.column(3).slice(row, to - row),
                 pa.array(whole.view(np.int64))],
                names=["id", "n_words", "source", "given", "words"])


def pack(docs: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source", cluster_col: str | None = None) -> DataFrame:
    """One row per piece: ``id_col, piece, first_word, n_words, source,
    cluster, bin_id, bin_offset``.  ``cluster`` is ``cluster_col``, an integer
    such as the ``component_id`` of near-duplicates; without that column, or
    where it is null, a hash of the text's words (A-Z lower-cased), so copies
    are one cluster.

    Edge cases: a null or empty text is one piece of no words and in no bin
    (``bin_id`` null); a null source conflicts with nothing; rows with a null
    id are packed like others; repeated rows are packed each, in different
    bins, and are spread over groups however many they are; other columns
    aren't read; an empty table gives an empty result."""
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"),
                      F.col(source_col).cast("string").alias("source"),
                      (F.col(cluster_col) if cluster_col else F.lit(None)).cast("bigint").alias("given"))
    sized = write_table(src.mapInArrow(_measure_task, "id bigint, n_words bigint, source string, given bigint, "
                                                      "words bigint"), "sized")
    groups = max(1, -(-sized.count() // group_rows))  # the count comes from the files' footers
    # rows that share an id are spread by their words
    dealt = (sized.withColumn("first", F.pmod(F.xxhash64("id", "words"), F.lit(groups)))
             .withColumn("cluster", F.coalesce("given", "words")).drop("given", "words")
             .withColumn("row", F.monotonically_increasing_id()))
    heavy = (dealt.groupBy("first").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * group_rows)
             .select("first", F.ceil(F.col("n") / group_rows).alias("parts")))
    # only repeated rows make a group heavy; such a group is dealt again, row by row
    part = F.pmod("row", F.coalesce("parts", F.lit(1)))
    dealt = (dealt.join(broadcast_if_small(write_table(heavy, "heavy")), "first", "left")
             .withColumn("grp", F.col("first") + groups * part).drop("first", "parts", "row"))
    return (dealt.groupBy("grp")
            .applyInArrow(_pack_task(capacity),
                          "id bigint, piece bigint, first_word bigint, n_words bigint, source string, "
                          "cluster bigint, bin_id bigint, bin_offset bigint")
            .withColumnRenamed("id", id_col))
