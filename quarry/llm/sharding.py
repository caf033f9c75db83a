"""Byte-balanced shards of indivisible groups, by Karmarkar-Karp differencing.

A group is all rows of one text.  A partial partition is the sums of its
``ways`` parts; an item alone is one.  The two partial partitions of the
largest spread are combined again and again, the largest part of one with the
smallest of the other, until one is left; its parts are the shards.

Differencing runs in one task, so its input is bounded: groups of at least
1/``BUNDLES`` of all bytes (at most ``BUNDLES`` of them) are items of their
own, the others are bundled by a hash of their text into ``BUNDLES`` items.
Bundles of a small share of the bytes still cancel: differencing leaves a
spread far below the smallest item.  Group sizes are sums with a partial sum
in each map task, so a text that a third of all rows have is one row per task
in the shuffle; rows meet the items' shards in two broadcast joins of at most
``BUNDLES`` rows each and are never grouped by shard in one task.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.graph import fresh
from quarry.llm.ranking import ranked
from quarry.session import drop_table, write_table

WAYS = 8
#: items of the differencing: at most this many bundles and as many groups alone
BUNDLES = 1 << 14


def difference(sizes: list[int], ways: int = WAYS) -> list[int]:
    """The part of each size; ties go to the earlier item."""
    if not sizes:
        return []
    sums = [(w, *[0] * (ways - 1)) for w in sizes]
    heap = [(-w if ways > 1 else 0, i) for i, w in enumerate(sizes)]
    heapq.heapify(heap)
    made: list[tuple[int, int, list[int]]] = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        raw = [x + y for x, y in zip(sums[a], reversed(sums[b]), strict=True)]
        order = sorted(range(ways), key=lambda j: -raw[j])
        node = len(sums)
        sums.append(tuple(raw[j] for j in order))
        sums[a] = sums[b] = ()
        made.append((a, b, order))
        heapq.heappush(heap, (raw[order[-1]] - raw[order[0]], node))
    # from the last combination down: which part each position of a partial partition became
    part: dict[int, list[int]] = {len(sums) - 1: list(range(ways))}
    for node in range(len(sums) - 1, len(sizes) - 1, -1):
        a, b, order = made[node - len(sizes)]
        mine, pa_, pb = part.pop(node), [0] * ways, [0] * ways
        for p, j in enumerate(order):
            pa_[j], pb[ways - 1 - j] = mine[p], mine[p]
        part[a], part[b] = pa_, pb
    return [part[i][0] for i in range(len(sizes))]


def _difference_task(ways: int):
    def run(batches):
        rows = [r for batch in batches for r in batch.to_pylist()]
        rows.sort(key=lambda r: (-r["size"], r["item"]))
        parts = difference([r["size"] for r in rows], ways)
        yield pa.RecordBatch.from_arrays([pa.array([r["item"] for r in rows], pa.string()),
                                          pa.array(parts, pa.int32())], names=["item", "shard"])
    return run


def _text_key(text: Column) -> Column:
    """The group of a text; null texts are a group."""
    return F.coalesce(F.md5(text), F.lit("null"))


def _bundle(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUNDLES)).cast("string")


def _items(groups: DataFrame, ways: int) -> DataFrame:
    """``item, shard`` of the items of ``key, size``: an item is a group's
    key or the number of a bundle."""
    groups = write_table(groups, "groups")
    total = groups.agg(F.sum("size")).head()[0] or 0
    alone = F.col("size") * BUNDLES >= total
    items = groups.groupBy(F.when(alone, F.col("key")).otherwise(_bundle(F.col("key"))).alias("item")) \
        .agg(F.sum("size").cast("bigint").alias("size"))
    out = write_table(items.repartition(1).mapInArrow(_difference_task(ways), "item string, shard int"), "items")
    drop_table(groups)
    return out


def _join_shards(rows: DataFrame, items: DataFrame, key: str, shard: str) -> DataFrame:
    """``rows`` with the shard of their group; at most BUNDLES rows a side are
    broadcast, by the way items are made."""
    of_key, of_bundle = fresh(rows, "of_key"), fresh(rows, "of_bundle")
    alone = items.where(F.length("item") == 32).select(F.col("item").alias(key), F.col("shard").alias(of_key))
    null = items.where("item = 'null'").select(F.col("item").alias(key), F.col("shard").alias(of_key))
    name = fresh(rows, "bundle")
    bundles = items.where("length(item) < 32 AND item <> 'null'").select(
        F.col("item").alias(name), F.col("shard").alias(of_bundle))
    return (rows.join(F.broadcast(alone.unionByName(null)), key, "left")
            .withColumn(name, _bundle(F.col(key))).join(F.broadcast(bundles), name, "left")
            .withColumn(shard, F.coalesce(of_key, of_bundle)).drop(name, of_key, of_bundle))


def _size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def place(docs: DataFrame, ways: int = WAYS, text_col: str = "text", shard_col: str = "shard") -> DataFrame:
    """The rows of ``docs``, all columns, with ``shard_col``.  Texts are read
    twice and never shuffled."""
    text, key = F.col(text_col).cast("string"), fresh(docs, "text_key")
    sizes = docs.select(_text_key(text).alias("key"), _size(text).alias("size"))
    items = _items(sizes.groupBy("key").agg(F.sum("size").alias("size")), ways)
    return _join_shards(docs.withColumn(key, _text_key(text)), items, key, shard_col).drop(key)


def write_shards(docs: DataFrame, path: str, ways: int = WAYS, text_col: str = "text") -> None:
    """Write ``docs`` as Parquet below ``path``, a folder ``shard=N`` each."""
    place(docs, ways, text_col).write.mode("overwrite").partitionBy("shard").parquet(path)


def shards(docs: DataFrame, ways: int = WAYS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col, size, text_crc32, law, shard,
    slot, grown_shard``.  ``law`` is ``bytes``: rows of one text share a
    shard, and the shards' bytes are as equal as differencing makes them.
    ``slot`` numbers a shard's rows by id (nulls first), then text;
    ``grown_shard`` is null, since another number of shards deals anew.

    Edge cases: a null text has size 1 and a null ``text_crc32``; null texts
    are one group, empty texts another; a null id keeps its row; rows that
    share an id are placed by their texts, repeated rows each have a slot of
    their own; a group larger than an equal share makes its shard the largest;
    other columns aren't read; an empty table gives an empty result."""
    text = F.col(text_col).cast("string")
    rows = write_table(docs.select(F.col(id_col).cast("bigint").alias("id"), _size(text).alias("size"),
                                   F.crc32(text).alias("crc"), _text_key(text).alias("key")), "sizes")
    items = _items(rows.groupBy("key").agg(F.sum("size").alias("size")), ways)
    placed = ranked(_join_shards(rows, items, "key", "shard"), "shard", [F.col("id").asc_nulls_first(), F.col("key")])
    drop_table(rows)
    return placed.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                         "shard", F.col("pos").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
