"""Merkle manifest of a table, by checkpoint and recompute.

Leaves are digests of whole rows.  Per group (source) every ``FAN``
consecutive nodes become their digest until one, the subroot, remains; the
subroots, in order of their groups, are the leaves of the tree that ends in
the root.  Only every second level is stored: a stored row is an aligned
subtree of up to ``FAN * FAN`` nodes, their digests packed side by side, with
the digest two levels up.  The level between is never written.  Proofs are
extracted from the top down: a task takes a stored subtree and the proof of
its top node, computes the missing level again, writes every node's siblings
in front of that proof and forgets the level.

Rows are placed by a range sort of (group, id), so a hot group covers many
tasks, and a subtree never has more than ``FAN * FAN`` nodes.  Texts don't
travel: a row is shuffled as its digests.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.ranking import ranked
from quarry.operators.joins import broadcast_if_small
from quarry.session import drop_table, write_table

FAN = 16
BLOCK = FAN * FAN

_BLOCK = "grp string, block bigint, n bigint, digests binary, ids array<bigint>, others array<binary>, node binary"
_TAIL = "grp string, pos bigint, tail binary, shape array<int>, subroot binary"


def row_digest(columns: list[Column]) -> Column:
    """SHA-256 (bytes) of a row: of each value ``-`` if null, else the UTF-8
    byte count of its text form, ``:`` and the text form."""
    parts = []
    for c in columns:
        s = c.cast("string")
        parts.append(F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def parent(digests: list[bytes]) -> bytes:
    return sha256(b"".join(digests).hex().encode()).digest()


def levels_of(digests: list[bytes], n: int) -> list[list[bytes]]:
    """The levels of a subtree, the stored one first, in a row of ``n`` nodes:
    a row of one node is its own top, one of up to FAN has one level more."""
    out = [digests]
    for _ in range(0 if n <= 1 else 1 if n <= FAN else 2):
        out.append([parent(out[-1][i:i + FAN]) for i in range(0, len(out[-1]), FAN)])
    return out


def _unpack(packed: bytes) -> list[bytes]:
    return [packed[i:i + 32] for i in range(0, len(packed), 32)]


def _subtrees(batches):
    """Lists of the batches' parts that belong to one (group, block)."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        g, b = batch.column("grp"), batch.column("block")
        change = pc.or_(pc.not_equal(g[1:], g[:-1]), pc.not_equal(b[1:], b[:-1]))
        cuts = [int(i) + 1 for i in pc.indices_nonzero(change)]
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            key = g[lo].as_py(), b[lo].as_py()
            if last is not None and key != last:
                yield last, held
                held = []
            last = key
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield last, held


def _block_task(batches):
    rows = []
    for (grp, block), held in _subtrees(batches):
        part = pa.Table.from_batches(held)
        digests, n = part.column("digest").to_pylist(), part.column("n")[0].as_py()
        rows.append({"grp": grp, "block": block, "n": n, "digests": b"".join(digests),
                     "ids": part.column("id").to_pylist(), "others": part.column("other").to_pylist(),
                     "node": levels_of(digests, n)[-1][0]})
        if len(rows) == 64:
            yield pa.RecordBatch.from_pylist(rows, _BLOCK_ARROW)
            rows = []
    if rows:
        yield pa.RecordBatch.from_pylist(rows, _BLOCK_ARROW)


_BLOCK_ARROW = pa.schema([("grp", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("digests", pa.binary()),
                          ("ids", pa.list_(pa.int64())), ("others", pa.list_(pa.binary())), ("node", pa.binary())])
_TAIL_ARROW = pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("tail", pa.binary()),
                         ("shape", pa.list_(pa.int32())), ("subroot", pa.binary())])


def _proofs(row):
    """(place, digest, siblings up to the root, how many stand left and right
    of the path on each level) of every node of a stored subtree."""
    digests = _unpack(row["digests"])
    levels = levels_of(digests, row["n"])
    for i, digest in enumerate(digests):
        siblings, shape, k = [], [], i
        for level in levels[:-1]:
            run = k - k % FAN
            left, right = level[run:k], level[k + 1:run + FAN]
            siblings += left + right
            shape += [len(left), len(right)]
            k //= FAN
        yield row["block"] * BLOCK + i, digest, b"".join(siblings) + row["tail"], shape + row["shape"]


def _tail_task(subroots: bool):
    """Proofs of the nodes; ``subroots``: the nodes are the groups' subroots."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist(
                    [{"grp": row["grp"], "pos": pos, "tail": tail, "shape": shape,
                      "subroot": digest if subroots else row["subroot"]}
                     for pos, digest, tail, shape in _proofs(row)], _TAIL_ARROW)
    return run


def fold(leaf: bytes, siblings: bytes, shape: list[int]) -> bytes:
    """The root that a leaf and its proof give."""
    text, cur, at = siblings.hex().encode(), leaf, 0
    for left, right in zip(shape[::2], shape[1::2], strict=True):
        mid, end = at + 64 * left, at + 64 * (left + right)
        cur = sha256(text[at:mid] + cur.hex().encode() + text[mid:end]).digest()
        at = end
    return cur


_PROOF_ARROW = pa.schema([("id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                          ("siblings", pa.list_(pa.string())), ("shape", pa.list_(pa.int32()))])
_AUDIT_ARROW = pa.schema([("id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                          ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())])


def _leaf_task(root: bytes, audit: bool):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                out = []
                for k, (_, leaf, tail, shape) in enumerate(_proofs(row)):
                    one = {"id": row["ids"][k], "leaf": leaf.hex(), "subroot": row["subroot"].hex(), "root": root.hex()}
                    if audit:
                        folded = fold(row["others"][k] or leaf, tail, shape)
                        one |= {"proof_sha256": sha256(tail.hex().encode()).hexdigest(), "folded_root": folded.hex(),
                                "verified": folded == root}
                    else:
                        one |= {"siblings": [d.hex() for d in _unpack(tail)], "shape": shape}
                    out.append(one)
                yield pa.RecordBatch.from_pylist(out, _AUDIT_ARROW if audit else _PROOF_ARROW)
    return run


def _store(nodes: DataFrame) -> list[DataFrame]:
    """Stored levels of the trees over ``grp, pos, n, digest, id, other``, the
    lowest first; every round stores the level two above."""
    rounds = []
    while True:
        blocks = write_table(
            nodes.withColumn("block", F.floor(F.col("pos") / BLOCK))
            .repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")
            .select("grp", "block", "n", "digest", "id", "other").mapInArrow(_block_task, _BLOCK), "subtrees")
        rounds.append(blocks)
        nodes = blocks.where(F.col("n") > BLOCK).select(
            "grp", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("node").alias("digest"),
            F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("binary").alias("other"))
        if nodes.isEmpty():
            return rounds


def _tops(rounds: list[DataFrame]) -> DataFrame:
    out = None
    for blocks in rounds:
        top = blocks.where(F.col("n") <= BLOCK).select("grp", F.col("node").alias("digest"))
        out = top if out is None else out.unionByName(top)
    return out


def _with_tails(blocks: DataFrame, tails: DataFrame) -> DataFrame:
    return blocks.join(broadcast_if_small(tails.withColumnRenamed("pos", "block")), ["grp", "block"])


def _down(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest stored subtrees with the proofs of their top nodes; ``tops``
    has the proof of each group's own top (``pos`` 0)."""
    tails = write_table(tops, "tails")
    for r in range(len(rounds) - 1, 0, -1):
        here = rounds[r].select("grp", "block", "n", "digests")
        # groups that end below have their proofs ready
        nodes = _with_tails(here, tails).mapInArrow(_tail_task(False), _TAIL)
        ready = tails.join(broadcast_if_small(here.where("block = 0").select("grp")), "grp", "left_anti")
        tails = write_table(nodes.unionByName(ready), "tails")
    return _with_tails(rounds[0], tails)


@dataclass
class Manifest:
    """The stored levels of the groups' trees and of the tree over them."""
    groups: list[DataFrame]
    top: list[DataFrame]
    root: bytes | None


def build(rows: DataFrame) -> Manifest:
    """Manifest of ``id bigint, grp string, digest binary, other binary``
    (``grp`` null: the group that comes first; ``other`` a digest to fold
    instead of the leaf's own in an audit, or null)."""
    # null and texts in one column that sorts bytewise with null first
    keyed = rows.withColumn("grp", F.when(F.col("grp").isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), "grp")))
    leaves = ranked(keyed, "grp", [F.col("id").asc_nulls_first(), F.col("digest")])
    groups = _store(leaves)
    drop_table(leaves)
    subroots = ranked(_tops(groups).select(F.lit("").alias("grp"), F.col("grp").alias("member"), "digest"),
                      "grp", [F.col("member")])
    members = write_table(subroots.select("member", "pos"), "members")
    top = _store(subroots.withColumn("id", F.col("pos")).withColumn("other", F.lit(None).cast("binary")))
    drop_table(subroots)
    top[0].members = members
    root = _tops(top).head()
    return Manifest(groups, top, None if root is None else bytes(root["digest"]))


def proofs(manifest: Manifest, audit: bool = False) -> DataFrame:
    """A proof per leaf: ``id, leaf, subroot, root, siblings, shape``;
    ``siblings`` from the leaf's level to the root's, left to right, ``shape``
    how many of a level stand left and right of the path.  With ``audit``
    ``proof_sha256, folded_root, verified`` come instead of the last two."""
    spark = manifest.groups[0].sparkSession
    empty = [{"grp": "", "pos": 0, "tail": b"", "shape": [], "subroot": None}]
    lowest = _down(manifest.top, spark.createDataFrame(empty, _TAIL))
    of_groups = (lowest.select("grp", "block", "n", "digests", "tail", "shape", "subroot").mapInArrow(_tail_task(True), _TAIL)
                 .select("pos", "tail", "shape", "subroot").join(manifest.top[0].members, "pos")
                 .select(F.col("member").alias("grp"), F.lit(0).cast("bigint").alias("pos"), "tail", "shape", "subroot"))
    blocks = _down(manifest.groups, of_groups)
    last = ("proof_sha256 string, folded_root string, verified boolean" if audit
            else "siblings array<string>, shape array<int>")
    return blocks.mapInArrow(_leaf_task(manifest.root or b"", audit),
                             f"id bigint, leaf string, subroot string, root string, {last}")


def audit(docs: DataFrame, tampered: dict[str, Column] | None = None, id_col: str = "doc_id", group_col: str = "source",
          columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """One row per row of ``docs``: ``id_col, leaf, subroot, root,
    proof_sha256, folded_root, verified``: every leaf's proof, folded again
    from the row as it is after ``tampered`` (a new value by column; a null
    one leaves the row alone).

    Edge cases: a null value is ``-`` in the digest and differs from an empty
    text; rows with a null id come first in their group, those with a null
    group form the first group; rows that share an id stand in the order of
    their digests, repeated rows are leaves of their own; a group of one row
    has the leaf as its subroot; columns not in ``columns`` aren't read; an
    empty table gives an empty result."""
    plain = [F.col(c) for c in columns]
    changed = [tampered.get(c, F.col(c)) for c in columns] if tampered else None
    other = F.lit(None).cast("binary")
    if changed:
        touched = F.greatest(F.lit(False), *(v.isNotNull() for v in tampered.values()))
        other = F.when(touched, row_digest([F.coalesce(v, p) for v, p in zip(changed, plain, strict=True)]))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(group_col).cast("string").alias("grp"),
                       row_digest(plain).alias("digest"), other.alias("other"))
    return proofs(build(rows), audit=True).withColumnRenamed("id", id_col)
