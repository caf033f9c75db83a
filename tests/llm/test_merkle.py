import random
from collections import defaultdict
from hashlib import sha256

import pytest
from conftest import document_rows
from pyspark.sql import functions as F

from quarry.llm import merkle
from quarry.llm.ranking import ranked

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(leaves):
    """All levels of a tree over the leaves."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, i):
    for level in levels[:-1]:
        run = level[i - i % 16:i - i % 16 + 16]
        yield run[:i % 16], run[i % 16 + 1:]
        i //= 16


def brute(rows, lowered):
    """rows: (id, group, leaf, tampered leaf or None)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        trees[g] = climb([r[2] for r in groups[g]])
    top = climb([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            steps = [*path(trees[g], i), *path(top, k)]
            cur = r[3] if lowered and r[3] else r[2]
            for left, right in steps:
                cur = h("".join(left) + cur + "".join(right))
            out.append((r[0], r[2], trees[g][-1][0], top[-1][0], h("".join("".join(a + b) for a, b in steps)), cur,
                        cur == top[-1][0]))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def documents(rows):
    out = []
    for i, text, lang, source, n in rows:
        other = leaf_of((i, source, lang, n, text.translate({c: c + 32 for c in range(65, 91)}))) if text and i != 3 else None
        out.append((i, source, leaf_of((i, source, lang, n, text)), other))
    return out


def test_awkward_rows(wide, no_docs):
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    got = merkle.audit(wide, tampered={"text": F.when(F.expr("doc_id <=> 3"), F.lit(None)).otherwise(lowered)})
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = got.collect()
    assert order(rows) == order(brute(documents(document_rows()), True))
    assert {r.verified for r in rows} == {True, False}
    assert merkle.audit(no_docs).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_many_groups_and_a_hot_one(spark, seed):
    """Trees of three stored levels, and more groups than a subtree holds."""
    r = random.Random(seed)
    rows = [(i, "hot", h(f"{seed}-{i}"), None) for i in range(66_000 if seed == 1 else 4097)]
    rows += [(10**6 + i, None if i % 40 == 0 else f"g{i % 700}é", h(f"x{i // 2}"), h("t") if r.random() < 0.2 else None)
             for i in range(3000)]
    r.shuffle(rows)
    df = (spark.createDataFrame(rows, "id long, grp string, digest string, other string")
          .withColumn("digest", F.unhex("digest")).withColumn("other", F.unhex("other")).repartition(7))
    built = merkle.build(df)
    assert len(built.groups) == (3 if seed == 1 else 2) and len(built.top) == 2
    assert order(merkle.proofs(built, audit=True).collect()) == order(brute(rows, True))


def test_siblings_of_a_proof(docs):
    rows = docs.select(F.col("doc_id").alias("id"), F.col("source").alias("grp"),
                       merkle.row_digest([F.col(c) for c in COLUMNS]).alias("digest"), F.lit(None).cast("binary").alias("other"))
    built = merkle.build(rows)
    got = merkle.proofs(built).collect()
    assert len(got) == len(document_rows())
    for r in got:
        folded = merkle.fold(bytes.fromhex(r.leaf), bytes.fromhex("".join(r.siblings)), r.shape)
        assert folded.hex() == r.root == built.root.hex()
    wrong = got[0]
    assert merkle.fold(bytes(32), bytes.fromhex("".join(wrong.siblings)), wrong.shape) != built.root


def test_one_row(spark):
    one = spark.createDataFrame([(1, "A", "en", None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    r = merkle.audit(one).head()
    assert r.leaf == r.subroot == r.root == r.folded_root == leaf_of((1, None, "en", None, "A"))
    assert r.proof_sha256 == h("") and r.verified


def test_places(spark):
    rows = [("a", 5)] * 900 + [("b", i) for i in range(50)] + [("", 1)]
    got = ranked(spark.createDataFrame(rows, "k string, v long").repartition(6), "k", [F.col("v")]).collect()
    for k, n in (("a", 900), ("b", 50), ("", 1)):
        mine = sorted((r.pos, r.v) for r in got if r.k == k)
        assert [p for p, _ in mine] == list(range(n)) and [v for _, v in mine] == sorted(v for _, v in mine)
        assert {r.n for r in got if r.k == k} == {n}
