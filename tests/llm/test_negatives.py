import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import negatives

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, anchor, top=5):
    """rows: (id, vector, label), as they are in the table."""
    use = []
    for i, v, y in {(i, None if v is None else tuple(v), y) for i, v, y in rows}:
        if i is None or y is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]
        if sum(x * x for x in q) <= 2 ** 60:
            use.append((i, y, q))
    out = []
    for i, y, q in use:
        if not anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, p)), j, z) for j, z, p in use if j != i and len(p) == len(q))
        for s, j, _ in [r for r in scored if r[2] == y][:top]:
            window = [r for r in scored if r[2] != y and 80 * -s <= 100 * -r[0] <= 100 * -s]
            out += [(i, j, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(window[:top])]
    return sorted(out)


def answer(df):
    return sorted(tuple(r) for r in df.collect())


def clustered(n, dim, seed, labels=4):
    r = np.random.default_rng(seed)
    centers = r.standard_normal((6, dim))
    x = centers[r.integers(0, 6, n)] + 0.4 * r.standard_normal((n, dim))
    return [(i, [float(np.float32(v)) for v in x[i]], int(r.integers(0, labels))) for i in range(n)]


def test_awkward_rows(spark):
    rows = clustered(90, 8, 1)
    rows += [(100, None, 1), (101, [1.0] * 8, None), (102, [1.0, None] * 4, 1), (103, [float("nan")] * 8, 1),
             (104, [float("inf")] * 8, 2), (105, [], 1), (110, [], 1), (None, [1.0] * 8, 1), (106, [0.0] * 8, 0),
             (107, [1e30] * 8, 0), (108, [2.0] * 5, 1), (109, [1.5] * 5, 1), (120, [1.0] * 5, 2), (130, [1.0], 3), (131, [0.9], 2)]
    rows += [rows[0], rows[0], (20, [0.5] * 8, 3), (30, [3e4] * 8, 1), (31, [3e4] * 8, 1), (33, [2.9e4] * 8, 2)]
    rows += [(200 + i, rows[7][1], i % 3) for i in range(30)]  # ties
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    clash = ["id", "row", "anchor", "v", "dim", "shard", "grp", "role", "c1", "c2", "targets", "rank", "score"]
    got = negatives.hard_negatives(df.select("*", *(F.lit("x").alias(c) for c in clash)), F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert answer(got) == brute(rows, lambda i: i % 10 == 0)
    none = spark.createDataFrame([], VECTORS)
    assert negatives.hard_negatives(none, F.col("vec_id") % 10 == 0).collect() == []


@pytest.mark.parametrize("dim", [2, 33])
def test_several_shards_and_a_hot_vector(spark, monkeypatch, dim):
    rows = clustered(1500, dim, dim)
    hot = [1.0 + 0.1 * k for k in range(dim)]
    rows += [(5000 + i, hot, i % 5) for i in range(700)]
    monkeypatch.setattr(negatives, "SHARD_ROWS", 256)  # read by the driver: several shards and groups of anchors
    monkeypatch.setattr(negatives, "GROUP_SHARDS", 0.05)
    got = negatives.hard_negatives(spark.createDataFrame(rows, VECTORS).repartition(5), F.col("vec_id") % 50 == 0)
    assert answer(got) == brute(rows, lambda i: i % 50 == 0)


def shard_of(rows):
    x = np.floor(256 * np.array([v for _, v, _ in rows]))
    half = x.shape[1] // 2
    c1, c2 = negatives.codebook(x[:, :half]), negatives.codebook(x[:, half:])
    order = np.lexsort((c2, c1))
    ids, labels = np.array([i for i, *_ in rows]), np.array([y for *_, y in rows])
    return negatives.Shard(x[order], ids[order], labels[order], ids[order], c1[order], c2[order])


def test_cells_come_by_bound_and_hold_their_rows():
    shard = shard_of(clustered(3000, 16, 3))
    r = random.Random(2)
    for _ in range(5):
        a = shard.x[r.randrange(3000)]
        cells = list(shard.cells(a[None]))
        assert len({c for *_, c in cells}) == len(cells) == len(shard.names1) * len(shard.names2)
        assert all(x[0] >= y[0] for x, y in zip(cells, cells[1:]))
        for up, low, c in cells:
            s = shard.x[shard.first[c]:shard.first[c + 1]] @ a
            assert ((s <= up) & (s >= low)).all()


def test_search_stops_early():
    """Of clustered rows, a search looks at a part only."""
    shard = shard_of(clustered(6000, 8, 4))
    no = np.array([-1])
    for k in range(0, 6000, 600):
        q, _, got = shard.search(shard.x[k:k + 1], no, no, False, np.zeros(1, int), np.array([negatives.LOWEST]),
                                 np.array([negatives.HIGHEST]), 5)
        assert got.tolist() == np.sort(shard.x @ shard.x[k])[::-1][:5].astype(int).tolist() and not q.any()
    assert shard.scored < 0.3 * 10 * 6000


@pytest.mark.parametrize("same", [True, False])
def test_queries_that_share_a_heap(same):
    """Each query's answer is that of a scan of the shard; open and closed windows, ties, anchors of the shard."""
    rows = clustered(3000, 6, 9)
    rows += [(9000 + i, rows[0][1], i % 4) for i in range(40)]
    shard = shard_of(rows)
    r = np.random.default_rng(1)
    pick = r.integers(0, len(rows), 30)
    who = np.sort(r.integers(0, 30, 70))
    a, ids, labels = shard.x[pick], shard.ids[pick], shard.labels[pick]
    full = (a @ shard.x.T).astype(np.int64)
    most = np.array([r.choice(full[w]) for w in who])
    least = np.where(r.random(70) < 0.5, negatives.LOWEST, (0.8 * most).astype(np.int64))
    got = list(zip(*(v.tolist() for v in shard.search(a, ids, labels, same, who, least, most, 4))))
    want = []
    for k, w in enumerate(who):
        fits = [i for i in range(len(rows)) if shard.ids[i] != ids[w] and (shard.labels[i] == labels[w]) == same
                and least[k] <= full[w, i] <= most[k]]
        want += [(k, i, full[w, i]) for i in sorted(fits, key=lambda i: (-full[w, i], shard.ids[i], shard.rows[i]))[:4]]
    assert got == want
