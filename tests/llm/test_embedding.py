import math

import brute
import numpy as np
import pyarrow as pa
from conftest import EXTRA
from pyspark.sql import functions as F

from quarry.llm import embedding


def want(rows):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v
          and np.isfinite(np.array(v, float)).all() and np.abs(np.array(v, float)).max() > 0]
    links, n = [], {}
    for k, (i, a) in enumerate(ok):
        for m, (j, b) in enumerate(ok):
            if k != m and len(a) == len(b) and a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= 0.9:
                links.append((i, j))
                n[k] = n.get(k, 0) + 1
    comp = brute.components([x for x in links if x[0] != x[1]])
    counts, at = [], 0
    for i, v in rows:
        usable = at < len(ok) and i is not None and i == ok[at][0] and v and None not in v \
            and np.isfinite(np.array(v, float)).all() and np.abs(np.array(v, float)).max() > 0
        counts.append((i, n.get(at, 0) if usable else 0, None if i is None else comp.get(i, i)))
        at += bool(usable)
    return sorted(counts, key=brute.key)


def table():
    r = np.random.default_rng(3)
    rows, centres = [], r.standard_normal((6, 16))
    for i in range(400):
        c = centres[i % 6] + r.standard_normal(16) * (0.05 if i % 3 else 0.3)
        rows.append((i, [float(x) for x in (c if i % 4 else r.standard_normal(16))]))
    rows += [(400, None), (401, []), (402, [0.0] * 16), (403, [1.0, None] + [0.0] * 14),
             (404, [float("nan")] * 16), (405, [float("inf")] + [0.0] * 15), (406, [1.0, 0.0]), (407, [3.0, 0.0]),
             (408, [1e-30] * 16), (409, [2e-30] * 16), rows[1], rows[2], (None, rows[1][1]), (None, None)]
    rows += [(500 + i, rows[5][1]) for i in range(40)]
    return rows


def test_links_and_components(spark):
    rows = table()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    df = df.select("*", *(F.lit(1).alias(c) for c in EXTRA))
    got = embedding.near_duplicates(df, recall=0.999999)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(((r[0], r[1], r[2]) for r in got.collect()), key=brute.key) == want(rows)


def test_tiles_and_recall(spark, monkeypatch):
    """Hot blocks cut into small tiles; recall against brute force."""
    monkeypatch.setattr(embedding, "TILE", 16)
    r = np.random.default_rng(9)
    base = r.standard_normal(32)
    x = [base + r.standard_normal(32) * r.choice([0.2, 0.3, 0.45]) for _ in range(250)]
    rows = [(i, [float(v) for v in x[i]]) for i in range(250)]
    got = embedding.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    u = np.array([np.float32(v) for v in x]).astype(float)
    u /= np.sqrt((u * u).sum(axis=1))[:, None]
    s = u @ u.T >= 0.9
    np.fill_diagonal(s, False)
    found = {r.vec_id: r.n_links for r in got.collect()}
    assert all(found[i] <= s[i].sum() for i in range(250))
    assert sum(found.values()) >= 0.99 * s.sum() > 0


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding.near_duplicates(df).collect() == []


def test_count_threshold():
    """The calibrated count keeps pairs at the threshold."""
    plan = embedding.Plan(10_000, 0.9, 0.99)
    r = np.random.default_rng(0)
    a = r.standard_normal((400, 48))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = r.standard_normal((400, 48))
    b -= (a * b).sum(axis=1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    pa_, pb = plan.project(a), plan.project(0.9 * a + math.sqrt(1 - 0.81) * b)
    assert ((np.abs(pa_ - pb) <= plan.window).sum(axis=1) >= plan.need).mean() > 0.99


def test_block_recall_of_large_tables():
    """Pairs just above the threshold share a block as often as stated."""
    r = np.random.default_rng(5)
    a = r.standard_normal((3000, 48))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = r.standard_normal((3000, 48))
    b -= (a * b).sum(axis=1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    c = r.uniform(0.9, 0.905, (3000, 1))
    b = c * a + np.sqrt(1 - c * c) * b
    batch = pa.RecordBatch.from_arrays([pa.array(range(6000)), pa.array([x.tobytes() for x in np.concatenate([a, b])])],
                                       names=["id", "vec"])
    for n in (1_000_000, 100_000_000):
        plan = embedding.Plan(n, 0.9, 0.999)
        codes = np.concatenate([np.array(x.column(1).to_pylist()) for x in embedding._code_task(plan)([batch])])
        assert (codes[:3000] == codes[3000:]).any(axis=1).mean() >= 0.997
