import random

import brute
import numpy as np
import pytest
from conftest import document_rows, edited, prose

from quarry.llm import graph, minhash


def answer(df):
    return sorted(((r[0], r[1], r[2]) for r in df.collect()), key=brute.key)


@pytest.mark.parametrize("width", [4, 5])
def test_awkward_rows(spark, wide, width):
    got = minhash.near_duplicates(wide, width=width)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = sorted(brute.near_duplicates([r[:2] for r in document_rows()], width), key=brute.key)
    assert answer(got) == want
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got.collect())


def test_group_of_copies_and_near_copies(spark):
    """Many edited copies whose similarities lie about the threshold."""
    base = prose(77, 100)
    rows = [(i, edited(base, i, i % 6) if i % 5 else base) for i in range(150)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4)
    assert answer(got) == sorted(brute.near_duplicates(rows, 4), key=brute.key)


@pytest.mark.parametrize("repeats", [1, 2, 3])
def test_repeated_rows_behind_unlinked_hubs(spark, repeats):
    """Two near-copies whose buckets all have smaller ids that neither links with."""
    rows = []
    for g in range(12):
        base = prose(30_000 + g, 100)
        rows += [(100 * g + i, edited(base, 100 * g + i, 3 if i < 30 else 1)) for i in range(32)]
    want = brute.near_duplicates(rows, 4)
    assert sum(c != i for i, _, c in want) >= 12
    got = minhash.near_duplicates(spark.createDataFrame(rows * repeats, "doc_id long, text string"), width=4)
    assert answer(got) == sorted(want * repeats, key=brute.key)


def test_empty(spark, no_docs):
    assert minhash.near_duplicates(no_docs).collect() == []
    assert minhash.keep_first(no_docs).collect() == []


def test_keep_first(spark, wide):
    got = minhash.keep_first(wide, width=5)
    assert got.dtypes == wide.dtypes
    ids = [r.doc_id for r in got.collect()]
    known = [i for i in ids if i is not None]
    want = {c for i, _, c in brute.near_duplicates([r[:2] for r in document_rows()], 5) if i is not None}
    assert sorted(known) == sorted(want)
    assert ids.count(None) == 2


def test_sketch_estimates_similarity():
    r = np.random.default_rng(0)
    a = np.unique(r.integers(0, 1 << 62, 900).astype(np.uint64))
    b = np.concatenate([a[:600], np.unique(r.integers(0, 1 << 62, 300).astype(np.uint64))])
    h = np.concatenate([a, b])
    o = np.repeat([0, 1], [len(a), len(b)])
    s = minhash.sketch(h, o, 3, 2000)
    j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((s[0] == s[1]).mean() - j) < 0.05
    assert (s[:2] != np.uint64(0xFFFFFFFFFFFFFFFF)).all() and (s[2] == np.uint64(0xFFFFFFFFFFFFFFFF)).all()


def test_components(spark):
    r = random.Random(4)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)]
    links += [(None, 3), (5, None), (7, 7)]
    got = graph.connected_components(spark.createDataFrame(links, "a long, b long"))
    want = brute.components([x for x in links if None not in x and x[0] != x[1]])
    assert {x.node: x.component for x in got.collect()} == want


def test_tile_tools():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 60, r.integers(1, 40)).astype(np.uint64)) for _ in range(30)]
    both = minhash.overlaps(sets, block=7)
    assert all(both[i, k] == len(np.intersect1d(sets[i], sets[k])) for i in range(30) for k in range(30))

