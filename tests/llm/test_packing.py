import random

from conftest import document_rows

from quarry.llm import minhash, packing, tokens


def brute_best_fit(pieces, capacity):
    bins, out = [], []
    for size, source, cluster in pieces:
        if not size:
            out.append((-1, 0))
            continue
        fits = [(capacity - sum(p[0] for p in b), k) for k, b in enumerate(bins)
                if capacity - sum(p[0] for p in b) >= size
                and not any(p[1] == source is not None or p[2] == cluster is not None for p in b)]
        k = min(fits)[1] if fits else len(bins)
        if k == len(bins):
            bins.append([])
        out.append((k, sum(p[0] for p in bins[k])))
        bins[k].append((size, source, cluster))
    return out


def test_best_fit_against_brute_force():
    r = random.Random(3)
    for _ in range(60):
        pieces = sorted(((r.randrange(0, 21), r.choice([None, "a", "b", "c"]), r.choice([None, 1, 2, 3, 4]))
                         for _ in range(50)), key=lambda p: -p[0])
        assert packing.best_fit(pieces, 20) == brute_best_fit(pieces, 20)


def test_awkward_rows(spark, wide, no_docs):
    rows = packing.pack(wide, capacity=100, group_rows=20).collect()
    want = {}
    for i, t, _, s, _ in document_rows():
        n = len((t or "").split())
        want.setdefault((i, s), []).extend([(k, a, min(100, n - a)) for k, a in enumerate(range(0, n, 100))] or [(0, 0, 0)])
    got = {}
    for r in rows:
        got.setdefault((r.doc_id, r.source), []).append((r.piece, r.first_word, r.n_words))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    bins = {}
    for r in rows:
        assert (r.bin_id is None) == (r.n_words == 0)
        bins.setdefault(r.bin_id, []).append(r)
    bins.pop(None)
    for b in bins.values():
        b.sort(key=lambda r: r.bin_offset)
        assert [r.bin_offset for r in b] == [sum(x.n_words for x in b[:k]) for k in range(len(b))]
        assert sum(r.n_words for r in b) <= 100
        sources = [r.source for r in b if r.source is not None]
        assert len(sources) == len(set(sources)) and len({r.cluster for r in b}) == len(b)
    assert packing.pack(no_docs).collect() == []


def test_repeated_rows_are_spread(spark):
    rows = [(7, "a b c", "s")] * 1500 + [(None, None, None)] * 900 + [(i, f"w{i} x", f"t{i}") for i in range(100, 700)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5),
                       capacity=100, group_rows=100).collect()
    assert len(got) == len(rows) and sum(r.doc_id == 7 for r in got) == 1500
    assert len({r.bin_id for r in got if r.doc_id == 7}) == 1500  # copies never share a bin
    group = {}
    for r in got:
        if r.bin_id is not None:
            group.setdefault(r.bin_id >> 32, set()).add(r.bin_id)
            assert 0 <= r.bin_offset < 100
    copies = [sum(r.bin_id is not None and r.bin_id >> 32 == g and r.doc_id == 7 for r in got) for g in group]
    assert max(copies) <= 200


def test_given_clusters_keep_apart(spark):
    """The classes of the near-duplicate operator feed the bitmap; rows
    without one are apart by their words."""
    base = " ".join(f"w{i}" for i in range(30))
    rows = [(i, base + f" end{i}", None) for i in range(6)] + [(10 + i, f"x{i} y z", None) for i in range(30)]
    docs = spark.createDataFrame(rows + [(None, "x0 y z", None), (None, "x0 y z", None)],
                                 "doc_id long, text string, source string")
    classes = minhash.near_duplicates(docs, width=4, similarity=(80, 100)).where("doc_id IS NOT NULL")
    classes = classes.select("doc_id", "component_id")
    got = packing.pack(docs.join(classes, "doc_id", "left"), capacity=1000, cluster_col="component_id").collect()
    assert len(got) == len(rows) + 2
    assert {r.cluster for r in got if r.doc_id is not None and r.doc_id < 6} == {0}
    assert len({r.bin_id for r in got if r.doc_id is not None and r.doc_id < 6}) == 6
    assert len({r.bin_id for r in got if r.doc_id is None}) == 2
    plain = packing.pack(docs, capacity=1000).collect()
    assert len({r.bin_id for r in plain if r.doc_id is not None and r.doc_id < 6}) == 1


def test_capacity_tree_against_brute_force():
    r = random.Random(5)
    for _ in range(60):
        sizes = [r.randrange(1, 33) for _ in range(40)]
        free, out = [32 - 20, 32 - 32, 5], [None] * len(sizes)
        want = list(free)
        for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
            fits = [f for f in want if f >= sizes[k]]
            if not fits:
                want.append(32)
            row = min((f, i) for i, f in enumerate(want) if f >= sizes[k])[1]
            want[row] -= sizes[k]
            out[k] = row
        got = tokens.best_fit_decreasing(sizes, 32, free)
        left = list(free) + [32] * (max(got) + 1 - len(free))
        for k, row in enumerate(got):
            left[row] -= sizes[k]
        assert sorted(left) == sorted(want) and min(left) >= 0


def test_token_rows_round_trip(spark, wide, no_docs):
    import numpy as np
    enc = tokens.encoder(tokens.VOCABULARY)
    parts = {}
    for r in tokens.packed_ids(wide, width=64, window=5000).collect():
        ids, cu = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.cu_seqlens, "<i4")
        assert len(ids) == 64 and cu[0] == 0 and cu[-1] == r.n_tokens <= 64 and len(cu) == len(r.doc_ids) + 1
        assert np.flatnonzero(np.unpackbits(np.frombuffer(r.resets, np.uint8))).tolist() == cu[:-1].tolist()
        for k, (d, f) in enumerate(zip(r.doc_ids, r.first_tokens)):
            parts.setdefault(d, []).append((f, ids[cu[k]:cu[k + 1]].tolist()))
    counts = {}
    for i, t, *_ in document_rows():
        if t:
            counts.setdefault(i, []).append(t)
    assert set(parts) == set(counts)
    for i, texts in counts.items():
        if len(texts) == 1:
            whole = [x for _, p in sorted(parts[i]) for x in p]
            assert enc.decode(whole) == texts[0]
        else:
            assert sum(len(p) for _, p in parts[i]) == sum(len(enc.encode_ordinary(t)) for t in texts)
    assert tokens.packed_ids(no_docs).collect() == []


def test_ids_of_extreme_texts(spark):
    """Long runs give the plain encoder's ids, and no run breaks it."""
    import numpy as np
    enc = tokens.encoder(tokens.VOCABULARY)
    for gap in (" ", "\n", "\t", " \n", "　 "):
        for n in (1, 999, 1999, 2000, 2001, 5000):
            for text in ("a" + gap * n + "b", gap * n, "x " + gap * n + "\ny" + gap * n, gap * n + "7", gap * n + "!"):
                assert tokens.encode(enc, text).tolist() == enc.encode_ordinary(text)
    for text in (" " * 2_000_000, "a" + "\n" * 2_000_000 + "b", "a" * 2_000_000, "x" + "\t " * 1_000_000 + "y"):
        assert enc.decode(tokens.encode(enc, text).tolist()) == text
    rows = [(1, " " * 2_000_000 + "end"), (2, "q" * 300_000), (3, "\n" * 50_000)]
    parts = {}
    for r in tokens.packed_ids(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        ids, cu = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.cu_seqlens, "<i4")
        for k, (d, f) in enumerate(zip(r.doc_ids, r.first_tokens)):
            parts.setdefault(d, []).append((f, ids[cu[k]:cu[k + 1]].tolist()))
    assert {d: enc.decode([x for _, p in sorted(v) for x in p]) for d, v in parts.items()} == dict(rows)
