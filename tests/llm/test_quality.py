import zlib

import numpy as np
from conftest import document_rows, prose

from quarry.llm import quality
from quarry.llm import wordhash as W


def labelled(n):
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        text = prose(i, 60 + i % 50)
        rows.append((i, text if good else "!! ".join(text.upper().split(" ")), "en", "s", 1))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = labelled(600)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lab = spark.createDataFrame(labels + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    got = quality.score(docs, quality.train(docs, lab)).collect()
    assert {r.doc_id for r in got if r.held_out} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1}
    truth = {i: q for i, q, _ in labels}
    assert np.mean([r.predicted == truth[r.doc_id] for r in got if r.held_out]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_labels_of_held_out_rows_change_nothing(spark):
    rows, labels = labelled(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, 0) for i, q, _ in labels]
    a, b = (quality.train(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int"))
            for x in (labels, flipped))
    x = np.random.default_rng(0).random((50, len(quality.FEATURES)))
    assert (a.score(x) == b.score(x)).all()


def test_awkward_rows(spark, wide, no_docs):
    rows, labels = labelled(100)
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.train(train, lab)
    got = quality.score(wide, model).collect()
    assert len(got) == len(document_rows()) and all(r.score is not None for r in got)
    assert sum(r.doc_id is None and r.held_out for r in got) == 2
    kept = quality.keep_good(wide, model)
    assert kept.dtypes == wide.dtypes and kept.count() == sum(r.predicted for r in got)
    assert quality.score(no_docs, model).collect() == [] and quality.keep_good(no_docs, model).collect() == []
    blank = quality.train(no_docs, lab)
    assert {r.score for r in quality.score(wide, blank).collect()} == {0.5}
    assert quality.train(train, lab.limit(0)).score(np.zeros((1, len(quality.FEATURES))))[0] == 0.5


def test_features_do_not_depend_on_buffers(monkeypatch):
    import pyarrow as pa
    texts = [r[1] for r in document_rows()]
    raw, off = W.text_bytes(pa.array(texts, pa.string()))
    whole = quality.features(raw, off)
    monkeypatch.setattr(W, "BUFFER_BYTES", 1000)
    assert np.allclose(quality.features(raw, off), whole)


def test_pair_table_learns_an_interaction():
    r = np.random.default_rng(2)
    x = r.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert ((model.score(x) >= 0.5) == y).mean() > 0.95


def test_repeated_ids_do_not_take_over_the_fit(spark):
    """Copies of one labelled document, and other texts under its id, leave the model as good."""
    rows, labels = labelled(300)
    extra = [(0, rows[0][1], "en", "s", 1)] * 2000 + [(0, prose(9000 + i, 40), "en", "s", 1) for i in range(50)]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string, source string, n_chars long")
    lab = spark.createDataFrame(labels + [labels[0]] * 500, "doc_id long, quality int, toxic int")
    once = spark.createDataFrame(rows + extra[2000:], docs.schema)
    a, b = quality.train(docs, lab), quality.train(once, spark.createDataFrame(labels, lab.schema))
    x = np.random.default_rng(0).random((50, len(quality.FEATURES)))
    assert (a.score(x) == b.score(x)).all()
    small = quality.train(docs, lab, max_rows=100)
    got = quality.score(once, small).where("doc_id > 0").collect()
    truth = {i: q for i, q, _ in labels}
    assert np.mean([r.predicted == truth[r.doc_id] for r in got]) > 0.9


def logit(p):
    return float(np.log(p / (1 - p)))


def best_cut(rows, a, b, ridge):
    """Bins a..cut and cut..b with the largest gain, every cut tried; rows: (bin, gradient, curvature)."""
    def part(lo, hi):
        g, h = (sum(r[k] for r in rows if lo <= r[0] < hi) for k in (1, 2))
        return g * g / (h + ridge)
    cuts = [(part(a, c) + part(c, b) - part(a, b), -c) for c in range(a + 1, b)]
    return -max(cuts)[1] if cuts else a


def test_one_round_against_brute_force():
    """A round visits the features in turn; each step is a tree of two levels on the present slopes, found here by
    trying every cut row by row."""
    r = np.random.default_rng(5)
    x = r.random((150, 3)).round(1)
    y = (x[:, 0] + 0.3 * r.random(150) > 0.6).astype(float)
    ridge, rate = 5.0, 0.15
    model = quality.fit(x, y, bins=8, rounds=2, n_pairs=0, ridge=ridge, rate=rate)
    margin = [logit((y.sum() + 1) / (len(y) + 2))] * len(y)
    tables = [[0.0] * (len(e) + 1) for e in model.edges]
    for _ in range(2):
        for f, e in enumerate(model.edges):
            at = [sum(v >= c for c in e) for v in x[:, f]]
            p = [1 / (1 + np.exp(-m)) for m in margin]
            rows = [(b, t - q, q * (1 - q)) for b, t, q in zip(at, y, p)]
            n = len(e) + 1
            mid = best_cut(rows, 0, n, ridge)
            ends = sorted({0, best_cut(rows, 0, mid, ridge), mid, best_cut(rows, mid, n, ridge), n})
            for a, b in zip(ends, ends[1:]):
                g, h = (sum(q[k] for q in rows if a <= q[0] < b) for k in (1, 2))
                for c in range(a, b):
                    tables[f][c] += rate * g / (h + ridge)
                margin = [m + rate * g / (h + ridge) if a <= b0 < b else m for m, b0 in zip(margin, at)]
    for got, want in zip(model.tables, tables, strict=True):
        assert np.allclose(got, want, atol=1e-9)


def test_scores_against_brute_force(spark):
    """A document's score is the sum of its entries, looked up one by one."""
    rows, labels = labelled(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert model.pairs and all(len(t) == len(e) + 1 for e, t in zip(model.edges, model.tables))
    import pyarrow as pa
    x = quality.features(*W.text_bytes(pa.array([q[1] for q in rows])))
    at = lambda edges, v: sum(v >= c for c in edges)
    got = {q.doc_id: q for q in quality.score(docs, model).collect()}
    for (i, *_), v in zip(rows, x):
        m = model.base + sum(t[at(e, v[k])] for k, (e, t) in enumerate(zip(model.edges, model.tables)))
        m += sum(t[at(ei, v[a]), at(ej, v[b])] for a, b, ei, ej, t in model.pairs)
        assert abs(got[i].score - 1 / (1 + np.exp(-m))) < 1e-9 and got[i].predicted == int(got[i].score >= 0.5)
