import hashlib
import random

import brute
from conftest import document_rows

from quarry.llm import pii


def joined(spans):
    order = list(pii.KINDS)
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (order.index(s[0]), s[1], s[2])))


def test_base_patterns_at_random():
    r = random.Random(1)
    for _ in range(4000):
        text = "".join(r.choice("aZ9904.@+-_ ()%é\n255") for _ in range(r.randrange(60)))
        assert pii.base_spans(text) == brute.base_spans(text), text


def test_awkward_rows(spark, wide, no_docs):
    field = pii.learn(wide)
    got = pii.find(wide, field)
    rows = [r[:2] for r in document_rows()]
    want = sorted(((i, *(sum(s[0] == k for s in brute.base_spans(t)) for k in pii.KINDS),
                    hashlib.sha256(joined(brute.base_spans(t)).encode()).hexdigest()) for i, t in rows), key=brute.key)
    assert sorted((tuple(r)[:6] for r in got.collect()), key=brute.key) == want
    texts = {i: t for i, t in rows if i}
    for r in got.collect():
        spans = [s for s in r.spans.split(",") if s]
        assert len(spans) == r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added
        if r.doc_id:
            assert set(joined(brute.base_spans(texts[r.doc_id])).split(",")) - {""} <= set(spans)
    assert pii.find(no_docs, pii.learn(no_docs)).collect() == []
    assert pii.mask(wide, field).dtypes == wide.dtypes and pii.mask(wide, field).count() == len(rows)


def test_field_adds_what_repeats(spark):
    """Two card numbers in a row are one dropped base match; the field marks
    each, and leaves numbers alone whose shape is no card's."""
    rows = [(i, f"word 4539578763621486 and 10.0.0.{i} or {i} of 12345, version 3.") for i in range(40)]
    rows.append((100, "two 4539578763621486 4539578763621486 here, 99 of 12345"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(docs, pii.learn(docs)).collect()}
    assert got[100].n_card == 0 and got[100].spans == "card:4:20,card:21:37"
    assert all(got[i].n_added == 0 for i in range(40))


def test_messages_agree_with_enumeration():
    """On a tree, loopy sum-product is exact."""
    import itertools

    import numpy as np
    r = np.random.default_rng(0)
    counts = r.integers(0, 9, (pii.SHAPES + 15, 5))
    f = pii.Field(counts, (0.9, 1.2, 0.7, 1.1))
    tokens = [(0, 1, s, str(s), 0) for s in (3, 50, 700, 3, 9)]
    label = np.array([-1, -1, 2, -1, -1])
    edges = np.array([[0, 1], [1, 2]]), np.array([[0, 3]]), np.array([[4, 1]])
    total = np.zeros((5, 5))
    for x in itertools.product(range(5), repeat=5):
        if x[2] == 2:
            e = sum(f.unary[t[2], k] for i, (t, k) in enumerate(zip(tokens, x)) if i != 2)
            e += sum(f.edges[k][x[a], x[b]] for k in range(3) for a, b in edges[k])
            for i in range(5):
                total[i, x[i]] += np.exp(e)
    assert np.allclose(f.beliefs(tokens, label, edges, 200), total / total.sum(axis=1, keepdims=True), atol=1e-3)


def test_masked():
    assert pii.masked("ab cd ef", [("ip", 3, 5), ("card", 3, 8)]) == "ab [CARD]"
    assert pii.masked("ab cd ef", []) == "ab cd ef"


def test_long_runs_take_linear_time():
    import time
    text = "0" * 200_000 + " " + "1." * 50_000 + " " + "a@" * 50_000 + " " + "+1" * 50_000 + "x" * 200_000
    began = time.perf_counter()
    spans = pii.base_spans(text)
    tokens = pii.nodes(text, spans)[0]
    pii.near_links(tokens)
    assert time.perf_counter() - began < 10


def test_near_links_against_brute_force():
    r = random.Random(3)

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    for _ in range(60):
        keys = ["".join(r.choice("12é") for _ in range(r.randrange(6, 11))) for _ in range(25)]
        keys += [k[:3] + k[4:] for k in keys[:8]] + [k[:5] + "7" + k[5:] for k in keys[:8]] + [k[:-1] + "@" for k in keys[:8]]
        r.shuffle(keys)
        got = [tuple(x) for x in pii.near_links([(0, 0, 0, k, 0) for k in keys]).tolist()]
        long = [i for i, k in enumerate(keys) if len(k) >= pii.NEAR_LENGTH and k not in keys[:i]]
        assert all(j < i and j in long and i in long and edits(keys[j], keys[i]) == 1 for j, i in got) and len(set(got)) == len(got)
        # every key with a near one before is linked to one
        assert {i for i in long if any(edits(keys[j], keys[i]) == 1 for j in long if j < i)} == {i for _, i in got}
        for a in keys[:12]:
            assert all(pii.one_edit(a, b) == (edits(a, b) == 1) for b in keys)


def test_weights_against_a_scan(spark):
    """The fitted weights leave no slope in the likelihood, computed example by example."""
    import numpy as np
    r = np.random.default_rng(4)
    field = pii.Field(r.integers(0, 40, (pii.SHAPES + 15, 5)))
    cells = [[int(r.integers(0, 50)), int(r.integers(0, 2)), int(r.choice([0, 1, 1, 3, 4])), *map(int, r.integers(0, 2, 15))]
             for _ in range(400)]
    n = [int(x) for x in r.integers(1, 5, 400)]
    table = spark.createDataFrame(list(zip(cells, n)), "cell array<bigint>, n bigint").repartition(5)

    def slope(w):
        out = -pii.RIDGE * (w - 1)
        for c, m in zip(cells, n):
            if c[2] == 0 and field.open[c[0]]:
                continue
            f = np.array([np.log(field.prior) if c[1] else field.unary[c[0]],
                          *(sum(c[3 + 5 * k + x] * field.edges[k][x] for x in range(5)) for k in range(3))])
            p = np.exp(w @ f) / np.exp(w @ f).sum()
            out = out + m * (f[:, c[2]] - f @ p)
        return out

    w = pii.fit_weights(field, table)
    inside = (w > 0) & (w < 3)
    assert inside.any() and (np.abs(slope(w))[inside] < 0.5).all() and np.abs(slope(np.ones(4))).max() > 5
    assert (slope(w)[w == 0] <= 0).all() and (slope(w)[w == 3] >= 0).all()
    assert (pii.fit_weights(field, table.limit(0)) == 1).all()


def test_hidden_spans_of_held_out_documents(spark):
    """Numbers that the patterns drop, since two stand in one match or a digit is wrong, are told by their twins."""
    r = random.Random(8)

    def card():
        head = "4" + "".join(r.choice("0123456789") for _ in range(14))
        return next(head + d for d in "0123456789" if pii.luhn(head + d))

    rows = []
    for i in range(400):
        c = card()
        rows.append((i, f"pay {c} now , order {r.randrange(10**6, 10**7)} of {c} and {r.randrange(100)} items"))
    for i in range(400, 420):
        c = card()
        rows.append((i, f"pay {c} now , again {c} {c} here , order {r.randrange(10**6, 10**7)}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x for x in pii.find(docs, pii.learn(docs)).collect()}
    assert all(got[i].n_added == 0 for i in range(400))
    assert sum(got[i].n_added == 2 for i in range(400, 420)) >= 18
