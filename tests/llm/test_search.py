"""Decontamination, passages, archives and urls."""

import random
import re
from collections import Counter

import brute
import duckdb
import numpy as np
import pytest
from conftest import EXTRA, document_rows, edited, prose
from pyspark.sql import functions as F

from quarry.llm import decontaminate, queries, substrings, urls, warc

ITEM = prose(3, 60)
BENCH = [(1, ITEM), (2, "one"), (3, "two words"), (4, prose(14, 60)), (4, "another text of item four"), (5, None),
         (6, ""), (None, prose(1, 30)), (7, prose(8, 25).upper()), (7, prose(8, 25).upper()), (8, "SÃO ünï w1 W2"),
         (9, "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1")]


def test_contamination(spark, wide, no_docs):
    bench = spark.createDataFrame(BENCH, "item_id long, text string").select("*", *(F.lit(0).alias(c) for c in EXTRA))
    got = decontaminate.contamination(wide, bench)
    want = sorted(brute.contamination([r[:2] for r in document_rows()], BENCH), key=brute.key)
    assert sorted((tuple(r)[:6] for r in got.collect()), key=brute.key) == want
    assert all(r.n_near >= r.n_items for r in got.collect())
    clean = decontaminate.clean(wide, bench)
    assert clean.dtypes == wide.dtypes
    assert sorted(((r.doc_id,) for r in clean.collect()), key=brute.key) == sorted(
        ((w[0],) for w in want if not w[5]), key=brute.key)
    empty = bench.limit(0)
    assert decontaminate.contamination(no_docs, bench).collect() == []
    assert {(r.n_hit, r.n_items) for r in decontaminate.contamination(wide, empty).collect()} == {(0, 0)}
    assert decontaminate.clean(wide, empty).count() == len(document_rows())


def test_contamination_at_random(spark):
    r = random.Random(8)
    rows = [(i, " ".join(r.choice("abc") for _ in range(r.randrange(60)))) for i in range(30)]
    bench = [(i, " ".join(r.choice("abc") for _ in range(r.randrange(14)))) for i in range(12)]
    got = decontaminate.contamination(spark.createDataFrame(rows, "doc_id long, text string"),
                                      spark.createDataFrame(bench, "item_id long, text string"))
    assert sorted(tuple(x)[:6] for x in got.collect()) == sorted(brute.contamination(rows, bench))


def brute_matches(rows, bench, width=10, near=16, close=80):
    """Matches by their definition; rows and items have ids of their own."""
    split = lambda t: [w for w in re.split("[^a-z0-9\x80-\U0010ffff]+", (t or "").translate(
        {c: c + 32 for c in range(65, 91)})) if w]
    docs = [(i, split(t)) for i, t in rows]
    count = Counter(w for _, ws in docs for w in ws)
    out = set()
    for item, t in bench:
        ws = split(t)
        for s in range(max(len(ws) - width, 0) + 1 if ws else 0):
            win = ws[s:s + width]
            held = [(count[w], o) for o, w in enumerate(win) if count[w]]
            for i, d in docs:
                out |= {(i, str(item), p, "phrase") for p in range(len(d) - len(win) + 1) if d[p:p + len(win)] == win}
                if len(held) < 2:
                    continue
                (_, a), (_, b) = sorted(held)[:2]  # the test's counts have no ties
                for p in (p - a for p, w in enumerate(d) if w == win[a]):
                    if any(abs(q - b - p) < near for q, w in enumerate(d) if w == win[b]):
                        stretch = set(d[max(p - near, 0):max(p + len(win) + near, 0)])
                        if 100 * len(set(win) & stretch) >= close * len(set(win)):
                            out.add((i, str(item), p, "near"))
    return out


def test_matches_against_brute_force(spark):
    """Windows with a word moved, dropped, put in, or that no document has, at
    all places modulo the block's width."""
    r = random.Random(12)
    vocab = [f"u{k}" for k in range(40)]
    bench = [(i, " ".join(r.sample(vocab, 12))) for i in range(5)] + [(9, "u1 never"), (10, "u2"), (11, None), (12, "never")]
    rows = []
    for i in range(70):
        w = r.choice(bench[:5])[1].split(" ")[:10]
        if i % 4 == 1:
            w = [x for x in w for x in (x, f"in{i}_{r.randrange(9)}")]
        elif i % 4 == 2:
            w[r.randrange(10)] = "other"
        elif i % 4 == 3:
            r.shuffle(w)
        rows.append((i, " ".join([f"p{i}_{k}" for k in range(i)] + w + [f"q{i}_{k}" for k in range(30)])))
    rows += [(100 + k, f"{w} " * (k + 1)) for k, w in enumerate(vocab)]  # counts without ties
    rows += [(200, None), (201, "")]
    bench[0] = (0, bench[0][1].replace(" ", " absent ", 1))
    got = decontaminate.matches(spark.createDataFrame(rows, "doc_id long, text string").repartition(4),
                                spark.createDataFrame(bench, "item_id long, text string"))
    assert got.columns == ["doc_id", "item", "start", "n_words", "kind"]
    found = [(x.doc_id, x.item, x.start, x.kind) for x in got.collect()]
    want = brute_matches(rows, bench)
    assert len(found) == len(set(found)) and set(found) == want and sum(x[3] == "near" for x in want) > 60
    summary = decontaminate.contamination(spark.createDataFrame(rows, "doc_id long, text string"),
                                          spark.createDataFrame(bench, "item_id long, text string")).collect()
    near = {i: len({x[1] for x in want if x[0] == i}) for i, _ in rows}
    assert {x.doc_id: x.n_near for x in summary} == near


def exact_runs(rows, n=50):
    """Row numbers of texts that share n words in a row with another row."""
    seen, hit = {}, set()
    for k, (_, t) in enumerate(rows):
        w = (t or "").encode().translate(brute.LOWER).split()
        for s in range(len(w) - n + 1):
            x = hash(tuple(w[s:s + n]))
            if seen.setdefault(x, k) != k:
                hit |= {k, seen[x]}
    return hit


def test_passages(spark, wide, no_docs):
    got = substrings.repeated_passages(wide).collect()
    rows = [r[:2] for r in document_rows()]
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for k in exact_runs(rows):
        assert any(r.n_passages for r in by[rows[k][0]])
    assert by[13][0].passages == "200:260" and by[14][0].passages == "0:60"
    s, e = map(int, by[15][0].passages.split(":"))
    assert 38 <= s <= 42 and 98 <= e <= 102  # the edited passage
    assert by[13][0].component_id == by[14][0].component_id == by[15][0].component_id == 13
    assert all(r.n_passages == 0 for i in range(22, 42) for r in by[i])
    assert substrings.repeated_passages(no_docs).collect() == []


def test_fuzzy_passages_at_random(spark):
    """Planted passages with an edit every 45 words are found about whole."""
    shared = [prose(1000 + i, 140) for i in range(6)]
    rows = []
    for i in range(60):
        p = edited(shared[i % 6], i, 3 if i % 2 else 1)
        rows.append((i, " ".join([prose(2000 + i, 100), p, prose(3000 + i, 50)])))
    rows += [(100 + i, prose(5000 + i, 300)) for i in range(40)]
    got = {r.doc_id: r for r in substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[100 + i].n_passages == 0 for i in range(40))
    found = [got[i].passage_words for i in range(60)]
    assert all(n > 90 for n in found) and sum(found) > 0.9 * 60 * 140


def test_passages_that_a_text_has_twice(spark):
    """Every occurrence counts, also behind a part of the passage that stands
    earlier in the same text."""
    rows, want = [], {}
    for i in range(24):
        p, x = prose(7000 + i, 60), [prose(8000 + 4 * i + k, 40) for k in range(4)]
        early = p if i % 2 else " ".join(p.split(" ")[:32])
        rows += [(2 * i, " ".join([x[0], early, x[1], p, x[2]])), (2 * i + 1, f"{x[3]} {p}")]
        n = len(early.split(" "))
        want[2 * i] = [(80 + n, 140 + n), *([(40, 100)] if i % 2 else [])]
        want[2 * i + 1] = [(40, 100)]
    got = substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in got:
        spans = [tuple(map(int, s.split(":"))) for s in r.passages.split(",") if s]
        for a, b in want[r.doc_id]:
            assert any(s <= a + 2 and e >= b - 2 for s, e in spans), (r.doc_id, spans)
    assert {r.component_id for r in got} == set(range(0, 48, 2))


def test_passages_of_lines_that_many_texts_have(spark):
    """A passage whole in two texts only, of two lines that 30 others have one of each."""
    rows, n = [], 12
    for i in range(n):
        one, two = prose(20_000 + i, 30), prose(21_000 + i, 30)
        rows += [(2 * i + k, " ".join([prose(22_000 + 2 * i + k, 40), one, two, prose(23_000 + 2 * i + k, 40)]))
                 for k in (0, 1)]
        for m in range(30):
            x = 24_000 + 100 * i + m
            rows += [(x, " ".join([prose(x, 40), one if m % 2 else two, prose(x + 10_000, 40)]))]
    got = substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = {r.doc_id: [tuple(map(int, s.split(":"))) for s in r.passages.split(",") if s] for r in got}
    found = [i for i in range(2 * n) if any(s <= 42 and e >= 98 for s, e in spans[i])]
    assert found == list(range(2 * n))
    assert all(not spans[x] for x in spans if x >= 24_000)


def test_chains_against_brute_force():
    r = random.Random(2)
    import numpy as np
    for _ in range(30):
        m = sorted({(r.randrange(80), r.randrange(80)) for _ in range(25)})
        x, y = np.array([p[0] for p in m]), np.array([p[1] for p in m])
        best = [0.0] * len(m)
        for i in range(len(m)):
            best[i] = substrings.K + max([0.0] + [best[j] - substrings.GAP * (m[i][0] - m[j][0] + m[i][1] - m[j][1])
                                                 for j in range(i) if m[j][0] < m[i][0] and m[j][1] < m[i][1]])
        got = substrings.chains(x, y)
        score = lambda c: sum(substrings.K - (substrings.GAP * (x[b] - x[a] + y[b] - y[a])) for a, b in zip(c, c[1:])) + substrings.K
        assert not got or abs(max(map(score, got)) - max(best)) < 1e-9


PAGES = [(1, "http://A.example.com/de/x?q", "h" * 200), (2, "https://m.x.example.net/en/1", "h" * 200),
         (3, None, "h" * 200), (4, "no scheme", "short"), (5, "http://a.net", "short"), (6, "http://a.net/", None),
         (7, "ftp://h.org/fr/9#f", ""), (7, "ftp://h.org/fr/9#f", ""), (8, "http://x\ny.org/é", "é" * 60),
         (9, "x://", "é" * 60), (None, "http://b.org/", "h" * 200), (None, None, None), (10, "http://b.org:80/a", "q" * 3_000_000),
         (10, "http://b.org:80/a", "q" * 3_000_000)]


def page_table(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").select(
        "*", *(F.lit("x").alias(c) for c in ("id", "n", "digest", "first", "host", "path", "bad", "judged")))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR, html VARCHAR)")
    c.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    return c


def test_archive_round_trip(spark, con, tmp_path):
    df = page_table(spark)
    got = sorted((tuple(r) for r in warc.round_trip(df).collect()), key=brute.key)
    assert got == sorted(con.execute(queries.ORACLE_SQL["op6_seekable_warc"]).fetchall(), key=brute.key)
    folder = str(tmp_path / "archive")
    index = warc.write_archive(df, folder, frame_bytes=500, bundle_bytes=1000)
    html = {i: h or "" for i, _, h in PAGES}
    for r in index.collect():
        head, payload = warc.fetch(f"{folder}/{r.bundle}", r.frame, r.offset)
        assert head["WARC-Record-ID"] == f"<urn:page:{'' if r.id is None else r.id}>"
        if head["WARC-Type"] == "response" and r.id is not None:
            assert payload.decode() == html[r.id]
    assert sorted((tuple(r) for r in warc.read_archive(index, folder).collect()), key=brute.key) == got
    none = warc.write_archive(df.limit(0), str(tmp_path / "none"))
    assert none.collect() == [] and warc.read_archive(none, str(tmp_path / "none")).collect() == []


def test_revisits_are_held_against_their_response(spark, tmp_path):
    """Without the bundle of the response, its revisits have no payload."""
    folder = str(tmp_path / "a")
    index = warc.write_archive(page_table(spark).repartition(8, "page_id", "url"), folder, frame_bytes=1, bundle_bytes=1)
    gone = [r.bundle for r in index.collect() if r.id == 1]
    assert len(gone) == 1
    rows = warc.read_archive(index.where(~index.bundle.isin(gone)), folder).collect()
    revisits = [r for r in rows if r.record_type == "revisit"]
    assert {r.refers_to for r in revisits} == {1, 8} and all(
        (r.payload_digest is None) == (r.payload_bytes is None) == (r.refers_to == 1) for r in revisits)
    assert all(r.payload_digest for r in rows if r.record_type == "response")


def test_plain_readers_can_read_a_bundle(spark, tmp_path):
    import zstandard
    folder = tmp_path / "a"
    warc.write_archive(page_table(spark).coalesce(1), str(folder), frame_bytes=400)
    raw = next(folder.iterdir()).read_bytes()
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == len(PAGES)


def test_urls(spark, con):
    r = random.Random(6)
    rows = PAGES + [(100 + i, f"http://s{r.randrange(9)}.d{i % 4}.com/{i}", "") for i in range(400)]
    rows += [(600 + i, f"http://spam.bad.info/{i}", "") for i in range(80)]
    labels = [(i, int(r.random() < 0.9), int(r.random() < 0.05)) for i in range(100, 500, 2)]
    labels += [(600 + i, 0, None) for i in range(60)] + [(None, 0, 1), (101, None, None), (100, 0, 0)]
    con.execute("CREATE OR REPLACE TABLE labels(doc_id BIGINT, quality INT, toxic INT)")
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
    con.execute("CREATE OR REPLACE TABLE p2 AS SELECT * FROM pages LIMIT 0")
    con.executemany("INSERT INTO p2 VALUES (?, ?, ?)", rows)
    sql = queries.ORACLE_SQL["op4_host_reputation"].replace("FROM pages", "FROM p2")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x"))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = sorted((tuple(x) for x in urls.judge(pages, lab).collect()), key=brute.key)
    assert got == sorted(con.execute(sql).fetchall(), key=brute.key)
    by = {x[0]: x for x in got}
    assert by[5][3] is None and by[6][3:] == ("net/", "block") and by[2][3:] == ("example.net/en/", "allow")
    assert by[1][3:] == ("example.com/de/", "block") and by[7][3:] == ("org/fr/", "allow")
    assert by[3][1:3] == by[4][1:3] == ("", "") and by[1][1:3] == ("a.example.com", "/de/x")
    assert by[600][4] == "block" and by[140][4] == "allow"
    assert urls.judge(pages.limit(0), lab).collect() == []
    assert urls.judge(pages, lab.limit(0)).where("rule IS NULL AND verdict = 'block'").count() == 0




def test_public_suffixes(spark):
    from pyspark.sql import functions as F

    from quarry.llm import urls
    rules = ("co.uk", "github.io", "*.ck", "!www.ck", "*.kobe.jp", "!city.kobe.jp")
    want = {"a.bbc.co.uk": "bbc.co.uk", "co.uk": "co.uk", "x.github.io": "x.github.io", "y.x.github.io": "x.github.io",
            "shop.b.ck": "shop.b.ck", "a.shop.b.ck": "shop.b.ck", "b.ck": "b.ck", "ck": "ck", "www.ck": "www.ck",
            "m.www.ck": "www.ck", "example.com": "example.com", "a.b.example.com": "example.com", "localhost": "localhost",
            "x.city.kobe.jp": "city.kobe.jp", "x.y.z.kobe.jp": "y.z.kobe.jp", "10.0.0.1:80": "10.0.0.1", "a.b.co.uk:8080": "b.co.uk",
            "": ""}
    df = spark.createDataFrame([(h,) for h in want], "host string").withColumn("l", urls._labels(F.col("host")))
    got = df.select("host", urls._last(F.col("l"), urls.suffix_size(F.col("l"), rules) + 1).alias("d")).collect()
    assert {r.host: r.d for r in got} == want


def test_tenants_of_a_suffix_do_not_share_a_prior(spark):
    from quarry.llm import urls
    rows = [(f"bad{i}.github.io", 1) for i in range(12) for _ in range(20)] + [("good.github.io", 0)] * 40
    rows += [(f"h{i}.example.com", i % 10 == 0) for i in range(40) for _ in range(5)]
    df = spark.createDataFrame([(h, int(b)) for h, b in rows], "host string, bad int")
    rate = lambda s: {r.host: r.rate for r in urls.reputation(df, s).collect()}
    assert rate(("github.io",))["good.github.io"] < rate(())["good.github.io"]


def test_best_stretch_against_brute_force():
    import numpy as np
    rng = np.random.default_rng(0)
    for _ in range(150):
        same = rng.random((4, int(rng.integers(3, 50)))) < rng.choice([0.5, 0.8, 0.95])
        least = int(rng.integers(3, 30))
        start, end = substrings.best_stretch(same, least, 80, 100)
        for row, s, e in zip(same, start, end):
            strict, soft = np.where(row, 20, -80), np.where(row, 80, -240)
            able = [(i, j) for i in range(len(row)) for j in range(i + 2, len(row) + 1)
                    if row[i] and row[i + 1] and row[j - 1] and row[j - 2]]
            value = lambda f, r: int(f[r[0]:r[1]].sum())
            enough = [r for r in able if r[1] - r[0] >= least]
            if e > s:
                assert e - s >= least and value(strict, (s, e)) >= 0
                assert (value(soft, (s, e)) == max(value(soft, r) for r in able)
                        or value(strict, (s, e)) in (max(value(strict, r) for r in able), max(value(strict, r) for r in enough)))
            else:
                assert max((value(strict, r) for r in enough), default=-1) < 0


def test_straight_chains_are_those_of_the_tree():
    import numpy as np
    r = random.Random(6)
    for _ in range(60):
        sizes = [r.randint(1, 12) for _ in range(5)]
        x = np.concatenate([np.sort(r.sample(range(2000), n)) for n in sizes])
        new = np.zeros(len(x), bool)
        new[np.cumsum([0, *sizes[:-1]])] = True
        begin = np.flatnonzero(substrings.straight(new, x))
        want, at = [], 0
        for n in sizes:
            score = 0.0
            for k in range(at, at + n):
                carried = score - 2 * substrings.GAP * (x[k] - x[k - 1]) if k > at else 0.0
                if carried <= 0:
                    want.append(k)
                score = substrings.K + max(carried, 0.0)
            at += n
        assert begin.tolist() == want


def recall(spark, words, match, others, trials=60):
    """Share of planted pairs of which both texts show most of the passage;
    each half of it also stands, as it is in the first text, in ``others`` texts."""
    r = random.Random(f"{words} {match}")
    vocab = [f"v{i}" for i in range(30_000)]
    say = lambda n: [r.choice(vocab) for _ in range(n)]
    rows = []
    for i in range(trials):
        core = say(words)
        other = list(core)
        for k in r.sample(range(2, words - 2), round(words * (100 - match) / 100)):
            other[k] = f"x{k}"
        rows += [(2 * i, " ".join(say(100) + core + say(100))), (2 * i + 1, " ".join(say(100) + other + say(100)))]
        for m in range(others):
            half = core[:words // 2] if m % 2 else core[words // 2:]
            rows.append((10**6 + i * others + m, " ".join(say(20) + half + say(20))))
    got = substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    spans = {x.doc_id: [tuple(map(int, s.split(":"))) for s in x.passages.split(",") if s]
             for x in got.where("doc_id < 1000000").collect()}
    held = lambda d: any(min(e, 100 + words) - max(s, 100) >= 0.5 * words for s, e in spans[d])
    return sum(held(2 * i) and held(2 * i + 1) for i in range(trials)) / trials


@pytest.mark.parametrize("words, match", [(50, 80), (50, 90), (60, 85), (100, 80), (400, 80)])
def test_recall_of_edited_passages(spark, words, match):
    assert recall(spark, words, match, 0) >= 0.9


@pytest.mark.parametrize("words, match", [(60, 95), (100, 90), (400, 90)])
def test_recall_among_texts_that_have_the_lines(spark, words, match):
    assert recall(spark, words, match, 30, trials=20) >= 0.9


@pytest.mark.parametrize("words, match, others", [(400, 80, 30), (100, 90, 200)])
def test_recall_beyond_first_and_last_texts(spark, words, match, others):
    """Seeds that few (pairs of the rest) and many texts have (tiles)."""
    assert recall(spark, words, match, others, trials=20) >= 0.9


def test_links_between_middle_texts(spark):
    """Edited passages of a line that 90 texts have: each couple is met by
    that line's seeds only, in tiles, and neither text is the first or last."""
    line, rows = prose(30_000, 30), []
    for i in range(90):
        tail = prose(31_000 + i // 2, 40).split(" ")
        if i % 2:
            tail[3::4] = [f"x{i}_{k}" for k in range(len(tail[3::4]))]
        rows.append((i, " ".join([prose(32_000 + i, 70), line, *tail, prose(33_000 + i, 70)])))
    got = substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i - i % 2 for i in range(90)}
    assert all(r.n_passages for r in got)


def _context_rows(rng, texts, wide):
    """Words around a seed: a line that all texts have, in some inside a shared passage, edited."""
    rows = rng.integers(1, 255, (texts, 2 * wide + substrings.K)).astype(np.uint8)
    rows[:, wide - 4:wide + substrings.K + 4] = np.arange(1, 2 * 4 + substrings.K + 1)
    for first, n in ((0, texts // 4), (texts // 4, texts // 8)):
        rows[first:first + n] = rows[first]
    edits = rng.integers(0, texts, texts), rng.integers(0, 2 * wide + substrings.K, texts)
    rows[edits] = 255
    return rows


def test_tiles_settle_what_their_first_pairs_share():
    wide, texts = 60, 1600
    rows = _context_rows(np.random.default_rng(3), texts, wide)
    comp, unmet, key = np.arange(texts), np.ones(texts, bool), np.arange(texts)
    held = substrings._Tile(key, comp, unmet, rows, wide, 50, 80, 100)
    pairs = [np.concatenate(v) for v in zip(*held.pairs(), strict=True)]
    assert len(pairs[0]) < 8 * texts  # all pairs of the larger passage alone are 50 times as many
    other = np.where(rows == 0, 255, rows)
    links = np.zeros((texts, texts), bool)
    for i in range(texts):
        some = np.flatnonzero(np.count_nonzero(rows[i] == other, axis=1) >= 40)
        s, e = substrings.best_stretch(rows[i] == other[some], 50, 80, 100)
        links[i, some] = e > s
    np.fill_diagonal(links, False)
    assert np.array_equal(held.unmet, ~links.any(axis=1))  # every text that has a partner has met one
    assert all(len(set(held.comp[np.flatnonzero(r)])) <= 1 for r in links)  # and no link is lost
    assert all((held.comp[np.flatnonzero(r)] == held.comp[i]).all() for i, r in enumerate(links))


def test_tiles_cover_all_that_all_pairs_cover():
    """A line of ``core`` words that all texts have, in families that share
    some words behind it: pairs that add nothing are left out, words aren't."""
    wide, texts, rng = 60, 700, np.random.default_rng(5)
    size = 2 * wide + substrings.K
    for core in (30, 45, 49, 52, 70):
        rows = rng.integers(1, 255, (texts, size)).astype(np.uint8)
        at = wide + 2 - core // 2
        rows[:, at:at + core] = rng.integers(1, 255, core)
        family, behind = rng.integers(0, texts // 6, texts), rng.integers(1, 255, (texts // 6, size))
        for i in range(0, texts, 3):
            end = at + core + rng.integers(0, 40)
            rows[i, at + core:end] = behind[family[i], at + core:end]
        for i in rng.integers(0, texts, texts // 5):
            rows[i, :rng.integers(0, wide)] = 0  # texts that begin there
        key = np.arange(texts)
        held = substrings._Tile(key, key, np.ones(texts, bool), rows, wide, 50, 80, 100)
        got = [p for p in held.pairs() if len(p[0])]
        met = np.zeros((texts, texts), bool)
        for m, n in got:
            met[m, n] = met[n, m] = True
        assert met.sum() < 8 * texts  # of 230,000 pairs with passages for 70 words
        other, cover, want = np.where(rows == 0, 255, rows), np.zeros(rows.shape, bool), np.zeros(rows.shape, bool)
        for i in range(texts):
            same = rows[i] == other
            same[i] = False
            for s, e, m in zip(*substrings.best_stretch(same, 50, 80, 100), met[i], strict=True):
                want[i, s:e] = True
                if m:
                    cover[i, s:e] = True
        assert np.array_equal(cover, want)


def test_all_stretches_of_a_chain():
    """Passages left and right of the best one on the same diagonal."""
    same = np.zeros((2, 400), bool)
    same[0, 10:70] = same[0, 120:320] = same[0, 340:395] = same[1, 5:45] = True
    got = zip(*(v.tolist() for v in substrings.all_stretches(same, 50, 80, 100)), strict=True)
    assert sorted(got) == [(0, 10, 70), (0, 120, 320), (0, 340, 395)]
