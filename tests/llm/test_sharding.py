import random
import zlib
from collections import Counter, defaultdict

from conftest import EXTRA, document_rows

from quarry.llm import sharding


def plain_differencing(sizes, ways):
    """Sums of the parts, with the partial partitions held as they are."""
    parts = [sorted([w] + [0] * (ways - 1)) for w in sizes]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[0] - p[-1])
        a, b = parts.pop(0), parts.pop(0)
        parts.append(sorted(x + y for x, y in zip(a, reversed(b))))
    return parts[0]


def test_against_plain_differencing():
    r = random.Random(4)
    for ways in (1, 2, 3, 8):
        for n in (1, 2, 7, 60, 400):
            # distinct spreads, so that ties can't be resolved in two ways
            sizes = [r.randrange(1, 10**12) for _ in range(n)]
            got = [0] * ways
            for w, p in zip(sizes, sharding.difference(sizes, ways)):
                got[p] += w
            assert sorted(got) == plain_differencing(sizes, ways)
    assert sharding.difference([]) == []
    assert sorted(sharding.difference([5] * 16)) == sorted(list(range(8)) * 2)


def test_tighter_than_largest_first():
    r = random.Random(5)
    sizes = sorted((int(r.paretovariate(1.2) * 1000) for _ in range(2000)), reverse=True)

    def spread(parts):
        total = Counter()
        for w, p in zip(sizes, parts):
            total[p] += w
        return max(total.values()) - min(total.values())

    largest_first, load = [], [0] * 8
    for w in sizes:
        p = load.index(min(load))
        load[p] += w
        largest_first.append(p)
    assert spread(sharding.difference(sizes)) <= max(spread(largest_first), 8)


def check(rows, got, ways=8):
    sizes = Counter()
    shard_of = {}
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < ways
        shard_of.setdefault((r.size, r.text_crc32), set()).add(r.shard)
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in shard_of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def test_awkward_rows(wide, no_docs):
    rows = sharding.shards(wide)
    assert rows.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    sizes = check([r[:2] for r in document_rows()], rows.collect())
    # the longest text outweighs an equal share: nothing joins it
    assert max(sizes.values()) == max(len(t) + 1 for _, t, *_ in document_rows() if t)
    assert sharding.shards(no_docs).collect() == []


def test_many_texts_and_a_hot_one(spark):
    """More texts than bundles, one of them in a third of all rows."""
    r = random.Random(6)
    rows = [(i, f"t{i} " + "x" * r.randrange(400)) for i in range(40_000)] + [(50_000 + i, "hot") for i in range(20_000)]
    rows += [(90_000, "y" * 400_000), (90_001, None), (90_002, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    sizes = check(rows, sharding.shards(df).collect())
    assert max(sizes.values()) - min(sizes.values()) <= 0.0001 * sum(sizes.values())


def test_rows_keep_their_columns(wide, tmp_path, spark):
    placed = sharding.place(wide, ways=3)
    assert placed.columns == [*wide.columns, "shard"] and placed.count() == wide.count()
    assert placed.select(*EXTRA).distinct().count() == 1
    sharding.write_shards(wide.select("doc_id", "text"), str(tmp_path / "out"), ways=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    want = Counter((r.doc_id, r.text, r.shard) for r in placed.select("doc_id", "text", "shard").collect())
    assert Counter((r.doc_id, r.text, r.shard) for r in back.collect()) == want
