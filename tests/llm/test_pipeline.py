"""The pipeline against brute force, and the entry module without it."""

import os
import subprocess
import sys

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import document_rows, prose

import corpus_pipeline
from quarry.llm import packing, pii, quality
from quarry.llm import wordhash as W

BENCH = [(1, prose(3, 60)), (2, prose(110, 12))]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("tables"))
    rows = [r for r in document_rows() if not (r[0] == 0 and r[2] is None)]
    for i in range(300):  # good and bad prose to learn from
        t = prose(9000 + i, 80)
        rows.append((1000 + i, t if i % 4 else "!! ".join(t.upper().split(" ")), "en", f"src{i % 5}", len(t)))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .repartition(4).write.parquet(f"{base}/documents.parquet")
    labels = [(1000 + i, int(i % 4 > 0), 0) for i in range(300)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.dtypes
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = [tuple(r) for r in docs.collect()]
    raw, off = W.text_bytes(pa.array([r[1] for r in rows], pa.string()))
    good = model.score(quality.features(raw, off)) >= 0.5
    rows = [r for r, ok in zip(rows, good, strict=True) if ok]
    assert sum(r[0] is not None and r[0] >= 1000 for r in rows) == 225
    # one document of each group, one row of each id; rows without id stay
    first = {c for i, _, c in brute.near_duplicates([r[:2] for r in rows], 5) if i is not None}
    seen, firsts = set(), []
    for r in rows:
        if r[0] is None or r[0] in first and r[0] not in seen:
            firsts.append(r)
            seen.add(r[0])
    flags = brute.contamination([r[:2] for r in firsts], BENCH)
    clean = [r for r, f in zip(firsts, flags, strict=True) if not f[5]]
    assert len(rows) > len(firsts) > len(clean)

    out = docs
    sizes = [len(rows), len(firsts), len(clean), len(clean)]
    stages = dict(corpus_pipeline.STAGES)
    for (name, stage), n in zip(list(stages.items())[:4], sizes, strict=True):
        before, out = out, spark.createDataFrame(stage(spark, out, sf_dir).collect(), docs.schema)
        assert out.dtypes == columns and out.count() == n, name
    field = pii.learn(before)
    want = sorted(((r[0], None if r[1] is None else pii.masked(
        r[1], brute.base_spans(r[1]) + field.added(r[1], brute.base_spans(r[1])))) for r in clean), key=brute.key)
    masked = out.collect()
    assert sorted(((r.doc_id, r.text) for r in masked), key=brute.key) == want
    assert all(r.n_chars == len(r.text) for r in masked if r.text is not None)
    assert not any(brute.base_spans(r.text) for r in masked)

    stored = corpus_pipeline.tables(spark, sf_dir)
    assert sorted(((r.doc_id, r.text) for r in stored["pii_skip_chain"].collect()), key=brute.key) == want
    packed = stored["conflict_best_fit"].collect()
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()), key=brute.key) == \
        sorted(map(tuple, packed), key=brute.key)
    got = sorted(((r.doc_id, r.piece, r.n_words) for r in packed), key=brute.key)
    pieces = []
    for i, t in want:
        n = len((t or "").encode().split())
        pieces += [(i, k, min(packing.CAPACITY, n - a)) for k, a in
                   enumerate(range(0, n, packing.CAPACITY) if n else [0])]
    assert got == sorted(pieces, key=brute.key)
    bins = {}
    for r in packed:
        if r.bin_id is not None:
            bins.setdefault(r.bin_id, []).append(r)
    for b in bins.values():
        assert sum(r.n_words for r in b) <= packing.CAPACITY
        sources = [r.source for r in b if r.source is not None]
        assert len(sources) == len(set(sources)) and len({r.cluster for r in b}) == len(b)


def test_stages_on_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame([], stage(spark, docs, sf_dir).schema)
    assert "bin_id" in docs.columns


def test_entry_without_the_subpackage(tmp_path):
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    (tmp_path / "__spark_entry__.py").write_text(open(f"{root}/__spark_entry__.py").read())
    os.mkdir(tmp_path / "quarry")
    for name in os.listdir(f"{root}/quarry"):
        if name != "llm":
            os.symlink(f"{root}/quarry/{name}", tmp_path / "quarry" / name)
    code = "import __spark_entry__ as E; print(len(E.queries()), any(k.startswith('op') and k[2].isdigit() for k in E.queries()))"
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                         env=os.environ | {"PYTHONPATH": str(tmp_path)})
    assert got.stdout.split()[-1:] == ["False"], got.stderr
    assert np.array(got.stdout.split()[0], dtype=int) >= 50
