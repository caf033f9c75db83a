import pyarrow as pa
import pytest
from pyspark.ml.feature import CountVectorizer, HashingTF, MinMaxScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.operators import features as FT


def test_minmax_scalars_fixture(spark):
    df = spark.createDataFrame([(0, 7), (5, 7), (10, 7)], "a int, b int")
    got = [(r["a_f"], r["b_f"]) for r in FT.minmax_scalars(df, ["a", "b"]).orderBy("a").collect()]
    assert got == [(0.0, 0.5), (0.5, 0.5), (1.0, 0.5)]


def test_fill_zero_only_named(spark):
    df = spark.createDataFrame([(None, None)], "favorite_count int, score int")
    r = FT.fill_zero(df, ["favorite_count"]).first()
    assert r["favorite_count"] == 0 and r["score"] is None


def _docs(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    return d.select("doc_id", X.remove_stopwords(X.tokenize(F.col("text"))).alias("toks"))


def test_long_form_minmax_equals_ml(spark):
    docs = _docs(spark)
    tfl = FT.term_counts_long(docs, "doc_id", "toks")
    voc = FT.vocabulary(tfl, "doc_id")
    terms = [r["term"] for r in voc.orderBy("index").collect()]
    cv = CountVectorizer(inputCol="toks", outputCol="cv", vocabSize=1 << 18).fit(docs)
    mm = MinMaxScaler(inputCol="cv", outputCol="mm").fit(cv.transform(docs))
    dense = mm.transform(cv.transform(docs)).select("doc_id", vector_to_array("mm").alias("a"))
    ml_vocab = cv.vocabulary
    assert sorted(ml_vocab) == sorted(terms)
    ml = {}
    for r in dense.collect():
        for i, v in enumerate(r["a"]):
            if v != 0.0:
                ml[(r["doc_id"], ml_vocab[i])] = round(v, 9)
    ours = {(r["doc_id"], r["term"]): round(r["value"], 9)
            for r in FT.minmax_terms_long(tfl, "doc_id", docs.count()).collect() if r["value"] != 0.0}
    assert ours == ml


def test_vocabulary_stable_under_partitioning(spark):
    docs = _docs(spark)
    seen = []
    for n in (1, 4, 16):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        tfl = FT.term_counts_long(docs, "doc_id", "toks")
        seen.append([tuple(r) for r in FT.vocabulary(tfl, "doc_id", 50).orderBy("index").collect()])
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert seen[0] == seen[1] == seen[2]
    assert [r[3] for r in seen[0]] == list(range(50))


def test_hashing_long_equals_ml(spark):
    """``pmod(hash(term), n)`` is the Spark 2.x HashingTF bucket (the
    reference ran 2.3).  Spark >= 3 ML HashingTF changed only the murmur3
    tail, so the two agree exactly on terms whose UTF-8 length is a multiple
    of 4 - which is what is compared here."""
    docs = _docs(spark).select("doc_id", F.filter("toks", lambda t: F.octet_length(t) % 4 == 0).alias("toks"))
    n = 1 << 18
    ml = HashingTF(inputCol="toks", outputCol="h", numFeatures=n).transform(docs)
    ml_long = {}
    for r in ml.select("doc_id", "h").collect():
        v = r["h"]
        for i, x in zip(v.indices, v.values):
            ml_long[(r["doc_id"], int(i))] = float(x)
    ours = {(r["doc_id"], r["index"]): r["tf"] for r in FT.hashing_tf_long(docs, "doc_id", "toks", n).collect()}
    assert ours == ml_long


@pytest.mark.parametrize("with_empty_doc", [False, True])
def test_sparse_text_scaling_equals_ml(spark, with_empty_doc):
    """The sparse-preserving title/body blocks hold the same (term, value)
    cells as ML CountVectorizer + MinMaxScaler: 'red' is in every document
    (min > 0, exact min-max path) unless an empty document is added."""
    from pyspark.ml import Pipeline
    rows = [(1, "red red blue"), (2, "red green"), (3, "red blue blue blue"), (4, "red")]
    df = spark.createDataFrame(rows, "id int, t string").select(
        "id", F.split("t", " ").alias("filtered1"))
    if with_empty_doc:
        df = df.unionByName(spark.createDataFrame([(5, [])], "id int, filtered1 array<string>"))
    stages = FT._scaled_text_block(df, "filtered1", "title_f", 1 << 18)
    model = Pipeline(stages=stages).fit(df)
    cvs = [s for s in model.stages if hasattr(s, "vocabulary")]
    names = [w for cvm in cvs for w in cvm.vocabulary]
    ours = {}
    for r in model.transform(df).select("id", vector_to_array("title_f").alias("a")).collect():
        for i, v in enumerate(r["a"]):
            ours[(r["id"], names[i])] = round(v, 9)
    cv = CountVectorizer(inputCol="filtered1", outputCol="cv").fit(df)
    mm = MinMaxScaler(inputCol="cv", outputCol="mm").fit(cv.transform(df))
    ml = {}
    for r in mm.transform(cv.transform(df)).select("id", vector_to_array("mm").alias("a")).collect():
        for i, v in enumerate(r["a"]):
            ml[(r["id"], cv.vocabulary[i])] = round(v, 9)
    assert ours == ml
    assert (len(cvs) == 1) == with_empty_doc


def test_pipeline_blocks(spark):
    from quarry.plans.q_features import features_in
    prepared = FT.prepare(features_in(spark, "/root/testdata/sf0.001"))
    model = FT.feature_pipeline(prepared)
    t = FT.training_table(model, prepared)
    row = t.first()
    # width = |title vocab| + |body vocab| + 4 scalars + |tags| + 1 + |votes|
    stages = model.stages
    vocabs = [s.vocabulary for s in stages if hasattr(s, "vocabulary")]
    assert row["features"].size == sum(len(v) for v in vocabs) + 5
    assert t.count() == prepared.count()


def test_vector_vocabulary_is_the_top_v_by_count_then_term(spark):
    """Also with terms that every document has."""
    from quarry.operators import features as FT
    rows = [(1, ["a", "b", "c", "z"]), (2, ["a", "b", "c", "y"]), (3, ["a", "b", "c", "a"])]
    df = spark.createDataFrame(rows, "id long, t array<string>")
    for v, width in ((2, 2), (4, 4), (10, 5)):
        from pyspark.ml import Pipeline
        m = Pipeline(stages=FT._scaled_text_block(df, "t", "out", v)).fit(df)
        assert {r["out"].size for r in m.transform(df).select("out").collect()} == {width}


def test_vocabulary_plan_starts_no_job(spark):
    from quarry.operators import features as FT
    df = spark.createDataFrame([(1, ["a", "b"])], "id long, t array<string>")
    sc = spark.sparkContext
    sc.setJobGroup("plan-only", "no job expected")
    try:
        FT.vocabulary(FT.term_counts_long(df, "id", "t"), "id", 10)
        assert len(sc.statusTracker().getJobIdsForGroup("plan-only")) == 0
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_vocabulary_by_threshold_equals_a_full_count(spark):
    import random
    from collections import Counter

    from quarry.operators import features as FT
    r = random.Random(1)
    words = [f"w{i}" for i in range(3000)]
    weights = [1 / (i + 1) for i in range(3000)]
    rows = [(i, r.choices(words, weights, k=r.randint(0, 60))) for i in range(1500)]
    rows += [(5000, None), (5001, []), (5002, [None, "w1"]), (5003, ["w0"] * 5000)]
    df = spark.createDataFrame(rows, "id long, toks array<string>").repartition(5)
    total, docs = Counter(), Counter()
    for _, toks in rows:
        total.update(t for t in toks or [] if t)
        docs.update({t for t in toks or [] if t})
    for size, least in ((10, 1), (10, 400), (200, 2), (5000, 1)):
        order = sorted((t for t in total if docs[t] >= least), key=lambda t: (-total[t], t))[:size]
        got = sorted((x["index"], x["term"], x["total"], x["df"])
                     for x in FT.vocabulary_by_threshold(df, "toks", size, least).collect())
        assert got == [(i, t, total[t], docs[t]) for i, t in enumerate(order)]
    assert FT.vocabulary_by_threshold(df.where("false"), "toks", 5).count() == 0
    long = Counter({(x["id"], x["term"]): x["tf"] for x in FT.term_counts_in_row(df, "id", "toks").collect()})
    assert long == Counter((i, t) for i, toks in rows for t in toks or [] if t)


def test_hashed_vectors_hold_the_long_form(spark):
    from quarry.operators import features as FT
    from quarry.operators.model import vector_cells
    rows = [(1, ["a", "bb", "ccc", "dddd", "é中", "a"]), (2, []), (3, None), (4, [None, "a"])]
    df = spark.createDataFrame(rows, "id long, toks array<string>")
    vectors = FT.hashing_tf_vectors(df, "toks", num_features=1024)
    cells = sorted(tuple(r) for r in vector_cells(vectors.where("features IS NOT NULL"), ("id",)).collect())
    assert cells == sorted(tuple(r) for r in FT.hashing_tf_long(df, "id", "toks", 1024).collect())
    assert {r["id"]: r["features"] is None for r in vectors.collect()} == {1: False, 2: False, 3: True, 4: False}


def test_long_assembly_against_the_pipeline(spark, tmp_path):
    """Cells and LibSVM rows hold what the ML pipeline's vectors hold."""
    from quarry.operators import features as FT
    from quarry.operators.long_features import assemble_long, score_linear_long, write_libsvm_long
    from quarry.operators.model import vector_cells
    from quarry.sources.libsvm import read_libsvm
    rows = [(i, f"common word{i % 5} extra{i}" + " common" * (i % 2), f"<p>body{i % 3}</p>", 100 + i, i % 4, None if i % 3 else i,
             -i, "a|b" if i % 2 else "b|", 7, "1|2|2", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, title string, body string, creation_date long, answer_count int, favorite_count int, "
                                     "score int, tags string, reputation int, vote_type_id string, label int")
    prepared = FT.prepare(df)
    train = prepared.where("id < 30")
    done = assemble_long(prepared, train, stopwords=[])
    model = FT.feature_pipeline(prepared, fit_df=train, stopwords=[])
    vectors = FT.training_table(model, prepared)
    width = vectors.head()["features"].size
    assert done.width == width and list(done.widths) == FT.BLOCKS
    sums = lambda cells: {r["id"]: round(r["s"], 9) for r in
                          cells.groupBy("id").agg({"value": "sum"}).toDF("id", "s").collect()}
    assert sums(done.cells) == sums(vector_cells(vectors, ("id",)))
    path = str(tmp_path / "svm")
    write_libsvm_long(prepared, done.cells, path)
    back = sorted((r["label"], r["features"].indices.tolist(), r["features"].values.tolist())
                  for r in read_libsvm(spark, path, width).collect())
    want = {}
    for r in done.cells.collect():
        want.setdefault(r["id"], []).append((r["index"], r["value"]))
    assert back == sorted((float(i % 2), *map(list, zip(*sorted(want[i])))) for i in range(40))
    ids = spark.createDataFrame([(0,), (1,), (99,)], "id int")
    given = spark.createDataFrame([(k, 0.5) for k in range(width)], "index long, coefficient double")
    got = {r["id"]: (round(r["raw"], 9), r["prediction"]) for r in score_linear_long(ids, done.cells, given, -1.0).collect()}
    for i in (0, 1):
        assert got[i][0] == round(-1 + 0.5 * sum(v for _, v in want[i]), 9)
    assert got[99] == (-1.0, 0.0)


def test_vector_summary_reads_stored_cells(spark):
    from pyspark.ml.linalg import Vectors
    from quarry.plans.q_features import vector_summary
    rows = [(1, 1.0, Vectors.sparse((1 << 31) - 1, [3, 70], [2.0, 0.5])), (2, 0.0, Vectors.dense([0.0, 4.0, 0.0])),
            (3, 0.0, Vectors.sparse(9, [], []))]
    got = vector_summary(spark.createDataFrame(rows, ["id", "label", "features"])).collect()
    # as an array of its width the first one would not fit into any heap
    assert sorted(tuple(r) for r in got) == [(1, 1.0, (1 << 31) - 1, 2, 2.5), (2, 0.0, 3, 1, 4.0), (3, 0.0, 9, 0, 0.0)]


def test_counts_by_runs_of_tokens(spark, monkeypatch):
    """Rows counted a few tokens at a time give the counts and extremes of whole batches."""
    monkeypatch.setattr(FT, "COUNT_TOKENS", 7)
    rows = [(i, [f"w{(i * k) % 5}" for k in range(i % 11)] if i % 4 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, toks array<string>").coalesce(1)
    want = {(i, w): t.count(w) for i, t in rows for w in (t or [])}
    batches = df.toArrow().to_batches()
    sizes = [sum(len(t or []) for t in b.column(1).to_pylist()) for b in FT._slices(batches, 1)]
    assert max(sizes) <= 10 and len(sizes) > 20  # a row holds at most 10
    got = df.coalesce(1).transform(lambda d: FT.term_counts_in_row(d, "id", "toks")).collect()
    assert {(r["id"], r["term"]): r["tf"] for r in got} == want and len(got) == len(want)
    voc = FT.vocabulary_by_threshold(df, "toks", 10).collect()
    for r in voc:
        tf = [n for (_, w), n in want.items() if w == r["term"]]
        assert (r["total"], r["df"], r["most"], r["least"]) == (sum(tf), len(tf), max(tf), min(tf))


def test_text_scalers_need_no_pass_of_their_own(spark):
    """The text blocks' scalers come fitted, and as ML fits them."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.base import Estimator
    from pyspark.ml.feature import MaxAbsScaler, MinMaxScaler
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["a", "c", "c", "c"]), (3, ["a", "b"]), (4, ["a"] * 4)],
                               "id int, t array<string>")
    stages = FT._scaled_text_block(df, "t", "f", 10)
    assert not any(isinstance(s, Estimator) for s in stages)
    out = PipelineModel(stages=stages[:-1]).transform(df)
    for col, kind in (("f_cv0", MaxAbsScaler), ("f_cv1", MinMaxScaler)):
        made = next(s for s in stages if s.hasParam("inputCol") and s.isSet("inputCol") and s.getInputCol() == col and not hasattr(s, "vocabulary"))
        fit = kind(inputCol=col, outputCol="x").fit(out)
        got, want = ([r[0].toArray().tolist() for r in m.transform(out.drop(c)).select(c).collect()]
                     for m, c in ((made, made.getOutputCol()), (fit, "x")))
        assert got == want


def test_feature_pipeline_persists_no_tokens(spark, monkeypatch):
    """Tokens are several times their text; a task that reads them back reads as much."""
    from pyspark.sql.classic.dataframe import DataFrame
    from pyspark.sql import functions as F
    held = []
    monkeypatch.setattr(DataFrame, "persist", lambda df, *a: held.append(df) or df)
    monkeypatch.setattr(DataFrame, "cache", lambda df: held.append(df) or df)
    rows = [(i, float(i % 2), f"title {i}", f"word{i} text", *[float(i)] * 5, ["a"], ["1"]) for i in range(6)]
    df = spark.createDataFrame(rows, ["id", "label", "title", "body_s", *FT.SCALARS, "tags_a", "vote_type_id_a"])
    model = FT.feature_pipeline(df, vocab_size=50)
    assert not held and FT.training_table(model, df).where(F.col("features").isNotNull()).count() == 6


def test_libsvm_lines_join_ready_cells():
    """A task joins the cells of an id, also across batches, and formats none itself."""
    import pyarrow as pa
    from quarry.operators.long_features import _line_task
    batch = lambda *rows: pa.RecordBatch.from_pydict({"id": [r[0] for r in rows], "cell": [r[1] for r in rows]})
    null = _line_task(iter([batch((None, "1.0"), (None, "2:1.0"), (1, "0.0"))]))
    assert [v for b in null for v in b.column(0).to_pylist()] == ["1.0 2:1.0", "0.0"]
    got = _line_task(iter([batch((1, "0.0"), (1, "3:0.5"), (2, "1.0")), batch((2, "1:2.0"), (2, "9:1.0E-5")), batch((3, "1.0"))]))
    assert [v for b in got for v in b.column(0).to_pylist()] == ["0.0 3:0.5", "1.0 1:2.0 9:1.0E-5", "1.0"]


def test_kept_words_are_those_of_the_ml_stages(spark, monkeypatch):
    """One pass over the bytes finds the tokens of RegexTokenizer and StopWordsRemover."""
    import random

    from pyspark.ml.feature import RegexTokenizer, StopWordsRemover

    from quarry.functions import words
    from quarry.functions.text import default_stopwords
    rnd = random.Random(5)
    texts = ["", "the The a", "Don't STOP été, c++ x_y  2", "x", " x"] + [
        "".join(rnd.choice("aAzZ09_ \n.,éßİKΣσ漢😀ıI-k") for _ in range(rnd.randrange(60))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    stops = default_stopwords()
    ml = RegexTokenizer(inputCol="t", outputCol="x", pattern="\\W").transform(df)
    ml = StopWordsRemover(inputCol="x", outputCol="w", stopWords=list(stops)).transform(ml)
    want = {r.id: r.w for r in ml.select("id", "w").collect()}
    assert {r.id: r.v for r in FT.KeptWords("t", "v", stops).transform(df).select("id", "v").collect()} == want
    # in runs of texts, with a null, from the middle of an array
    monkeypatch.setattr(words, "TEXT_BYTES", 50)
    column = pa.array(["skip", None, *texts])[1:]
    got = [v for _, part in words.slices(column) for v in words.kept_words(part, words.stop_set(stops)).to_pylist()]
    assert got == [None, *(want[i] for i in range(len(texts)))]


def test_fit_reads_texts_without_ml_tokens(spark):
    """Title and body words are found by KeptWords and by the vocabularies themselves."""
    df = spark.createDataFrame([(1, "Red car", "the fast red car"), (2, "blue Car", "a slow blue car, a car")], "id int, title string, body_s string")
    stages = FT._scaled_text_block(df, "filtered2", "body_f", 100, ("body_s", ["the", "A"]))
    words = FT.KeptWords("body_s", "filtered2", ["the", "A"]).transform(df)
    old = FT._scaled_text_block(words, "filtered2", "body_f", 100)
    assert [s.vocabulary for s in stages if hasattr(s, "vocabulary")] == [s.vocabulary for s in old if hasattr(s, "vocabulary")]
    assert [s.vocabulary for s in stages if hasattr(s, "vocabulary")] == [["blue", "fast", "red", "slow"], ["car"]]


def test_blocks_without_text_are_fitted_without_reading_texts(spark, monkeypatch):
    """Only the table of short columns, written in one pass, is read by the fits of tags, votes and scalars."""
    from quarry import session
    from quarry.plans.q_features import features_in
    prepared = FT.prepare(features_in(spark, "/root/testdata/sf0.001"))
    written, fitted = [], []
    write = session.write_table
    monkeypatch.setattr(session, "write_table", lambda df, name="t", *a: written.append((name, df.columns)) or write(df, name, *a))
    for kind in (CountVectorizer, MinMaxScaler):
        fit = kind.fit
        monkeypatch.setattr(kind, "fit", lambda self, df, *a, fit=fit: fitted.append(df.inputFiles()) or fit(self, df, *a))
    model = FT.feature_pipeline(prepared, variant="hash", vocab_size=1 << 10)
    assert written == [("fit_rows", ["tags_a", "vote_type_id_a", *FT.SCALARS])]
    assert len(fitted) == 3 and all("/tables/fit_rows-" in f for files in fitted for f in files)
    assert FT.training_table(model, prepared).count() == prepared.count()
