"""The four file-to-file jobs end to end on CSV dumps made from the tables."""

from pyspark.sql import functions as F

from quarry.plans import jobs as J
from quarry.sources import csv as CSV

SF = "/root/testdata/sf0.001"


def _dumps(spark, base):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    p = spark.read.parquet(f"{SF}/part.parquet")
    names = p.select(F.col("p_partkey"), F.regexp_replace("p_name", " ", "").alias("glued"))
    posts = (o.join(d, o.o_orderkey % 200 == d.doc_id, "left")
             .join(names, o.o_orderkey % 200 == names.p_partkey, "left")
             .select(F.col("o_orderkey").cast("string").alias("id"),
                     F.col("o_orderpriority").alias("title"),
                     F.concat(F.lit("<p>"), F.col("text"), F.lit("</p>")).alias("body"),
                     F.col("o_orderdate").cast("string").alias("creation_date"),
                     (F.col("o_orderkey") % 5).cast("string").alias("answer_count"),
                     F.when(F.col("o_orderkey") % 3 == 0, F.lit(None))
                     .otherwise((F.col("o_orderkey") % 7).cast("string")).alias("favorite_count"),
                     F.col("o_totalprice").cast("string").alias("score"),
                     F.col("glued").alias("tags"),
                     F.lit("10").alias("view_count"),
                     F.col("o_custkey").cast("string").alias("owner_user_id"),
                     "o_orderstatus"))
    w = dict(CSV.LOSSLESS_WRITE, nullValue="")
    posts.where("o_orderstatus <> 'F'").drop("o_orderstatus").write.options(**w).csv(f"{base}/in/all_questions")
    posts.where("o_orderstatus = 'F'").drop("o_orderstatus").write.options(**w).csv(f"{base}/in/stackoverflow_posts")
    spark.read.parquet(f"{SF}/customer.parquet").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_acctbal").cast("string").alias("reputation"),
        F.col("c_name").alias("display_name")).write.options(**w).csv(f"{base}/in/users")
    spark.read.parquet(f"{SF}/lineitem.parquet").select(
        F.col("l_orderkey").cast("string").alias("post_id"),
        F.col("l_linenumber").cast("string").alias("vote_type_id"),
        F.lit("x").alias("creation_date")).write.options(**w).csv(f"{base}/in/votes")
    p.select(F.explode(F.split("p_name", " ")).alias("tag_name")).distinct() \
        .write.options(**w).csv(f"{base}/in/all_tags")


def test_jobs_end_to_end(spark, tmp_path):
    base = str(tmp_path)
    _dumps(spark, base)
    J.clean_job(spark, f"{base}/in/", f"{base}/labelled")
    lab = J.read_labelled(spark, f"{base}/labelled")
    counts = {r["label"]: r["count"] for r in lab.groupBy("label").count().collect()}
    assert counts.get(0, 0) > 0 and counts.get(1, 0) > 0
    assert lab.where("vote_type_id IS NULL").count() == 0
    J.tags_job(spark, f"{base}/in/", f"{base}/labelled", f"{base}/tagged")
    tagged = J.read_labelled(spark, f"{base}/tagged")
    assert tagged.count() > 0
    assert tagged.where("tags NOT LIKE '%|%'").count() == 0   # every name has two words
    width = J.features_job(spark, f"{base}/tagged", f"{base}/libsvm")
    assert width > 5
    res = J.train_job(spark, f"{base}/libsvm", num_features=width, max_iter=50)
    assert res["metrics_weighted"].first()["accuracy"] > 0.5
    assert res["test_mae"].count() == 1
    parity = f"{base}/libsvm_all"
    width = J.features_job(spark, f"{base}/tagged", parity, split="none")
    res = J.train_job(spark, parity, num_features=width, max_iter=5, split="none")
    assert res["test_mae"].count() == 1


def test_broken_lines_are_written_and_dropped(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    CSV.write_csv(rows, f"{tmp_path}/x_good")
    CSV.write_lines(rows.select(F.concat("id", F.lit(",a \"b\",c")).alias("line")), "id,v", f"{tmp_path}/x_broken")
    raw = {r["value"] for r in spark.read.text(f"{tmp_path}/x_broken").collect()}
    assert raw == {"id,v", '1,a "b",c', '2,a "b",c'}
    assert sorted(J.read_untyped(spark, f"{tmp_path}/x_*").collect()) == [("1", "a"), ("2", "b")]


def test_dumps_shuffle_a_body_once(spark):
    """A post's versions are made behind the joins, and both sets are written in one pass."""
    from quarry.plans import q_chain as Q
    posts = Q._posts(spark, SF)
    assert posts._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 2  # bodies, tags
    orders = spark.read.parquet(f"{SF}/orders.parquet").groupBy("o_orderpriority").count().collect()
    want = {r[0]: r[1] for r in orders}
    got = {r[0]: r[1] for r in posts.groupBy("title").count().collect()}
    assert got == want | {"3-MEDIUM": 2 * want["3-MEDIUM"], "": want["1-URGENT"]}
    base = Q._dumps(spark, SF)
    read = {n: J.read_untyped(spark, base + n) for n in (J.QUESTIONS_GLOB, J.ANSWERED_GLOB)}
    assert all(d.columns == [*Q.POST_COLS, "extra"] for d in read.values())
    assert sum(d.count() for d in read.values()) == sum(got.values())  # broken lines are dropped
    assert {f.rsplit(".", 1)[-1] for d in read.values() for f in d.inputFiles() if "broken" not in f} == {"gz"}


def test_chain_keeps_no_scratch_files(spark, monkeypatch):
    """Dumps and tables that no later step reads are gone, and so are the shuffle files of what was written."""
    from pathlib import Path
    from quarry.plans import q_chain as Q
    from quarry.sources import csv as CSV
    folders, path = [], CSV.scratch_path
    monkeypatch.setattr(CSV, "scratch_path", lambda *a: folders.append(path(*a)) or folders[-1])
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f for f in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    before = shuffled()
    got = Q.job_tags(spark, SF)
    assert not shuffled() - before
    left = {p.name for p in Path(folders[0].removeprefix("file:")).iterdir() if p.is_dir()}
    assert left == {"set=all_tags", "set=out_tagged"}
    assert got.count() > 0


def test_training_frame_is_a_table_that_goes(spark):
    """No persisted rows and no checkpoint beside it."""
    from pathlib import Path
    from pyspark.ml.linalg import Vectors
    from quarry.operators import model as MD
    from quarry.session import drop_table
    df = spark.createDataFrame([(i, i % 2, Vectors.sparse(9, {i % 9: float(i)})) for i in range(40)], ["id", "label", "features"])
    cached = set(spark._jsc.getPersistentRDDs().keySet().toArray())
    table = MD.training_frame(df)
    assert sorted(table.collect()) == sorted(df.collect())
    assert not set(spark._jsc.getPersistentRDDs().keySet().toArray()) - cached
    folder = Path(table.scratch_path.removeprefix("file:"))
    assert folder.is_dir()
    drop_table(table)
    assert not folder.exists()
