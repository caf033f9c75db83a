"""Physical-plan properties that matter at scale (read from explain)."""

from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return _plan(df)


def test_status_filter_reaches_scan_and_title_filter_does_not(spark):
    """Untitled versions count towards their id's versions before they go."""
    plan = _plan(E.queries()["votes_per_post_rejoin"](spark, SF))
    assert "EqualTo(o_orderstatus,F)" in plan and "Not(EqualTo(o_orderpriority,))" not in plan


def test_scan_reads_only_projected_columns(spark):
    plan = _plan(E.queries()["project_columns"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_returnflag:string>" in plan


def test_clean_runs_as_one_plan(spark):
    plan = _final_plan(E.queries()["label_union"](spark, SF))
    shuffles = plan.count("Exchange hashpartitioning") + plan.count("Exchange RoundRobin")
    # distinct (after map-side partial aggregation), by post id, vote lists
    assert shuffles <= 3, plan
    assert "partial_" in plan or "HashAggregate" in plan
    assert "SortMergeJoin" not in plan


def test_tokeniser_not_duplicated_below_shuffle(spark):
    from pyspark.sql import functions as F
    from quarry.functions import text as X
    from quarry.operators import features as FT
    from quarry.sources import tables as TB
    d = TB.table(spark, SF, "documents")
    toks = d.select("doc_id", X.remove_stopwords(X.tokenize(F.col("text"))).alias("toks"))
    plan = _plan(FT.term_counts_long(toks, "doc_id", "toks"))
    # the tokeniser appears in exactly one operator (no inferred filter copy)
    assert plan.count("split(lower(text") == 1, plan


def test_broadcast_only_when_size_shown(spark):
    from quarry.operators.joins import broadcast_if_small, proven_bytes
    small = spark.range(1000).selectExpr("id", "cast(id as double) AS reputation")
    assert proven_bytes(small) == 2 * (8 + 16) * 1000
    assert "broadcast" in _plan(spark.range(5).join(broadcast_if_small(small), "id")).lower()
    big = spark.range(3_000_000).selectExpr("id", "cast(id as double) AS reputation")
    assert broadcast_if_small(big, max_bytes=1 << 20) is big


def test_bodies_are_exchanged_once(spark):
    """Step 1 of posts without copies: only the join by post id moves bodies."""
    from quarry.operators import clean as C
    from quarry.session import write_table
    posts = spark.createDataFrame([(i, f"title {i}", "body", i, i % 7) for i in range(500)],
                                  "id long, title string, body string, score long, owner_user_id long")
    users = spark.createDataFrame([(i, i * 10) for i in range(7)], "id long, reputation long")
    votes = spark.createDataFrame([(i % 500, i % 3) for i in range(2000)], "post_id long, vote_type_id long")
    posts, users, votes = (write_table(t, "t") for t in (posts, users, votes))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = C.clean_branch(posts, users, votes, 1)
        text = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert out.count() == 500
    lines = text.split("\n")
    below = [lines[i + 1:] for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    moved = [part for part in below if "body" in "\n".join(part[:3])]
    assert len(moved) == 1, text


def test_vocabulary_shuffles_terms_only(spark):
    from pyspark.sql import functions as F
    from quarry.operators import features as FT
    docs = spark.createDataFrame([(i, ["a", "b", f"t{i}"]) for i in range(50)], "id long, toks array<string>")
    got = FT.term_counts_in_row(docs, "id", "toks")
    assert "Exchange" not in _plan(got)
    totals = FT.term_partials(docs, "toks").groupBy("term").agg(F.sum("total"))
    assert _plan(totals).count("Exchange hashpartitioning(term") <= 1 and "id#" not in _plan(totals).split("MapInArrow")[0]


def test_only_bare_scans_are_counted(spark):
    from quarry.operators.joins import proven_bytes
    from quarry.sources import tables as TB
    users = TB.users(spark, SF)
    assert proven_bytes(users) == 2 * (8 + 16) * users.count()
    assert proven_bytes(users.where("id > 5")) is None and proven_bytes(users.distinct()) is None


def test_bodies_with_copies_are_exchanged_once(spark, monkeypatch):
    """Step 1 of posts with copies and users too many to broadcast: whole
    posts are shuffled by their id alone, as often as without copies."""
    from quarry.operators import clean as C
    from quarry.session import write_table
    monkeypatch.setattr(C, "broadcast_if_small", lambda df, *a, **k: df)
    posts = spark.createDataFrame([(i % 400 or None, f"title {i % 450 % 400}", "body", i % 7, i % 9 or None) for i in range(900)],
                                  "id long, title string, body string, score long, owner_user_id long")
    users = spark.createDataFrame([(i, i * 10 + k) for i in range(8) for k in range(1 + i % 2)], "id long, reputation long")
    votes = spark.createDataFrame([(i % 350, i % 3) for i in range(2000)], "post_id long, vote_type_id long")
    posts, users, votes = (write_table(t, "t") for t in (posts, users, votes))
    plain = posts.distinct().join(users.select(F.col("id").alias("owner_user_id"), "reputation").distinct(), "owner_user_id")
    lists = votes.groupBy(F.col("post_id").alias("id")).agg(F.sort_array(F.collect_set("vote_type_id")).alias("v"))
    plain = plain.join(plain.groupBy("id").agg(F.count(F.lit(1)).alias("k")), "id").join(lists, "id")
    want = sorted((r.id, r.title, r.score, r.owner_user_id, r.reputation, "|".join(str(v) for v in r.v for _ in range(r.k)))
                  for r in plain.collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = C.clean_branch(posts, users, votes, 1)
        text = out._jdf.queryExecution().executedPlan().toString()
        got = out.collect()
        monkeypatch.setattr(C, "COPIES", 1)
        hot = C.clean_branch(posts, users, votes, 1).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for rows in (got, hot):
        assert sorted((r.id, r.title, r.score, r.owner_user_id, r.reputation, r.vote_type_id) for r in rows) == want
    lines = text.split("\n")
    below = [lines[i + 1:] for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len([part for part in below if "body" in "\n".join(part[:3])]) == 1, text
