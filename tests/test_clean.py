from pyspark.sql import functions as F

from quarry.operators import clean as C

POSTS = "id int, title string, creation_date string, owner_user_id int"


def _naive(posts, users, votes, value):
    """The reference's form: join, distinct, collect_list, re-join, distinct."""
    pu = posts.alias("p").join(users.alias("u"), F.col("p.owner_user_id") == F.col("u.id")) \
        .select("p.*", "u.reputation")
    puv = pu.alias("x").join(votes.alias("v"), F.col("x.id") == F.col("v.post_id")) \
        .select("x.*", "v.vote_type_id").distinct()
    vl = puv.groupBy("id").agg(F.array_join(F.array_sort(F.collect_list("vote_type_id")).cast("array<string>"),
                                            "|").alias("vote_type_id"))
    fin = puv.drop("vote_type_id").alias("t1").join(vl.alias("t2"), F.col("t1.id") == F.col("t2.id")) \
        .select("t1.*", "t2.vote_type_id").distinct()
    return C.label(fin, value)


def _frames(spark):
    posts = spark.createDataFrame([
        (1, "x", "2018-09-04", 10), (1, "x", "2018-09-04", 10),      # exact copy
        (2, "", "2018-09-05", 10), (3, None, "2018-09-06", 11),
        (4, "orphan", "2018-09-07", 99), (5, "null owner", "2018-09-07", None),
        (6, "no votes", "2018-09-08", 10), (7, "nullvotes", "2018-09-09", 11),
        (8, "v1", "2018-09-10", 12), (8, "v2", "2018-09-10", 12),    # two versions of id 8
    ], POSTS)
    users = spark.createDataFrame([(10, 100), (10, 100), (11, 5), (12, 7)], "id int, reputation int")
    votes = spark.createDataFrame([
        (1, 2), (1, 2), (1, 3), (2, 1), (3, 1), (4, 1), (7, None), (7, None), (8, 5), (8, 2),
    ], "post_id int, vote_type_id int")
    return posts, users, votes


def test_vote_lists_and_orphans(spark):
    posts, users, votes = _frames(spark)
    out = {r["id"]: r for r in C.clean_branch(posts, users, votes, 0).collect()}
    assert set(out) == {1, 2, 3, 7, 8}          # 4 unknown owner, 5 null owner, 6 no votes
    assert out[1]["vote_type_id"] == "2|3"       # distinct first
    assert out[7]["vote_type_id"] == ""          # only null votes
    assert out[1]["creation_date"] == 1536019200
    assert out[1]["label"] == 0


def test_matches_reference_form_with_versions(spark):
    posts, users, votes = _frames(spark)
    ours = C.clean_branch(posts, users, votes, 1)
    ref = _naive(posts, users, votes, 1)
    cols = sorted(ours.columns)
    assert ours.select(cols).exceptAll(ref.select(cols)).count() == 0
    assert ref.select(cols).exceptAll(ours.select(cols)).count() == 0
    v8 = [r["vote_type_id"] for r in ours.where("id = 8").collect()]
    assert v8 == ["2|2|5|5", "2|2|5|5"]          # each type once per version


def test_titles_per_branch(spark):
    posts, users, votes = _frames(spark)
    both = C.clean(posts, posts, users, votes)
    ans = {r["title"] for r in both.where("label = 1 AND id IN (1,2,3)").collect()}
    una = {r["title"] for r in both.where("label = 0 AND id IN (1,2,3)").collect()}
    assert ans == {"x"}
    assert una == {"x", "", None}
    # one plan for both sets, yet versions are counted per set
    v8 = sorted((r["label"], r["vote_type_id"]) for r in both.where("id = 8").collect())
    assert v8 == [(0, "2|2|5|5")] * 2 + [(1, "2|2|5|5")] * 2
    sep = C.clean_branch(posts, users, votes, 0).unionByName(
        C.clean_branch(posts, users, votes, 1, require_title=True))
    assert both.exceptAll(sep).count() == 0 and sep.exceptAll(both).count() == 0


def test_skew_split_join_equals_plain(spark):
    posts, users, votes = _frames(spark)
    a = C.attach_user(posts, users, skew="split")
    b = C.attach_user(posts, users)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_deterministic_across_partitions(spark):
    import __spark_entry__ as E
    q = E.queries()["label_union"]
    results = []
    for n in (1, 4, 16):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        results.append(sorted(map(tuple, q(spark, "/root/testdata/sf0.001").collect()), key=repr))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]


def test_auto_skew_split_when_users_not_broadcast(spark, monkeypatch):
    from quarry.operators import clean as CL
    posts, users, votes = _frames(spark)
    # force "not small": auto mode must take the hot-key split path
    monkeypatch.setattr(CL, "broadcast_if_small", lambda df, *a, **k: df)
    a = CL.clean_branch(posts, users, votes, 0, skew="auto")
    b = _naive(posts, users, votes, 0)
    cols = sorted(a.columns)
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0
    assert b.select(cols).exceptAll(a.select(cols)).count() == 0


def test_skewed_inputs_match_reference_form(spark):
    from quarry.operators.joins import hot_keys
    n = 3000
    # owner 1 holds a third of the posts; post 0 is copied n/3 times
    posts = spark.range(n).selectExpr(
        "CAST(CASE WHEN id < 1000 THEN 0 ELSE id END AS INT) AS id",
        "'t' AS title", "'2018-09-04' AS creation_date",
        "CAST(CASE WHEN id % 3 = 0 THEN 1 ELSE id % 50 + 2 END AS INT) AS owner_user_id")
    users = spark.range(60).selectExpr("CAST(id AS INT) AS id", "CAST(id * 10 AS INT) AS reputation")
    # post 0 holds a third of the votes
    votes = spark.range(3 * n).selectExpr(
        "CAST(CASE WHEN id % 3 = 0 THEN 0 ELSE id % 2000 + 1000 END AS INT) AS post_id",
        "CAST(id % 4 AS INT) AS vote_type_id")
    assert [r[0] for r in hot_keys(posts, "owner_user_id", 0.2).collect()] == [1]
    for skew in ("split", "aqe"):
        ours = C.clean_branch(posts, users, votes, 1, skew=skew)
        ref = _naive(posts, users, votes, 1)
        cols = sorted(ours.columns)
        assert ours.select(cols).exceptAll(ref.select(cols)).count() == 0
        assert ref.select(cols).exceptAll(ours.select(cols)).count() == 0


def test_untitled_version_counts_before_it_goes(spark):
    """Id 8 has versions '' and 'x' and votes 5 and 2: each type once per version."""
    posts = spark.createDataFrame([(8, "", 1), (8, "x", 1), (8, "x", 1), (9, None, 1)],
                                  "id long, title string, owner_user_id long")
    users = spark.createDataFrame([(1, 10)], "id long, reputation int")
    votes = spark.createDataFrame([(8, 5), (8, 2), (8, 2), (9, 1)], "post_id long, vote_type_id int")
    one = C.clean_branch(posts, users, votes, 1, require_title=True).collect()
    both = C.clean(posts.limit(0), posts, users, votes).collect()
    for rows in (one, both):
        assert [(r.id, r.title, r.vote_type_id) for r in rows] == [(8, "x", "2|2|5|5")]


def test_salted_join_equals_plain_join(spark):
    """A third of the rows on one key, copies of one row among them, a null
    key, and two rows of the hot key on the small side."""
    from quarry.operators.joins import hot_key_split_join
    big = spark.range(3000).selectExpr(
        "CAST(CASE WHEN id % 3 = 0 THEN 7 WHEN id % 100 = 1 THEN NULL ELSE id % 40 END AS INT) AS k",
        "CASE WHEN id % 3 = 0 THEN 'copy' ELSE CAST(id AS STRING) END AS v")
    small = spark.range(50).selectExpr("CAST(id AS INT) AS k2", "id * 10 AS w").union(
        spark.createDataFrame([(7, -1), (None, -2)], "k2 int, w long"))
    got = hot_key_split_join(big, small, "k", "k2", share=0.1)
    plain = big.join(small, F.col("k") == F.col("k2"))
    assert got.columns == plain.columns
    assert got.exceptAll(plain).count() == plain.exceptAll(got).count() == 0
    assert hot_key_split_join(big.limit(0), small, "k", "k2").count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # the big side is planned for the join and, by its key only, for the count
    assert plan.count("Range (0, 3000") <= 3 and plan.count("Range (0, 50,") == 1


def test_distinct_wide_equals_distinct(spark):
    from collections import Counter

    from pyspark.sql import functions as F

    from quarry.operators import clean as C
    rows = [(1, "a", None, 0.0), (1, "a", None, -0.0), (1, None, "a", 0.0), (1, "a", None, 0.5), (None, None, None, None),
            (None, None, None, None), (2, "b", "c", float("nan")), (2, "b", "c", float("nan"))]
    rows += [(9, "hot", "x" * 500, 1.0)] * 400 + [(i, f"t{i}", "y", 2.0) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, title string, body string, score double").repartition(6)
    text = lambda d: Counter(str(tuple(r)) for r in d.select("id", "title", "body", F.col("score") + 0.0).collect())
    assert text(C.distinct_wide(df)) == text(df.distinct()) and max(text(C.distinct_wide(df)).values()) == 1
    unlike = df.where("id < 300 AND id > 2").distinct()
    assert C.distinct_wide(unlike) is unlike  # no fingerprint repeats: nothing else is done
    nested = df.withColumn("list", F.array("score"))
    assert C.distinct_wide(nested).count() == nested.distinct().count()
    assert C.distinct_wide(df.where("false")).count() == 0
