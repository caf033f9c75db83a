"""Step-1 queries (clean) on orders/customer/lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import clean as C
from quarry.plans.registry import query
from quarry.sources import tables as TB

# Reference semantics written literally in SQL: join, distinct, list per id,
# re-join, distinct.
_BRANCH_SQL = """
one_{b} AS (
  SELECT o_orderkey AS id, o_orderpriority AS title, o_orderdate AS creation_date,
         o_totalprice AS score, o_custkey AS owner_user_id
  FROM orders WHERE {where}),
posts_{b} AS (  -- versions of one id: without title, null title, exact copy, another score
  SELECT * FROM one_{b}
  UNION ALL SELECT id, '', creation_date, score, owner_user_id FROM one_{b} WHERE title = '1-URGENT'
  UNION ALL SELECT id, NULL, creation_date, score, owner_user_id FROM one_{b} WHERE title = '2-HIGH'
  UNION ALL SELECT * FROM one_{b} WHERE title = '3-MEDIUM'
  UNION ALL SELECT id, title, creation_date, score + 1, owner_user_id FROM one_{b} WHERE title = '5-LOW'),
users_d AS (SELECT DISTINCT c_custkey AS id, c_acctbal AS reputation FROM customer),
votes_d AS (SELECT DISTINCT l_orderkey AS post_id, l_linenumber AS vote_type_id FROM lineitem),
pu_{b} AS (
  SELECT p.id, p.title, p.creation_date, p.score, p.owner_user_id, u.reputation
  FROM posts_{b} p JOIN users_d u ON p.owner_user_id = u.id),
puv_{b} AS (
  SELECT DISTINCT pu.*, v.vote_type_id FROM pu_{b} pu JOIN votes_d v ON pu.id = v.post_id),
vl_{b} AS (
  SELECT id, coalesce(string_agg(CAST(vote_type_id AS VARCHAR), '|' ORDER BY vote_type_id), '')
         AS vote_type_id
  FROM puv_{b} GROUP BY id),
fin_{b} AS (
  SELECT DISTINCT t1.id, t1.title, t1.creation_date, t1.score, t1.owner_user_id,
         t1.reputation, t2.vote_type_id
  FROM puv_{b} t1 JOIN vl_{b} t2 ON t1.id = t2.id)
"""

_FINAL_COLS = """id, title, CAST(epoch(date_trunc('day', creation_date)) AS BIGINT) AS creation_date,
  score, owner_user_id, reputation, vote_type_id"""


def _versions(posts):
    """The posts, some of them in a second version or copy (as in the SQL)."""
    def those(title):
        return posts.where(F.col("title") == title)
    return (posts.unionByName(those("1-URGENT").withColumn("title", F.lit("")))
            .unionByName(those("2-HIGH").withColumn("title", F.lit(None).cast("string")))
            .unionByName(those("3-MEDIUM"))
            .unionByName(those("5-LOW").withColumn("score", F.col("score") + 1)))


def _answered(spark, sf):
    return C.clean_branch(_versions(TB.answered_posts(spark, sf)), TB.users(spark, sf), TB.votes(spark, sf),
                          1, require_title=True)


@query("votes_per_post_rejoin", sql=f"""
WITH {_BRANCH_SQL.format(b='a', where="o_orderstatus = 'F'")}
SELECT {_FINAL_COLS}, 1 AS label FROM fin_a WHERE title <> ''
""")
def votes_per_post_rejoin(spark, sf):
    """Flagship: the answered branch of step 1 end to end."""
    return _answered(spark, sf)


@query("label_posts", sql=f"""
WITH {_BRANCH_SQL.format(b='q', where="o_orderstatus <> 'F'")}
SELECT {_FINAL_COLS}, 0 AS label FROM fin_q
""")
def label_posts(spark, sf):
    """Unanswered branch: typed users and votes, label 0, no title filter."""
    return C.clean_branch(_versions(TB.unanswered_posts(spark, sf)), TB.users(spark, sf),
                          TB.votes(spark, sf), 0)


@query("label_union", sql=f"""
WITH {_BRANCH_SQL.format(b='q', where="o_orderstatus <> 'F'")},
{_BRANCH_SQL.format(b='a', where="o_orderstatus = 'F'").replace('users_d AS', 'users_d2 AS').replace('votes_d AS', 'votes_d2 AS')}
SELECT {_FINAL_COLS}, 0 AS label FROM fin_q
UNION ALL
SELECT {_FINAL_COLS}, 1 AS label FROM fin_a WHERE title <> ''
""")
def label_union(spark, sf):
    """Step 1 whole: both labelled sets in one frame (unionByName)."""
    return C.clean(_versions(TB.unanswered_posts(spark, sf)), _versions(TB.answered_posts(spark, sf)),
                   TB.users(spark, sf), TB.votes(spark, sf))


@query("join_post_user", sql="""
SELECT p.o_orderkey AS id, p.o_custkey AS owner_user_id, u.c_acctbal AS reputation
FROM orders p JOIN (SELECT DISTINCT c_custkey, c_acctbal FROM customer) u
  ON p.o_orderkey IS NOT NULL AND p.o_custkey = u.c_custkey
""")
def join_post_user(spark, sf):
    """Inner N:1 join posts x users on the owner key."""
    p = TB.posts(spark, sf).select("id", "owner_user_id")
    return C.attach_user(p, C.dedupe(TB.users(spark, sf)))


@query("join_post_user_skew_split", sql="""
SELECT p.o_orderkey AS id, p.o_custkey AS owner_user_id, u.c_acctbal AS reputation
FROM orders p JOIN (SELECT DISTINCT c_custkey, c_acctbal FROM customer) u
  ON p.o_custkey = u.c_custkey
""")
def join_post_user_skew_split(spark, sf):
    """The same join with the rows of owners holding > 0.05% of the posts
    salted within one shuffle join."""
    p = TB.posts(spark, sf).select("id", "owner_user_id")
    from quarry.operators.joins import hot_key_split_join
    u = C.dedupe(TB.users(spark, sf)).withColumnRenamed("id", "_uid")
    return hot_key_split_join(p, u, "owner_user_id", "_uid", share=0.0005).drop("_uid")


@query("join_mixed_type_key", sql="""
WITH u AS (
  SELECT CASE WHEN c_nationkey = 0 THEN 'cust-' || CAST(c_custkey AS VARCHAR)
              ELSE CAST(c_custkey AS VARCHAR) END AS id, c_acctbal AS reputation FROM customer)
SELECT p.o_orderkey AS id, p.o_custkey AS owner_user_id, u.reputation
FROM orders p JOIN u ON p.o_custkey = TRY_CAST(u.id AS BIGINT)
""")
def join_mixed_type_key(spark, sf):
    """int owner key = string user key: the string side is parsed once at the
    scan (null on junk), never compared as text."""
    from quarry.functions.casts import lenient_cast
    from pyspark.sql import types as T
    c = TB.table(spark, sf, "customer")
    raw = c.select(
        F.when(F.col("c_nationkey") == 0, F.concat(F.lit("cust-"), F.col("c_custkey").cast("string")))
        .otherwise(F.col("c_custkey").cast("string")).alias("id"),
        F.col("c_acctbal").alias("reputation"))
    typed = raw.select(lenient_cast(F.col("id"), T.LongType(), decimal_detour=False).alias("id"),
                       "reputation")
    p = TB.posts(spark, sf).select("id", "owner_user_id")
    return C.attach_user(p, typed)


@query("join_post_vote_fanout", sql="""
SELECT DISTINCT p.o_orderkey AS id, p.o_custkey AS owner_user_id, u.c_acctbal AS reputation,
       v.l_linenumber AS vote_type_id
FROM orders p JOIN customer u ON p.o_custkey = u.c_custkey
JOIN lineitem v ON p.o_orderkey = v.l_orderkey
""")
def join_post_vote_fanout(spark, sf):
    """1:N fan-out to votes + distinct (posts without votes vanish).  The
    votes are projected and deduplicated first (map-side partial distinct),
    so a post holding a third of all votes arrives as (#vote types) rows per
    map task, not as one giant partition."""
    p = TB.posts(spark, sf).select("id", "owner_user_id")
    pu = C.attach_user(p, TB.users(spark, sf))
    v = C.dedupe(TB.votes(spark, sf))
    return (pu.join(v, pu["id"] == v["post_id"], "inner")
            .select("id", "owner_user_id", "reputation", "vote_type_id").distinct())


@query("votes_collect_list", sql="""
SELECT post_id, coalesce(string_agg(CAST(v AS VARCHAR), '|' ORDER BY v), '') AS vote_type_id
FROM (SELECT DISTINCT l_orderkey AS post_id, l_linenumber AS v FROM lineitem WHERE l_orderkey IS NOT NULL)
GROUP BY post_id
""")
def votes_collect_list(spark, sf):
    """post -> distinct vote types as ``a|b|c`` (map-side partial collect_set)."""
    vl = C.vote_lists(TB.votes(spark, sf))
    from quarry.functions.text import pipe_join
    return vl.select(F.col("_pid").alias("post_id"), pipe_join(F.col("_types")).alias("vote_type_id"))


@query("distinct_full_row", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, epoch_us(l_shipdate) AS l_shipdate_us
FROM (SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem))
""")
def distinct_full_row(spark, sf):
    """Full-row distinct over the vote table with every row injected twice."""
    li = TB.table(spark, sf, "lineitem")
    d = C.dedupe(li.unionByName(li))
    return d.withColumn("l_shipdate_us", F.unix_micros(F.col("l_shipdate").cast("timestamp"))) \
            .drop("l_shipdate")


@query("project_columns", sql="""
SELECT l_orderkey AS post_id, l_linenumber AS vote_type_id, l_returnflag FROM lineitem
""")
def project_columns(spark, sf):
    """Projection + rename + drop (the scan reads only these three columns)."""
    li = TB.table(spark, sf, "lineitem")
    return (li.select(F.col("l_orderkey").alias("post_id"), F.col("l_linenumber").alias("vote_type_id"),
                      "l_returnflag", "l_tax").drop("l_tax"))


@query("date_to_unix", sql="""
SELECT o_orderkey AS id, CAST(epoch(date_trunc('day', o_orderdate)) AS BIGINT) AS creation_date
FROM orders
""")
def date_to_unix(spark, sf):
    """Creation day -> unix seconds of its midnight (session zone UTC)."""
    from quarry.functions.casts import day_to_unix
    o = TB.table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("id"), day_to_unix(F.col("o_orderdate")).alias("creation_date"))


@query("cast_schema", sql="""
SELECT c_custkey AS key,
       TRY_CAST(CAST(c_custkey AS VARCHAR) AS INTEGER) AS id,
       TRY_CAST(c_name AS INTEGER) AS name_as_int,
       -- Spark 2.x non-ANSI: decimal text truncates toward zero (DuckDB's
       -- integer cast would round, so go through decimal and trunc)
       CAST(trunc(TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(38,6))) AS INTEGER) AS reputation,
       CAST(c_mktsegment AS VARCHAR) AS segment,
       -- only the last two forms are dates; the others merely begin like one
       CAST(CASE WHEN c_nationkey NOT IN (0, 1, 2) THEN 1536019200 END AS BIGINT) AS day
FROM customer
""")
def cast_schema(spark, sf):
    """All-string rows -> typed schema with null-on-failure casts
    (``'12.7'`` -> 12, ``'Customer#..'`` -> null)."""
    from quarry.schemas import enforce
    from pyspark.sql import types as T
    c = TB.table(spark, sf, "customer")
    raw = c.select(F.col("c_custkey").alias("key"),
                   F.col("c_custkey").cast("string").alias("id"),
                   F.col("c_name").alias("name_as_int"),
                   F.col("c_acctbal").cast("string").alias("reputation"),
                   F.col("c_mktsegment").alias("segment"),
                   F.when(F.col("c_nationkey") == 0, "2018-09-04abc").when(F.col("c_nationkey") == 1, "2018-09-041")
                   .when(F.col("c_nationkey") == 2, "04.09.2018")
                   .when(F.col("c_nationkey") == 3, "2018-09-04 12:33:11 UTC").otherwise("2018-09-04").alias("day"))
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("id", T.IntegerType()),
                           T.StructField("name_as_int", T.IntegerType()),
                           T.StructField("reputation", T.IntegerType()),
                           T.StructField("segment", T.StringType()),
                           T.StructField("day", T.DateType())])
    return enforce(raw, schema).withColumn("day", F.unix_timestamp(F.col("day").cast("timestamp")))


_DOC_LABELS = """(SELECT d.doc_id, d.lang, l.quality, l.toxic,
        CASE WHEN l.quality = 1 THEN d.source WHEN l.quality = 0 THEN '' END AS title
   FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def _doc_labels(spark, sf):
    d = TB.table(spark, sf, "documents").select("doc_id", "lang", "source")
    lab = TB.table(spark, sf, "labels")
    j = d.join(lab, "doc_id", "left")
    title = F.when(F.col("quality") == 1, F.col("source")).when(F.col("quality") == 0, F.lit(""))
    return j.select("doc_id", "lang", "quality", "toxic", title.alias("title"))


@query("filter_nonempty_title", sql=f"""
SELECT doc_id, title FROM {_DOC_LABELS} WHERE title <> ''
""")
def filter_nonempty_title(spark, sf):
    """``title != ''`` drops empty and null titles."""
    return C.nonempty(_doc_labels(spark, sf)).select("doc_id", "title")


@query("filter_required_not_null", sql=f"""
SELECT doc_id, lang, quality, coalesce(toxic, 0) AS toxic FROM {_DOC_LABELS}
WHERE doc_id IS NOT NULL AND lang IS NOT NULL AND quality IS NOT NULL
""")
def filter_required_not_null(spark, sf):
    """Drop rows with a null in any required column; the optional one is
    filled with 0 afterwards."""
    from quarry.operators.features import required_not_null, fill_zero
    df = _doc_labels(spark, sf).select("doc_id", "lang", "quality", "toxic")
    return fill_zero(required_not_null(df, ["doc_id", "lang", "quality"]), ["toxic"])


@query("fill_null_zero", sql=f"""
SELECT doc_id, coalesce(quality, 0) AS quality FROM {_DOC_LABELS}
""")
def fill_null_zero(spark, sf):
    """null -> 0 on a typed integer column."""
    from quarry.operators.features import fill_zero
    return fill_zero(_doc_labels(spark, sf).select("doc_id", "quality"), ["quality"])
