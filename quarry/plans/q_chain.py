"""The file jobs as queries: CSV dumps of the tables (every column text, lines
broken off in between) -> untyped scan -> step 1 -> step 2 -> step 3 -> step 4."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.operators import model as MD
from quarry.plans import jobs as J
from quarry.plans.q_features import COUNT_CELLS_SQL, TRAIN_SQL, cells_sql, vector_summary
from quarry.plans.q_model import GRADIENT_BOUND
from quarry.plans.q_tags import _DICT, _FWD, _REV, _SEG
from quarry.plans.registry import query
from quarry.sources import csv as CSV
from quarry.sources import tables as TB
from quarry.session import drop_path, released_shuffles
from quarry.sources.libsvm import read_libsvm

POST_COLS = [f.name for f in S.POSTS]


def _text(amount):
    """An amount as a dump writes it (``1234.56``)."""
    return F.col(amount).cast("decimal(15,2)").cast("string")


def _posts(spark, sf):
    """All ten post columns as text: body from documents, tags from part, some
    dates malformed, and for some posts a second version without title."""
    o = TB.table(spark, sf, "orders")
    d = TB.table(spark, sf, "documents").select("doc_id", F.col("text").alias("body"))
    p = TB.glued_tags(spark, sf).withColumnRenamed("id", "_part")
    key = F.col("o_orderkey")
    j = o.join(d, o.o_orderkey == d.doc_id, "left").join(p, o.o_orderkey == p._part, "left")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    posts = j.select(
        key.cast("string").alias("id"), F.col("o_orderpriority").alias("title"),
        F.coalesce("body", F.lit("")).alias("body"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat(day, F.lit("abc"))).otherwise(day).alias("creation_date"),
        (key % 5).cast("string").alias("answer_count"),
        F.when(key % 3 == 0, F.lit("")).otherwise((key % 7).cast("string")).alias("favorite_count"),
        _text("o_totalprice").alias("score"), F.coalesce("tags", F.lit("")).alias("tags"),
        F.lit("n/a").alias("view_count"), F.col("o_custkey").cast("string").alias("owner_user_id"),
        "o_orderstatus")
    # versions are made behind the join, so a body is shuffled once
    title = F.col("title")
    versions = F.when(title == "1-URGENT", F.array(title, F.lit(""))).when(title == "3-MEDIUM", F.array(title, title)) \
        .otherwise(F.array(title))
    return posts.withColumn("title", F.explode(versions))


def _dumps(spark, sf):
    """Write the five dumps; returns their prefix.  Both sets of posts, whose
    files are read whole, are written in one pass and compressed; so are the
    votes, in files of a bounded number of rows."""
    with released_shuffles(spark):
        return _write_dumps(spark, sf)


def _write_dumps(spark, sf):
    folder = CSV.scratch_path(spark, "dumps")
    base = folder + "/set="
    posts = _posts(spark, sf)
    name = F.when(F.col("o_orderstatus") == "F", F.lit("stackoverflow_posts")).otherwise(F.lit("all_questions"))
    CSV.write_csv(posts.where("o_orderstatus IS NOT NULL").select(*POST_COLS, F.lit("x").alias("extra"), name.alias("set")),
                  folder, partition_by="set", compression="gzip")
    # lines broken off after the second field, under the same header
    header = ",".join(POST_COLS + ["extra"])
    short = posts.where("o_orderstatus <> 'F'").select(F.concat_ws(",", "id", "title"))
    CSV.write_lines(short, header, base + "broken_questions")
    CSV.write_csv(TB.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("display_name"),
        _text("c_acctbal").alias("reputation")), base + "users")
    CSV.write_csv(TB.votes(spark, sf).select(
        F.lit("x").alias("kind"), *(F.col(c).cast("string") for c in ("post_id", "vote_type_id"))), base + "votes",
                  compression="gzip", maxRecordsPerFile=2_000_000)
    CSV.write_csv(TB.tag_words(spark, sf), base + "all_tags")
    return base


# an empty field of a dump is null
_STEP1_SQL = """one AS (
  SELECT o_orderkey AS id, o_orderpriority AS title, nullif(text, '') AS body,
         CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(epoch(date_trunc('day', o_orderdate)) AS BIGINT) END AS creation_date,
         o_orderkey % 5 AS answer_count, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 7 END AS favorite_count,
         CAST(trunc(CAST(o_totalprice AS DECIMAL(15,2))) AS INTEGER) AS score,
         nullif(replace(p_name, ' ', ''), '') AS tags, CAST(NULL AS INTEGER) AS view_count,
         o_custkey AS owner_user_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label
  FROM orders LEFT JOIN documents ON o_orderkey = doc_id LEFT JOIN part ON o_orderkey = p_partkey),
posts AS (SELECT * FROM one UNION ALL SELECT * REPLACE (NULL AS title) FROM one WHERE title = '1-URGENT'
          UNION ALL SELECT * FROM one WHERE title = '3-MEDIUM'),
users_d AS (SELECT DISTINCT c_custkey AS uid, CAST(trunc(CAST(c_acctbal AS DECIMAL(15,2))) AS INTEGER) AS reputation
            FROM customer),
votes_d AS (SELECT DISTINCT l_orderkey AS post_id, l_linenumber AS vote FROM lineitem),
puv AS (SELECT DISTINCT p.*, u.reputation, v.vote FROM posts p JOIN users_d u ON owner_user_id = uid
        JOIN votes_d v ON p.id = v.post_id),
vl AS (SELECT id, label, string_agg(CAST(vote AS VARCHAR), '|' ORDER BY vote) AS vote_type_id
       FROM puv GROUP BY id, label),
step1 AS (
  SELECT DISTINCT CAST(id AS INTEGER) AS id, title, body, creation_date, CAST(answer_count AS INTEGER) AS answer_count,
         CAST(favorite_count AS INTEGER) AS favorite_count, score, tags, view_count,
         CAST(owner_user_id AS INTEGER) AS owner_user_id, reputation, vl.vote_type_id, label
  FROM puv JOIN vl USING (id, label) WHERE label = 0 OR title <> '')"""


def _cleaned(spark, sf):
    """The chain through step 1; returns the dumps' prefix.  The dumps that no
    later step reads go."""
    base = _dumps(spark, sf)
    J.clean_job(spark, base, base + "out_labelled")
    drop_path(spark, *(base + name for name in ("all_questions", "stackoverflow_posts", "broken_questions", "users", "votes")))
    return base


@query("job_clean", sql=f"WITH {_STEP1_SQL} SELECT * FROM step1")
def job_clean(spark, sf):
    """Dumps -> untyped scan, broken lines dropped, casts -> step 1 over the
    whole record -> file -> read back."""
    return J.read_labelled(spark, _cleaned(spark, sf) + "out_labelled")


_STEP2_SQL = f"""{_DICT},
{_STEP1_SQL},
glued AS (SELECT DISTINCT id, tags AS s FROM step1),
{_FWD},
{_REV},
{_SEG},
step2 AS (SELECT step1.* REPLACE (split_tags AS tags) FROM step1 JOIN seg USING (id) WHERE split_tags IS NOT NULL)"""


def _tagged(spark, sf):
    """The chain through step 2, file to file; returns the dumps' prefix.
    Step 1's posts go once step 2's are written."""
    base = _cleaned(spark, sf)
    J.tags_job(spark, base, base + "out_labelled", base + "out_tagged")
    drop_path(spark, base + "out_labelled")
    return base


@query("job_tags", sql=f"WITH RECURSIVE {_STEP2_SQL} SELECT * FROM step2")
def job_tags(spark, sf):
    """The same chain through step 2, file to file."""
    return J.read_labelled(spark, _tagged(spark, sf) + "out_tagged")


# rows without a required value go
_STEP3_IN_SQL = f"""{_STEP2_SQL},
src0 AS (SELECT id, CAST(label AS DOUBLE) AS label, title, regexp_replace(body, '<.*?>', '', 'g') AS body,
                CAST(creation_date AS DOUBLE) AS s1, CAST(answer_count AS DOUBLE) AS s2,
                CAST(coalesce(favorite_count, 0) AS DOUBLE) AS s3, CAST(score AS DOUBLE) AS s4,
                CAST(reputation AS DOUBLE) AS s5, string_split(tags, '|') AS tag_list,
                string_split(vote_type_id, '|') AS vote_list
         FROM step2 WHERE COLUMNS(* EXCLUDE (favorite_count, view_count, owner_user_id)) IS NOT NULL),
src AS (SELECT *, {TRAIN_SQL} AS train FROM src0)"""


_LIBSVM: dict = {}


def _libsvm(spark, sf):
    """(path, vector width) of the chain's LibSVM files, memoised per
    application and scale so that steps 3 and 4 share one run."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LIBSVM:
        base = _tagged(spark, sf)
        _LIBSVM[key] = base + "out_libsvm", J.features_job(spark, base + "out_tagged", base + "out_libsvm")
        drop_path(spark, base + "out_tagged")
    return _LIBSVM[key]


@query("job_features", sql=f"""
WITH RECURSIVE {cells_sql(_STEP3_IN_SQL, "tag_list", "vote_list")},
{COUNT_CELLS_SQL}
SELECT CASE WHEN train THEN 'train' ELSE 'test' END AS side, label, CAST((SELECT n FROM width) AS INTEGER) AS width,
       CAST(count(*) FILTER (WHERE v <> 0) AS INTEGER) AS nnz, round(coalesce(sum(v), 0), 6) AS total
FROM src LEFT JOIN cells ON src.id = cells.id GROUP BY src.id, train, label
""")
def job_features(spark, sf):
    """The chain through step 3: every row of both LibSVM outputs, read back
    and summarised."""
    path, width = _libsvm(spark, sf)
    sides = [vector_summary(read_libsvm(spark, f"{path}/{name}", width).withColumn("id", F.lit(0)))
             .withColumn("side", F.lit(name)) for name in ("train", "test")]
    return sides[0].unionByName(sides[1]).select("side", "label", "width", "nnz", "total")


@query("job_train", sql=f"""
WITH RECURSIVE {_STEP3_IN_SQL}
SELECT label, count(*) AS n_label, CAST((SELECT count(*) FROM src WHERE train) AS BIGINT) AS total, true AS optimal
FROM src WHERE train GROUP BY label
""")
def job_train(spark, sf):
    """All four jobs: the training rows that the metrics count per label, and
    whether the fitted point is optimal on the training file."""
    path, width = _libsvm(spark, sf)
    done = J.train_job(spark, path, num_features=width)
    train = read_libsvm(spark, f"{path}/train", width).withColumn("id", F.lit(0))
    worst = MD.gradient(done["model"], train).agg(F.max(F.abs("gradient"))).first()[0]
    ok = worst is not None and worst <= GRADIENT_BOUND
    return done["metrics_by_label"].select("label", "n_label", "total", F.lit(ok).alias("optimal"))
