"""Feature-stage queries: long-form vocabulary, count vectors and min-max
scaling (SQL-checked), hashed term frequencies and the ML pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.operators import features as FT
from quarry.plans.q_text import _stop_sql
from quarry.plans.registry import query
from quarry.sources import tables as TB

_TF_SQL = f"""toks AS (SELECT doc_id, unnest({_stop_sql('text')}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term),
totals AS (SELECT term, CAST(sum(tf) AS BIGINT) AS total, count(*) AS df FROM tf GROUP BY term),
ranked AS (SELECT term, total, df, row_number() OVER (ORDER BY total DESC, term) - 1 AS index FROM totals)"""

TOPK = 1000


def _tokens(spark, sf):
    d = TB.table(spark, sf, "documents")
    return d.select("doc_id", X.remove_stopwords(X.tokenize(F.col("text"))).alias("toks"))


def _tf_long(spark, sf):
    """Term counts in long form; a document is one row, so nothing is shuffled."""
    return FT.term_counts_in_row(_tokens(spark, sf), "doc_id", "toks")


@query("vocabulary_terms", sql=f"""
WITH {_TF_SQL}
SELECT term, total, df FROM totals
""")
def vocabulary_terms(spark, sf):
    """Corpus vocabulary: total count and document frequency per term."""
    counts = FT.term_partials(_tokens(spark, sf), "toks").groupBy("term")
    return counts.agg(F.sum("total").alias("total"), F.sum("df").alias("df"))


@query("vocabulary_topk", sql=f"""
WITH {_TF_SQL}
SELECT term, total, df, index FROM ranked WHERE index < {TOPK}
""")
def vocabulary_topk(spark, sf):
    """Top-V terms by total count (ties by term) with their vector index."""
    return FT.vocabulary_by_threshold(_tokens(spark, sf), "toks", vocab_size=TOPK).select(
        "term", "total", "df", "index")


@query("count_vector_long", sql=f"""
WITH {_TF_SQL}
SELECT t.doc_id, t.term, r.index, t.tf FROM tf t JOIN ranked r ON t.term = r.term
WHERE r.index < {FT.DEFAULT_VOCAB}
""")
def count_vector_long(spark, sf):
    """Count vectors unfolded to (doc, term, index, tf), default width 2^18.
    The long form feeds two jobs (vocabulary, join), so it is written once to
    the checkpoint folder instead of tokenising the corpus twice."""
    from quarry.session import write_table
    tfl = write_table(_tf_long(spark, sf), "tf_long")
    voc = FT.vocabulary(tfl, "doc_id", vocab_size=FT.DEFAULT_VOCAB)
    return FT.count_vector_long(tfl, voc).select("doc_id", "term", "index", "tf")


@query("minmax_terms_long", sql=f"""
WITH {_TF_SQL},
n AS (SELECT count(*) AS n FROM documents),
st AS (SELECT term, max(tf) AS mx, CASE WHEN count(*) < (SELECT n FROM n) THEN 0 ELSE min(tf) END AS mn
       FROM tf GROUP BY term)
SELECT t.doc_id, t.term, t.tf,
       round(CASE WHEN st.mx = st.mn THEN 0.5 ELSE (t.tf - st.mn) / (st.mx - st.mn) END, 6) AS value
FROM tf t JOIN st ON t.term = st.term
""")
def minmax_terms_long(spark, sf):
    """Min-max scaled term counts in long form (absent cells stay 0).  The
    counts feed the statistics and the join, so they are written once."""
    from quarry.session import write_table
    n_docs = TB.table(spark, sf, "documents").count()
    r = FT.minmax_terms_long(write_table(_tf_long(spark, sf), "tf_long"), "doc_id", n_docs)
    return r.select("doc_id", "term", "tf", F.round("value", 6).alias("value"))


@query("minmax_scalars", sql="""
WITH o AS (SELECT o_orderkey AS id, o_totalprice AS score,
                  CAST(epoch(date_trunc('day', o_orderdate)) AS BIGINT) AS creation_date,
                  o_custkey AS owner, length(o_orderstatus) AS one FROM orders),
m AS (SELECT min(score) a1, max(score) b1, min(creation_date) a2, max(creation_date) b2,
             min(owner) a3, max(owner) b3, min(one) a4, max(one) b4 FROM o)
SELECT id,
  round(CASE WHEN b1 = a1 THEN 0.5 ELSE (score - a1) / (b1 - a1) END, 6) AS score_f,
  round(CASE WHEN b2 = a2 THEN 0.5 ELSE (creation_date - a2) / (b2 - a2) END, 6) AS creation_date_f,
  round(CASE WHEN b3 = a3 THEN 0.5 ELSE (owner - a3) / (b3 - a3) END, 6) AS owner_f,
  round(CASE WHEN b4 = a4 THEN 0.5 ELSE (one - a4) / (b4 - a4) END, 6) AS one_f
FROM o, m
""")
def minmax_scalars(spark, sf):
    """Several scalar columns scaled to [0, 1] with one aggregate job; a
    constant column gives 0.5."""
    from quarry.functions.casts import day_to_unix
    o = TB.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("score"),
        day_to_unix(F.col("o_orderdate")).alias("creation_date"),
        F.col("o_custkey").alias("owner"), F.length("o_orderstatus").alias("one"))
    cols = ["score", "creation_date", "owner", "one"]
    r = FT.minmax_scalars(o, cols)
    return r.select("id", *[F.round(c + "_f", 6).alias(c + "_f") for c in cols])


def murmur_sql(source: str, col: str) -> str:
    """CTEs that end in ``hashed(term, index)``: the bucket of each term of
    ``source`` by 32-bit murmur3 (seed 42) of its UTF-8 bytes, of which the
    last len % 4 are mixed in one by one as signed numbers."""
    m = 4294967295
    rotated = lambda x, r: f"((({x} << {r}) & {m}) | ({x} >> {32 - r}))"
    return f"""bytes AS (SELECT {col} AS term, list_transform(range(0, octet_length(encode({col}))),
      lambda i: CAST('0x' || substr(hex(encode({col})), 2 * i + 1, 2) AS UBIGINT)) AS b
    FROM (SELECT DISTINCT {col} FROM {source})),
  mixed AS (SELECT term, len(b) AS n, list_transform(list_transform(list_concat(
      list_transform(range(0, len(b) // 4), lambda i: b[4 * i + 1] + b[4 * i + 2] * 256 + b[4 * i + 3] * 65536 + b[4 * i + 4] * 16777216),
      list_transform(b[len(b) // 4 * 4 + 1:], lambda x: CASE WHEN x > 127 THEN x + 4294967040 ELSE x END)),
      lambda x: (x * 3432918353) & {m}), lambda x: ({rotated('x', 15)} * 461845907) & {m}) AS k FROM bytes),
  h0 AS (SELECT term, xor(list_reduce(list_concat([CAST(42 AS UBIGINT)], k),
      lambda h, x: ({rotated('xor(h, x)', 13)} * 5 + 3864292196) & {m}), CAST(n AS UBIGINT)) AS h FROM mixed),
  h1 AS (SELECT term, (xor(h, h >> 16) * 2246822507) & {m} AS h FROM h0),
  h2 AS (SELECT term, (xor(h, h >> 13) * 3266489909) & {m} AS h FROM h1),
  hashed AS (SELECT term, CAST(xor(h, h >> 16) % {FT.DEFAULT_VOCAB} AS INTEGER) AS index FROM h2)"""


_HASHED_TF_SQL = f"""
WITH toks AS (SELECT doc_id, unnest({_stop_sql('text')}) AS term FROM documents),
{murmur_sql('toks', 'term')}
SELECT doc_id, index, CAST(count(*) AS DOUBLE) AS tf FROM toks JOIN hashed USING (term) GROUP BY doc_id, index
"""


@query("hashing_tf", sql=_HASHED_TF_SQL)
def hashing_tf(spark, sf):
    """Hashed term frequencies (2^18 buckets) in long form (doc, index, tf)."""
    return FT.hashing_tf_long(_tokens(spark, sf), "doc_id", "toks")


@query("hashing_tf_vectors", sql=_HASHED_TF_SQL)
def hashing_tf_vectors(spark, sf):
    """The same buckets as sparse vectors, unfolded to their cells."""
    from quarry.operators.model import vector_cells
    vectors = FT.hashing_tf_vectors(_tokens(spark, sf), "toks")
    return vector_cells(vectors, ("doc_id",)).select("doc_id", "index", F.col("value").alias("tf"))


def features_in(spark, sf):
    """Feature-stage input built from documents x labels (see README):
    id, title (first line), body (whole text), creation_date (n_chars),
    answer_count (line breaks), favorite_count (toxic), score (words),
    tags (lang|source), reputation (length of source), vote_type_id (lang),
    label (quality)."""
    d = TB.table(spark, sf, "documents")
    lab = TB.table(spark, sf, "labels")
    j = d.join(lab, "doc_id", "inner")
    return j.select(
        F.col("doc_id").cast("int").alias("id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("body"),
        F.col("n_chars").alias("creation_date"),
        (F.length("text") - F.length(F.regexp_replace("text", "\n", ""))).alias("answer_count"),
        F.col("toxic").alias("favorite_count"),
        F.size(F.split("text", " ")).alias("score"),
        F.concat_ws("|", "lang", "source").alias("tags"),
        F.length("source").alias("reputation"),
        F.col("lang").alias("vote_type_id"),
        F.col("quality").alias("label"),
    )


def training_data(spark, sf, variant="count", fit_on="train"):
    """The feature table; the pipeline is fitted on the training side of the
    hash split (``fit_on='all'``: on every row)."""
    from quarry.operators.model import split_hash
    prepared = FT.prepare(features_in(spark, sf))
    fit_df = split_hash(prepared, "id")[0] if fit_on == "train" else prepared
    model = FT.feature_pipeline(prepared, variant=variant, fit_df=fit_df)
    return FT.training_table(model, prepared)


def vector_summary(t, col="features"):
    """(id, label, width, nnz, total) per row - scalar columns for checking,
    from the stored cells: a sparse vector is never made as wide as it says."""
    v = F.unwrap_udt(F.col(col))
    return t.select(
        "id", "label", F.coalesce(v["size"], F.size(v["values"])).alias("width"),
        F.size(F.filter(v["values"], lambda x: x != 0)).alias("nnz"),
        F.round(F.aggregate(v["values"], F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


#: the training side of the hash split, as in model.split_hash
TRAIN_SQL = "('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8))::UBIGINT % 10 <> 9"

FEATURES_IN_SQL = f"""src0 AS (
  SELECT CAST(d.doc_id AS INTEGER) AS id, CAST(l.quality AS DOUBLE) AS label,
         string_split(d.text, chr(10))[1] AS title, regexp_replace(d.text, '<.*?>', '', 'g') AS body,
         CAST(d.n_chars AS DOUBLE) AS s1, CAST(len(string_split(d.text, chr(10))) - 1 AS DOUBLE) AS s2,
         CAST(coalesce(l.toxic, 0) AS DOUBLE) AS s3, CAST(len(string_split(d.text, ' ')) AS DOUBLE) AS s4,
         CAST(length(d.source) AS DOUBLE) AS s5, d.lang, d.source
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
  WHERE d.doc_id IS NOT NULL AND d.text IS NOT NULL AND d.n_chars IS NOT NULL AND d.lang IS NOT NULL
    AND d.source IS NOT NULL AND l.quality IS NOT NULL),
src AS (SELECT *, {TRAIN_SQL} AS train FROM src0)"""

def cells_sql(source, tags="[lang, source]", votes="[lang]"):
    """Every block as (id, value) cells; min, max and vocabularies of the
    training side.  ``source`` ends with the rows ``src``, of which ``tags``
    and ``votes`` are the lists."""
    return f"""{source},
toks AS (SELECT id, train, 'title' AS block, unnest({_stop_sql('title')}) AS term FROM src
         UNION ALL SELECT id, train, 'body', unnest({_stop_sql('body')}) FROM src),
tf AS (SELECT id, train, block, term, count(*) AS tf FROM toks GROUP BY ALL),
st AS (SELECT block, term, sum(tf) AS total, max(tf) AS mx,
              CASE WHEN count(*) < (SELECT count(*) FROM src WHERE train) THEN 0 ELSE min(tf) END AS mn
       FROM tf WHERE train GROUP BY block, term),
voc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY block ORDER BY total DESC, term) AS rk FROM st)
        WHERE rk <= {FT.DEFAULT_VOCAB}),
lists AS (SELECT id, train, 'tags' AS block, unnest({tags}) AS term FROM src
          UNION ALL SELECT id, train, 'votes', unnest({votes}) FROM src),
lvoc AS (SELECT DISTINCT block, term FROM lists WHERE train),
scal AS (SELECT id, train, unnest(['s1', 's2', 's3', 's4', 's5']) AS name, unnest([s1, s2, s3, s4, s5]) AS x FROM src),
mm AS (SELECT name, min(x) AS lo, max(x) AS hi FROM scal WHERE train GROUP BY name),
other AS (
  SELECT id, CAST(count(*) AS DOUBLE) AS v FROM lists JOIN lvoc USING (block, term) GROUP BY id, block, term
  UNION ALL
  SELECT id, CASE WHEN hi = lo THEN 0.5 ELSE (x - lo) / (hi - lo) END FROM scal JOIN mm USING (name))"""


_CELLS_SQL = cells_sql(FEATURES_IN_SQL)

#: the cells of the count variant, terms of every training row included, and the width
COUNT_CELLS_SQL = """cells AS (
  SELECT id, CASE WHEN mx = mn THEN 0.5 ELSE (tf - mn) / (mx - mn) END AS v FROM tf JOIN voc USING (block, term)
  UNION ALL  -- a term of every training document that a test document lacks
  SELECT s.id, CASE WHEN mx = mn THEN 0.5 ELSE (0 - mn) / (mx - mn) END
  FROM (SELECT * FROM src WHERE NOT train) s JOIN (SELECT * FROM voc WHERE mn > 0) voc ON true
  WHERE NOT EXISTS (SELECT 1 FROM tf WHERE tf.id = s.id AND tf.block = voc.block AND tf.term = voc.term)
  UNION ALL SELECT * FROM other),
width AS (SELECT (SELECT count(*) FROM voc) + (SELECT count(*) FROM lvoc) + 5 AS n)"""

_SUMMARY_SQL = """SELECT src.id, src.label, CAST((SELECT n FROM width) AS INTEGER) AS width, {nnz}
       round(coalesce(sum(v), 0), 6) AS total
FROM src LEFT JOIN cells ON src.id = cells.id GROUP BY src.id, src.label"""


@query("feature_pipeline", sql=f"""
WITH {_CELLS_SQL},
{COUNT_CELLS_SQL}
{_SUMMARY_SQL.format(nnz="CAST(count(*) FILTER (WHERE v <> 0) AS INTEGER) AS nnz,")}
""")
def feature_pipeline(spark, sf):
    """9-block pipeline (count vectors + min-max) fitted on the training
    split, summarised per row."""
    return vector_summary(training_data(spark, sf))


@query("assemble_features", sql=f"""
WITH {_CELLS_SQL},
cells AS (SELECT id, CAST(tf AS DOUBLE) AS v FROM tf UNION ALL SELECT * FROM other),
width AS (SELECT 2 * {FT.DEFAULT_VOCAB} + (SELECT count(*) FROM lvoc) + 5 AS n)
{_SUMMARY_SQL.format(nnz="")}
""")
def assemble_features(spark, sf):
    """Hashed variant (title/body hashed, no scaling): width and total per
    row.  The number of cells depends on collisions, which SQL can't tell."""
    return vector_summary(training_data(spark, sf, variant="hash")).drop("nnz")


@query("hashing_tf_totals", sql=f"""
SELECT doc_id, CAST(count(*) AS DOUBLE) AS total
FROM (SELECT doc_id, unnest({_stop_sql('text')}) AS term FROM documents) GROUP BY doc_id
""")
def hashing_tf_totals(spark, sf):
    """Sum of the hashed term frequencies per document = its kept tokens."""
    return hashing_tf(spark, sf).groupBy("doc_id").agg(F.sum("tf").alias("total"))


# ------------------------------------------------------- long-form assembly

# the cells of all blocks with the index of their term, item or scalar inside the block
_LONG_SQL = f"""{_CELLS_SQL},
lrank AS (SELECT block, term, row_number() OVER (PARTITION BY block ORDER BY count(*) DESC, term) - 1 AS k
          FROM lists WHERE train GROUP BY block, term),
local AS (
  SELECT id, block, rk - 1 AS k, CASE WHEN mx = mn THEN 0.5 ELSE (tf - mn) / (mx - mn) END AS v
  FROM tf JOIN voc USING (block, term)
  UNION ALL
  SELECT s.id, voc.block, rk - 1, CASE WHEN mx = mn THEN 0.5 ELSE (0 - mn) / (mx - mn) END
  FROM (SELECT * FROM src WHERE NOT train) s JOIN (SELECT * FROM voc WHERE mn > 0) voc ON true
  WHERE NOT EXISTS (SELECT 1 FROM tf WHERE tf.id = s.id AND tf.block = voc.block AND tf.term = voc.term)
  UNION ALL
  SELECT id, block, k, CAST(count(*) AS DOUBLE) FROM lists JOIN lrank USING (block, term) GROUP BY id, block, term, k
  UNION ALL
  SELECT id, name, 0, CASE WHEN hi = lo THEN 0.5 ELSE (x - lo) / (hi - lo) END FROM scal JOIN mm USING (name)),
sizes AS (
  SELECT * FROM (VALUES ('title', 1), ('body', 2), ('s1', 3), ('s2', 4), ('s3', 5), ('s4', 6), ('tags', 7), ('s5', 8),
                        ('votes', 9)) AS b(block, place)
  LEFT JOIN (SELECT block, count(*) AS n FROM voc GROUP BY block UNION ALL SELECT block, count(*) FROM lrank GROUP BY block
             UNION ALL SELECT name, 1 FROM mm) USING (block)),
offsets AS (SELECT block, coalesce(sum(n) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o
            FROM sizes),
long AS (SELECT id, CAST(o + k AS BIGINT) AS index, v AS value FROM local JOIN offsets USING (block) WHERE v <> 0)"""

_ASSEMBLED: dict = {}


def assembled(spark, sf):
    """(prepared rows, long-form cells fitted on the training split),
    memoised per application and scale."""
    from quarry.operators.long_features import assemble_long
    from quarry.operators.model import split_hash
    key = (spark.sparkContext.applicationId, sf)
    if key not in _ASSEMBLED:
        prepared = FT.prepare(features_in(spark, sf))
        _ASSEMBLED[key] = prepared, assemble_long(prepared, split_hash(prepared, "id")[0])
    return _ASSEMBLED[key]


@query("assemble_cells", sql=f"""
WITH {_LONG_SQL}
SELECT id, index, round(value, 6) AS value FROM long
""")
def assemble_cells(spark, sf):
    """Every cell of the nine assembled blocks, by its global index."""
    return assembled(spark, sf)[1].cells.select("id", "index", F.round("value", 6).alias("value"))


@query("libsvm_long_roundtrip", sql=f"""
WITH {_LONG_SQL}
SELECT label, (SELECT CAST(sum(n) AS INTEGER) FROM sizes) AS width, CAST(index AS INTEGER) AS index, round(value, 6) AS value
FROM long JOIN src USING (id)
""")
def libsvm_long_roundtrip(spark, sf):
    """Cells written straight to LibSVM in one secondary sort, read back as
    vectors and unfolded again."""
    from quarry.operators.long_features import write_libsvm_long
    from quarry.operators.model import vector_cells
    from quarry.sources.csv import scratch_path
    from quarry.sources.libsvm import read_libsvm
    prepared, done = assembled(spark, sf)
    path = scratch_path(spark, "libsvm_long")
    write_libsvm_long(prepared, done.cells, path)
    back = read_libsvm(spark, path, num_features=done.width)
    return vector_cells(back, ("label",)).select("label", F.lit(done.width).alias("width"), "index",
                                                 F.round("value", 6).alias("value"))


@query("score_linear_long", sql=f"""
WITH {_LONG_SQL},
raw AS (SELECT src.id, 0.25 + coalesce(sum(value * ((index * 7919) % 2001 - 1000) / 1000.0), 0) AS raw
        FROM (SELECT id FROM src WHERE NOT train) src LEFT JOIN long ON long.id = src.id GROUP BY src.id)
SELECT id, round(raw, 6) AS raw, round(1 / (1 + exp(-raw)), 6) AS probability,
       CASE WHEN raw > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
FROM raw
""")
def score_linear_long(spark, sf):
    """Test rows scored as a sparse matrix-vector product: cells joined with
    coefficients that their index gives, and summed."""
    from quarry.operators.long_features import score_linear_long as score
    from quarry.operators.model import split_hash
    prepared, done = assembled(spark, sf)
    given = spark.range(done.width).select(F.col("id").alias("index"),
                                           ((F.col("id") * 7919 % 2001 - 1000) / 1000.0).alias("coefficient"))
    test = split_hash(prepared.select("id"), "id")[1]
    out = score(test, done.cells.join(test, "id", "left_semi"), given, intercept=0.25)
    return out.select("id", F.round("raw", 6).alias("raw"), F.round("probability", 6).alias("probability"), "prediction")
