"""Split / train / score / metrics queries.

Metrics queries read ``labels`` (label = quality, prediction = toxic as a
stand-in classifier) so that SQL can check them; the learning queries train
on the documents x labels feature table and are rows-only checks.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from quarry.operators import metrics as MT
from quarry.operators import model as MD
from quarry.plans.q_features import FEATURES_IN_SQL, training_data
from quarry.plans.registry import query
from quarry.sources import tables as TB

_CONF = """c AS (SELECT CAST(quality AS DOUBLE) AS label, CAST(toxic AS DOUBLE) AS prediction, count(*) AS n
       FROM labels GROUP BY ALL),
pl AS (SELECT label, sum(n) AS n_label, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp
       FROM c GROUP BY label),
pp AS (SELECT prediction AS label, sum(n) AS n_pred FROM c GROUP BY prediction),
j AS (SELECT pl.label, pl.n_label, pl.tp, coalesce(pp.n_pred, 0) AS n_pred,
             sum(pl.n_label) OVER () AS total
      FROM pl LEFT JOIN pp ON pl.label = pp.label),
m AS (SELECT label, tp, n_pred - tp AS fp, n_label - tp AS fn, total - n_label - (n_pred - tp) AS tn,
             n_label, total,
             CASE WHEN (total - n_label) = 0 THEN 0.0 ELSE (n_pred - tp) / (total - n_label) END AS fpr,
             CASE WHEN n_label = 0 THEN 0.0 ELSE tp / n_label END AS tpr,
             CASE WHEN n_pred = 0 THEN 0.0 ELSE tp / n_pred END AS prec
      FROM j),
mf AS (SELECT *, CASE WHEN prec + tpr = 0 THEN 0.0 ELSE 2 * prec * tpr / (prec + tpr) END AS f FROM m)"""


def _pred(spark, sf):
    lab = TB.table(spark, sf, "labels")
    return lab.select(F.col("quality").alias("label"), F.col("toxic").alias("prediction"))


def _rounded(df):
    """Doubles to 6 digits, for comparison; the operators don't round."""
    return df.select(*(F.round(c, 6).alias(c) if kind == "double" else c for c, kind in df.dtypes))


@query("metrics_by_label", sql=f"""
WITH {_CONF}
SELECT label, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
       CAST(tn AS BIGINT) AS tn, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr,
       round(prec, 6) AS precision, round(tpr, 6) AS recall, round(f, 6) AS f_measure,
       CAST(n_label AS BIGINT) AS n_label, CAST(total AS BIGINT) AS total
FROM mf
""")
def metrics_by_label(spark, sf):
    """Per-label fpr, tpr, precision, recall, F-measure from confusion counts."""
    return _rounded(MT.by_label(_pred(spark, sf)))


@query("metrics_weighted", sql=f"""
WITH {_CONF}
SELECT round(sum(tp) / max(total), 6) AS accuracy,
       round(sum(n_label / total * fpr), 6) AS weighted_fpr,
       round(sum(n_label / total * tpr), 6) AS weighted_tpr,
       round(sum(n_label / total * f), 6) AS weighted_f_measure,
       round(sum(n_label / total * prec), 6) AS weighted_precision,
       round(sum(n_label / total * tpr), 6) AS weighted_recall
FROM mf
""")
def metrics_weighted(spark, sf):
    """Accuracy and label-frequency-weighted metrics."""
    return _rounded(MT.weighted(_pred(spark, sf)))


@query("metric_mae", sql="""
SELECT round(avg(abs(CAST(quality AS DOUBLE) - CAST(toxic AS DOUBLE))), 6) AS mae FROM labels
""")
def metric_mae(spark, sf):
    """Mean absolute error of 0/1 predictions (= error rate)."""
    return _rounded(MT.mae(_pred(spark, sf)))


@query("split_hash", sql="""
SELECT doc_id, CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::UBIGINT % 10 AS INTEGER) AS bucket,
       CASE WHEN ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::UBIGINT % 10 = 9
            THEN 'test' ELSE 'train' END AS split
FROM documents
""")
def split_hash(spark, sf):
    """Stable 90/10 split by md5 of the id (reproducible under any
    partitioning, unlike randomSplit)."""
    d = TB.table(spark, sf, "documents").select("doc_id")
    b = MD.hash_bucket(F.col("doc_id"))
    return d.select("doc_id", b.alias("bucket"),
                    F.when(b == 9, F.lit("test")).otherwise(F.lit("train")).alias("split"))


# ---------------------------------------------------------------- learning

_FITTED: dict = {}


def _fitted(spark, sf):
    """Feature table + 90/10 hash split + fitted model, memoised per
    application and scale so that the learning queries share one training
    run.  Features are fitted on the training side."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        data = MD.training_frame(training_data(spark, sf))
        train, test = MD.split_hash(data, "id")
        model = MD.fit_logreg(train)
        _FITTED[key] = (data, train, test, model)
    return _FITTED[key]


@query("split_random")
def split_random(spark, sf):
    """randomSplit([0.9, 0.1], seed 11) as the reference: (id, split)."""
    train, test = MD.split_random(_fitted(spark, sf)[0].select("id"), (0.9, 0.1), seed=11)
    return train.select("id", F.lit("train").alias("split")).unionByName(
        test.select("id", F.lit("test").alias("split")))


@query("split_random_invariants", sql=f"""
WITH {FEATURES_IN_SQL}
SELECT id, CAST(1 AS BIGINT) AS times, true AS share_in_bounds FROM src
""")
def split_random_invariants(spark, sf):
    """Each id is on one side of the random split once, and the training side
    has a share of the rows within five deviations of 0.9."""
    sides = split_random(spark, sf)
    n, train = sides.agg(F.count(F.lit(1)), F.count_if(F.col("split") == "train")).first()
    near = abs(train - 0.9 * n) <= 5 * (0.09 * n) ** 0.5
    return sides.groupBy("id").agg(F.count(F.lit(1)).alias("times")).withColumn("share_in_bounds", F.lit(near))


@query("split_train_test", sql=f"""
WITH {FEATURES_IN_SQL}
SELECT id, label, CASE WHEN train THEN 'train' ELSE 'test' END AS split FROM src
""")
def split_train_test(spark, sf):
    """The two sides that the learning queries train and test on."""
    _, train, test, _ = _fitted(spark, sf)
    return train.select("id", "label", F.lit("train").alias("split")).unionByName(
        test.select("id", "label", F.lit("test").alias("split")))


@query("train_logreg")
def train_logreg(spark, sf):
    """L2 logistic regression (maxIter 1000, lambda 0.01); training-split
    metrics by label, as the reference prints them."""
    _, train, _, model = _fitted(spark, sf)
    return _rounded(MT.by_label(MD.score(model, train)))


@query("train_metrics_weighted")
def train_metrics_weighted(spark, sf):
    """Training-split accuracy and weighted metrics."""
    _, train, _, model = _fitted(spark, sf)
    return _rounded(MT.weighted(MD.score(model, train)))


@query("model_coefficients")
def model_coefficients(spark, sf):
    """Non-zero coefficients and the intercept (index -1)."""
    return MD.coefficients(_fitted(spark, sf)[3], spark)


@query("objective_history")
def objective_history(spark, sf):
    """Objective value per training iteration."""
    return MD.objective_history(_fitted(spark, sf)[3], spark)


#: largest gradient entry, in the standardised space, of a converged fit
GRADIENT_BOUND = 1e-3


@query("optimality", sql=f"""
WITH {FEATURES_IN_SQL}
SELECT id, true AS converged FROM src WHERE train
""")
def optimality(spark, sf):
    """Every training id with whether the fitted point is optimal: no entry of
    the objective's gradient over those rows exceeds the bound."""
    _, train, _, model = _fitted(spark, sf)
    worst = MD.gradient(model, train).agg(F.max(F.abs("gradient"))).first()[0]
    return train.select("id", F.lit(worst is not None and worst <= GRADIENT_BOUND).alias("converged"))


@query("objective_check", sql=f"""
WITH {FEATURES_IN_SQL}
SELECT count(*) AS n_train, true AS last_matches, true AS monotone FROM src WHERE train
""")
def objective_check(spark, sf):
    """The objective, computed again over the training rows at the fitted
    point, against the last entry of the training history, which never
    rises."""
    _, train, _, model = _fitted(spark, sf)
    history = model.summary.objectiveHistory
    matches = abs(MD.objective(model, train) - history[-1]) <= 1e-6
    falling = all(b <= a + 1e-12 for a, b in zip(history, history[1:]))
    return train.agg(F.count(F.lit(1)).alias("n_train")).select(
        "n_train", F.lit(matches).alias("last_matches"), F.lit(falling).alias("monotone"))


@query("cached_split", sql=f"""
WITH {FEATURES_IN_SQL}
SELECT label, count(*) AS n_rows, count(*) AS n_again, true AS cached, true AS released
FROM src WHERE train GROUP BY label
""")
def cached_split(spark, sf):
    """Rows of the training split per label, counted twice from its cached
    blocks (the plan reads them), and whether it is released afterwards."""
    _, train, _, _ = _fitted(spark, sf)
    with MD.held(train):
        counts = train.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"))
        cached = "InMemoryRelation" in counts._jdf.queryExecution().withCachedData().toString()
        first, again = counts.collect(), dict(counts.collect())  # a row per class
    released = train.storageLevel == StorageLevel.NONE
    return spark.createDataFrame([(r.label, r.n_rows, again[r.label], cached, released) for r in first],
                                 "label double, n_rows bigint, n_again bigint, cached boolean, released boolean")


@query("score_test")
def score_test(spark, sf):
    """Batch scoring of the test split: (id, label, prediction, p1)."""
    from pyspark.ml.functions import vector_to_array
    _, _, test, model = _fitted(spark, sf)
    s = MD.score(model, test)
    return s.select("id", "label", "prediction",
                    F.round(vector_to_array("probability")[1], 6).alias("p1"))


@query("score_test_rows", sql=f"""
WITH {FEATURES_IN_SQL}
SELECT id, label, true AS scored FROM src WHERE NOT train
""")
def score_test_rows(spark, sf):
    """Every test row is scored once, its prediction agreeing with its
    probability."""
    s = score_test(spark, sf)
    scored = F.col("p1").between(0, 1) & (F.abs(F.col("prediction") - F.col("p1")) <= 0.500001)
    return s.select("id", "label", scored.alias("scored"))


@query("score_test_mae")
def score_test_mae(spark, sf):
    """Mean absolute error on the test split (the reference's test metric)."""
    _, _, test, model = _fitted(spark, sf)
    return _rounded(MT.mae(MD.score(model, test)))
