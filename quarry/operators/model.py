"""Step 4 - split, train, score, inspect.

Logistic regression is Spark ML's (L-BFGS, gradients tree-aggregated from
the executors each iteration).  Model inspection results are returned as
DataFrames instead of console prints.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_bucket(key: Column, buckets: int = 10) -> Column:
    """Stable bucket of a key: first 32 bits of md5 of its text, mod
    ``buckets`` (independent of partitioning and row order)."""
    h = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return (h % buckets).cast("int")


def training_frame(df: DataFrame, features: str = "features") -> DataFrame:
    """Make the (id, label, features) table ready for iterative training.

    * the per-feature ML attribute metadata of the assembled vector (one
      entry per vocabulary term, megabytes) is dropped - the learner needs
      only the vector width;
    * the lineage is cut by a compressed table in the shared folder named by
      ``spark.checkpoint.dir`` (``drop_table`` deletes it), so each optimizer
      iteration ships a tiny task instead of the whole feature pipeline
      (vocabularies included), and a lost executor re-reads the table instead
      of recomputing the pipeline.
    """
    from quarry.session import write_table
    cols = [F.col(c).alias(c, metadata={}) if c == features else F.col(c) for c in df.columns]
    return write_table(df.select(*cols), "training", "zstd")


def split_hash(df: DataFrame, key: str, test_buckets=(9,), buckets: int = 10):
    """(train, test) by a stable hash of ``key`` - reproducible under any
    partitioning and after recomputation (unlike ``randomSplit``).  Rows with
    a null key are on the training side."""
    b = hash_bucket(F.col(key), buckets)
    test = F.coalesce(b.isin(list(test_buckets)), F.lit(False))
    return df.where(~test), df.where(test)


def split_random(df: DataFrame, weights=(0.9, 0.1), seed: int = 11):
    """``randomSplit`` as the reference does (depends on partitioning)."""
    return df.randomSplit(list(weights), seed=seed)


@contextmanager
def held(df: DataFrame):
    """``df`` persisted (in memory, else on disk) within the block and
    released after it, also if it fails.  A frame that its caller persists
    stays as it is.  Blocks of a lost executor are computed again."""
    own = not (df.storageLevel.useMemory or df.storageLevel.useDisk)
    if own:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        if own:
            df.unpersist()


def fit_logreg(train: DataFrame, max_iter: int = 1000, reg: float = 0.01,
               elastic_net: float = 0.0, features: str = "features",
               label: str = "label") -> LogisticRegressionModel:
    """Binomial L2 logistic regression (reference: maxIter 1000, lambda 0.01,
    elastic net 0).  The training split is persisted for the iterations."""
    with held(train) as rows:
        lr = LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic_net,
                                featuresCol=features, labelCol=label)
        return lr.fit(rows)


def score(model: LogisticRegressionModel, df: DataFrame) -> DataFrame:
    """Batch scoring: adds ``rawPrediction``, ``probability``, ``prediction``."""
    return model.transform(df)


def coefficients(model: LogisticRegressionModel, spark) -> DataFrame:
    """(index, coefficient) for the non-zero coefficients, plus the intercept
    as index -1.  The model vector is already on the driver; this exposes it
    as a DataFrame."""
    v = model.coefficients
    idx = v.indices.tolist() if hasattr(v, "indices") else list(range(len(v)))
    vals = v.values.tolist() if hasattr(v, "values") else list(v)
    rows = [(-1, float(model.intercept))] + [(int(i), float(x)) for i, x in zip(idx, vals) if x != 0.0]
    return spark.createDataFrame(rows, "index int, coefficient double")


def objective_history(model: LogisticRegressionModel, spark) -> DataFrame:
    """(iteration, objective) of the training run."""
    hist = model.summary.objectiveHistory
    return spark.createDataFrame([(i, float(x)) for i, x in enumerate(hist)],
                                 "iteration int, objective double")


def vector_cells(df: DataFrame, keep=("id", "label"), features: str = "features") -> DataFrame:
    """``keep`` columns, ``index``, ``value``: the stored cells of a vector
    column, unfolded without Python; sparse vectors stay sparse."""
    v = F.unwrap_udt(F.col(features))
    at = F.when(v["type"] == 0, v["indices"]).otherwise(F.sequence(F.lit(0), F.size(v["values"]) - 1))
    cells = F.arrays_zip(at.alias("index"), v["values"].alias("value"))
    return df.select(*keep, F.explode(cells).alias("c")).select(*keep, "c.index", "c.value")


def _margins(model: LogisticRegressionModel, df: DataFrame, features: str, label: str) -> DataFrame:
    """(id, label, features, margin): margin = log-odds of label 1."""
    from pyspark.ml.functions import vector_to_array
    scored = model.transform(df)
    return scored.select("id", F.col(label).alias("label"), F.col(features).alias("features"),
                         vector_to_array(model.getRawPredictionCol())[1].alias("margin"))


def _spread(sums: DataFrame, n: int) -> DataFrame:
    """With ``sd``: the sample standard deviation of a feature from the sums
    of its cells (absent cells are 0)."""
    variance = (F.col("xx") - F.col("x") * F.col("x") / n) / (n - 1)
    return sums.withColumn("sd", F.sqrt(F.greatest(variance, F.lit(0.0))))


def gradient(model: LogisticRegressionModel, train: DataFrame, reg: float = 0.01, features: str = "features",
             label: str = "label") -> DataFrame:
    """(index, gradient) of the training objective at the fitted point, in the
    standardised space the learner works in; index -1 is the intercept.

    Per coordinate: mean of (probability - label) x value / sd, plus ``reg``
    times the standardised coefficient.  One aggregation over the cells by
    coordinate, partial in each map task.  A constant feature has no gradient
    and is left out."""
    from quarry.operators.joins import broadcast_if_small
    rows = _margins(model, train, features, label)
    rows = rows.withColumn("off", 1 / (1 + F.exp(-F.col("margin"))) - F.col("label"))
    n, total = rows.agg(F.count(F.lit(1)), F.sum("off")).first()
    cells = vector_cells(rows, ("off",))
    sums = cells.groupBy("index").agg(F.sum(F.col("off") * F.col("value")).alias("g"), F.sum("value").alias("x"),
                                      F.sum(F.col("value") * F.col("value")).alias("xx"))
    weight = coefficients(model, train.sparkSession).where("index >= 0")
    each = _spread(sums, n).where("sd > 0").join(broadcast_if_small(weight), "index", "left")
    own = F.col("g") / n / F.col("sd") + reg * F.coalesce("coefficient", F.lit(0.0)) * F.col("sd")
    intercept = train.sparkSession.createDataFrame([(-1, float((total or 0.0) / max(n, 1)))], "index int, gradient double")
    return each.select("index", own.alias("gradient")).unionByName(intercept)


def objective(model: LogisticRegressionModel, train: DataFrame, reg: float = 0.01, features: str = "features",
              label: str = "label") -> float:
    """The training objective at the fitted point: mean log-loss, computed
    without overflow, plus ``reg`` / 2 times the squared norm of the
    standardised coefficients."""
    from quarry.operators.joins import broadcast_if_small
    rows = _margins(model, train, features, label)
    m, y = F.col("margin"), F.col("label")
    loss = F.log1p(F.exp(-F.abs(m))) + F.greatest(m, F.lit(0.0)) - y * m
    n, mean = rows.agg(F.count(F.lit(1)), F.avg(loss)).first()
    sums = vector_cells(rows, ()).groupBy("index").agg(F.sum("value").alias("x"),
                                                       F.sum(F.col("value") * F.col("value")).alias("xx"))
    weight = coefficients(model, train.sparkSession).where("index >= 0")
    scaled = F.col("coefficient") * F.col("sd")
    norm = _spread(sums, n).join(broadcast_if_small(weight), "index").agg(F.sum(scaled * scaled)).first()[0]
    return float(mean + reg / 2 * (norm or 0.0))
