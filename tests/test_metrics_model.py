import pytest
from pyspark import StorageLevel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quarry.operators import metrics as MT
from quarry.operators import model as MD


def test_metrics_equal_logreg_summary(spark):
    rows = [(float(i % 3 == 0), Vectors.dense([float(i % 7), float(i % 5), float(i % 3 == 0) * 0.3 + (i % 11) / 10]))
            for i in range(300)]
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])
    df = spark.createDataFrame(rows, schema)
    model = MD.fit_logreg(df, max_iter=100)
    s = model.summary
    pred = MD.score(model, df)
    by = {r["label"]: r for r in MT.by_label(pred).collect()}
    for lab in (0.0, 1.0):
        assert by[lab]["tpr"] == pytest.approx(s.truePositiveRateByLabel[int(lab)], abs=1e-6)
        assert by[lab]["fpr"] == pytest.approx(s.falsePositiveRateByLabel[int(lab)], abs=1e-6)
        assert by[lab]["precision"] == pytest.approx(s.precisionByLabel[int(lab)], abs=1e-6)
        assert by[lab]["f_measure"] == pytest.approx(s.fMeasureByLabel()[int(lab)], abs=1e-6)
    w = MT.weighted(pred).first()
    assert w["accuracy"] == pytest.approx(s.accuracy, abs=1e-6)
    assert w["weighted_fpr"] == pytest.approx(s.weightedFalsePositiveRate, abs=1e-6)
    assert w["weighted_precision"] == pytest.approx(s.weightedPrecision, abs=1e-6)
    assert w["weighted_f_measure"] == pytest.approx(s.weightedFMeasure(), abs=1e-6)
    mae = MT.mae(pred).first()["mae"]
    assert mae == pytest.approx(1 - s.accuracy, abs=1e-6)


def test_split_hash_stable(spark):
    d = spark.range(1000).withColumnRenamed("id", "k")
    tr1, te1 = MD.split_hash(d.repartition(3), "k")
    tr2, te2 = MD.split_hash(d.repartition(17), "k")
    assert sorted(r[0] for r in te1.collect()) == sorted(r[0] for r in te2.collect())
    assert tr1.count() + te1.count() == 1000


def _toy(spark, n=300):
    import random

    from pyspark.ml.linalg import Vectors
    r = random.Random(9)
    rows = []
    for i in range(n):
        x = [r.gauss(0, 1), r.gauss(3, 5), float(r.random() < 0.1), 1.0]
        y = float(x[0] - 0.1 * x[1] + r.gauss(0, 1) > 0)
        v = Vectors.dense(x) if i % 2 else Vectors.sparse(4, [(k, a) for k, a in enumerate(x) if a])
        rows.append((i, y, v))
    return spark.createDataFrame(rows, ["id", "label", "features"])


def test_gradient_and_objective_at_the_fitted_point(spark):
    import numpy as np

    from quarry.operators import model as MD
    df = _toy(spark)
    model = MD.fit_logreg(df, reg=0.05)
    rows = sorted(df.collect(), key=lambda r: r["id"])
    x, y = np.array([r["features"].toArray() for r in rows]), np.array([r["label"] for r in rows])
    sd = x.std(axis=0, ddof=1)
    beta, b = model.coefficients.toArray(), model.intercept
    m = x @ beta + b
    off = 1 / (1 + np.exp(-m)) - y
    got = {r["index"]: r["gradient"] for r in MD.gradient(model, df, reg=0.05).collect()}
    assert set(got) == {-1, 0, 1, 2}  # the constant feature has none
    for k in range(3):
        assert abs(got[k] - (off @ x[:, k] / len(y) / sd[k] + 0.05 * beta[k] * sd[k])) < 1e-12
    assert abs(got[-1] - off.mean()) < 1e-12 and max(map(abs, got.values())) < 1e-4
    loss = np.mean(np.logaddexp(0, m) - y * m) + 0.025 * ((beta * sd) ** 2).sum()
    assert abs(MD.objective(model, df, reg=0.05) - loss) < 1e-12
    assert abs(loss - model.summary.objectiveHistory[-1]) < 1e-6
    other = MD.fit_logreg(df, reg=0.05, max_iter=1)
    assert max(abs(r["gradient"]) for r in MD.gradient(other, df, reg=0.05).collect()) > 1e-3


def test_training_split_is_persisted_and_released(spark, monkeypatch):
    from pyspark.ml.classification import LogisticRegression

    from quarry.operators import model as MD
    seen, fit = [], LogisticRegression.fit

    def spy(self, df):
        seen.append(df.is_cached)
        return fit(self, df)
    monkeypatch.setattr(LogisticRegression, "fit", spy)
    df = _toy(spark)
    MD.fit_logreg(df, max_iter=3)
    assert seen == [True] and not df.is_cached


def test_null_keys_are_on_the_training_side(spark):
    from quarry.operators import model as MD
    df = spark.createDataFrame([(None,), (None,)] + [(i,) for i in range(200)], "id long")
    train, test = MD.split_hash(df, "id")
    assert train.where("id IS NULL").count() == 2 and train.count() + test.count() == 202


def test_the_split_is_held_while_it_is_learned_from(spark, monkeypatch):
    df = spark.createDataFrame([(float(i % 2), Vectors.dense([float(i % 2), float(i % 3)])) for i in range(40)], ["label", "features"])
    seen = []

    class Learner:
        def __init__(self, **_):
            pass

        def fit(self, rows):
            seen.append(rows.storageLevel.useMemory and rows.storageLevel.useDisk)
            if len(seen) == 2:
                raise ValueError("stopped")

    monkeypatch.setattr(MD, "LogisticRegression", Learner)
    MD.fit_logreg(df)
    assert seen == [True] and df.storageLevel == StorageLevel.NONE
    with pytest.raises(ValueError):
        MD.fit_logreg(df)
    assert df.storageLevel == StorageLevel.NONE
    df.persist(StorageLevel.DISK_ONLY)  # the caller's own
    MD.fit_logreg(df)
    assert df.storageLevel == StorageLevel.DISK_ONLY
    df.unpersist()
