"""Score arriving posts with a fitted feature pipeline and model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame

from quarry.operators.features import prepare


def score_stream(stream: DataFrame, features: PipelineModel,
                 model: LogisticRegressionModel) -> DataFrame:
    """Feature-stage input rows (a streaming DataFrame, e.g. ``readStream``
    of CSV/Parquet with the feature-input schema) -> (id, prediction,
    probability).  Stateless, so any output mode and sink work; the
    checkpoint location of the sink gives exactly-once output."""
    scored = model.transform(features.transform(prepare(stream)))
    return scored.select("id", "prediction", "probability")
