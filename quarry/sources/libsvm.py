"""LibSVM edges: the training table is written and read in LibSVM format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_libsvm(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """(label, features) -> LibSVM text (1-based indices, sparse)."""
    df.select(F.col("label").cast("double").alias("label"), "features") \
        .write.mode(mode).format("libsvm").save(path)


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """LibSVM -> (label double, features vector).  Passing the width avoids
    the extra pass Spark makes to find the largest index."""
    r = spark.read.format("libsvm")
    if num_features:
        r = r.option("numFeatures", str(num_features))
    return r.load(path)
