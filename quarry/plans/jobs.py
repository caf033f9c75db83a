"""The four stage jobs, file to file, as a user of the reference runs them.

    clean_job     CSV dumps (questions, answered posts, users, votes)
                  -> labelled posts, one folder per label (label=0 / label=1)
    tags_job      tag CSV + labelled posts -> tagged posts (``tags`` = a|b|c)
    features_job  tagged posts -> LibSVM (label, features)
    train_job     LibSVM -> model + metric DataFrames

Every job takes the session; outputs are replaced with mode overwrite.  Posts
pass between the jobs as Parquet; ``fmt='csv'`` writes and reads them as
lossless CSV instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.operators import clean as C
from quarry.operators import features as FT
from quarry.operators import metrics as MT
from quarry.operators import model as MD
from quarry.operators import tags as TG
from quarry.sources import csv as CSV
from quarry.session import drop_table, released_shuffles, write_table
from quarry.sources.libsvm import read_libsvm, write_libsvm

#: fixed values: the input file-name patterns of the dumps
QUESTIONS_GLOB = "*questions*"
ANSWERED_GLOB = "stackoverflow*"
USERS_GLOB = "users*"
VOTES_GLOB = "votes*"
TAGS_GLOB = "*tags*"


def read_untyped(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Header CSV, every column a string, rows whose field count differs from
    the header dropped (extra columns of a dump are kept and ignored).  Dumps
    without line breaks in their fields are splittable with ``multi_line``
    off."""
    opts = dict(CSV.LOSSLESS_READ)
    opts["mode"] = "DROPMALFORMED"
    # the default null text of a dump is the empty field
    opts.pop("nullValue")
    opts["multiLine"] = str(multi_line).lower()
    opts["columnPruning"] = "false"
    return spark.read.options(**opts).csv(path)


def clean_job(spark: SparkSession, input_prefix: str, output_path: str,
              partitions: int | None = None, fmt: str = "parquet", multi_line: bool = True) -> None:
    """Step 1: labelled posts of both sets, written once, split by label.

    The dumps are projected and typed at the scan.  Typed posts are written
    before they are made distinct, since that reads them twice; copies of
    votes fall to the vote lists.  ``multi_line``: post texts hold line breaks;
    each file is then one task, so dumps must come in files of a bounded size
    (some 256 MB).  Dumps without line breaks are split with it off."""
    with released_shuffles(spark):
        q, a = (write_table(S.enforce(read_untyped(spark, input_prefix + glob, multi_line), S.POSTS), name, "zstd")
                for glob, name in ((QUESTIONS_GLOB, "questions"), (ANSWERED_GLOB, "answered")))
        u = S.enforce(read_untyped(spark, input_prefix + USERS_GLOB, multi_line=False), S.USERS)
        v = S.enforce(read_untyped(spark, input_prefix + VOTES_GLOB, multi_line=False), S.VOTES)
        out = S.assert_columns(C.clean(q, a, u, v), [f.name for f in S.LABELLED])
        if partitions:
            out = out.repartition(partitions)
        _write_labelled(out, output_path, fmt)
        drop_table(q, a)


def _write_labelled(df: DataFrame, path: str, fmt: str) -> None:
    opts = CSV.LOSSLESS_WRITE if fmt == "csv" else {"compression": "zstd"} if fmt == "parquet" else {}
    df.write.mode("overwrite").partitionBy("label").format(fmt).options(**opts).save(path)


def read_labelled(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Labelled posts (the ``label=`` folders restore the label column)."""
    schema = S.LABELLED
    body = type(schema)([f for f in schema if f.name != "label"])
    opts = CSV.LOSSLESS_READ if fmt == "csv" else {}
    df = spark.read.schema(body).format(fmt).options(**opts).option("basePath", path) \
        .load(path.rstrip("/") + "/label=*")
    return df.withColumn("label", F.col("label").cast("int"))


def tags_job(spark: SparkSession, tags_prefix: str, labelled_path: str, output_path: str,
             on_fail: str = "drop", fmt: str = "parquet") -> None:
    """Step 2: replace ``tags`` by its segmentation (a|b|c); rows that cannot
    be segmented are dropped (or kept with null / the sentinel)."""
    with released_shuffles(spark):
        dictionary = read_untyped(spark, tags_prefix + TAGS_GLOB, multi_line=False)
        posts = read_labelled(spark, labelled_path, fmt)
        seg = TG.segment(posts, dictionary, col="tags", out="_split", on_fail=on_fail)
        out = seg.withColumn("tags", F.col("_split")).drop("_split")
        _write_labelled(out, output_path, fmt)


def features_job(spark: SparkSession, tagged_path: str, output_path: str,
                 variant: str = "count", vocab_size: int = FT.DEFAULT_VOCAB,
                 split: str = "hash", fmt: str = "parquet") -> int:
    """Step 3: tagged posts -> LibSVM; returns the vector width.

    split ``hash``: 90/10 by a hash of the post id, features fitted on the
    training side, files in ``train`` and ``test`` below ``output_path``;
    ``none``: features fitted on all rows, one output (split while training)."""
    prepared = FT.prepare(read_labelled(spark, tagged_path, fmt))
    fit_df = MD.split_hash(prepared, "id")[0] if split == "hash" else None
    model = FT.feature_pipeline(prepared, variant=variant, vocab_size=vocab_size, fit_df=fit_df)
    with released_shuffles(spark):
        table = MD.training_frame(FT.training_table(model, prepared))
        if split == "hash":
            for side, name in zip(MD.split_hash(table, "id"), ("train", "test")):
                write_libsvm(side, f"{output_path}/{name}")
        else:
            write_libsvm(table, output_path)
        first = table.select("features").first()
        drop_table(table)
    return first["features"].size if first else 0


def train_job(spark: SparkSession, libsvm_path: str, num_features: int,
              max_iter: int = 1000, reg: float = 0.01, seed: int = 11, split: str = "hash") -> dict:
    """Step 4: L2 logistic regression on the training side, its metrics and
    the mean absolute error on the test side, all as DataFrames.  ``split`` is
    that of :func:`features_job`; ``none`` splits here at random (90/10)."""
    if split == "hash":
        train, test = (read_libsvm(spark, f"{libsvm_path}/{name}", num_features) for name in ("train", "test"))
    else:
        train, test = MD.split_random(read_libsvm(spark, libsvm_path, num_features), (0.9, 0.1), seed=seed)
    train = MD.training_frame(train)
    model = MD.fit_logreg(train, max_iter=max_iter, reg=reg)
    scored_train = MD.score(model, train)
    return {
        "model": model,
        "coefficients": MD.coefficients(model, spark),
        "objective_history": MD.objective_history(model, spark),
        "metrics_by_label": MT.by_label(scored_train),
        "metrics_weighted": MT.weighted(scored_train),
        "test_mae": MT.mae(MD.score(model, test)),
    }
