"""Session helpers.

Library code never creates a session; it takes the caller's.  ``local_session``
is for tests, the bench and the smoke entry point only.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every stage relies on (safe to apply to an existing session).
RUNTIME_CONF = {
    # Day -> unix seconds follows the session zone; pin it (trap T6).
    "spark.sql.session.timeZone": "UTC",
    # DROPMALFORMED must look at the whole CSV row, not only the projected
    # columns, to drop the rows Spark 2.x dropped (trap T2).
    "spark.sql.csv.parser.columnPruning.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8,
                  app: str = "quarry") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        # Tests and bench only: a local master gets a scratch folder of its own.
        builder = builder.config(
            "spark.checkpoint.dir",
            tempfile.mkdtemp(prefix="quarry-ckpt-", dir="/tmp"))
    else:
        builder = builder.config("spark.checkpoint.dir", os.environ["SPARK_CHECKPOINT_DIR"])
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is only read.
    A folder of our own is created only when the setting is unset and the
    master is local (tests, bench).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError(
            "spark.checkpoint.dir is unset; point it at shared storage")
    path = tempfile.mkdtemp(prefix="quarry-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return path


def write_table(df, name: str = "t", compression: str | None = None):
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint
    folder and reading it back (one computation; AQE coalesces the write;
    survives executor loss).  Used for long-form intermediates.
    ``compression``: that of the session if None; ``zstd`` suits whole texts."""
    import uuid
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
    (df.write.option("compression", compression) if compression else df.write).mode("overwrite").parquet(path)
    # the schema is known: reading it back starts no job
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


@contextmanager
def released_shuffles(spark):
    """The shuffle files of each query run inside go when it is done, not when
    the driver happens to collect its garbage.  For steps that write what they
    compute: a query run again would have to shuffle anew."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def drop_path(spark, *paths: str) -> None:
    """Delete scratch files that no plan still to be run reads."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def drop_table(*tables) -> None:
    """Delete the files behind tables that ``write_table`` returned and that
    no plan still to be run reads."""
    for df in tables:
        path = getattr(df, "scratch_path", None)
        if path:
            drop_path(df.sparkSession, path)
