"""Join helpers: broadcast only behind a size check, split hot keys.

``broadcast_if_small`` broadcasts the small side only when its size is shown
to be below a bound: exactly from the row count when it is a bare scan of
fixed-width columns, else Catalyst's estimate times a safety factor.  Above the
bound it leaves the choice to the planner (sort-merge join with AQE skew
splitting).

``hot_key_split_join`` handles the case where a single key holds a large
share of the big side (e.g. one user owning a third of all posts): the heavy
hitters are found with a partially-aggregated count and their rows are salted
within one shuffle join.  Results equal a plain inner join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: default bound for an explicitly broadcast side (bytes of Catalyst estimate)
BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` (optimized plan statistics)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # pragma: no cover - estimate unavailable
        return None


#: estimates come from compressed file sizes; decoded rows are larger
ESTIMATE_SAFETY = 3

_FIXED = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date",
          "timestamp", "timestamp_ntz")


def _bare_scan(df: DataFrame) -> bool:
    """Whether ``df`` is columns of a Parquet scan, of a range or of local
    rows, so that counting it runs no part of a plan twice."""
    node = df._jdf.queryExecution().optimizedPlan()
    while node.nodeName() == "Project" and node.deterministic():
        node = node.child()
    name = node.nodeName()
    return name in ("Range", "LocalRelation") or (name == "LogicalRelation" and " parquet" in node.toString())


def proven_bytes(df: DataFrame) -> int | None:
    """Exact upper bound of the broadcast size of a bare scan whose columns
    all have a fixed width: rows x (8-byte null bitset + 8 bytes per field),
    doubled for the hash relation; Parquet answers the count from its
    footers.  None for other plans and columns of variable width."""
    if not all(f.dataType.simpleString() in _FIXED for f in df.schema) or not _bare_scan(df):
        return None
    width = 8 * ((len(df.columns) + 63) // 64) + 8 * len(df.columns)
    return 2 * width * df.count()


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Wrap ``df`` in a broadcast hint only when its size is shown to be
    below ``max_bytes``: exactly for fixed-width rows (row count), else from
    Catalyst's estimate with a safety factor.  Otherwise return it unchanged
    (sort-merge join, AQE may still switch at runtime on measured sizes)."""
    size = proven_bytes(df)
    if size is None:
        est = estimated_bytes(df)
        size = None if est is None else est * ESTIMATE_SAFETY
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    return df


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    """Keys holding more than ``share`` of the rows of ``df``.

    At most ``1/share`` keys qualify, so the result has a proven size bound.
    The count is partially aggregated map-side before the shuffle.
    """
    keyed = df.where(F.col(key).isNotNull()).select(key)
    total = keyed.count()  # one scalar back to the driver
    counts = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > F.lit(total * share)).select(key)


def hot_key_split_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str,
                       share: float = 0.01, salts: int | None = None) -> DataFrame:
    """Inner join ``big`` and ``small`` on ``big_key == small_key`` in one
    shuffle join, with the heavy hitters of ``big_key`` salted.

    Only the hot-key list (at most ``1/share`` rows) is broadcast.  Rows of a
    hot key are dealt over ``salts`` (default: the shuffle partitions) parts
    by a hash of the row and its input partition, so copies of one row spread
    as well and a recomputed task deals them alike; the matching rows of
    ``small`` are repeated once per salt.
    """
    if salts is None:
        salts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(big, big_key, share).withColumnRenamed(big_key, "_hot"))
    deal = F.pmod(F.xxhash64(*big.columns) + F.spark_partition_id(), F.lit(salts)).cast("int")
    left = (big.join(hot, big[big_key] == hot["_hot"], "left")
            .withColumn("_salt", F.when(F.col("_hot").isNotNull(), deal).otherwise(F.lit(0)))
            .drop("_hot"))
    last = F.when(F.col("_hot").isNotNull(), F.lit(salts - 1)).otherwise(F.lit(0))
    right = (small.join(hot, small[small_key] == hot["_hot"], "left")
             .withColumn("_salt2", F.explode(F.sequence(F.lit(0), last))).drop("_hot"))
    on = (left[big_key] == right[small_key]) & (left["_salt"] == right["_salt2"])
    return left.join(right, on, "inner").drop("_salt", "_salt2")
