"""Places of rows within their key, without a task that holds a whole key.

Rows are range-partitioned by key and order, so a hot key covers many
partitions; the counts per partition and key (a row per key and partition it
touches) give each partition its offset in the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.operators.joins import broadcast_if_small
from quarry.session import drop_table, write_table


def ranked(df: DataFrame, key: str, order: list) -> DataFrame:
    """``df`` with ``pos`` (place within ``key`` by ``order``, from 0) and
    ``n`` (rows of the key), as a written table.  ``key`` must not be null;
    rows equal in ``order`` stand in any order.  The columns ``salt``,
    ``part`` and ``idx`` are used inside."""
    # rows that repeat would all fall in one range; their numbers tell them apart
    salted = write_table(df.withColumn("salt", F.monotonically_increasing_id()), "salted")
    by = [F.col(key), *order, F.col("salt")]
    laid = write_table(
        salted.repartitionByRange(*by).sortWithinPartitions(*by).drop("salt")
        .select("*", F.spark_partition_id().alias("part"),
                F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("idx")), "laid")
    runs = laid.groupBy("part", key).agg(F.min("idx").alias("first"), F.count(F.lit(1)).alias("m"))
    whole = Window.partitionBy(key)
    before = F.sum("m").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = write_table(runs.select("part", key, (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
                                      F.sum("m").over(whole).alias("n")), "offsets")
    out = write_table(laid.join(broadcast_if_small(offsets), ["part", key])
                      .withColumn("pos", F.col("idx") + F.col("shift")).drop("part", "idx", "shift"), "ranked")
    drop_table(salted, laid, offsets)
    return out
