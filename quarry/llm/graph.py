"""Connected components of a link table, as Spark joins.

Each round hooks every label to its smallest neighbour, jumps one pointer
and contracts the links; links inside a component vanish, so the table
shrinks every round.  Every round's tables are written to the shared
checkpoint folder, so both sides of each join are plain exchanges whose hot
partitions adaptive execution can split, and a lost executor costs one round
at most.  Nothing but row counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import drop_table, write_table


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while stem in taken:
        stem += "_"
    return stem


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node that has a link to another one;
    ``component`` is the smallest node reachable.  Null ends and loops are
    no links.  An empty link table gives an empty result."""
    cur = write_table(
        links.select(F.col(a).alias("a"), F.col(b).alias("b"))
        .where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while True:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = write_table(both.groupBy("a").agg(F.min("b").alias("m"))
                           .select(F.col("a").alias("node"), F.least("a", "m").alias("up")), "hook")
        up2 = hook.select(F.col("node").alias("up"), F.col("up").alias("top"))
        jump = write_table(hook.join(up2, "up", "left")
                           .select("node", F.coalesce("top", "up").alias("top")), "jump")
        if labels is None:
            labels = write_table(jump.select("node", F.col("top").alias("component")), "labels")
        else:
            step = jump.select(F.col("node").alias("component"), "top")
            old, labels = labels, write_table(labels.join(step, "component", "left")
                                      .select("node", F.coalesce("top", "component").alias("component")),
                                      "labels")
            drop_table(old)
        ja = jump.select(F.col("node").alias("a"), F.col("top").alias("ta"))
        jb = jump.select(F.col("node").alias("b"), F.col("top").alias("tb"))
        nxt = (cur.join(ja, "a").join(jb, "b").where("ta <> tb")
               .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct())
        old, cur = cur, write_table(nxt, "links")
        drop_table(old, hook, jump)
        if cur.isEmpty():
            drop_table(cur)
            return labels
