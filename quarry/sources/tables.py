"""The supplied Parquet tables and the Q&A roles they play.

Role mapping (the tables are TPC-H-like, the pipeline is about Q&A posts):

=========  ==================  =============================================
role       table               columns
=========  ==================  =============================================
post       orders              id=o_orderkey, owner_user_id=o_custkey,
                               creation_date=o_orderdate, score=o_totalprice,
                               title=o_orderpriority; answered iff status 'F'
user       customer            id=c_custkey, reputation=c_acctbal
vote       lineitem            post_id=l_orderkey, vote_type_id=l_linenumber
title/text documents           doc_id, text
body       pages               page_id, html
label      labels              quality (label), toxic (stand-in prediction)
tags       part                dictionary = words of p_name; glued = p_name
                               without spaces
=========  ==================  =============================================

Adapters are plain projections, so Catalyst prunes the Parquet scan to the
columns a query uses and pushes filters into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


#: tables whose rows carry whole texts (tokenising them is the CPU-heavy part)
TEXT_TABLES = frozenset({"documents", "pages", "conversations", "benchmark"})


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition only when the scan has fewer partitions than
    the cluster has cores (e.g. one large row group).  On a real data set the
    scan already has thousands of splits and this is a no-op; round robin
    cannot be skewed by any key."""
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if name in TEXT_TABLES:
        df = spread(df)
    return df


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderdate").alias("creation_date"),
        F.col("o_totalprice").alias("score"),
        F.col("o_custkey").alias("owner_user_id"),
        F.col("o_orderstatus").alias("status"),
    )


def answered_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts(spark, sf_dir).where(F.col("status") == "F").drop("status")


def unanswered_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts(spark, sf_dir).where(F.col("status") != "F").drop("status")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("reputation"))


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("post_id"),
                     F.col("l_linenumber").alias("vote_type_id"))


def tag_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag dictionary: the distinct words of ``part.p_name`` as ``tag_name``."""
    p = table(spark, sf_dir, "part")
    return (p.select(F.explode(F.split("p_name", " ")).alias("tag_name"))
            .where(F.length("tag_name") > 0).distinct())


def glued_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with glued tags: ``id``=p_partkey, ``tags``=p_name without spaces."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"),
                    F.regexp_replace("p_name", " ", "").alias("tags"))
