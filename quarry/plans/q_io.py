"""Source / sink queries: CSV and LibSVM round trips through the shared
scratch folder (under ``spark.checkpoint.dir``).  Each query writes when it
is built and returns the read-back frame, which must equal the table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.plans.registry import query
from quarry.sources import csv as CSV
from quarry.sources import tables as TB

CUSTOMER = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType())])
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])

_CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@query("scan_csv_typed", sql=_CUSTOMER_SQL)
def scan_csv_typed(spark, sf):
    """CSV read with an explicit typed schema (no inference pass)."""
    path = CSV.scratch_path(spark, "customer_csv")
    CSV.write_csv(TB.table(spark, sf, "customer"), path)
    return CSV.read_csv(spark, path, CUSTOMER)


@query("scan_csv_dropmalformed", sql=_CUSTOMER_SQL)
def scan_csv_dropmalformed(spark, sf):
    """DROPMALFORMED: short lines, long lines and lines with an unparseable
    typed value (all derived from customer rows) are dropped; good rows stay."""
    base = CSV.scratch_path(spark, "customer_malformed")
    c = TB.table(spark, sf, "customer")
    CSV.write_csv(c, f"{base}/good")
    q = lambda col: F.concat(F.lit('"'), F.col(col).cast("string"), F.lit('"'))
    bad = c.where(F.col("c_nationkey") <= 2).select(
        F.when(F.col("c_nationkey") == 0, F.concat_ws(",", q("c_custkey"), q("c_name")))
        .when(F.col("c_nationkey") == 1, F.concat_ws(",", q("c_custkey"), q("c_name"), q("c_nationkey"),
                                                     q("c_acctbal"), q("c_mktsegment"), F.lit('"extra"')))
        .otherwise(F.concat_ws(",", q("c_custkey"), q("c_name"), F.lit('"not-a-number"'),
                               q("c_acctbal"), q("c_mktsegment"))).alias("value"))
    CSV.write_lines(bad, ",".join(CUSTOMER.fieldNames()), f"{base}/bad")
    return CSV.read_csv(spark, [f"{base}/good", f"{base}/bad"], CUSTOMER, mode="DROPMALFORMED")


@query("scan_glob_multi_file", sql=_CUSTOMER_SQL)
def scan_glob_multi_file(spark, sf):
    """Multi-directory glob scan: users_<segment> folders are read, a decoy
    folder next to them is not."""
    base = CSV.scratch_path(spark, "glob")
    c = TB.table(spark, sf, "customer")
    # one write, one folder per segment (a copy of the column names the folder)
    c.withColumn("seg", F.col("c_mktsegment")).write.mode("overwrite").partitionBy("seg") \
        .options(**CSV.LOSSLESS_WRITE).csv(f"{base}/users_by_segment")
    CSV.write_csv(TB.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"),
                  f"{base}/votes_decoy")
    return CSV.read_csv(spark, f"{base}/users*/seg=*", CUSTOMER)


@query("csv_roundtrip", sql="SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_roundtrip(spark, sf):
    """Loss-free CSV round trip of whole multi-line documents (quotes,
    newlines, empty and null values)."""
    path = CSV.scratch_path(spark, "documents_csv")
    CSV.write_csv(TB.table(spark, sf, "documents"), path)
    return CSV.read_csv(spark, path, DOCUMENTS)


@query("overwrite_idempotent", sql=_CUSTOMER_SQL)
def overwrite_idempotent(spark, sf):
    """Mode overwrite replaces an older output of other rows."""
    path = CSV.scratch_path(spark, "customer_twice")
    c = TB.table(spark, sf, "customer")
    CSV.write_csv(c.withColumn("c_name", F.lit("an older output")).unionByName(c), path)
    CSV.write_csv(c, path)
    return CSV.read_csv(spark, path, CUSTOMER)


@query("repartition_n", sql=f"SELECT *, CAST(3 AS BIGINT) AS n_files FROM ({_CUSTOMER_SQL})")
def repartition_n(spark, sf):
    """Output file count as a parameter (here 3 files, counted on reading)."""
    path = CSV.scratch_path(spark, "customer_n")
    CSV.write_csv(TB.table(spark, sf, "customer"), path, partitions=3)
    back = CSV.read_csv(spark, path, CUSTOMER)
    files = back.select(F.input_file_name().alias("f")).distinct().count()
    return back.withColumn("n_files", F.lit(files).cast("bigint"))


@query("libsvm_roundtrip", sql="""
WITH c AS (SELECT doc_id, quality, doc_id % 997 AS i, 1 + toxic AS n FROM labels
           UNION ALL SELECT doc_id, quality, doc_id * 31 % 997, 1 FROM labels),
s AS (SELECT doc_id, quality, i, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY ALL)
SELECT CAST(any_value(quality) AS DOUBLE) AS label, CAST(1000 AS INTEGER) AS width,
       string_agg(i || ':' || n, ' ' ORDER BY i) AS cells
FROM s GROUP BY doc_id
""")
def libsvm_roundtrip(spark, sf):
    """(label, features) -> LibSVM -> back: sparse vectors 1,000 wide with
    gaps, the last three features never set, unfolded to index:value text."""
    from pyspark.ml.feature import CountVectorizerModel
    from pyspark.ml.functions import vector_to_array
    from quarry.sources.libsvm import read_libsvm, write_libsvm
    first = (F.col("doc_id") % 997).cast("string")
    items = F.concat(F.array_repeat(first, 1 + F.col("toxic").cast("int")),
                     F.array((F.col("doc_id") * 31 % 997).cast("string")))
    vocab = CountVectorizerModel.from_vocabulary([str(i) for i in range(1000)], inputCol="items", outputCol="features")
    v = vocab.transform(TB.table(spark, sf, "labels").select(F.col("quality").alias("label"), items.alias("items")))
    path = CSV.scratch_path(spark, "libsvm")
    write_libsvm(v.select("label", "features"), path)
    back = read_libsvm(spark, path, num_features=1000).select("label", vector_to_array("features").alias("a"))
    cells = F.filter(F.transform("a", lambda x, i: F.when(x != 0, F.concat_ws(":", i, x.cast("bigint")))),
                     lambda c: c.isNotNull())
    return back.select("label", F.size("a").alias("width"), F.concat_ws(" ", cells).alias("cells"))
