import datetime

from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import text as X
from quarry.functions.casts import day_to_unix, lenient_cast, to_date_lenient


def test_bad_casts(spark):
    df = spark.createDataFrame([("abc",), ("12.7",), ("-3.9",), ("42",)], "s string")
    got = [r[0] for r in df.select(lenient_cast(F.col("s"), T.IntegerType())).collect()]
    assert got == [None, 12, -3, 42]
    strict = [r[0] for r in df.select(lenient_cast(F.col("s"), T.IntegerType(), False)).collect()]
    assert strict == [None, None, None, 42]


def test_date_casts(spark):
    df = spark.createDataFrame([("zzz",), ("2018-09-04 12:33:11 UTC",), (None,)], "s string")
    got = [r[0] for r in df.select(to_date_lenient(F.col("s"))).collect()]
    assert got == [None, datetime.date(2018, 9, 4), None]


def test_day_to_unix_follows_session_zone(spark):
    df = spark.createDataFrame([("2018-09-04",)], "s string")
    assert df.select(day_to_unix(F.col("s"))).first()[0] == 1536019200
    spark.conf.set("spark.sql.session.timeZone", "America/Toronto")
    try:
        assert df.select(day_to_unix(F.col("s"))).first()[0] == 1536033600
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_html_strip(spark):
    df = spark.createDataFrame([("<p>a</p><p>b</p>",), ("x<a\nhref='y'>z",)], "s string")
    got = [r[0] for r in df.select(X.strip_html(F.col("s"))).collect()]
    assert got == ["ab", "x<a\nhref='y'>z"]


def test_split_pipe_java_semantics(spark):
    df = spark.createDataFrame([("a||",), ("|a",), ("|||",), ("",), ("a||b|",), (None,)], "s string")
    got = [r[0] for r in df.select(X.split_pipe(F.col("s"))).collect()]
    assert got == [["a"], ["", "a"], [], [""], ["a", "", "b"], None]


def test_tokenize_fixture(spark):
    df = spark.createDataFrame([("Don't STOP été, c++ x_y  2",)], "s string")
    got = df.select(X.tokenize(F.col("s"))).first()[0]
    assert got == ["don", "t", "stop", "t", "c", "x_y", "2"]


def test_tokenize_and_stopwords_equal_ml(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    tok = RegexTokenizer(inputCol="text", outputCol="ml_tok", pattern="\\W").transform(d)
    rem = StopWordsRemover(inputCol="ml_tok", outputCol="ml_stop",
                           stopWords=list(X.default_stopwords())).transform(tok)
    ours = rem.select("ml_tok", "ml_stop", X.tokenize(F.col("text")).alias("t"),
                      X.remove_stopwords(X.tokenize(F.col("text"))).alias("s"))
    bad = ours.where((F.col("ml_tok") != F.col("t")) | (F.col("ml_stop") != F.col("s"))).count()
    assert bad == 0


def test_stopword_list_fixed_values():
    words = X.default_stopwords()
    assert len(words) == 784 and len(set(words)) == 781
    assert words[:3] == ("a", "about", "above")


def test_text_that_only_begins_with_a_date_is_null(spark):
    from pyspark.sql import functions as F
    from quarry.functions.casts import to_date_lenient
    rows = [("2018-09-04", True), ("2018-09-04 12:33:11 UTC", True), ("2018-09-04abc", False), ("2018-09-041", False)]
    df = spark.createDataFrame(rows, "s string, ok boolean").withColumn("d", to_date_lenient(F.col("s")))
    assert all((str(r.d) == "2018-09-04") == r.ok and (r.d is None) != r.ok for r in df.collect())


def test_integral_cast_tries_only_texts_that_may_pass(spark):
    """A direct cast that fails throws inside; the guard changes no result."""
    odd = ["5", " 5 ", "+5", "-5", "\t7\x7f", "--5", "12.7", ".5", "5.", "1e3", "n/a", "", " ", None, "１２", "99999999999", "5\u0085",
           "9223372036854775807", "9223372036854775808", "0x10", "5 5", " 5", "1_000", "5\n", "-0", "NaN"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(odd)], "i int, v string")
    for kind in (T.IntegerType(), T.LongType(), T.ShortType()):
        name = kind.simpleString()
        plain = F.coalesce(F.col("v").try_cast(name), F.col("v").try_cast("decimal(38,6)").try_cast(name))
        got = df.select("v", lenient_cast(F.col("v"), kind).alias("got"), plain.alias("want"))
        assert [r for r in got.collect() if r.got != r.want] == []
        assert "RLIKE" in got.select("got")._jdf.queryExecution().optimizedPlan().toString()
    doubles = spark.createDataFrame([(12.7,), (-0.5,), (1e10,), (float("nan"),), (None,)], "v double")
    got = doubles.select(lenient_cast(F.col("v"), T.IntegerType()).alias("got"))
    assert [r.got for r in got.collect()] == [12, 0, None, None, None]
    assert "RLIKE" not in got._jdf.queryExecution().optimizedPlan().toString()
