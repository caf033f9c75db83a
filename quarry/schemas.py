"""Logical schemas of the Q&A pipeline and schema enforcement.

Every stage reads with an explicit schema (no inference pass) and checks its
output columns at the exit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.casts import lenient_cast

_POST_FIELDS = [
    ("id", T.IntegerType()),
    ("title", T.StringType()),
    ("body", T.StringType()),
    ("creation_date", T.DateType()),
    ("answer_count", T.IntegerType()),
    ("favorite_count", T.IntegerType()),
    ("score", T.IntegerType()),
    ("tags", T.StringType()),
    ("view_count", T.IntegerType()),
    ("owner_user_id", T.IntegerType()),
]


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


#: questions (label 0) and posts-with-answer (label 1) share one layout
POSTS = _struct(_POST_FIELDS)
USERS = _struct([("id", T.IntegerType()), ("reputation", T.IntegerType())])
VOTES = _struct([("post_id", T.IntegerType()), ("vote_type_id", T.IntegerType())])
TAGS = _struct([("tag_name", T.StringType())])

#: step-1 output: creation_date as unix seconds, vote types as a pipe string
LABELLED = _struct(
    [
        ("id", T.IntegerType()),
        ("title", T.StringType()),
        ("body", T.StringType()),
        ("creation_date", T.LongType()),
        ("answer_count", T.IntegerType()),
        ("favorite_count", T.IntegerType()),
        ("score", T.IntegerType()),
        ("tags", T.StringType()),
        ("view_count", T.IntegerType()),
        ("owner_user_id", T.IntegerType()),
        ("reputation", T.IntegerType()),
        ("vote_type_id", T.StringType()),
        ("label", T.IntegerType()),
    ]
)

#: columns the feature stage needs; all but favorite_count must be non-null
FEATURE_INPUT = ["id", "title", "body", "creation_date", "answer_count",
                 "favorite_count", "score", "tags", "reputation",
                 "vote_type_id", "label"]
REQUIRED_NOT_NULL = [c for c in FEATURE_INPUT if c != "favorite_count"]


def all_string(schema: T.StructType) -> T.StructType:
    """The same field names, every field a string (raw CSV read)."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema])


def enforce(df: DataFrame, schema: T.StructType, decimal_detour: bool = True) -> DataFrame:
    """Project ``df`` onto ``schema`` with null-on-failure casts.

    Missing columns are an error; extra columns are dropped.  A value that
    does not parse becomes NULL instead of failing the job (ANSI mode is on in
    Spark 4).
    """
    cols: list[Column] = []
    for f in schema:
        if f.name not in df.columns:
            raise ValueError(f"column {f.name!r} missing; have {df.columns}")
        cols.append(lenient_cast(F.col(f.name), f.dataType, decimal_detour).alias(f.name))
    return df.select(*cols)


def assert_columns(df: DataFrame, expected: list[str]) -> DataFrame:
    if df.columns != expected:
        raise AssertionError(f"stage contract: expected {expected}, got {df.columns}")
    return df
