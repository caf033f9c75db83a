"""Text-expression queries (HTML strip, pipe split, tokenise, stop words)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.plans.registry import query
from quarry.sources import tables as TB


def stopwords_sql_list() -> str:
    words = sorted({w.lower() for w in X.default_stopwords()})
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


_TOKENS_SQL = "list_filter(string_split_regex(lower({c}), '\\W'), lambda x: len(x) > 0)"


def _exploded_sql(src: str, id_col: str, list_expr: str) -> str:
    return f"""
SELECT {id_col}, CAST(pos - 1 AS INTEGER) AS pos, token FROM (
  SELECT {id_col}, unnest(toks) AS token, unnest(generate_series(1, len(toks))) AS pos
  FROM (SELECT {id_col}, {list_expr} AS toks FROM {src}))
"""


@query("html_strip", sql="""
SELECT page_id, regexp_replace(html, '<.*?>', '', 'g') AS body_s FROM pages
""")
def html_strip(spark, sf):
    """Remove HTML tags from the whole page (a tag broken over lines stays)."""
    p = TB.table(spark, sf, "pages")
    return p.select("page_id", X.strip_html(F.col("html")).alias("body_s"))


_SPLIT_SRC = """(
  SELECT doc_id, 1 AS variant, lang || '|' || source || '||' AS s FROM documents
  UNION ALL SELECT doc_id, 2, '|' || lang FROM documents
  UNION ALL SELECT doc_id, 3, '|||' FROM documents
  UNION ALL SELECT doc_id, 4, '' FROM documents
  UNION ALL SELECT doc_id, 5, lang || '||' || source || '|' FROM documents)"""


@query("split_pipe", sql=f"""
SELECT doc_id, variant, CAST(len(arr) AS INTEGER) AS n_items, array_to_string(arr, ',') AS items FROM (
  SELECT doc_id, variant,
         CASE WHEN regexp_full_match(s, '\\|+') THEN []::VARCHAR[]
              ELSE string_split(rtrim(s, '|'), '|') END AS arr
  FROM {_SPLIT_SRC})
""")
def split_pipe(spark, sf):
    """``a|b||`` -> [a, b]; ``|a`` -> ['', a]; ``|||`` -> []; '' -> ['']."""
    d = TB.table(spark, sf, "documents").select("doc_id", "lang", "source")
    lang, src = F.col("lang"), F.col("source")
    variants = [
        (1, F.concat(lang, F.lit("|"), src, F.lit("||"))),
        (2, F.concat(F.lit("|"), lang)),
        (3, F.lit("|||")),
        (4, F.lit("")),
        (5, F.concat(lang, F.lit("||"), src, F.lit("|"))),
    ]
    parts = [d.select("doc_id", F.lit(v).alias("variant"), e.alias("s")) for v, e in variants]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    arr = X.split_pipe(F.col("s"))
    return u.select("doc_id", "variant", F.size(arr).alias("n_items"),
                    F.array_join(arr, ",").alias("items"))


@query("tokenize", sql=_exploded_sql("documents", "doc_id", _TOKENS_SQL.format(c="text")))
def tokenize(spark, sf):
    """Whole documents -> (doc_id, pos, token): lower-case, split on non-word
    characters, empty tokens dropped."""
    d = TB.table(spark, sf, "documents")
    return d.select("doc_id", X.posexplode_items(X.tokenize(F.col("text"))).alias("pos", "token")) \
        .where(F.col("pos").isNotNull())


def _stop_sql(c: str) -> str:
    return f"list_filter({_TOKENS_SQL.format(c=c)}, lambda x: NOT list_contains({stopwords_sql_list()}, x))"




@query("stopwords_removed", sql=_exploded_sql("documents", "doc_id", _stop_sql("text")))
def stopwords_removed(spark, sf):
    """Tokens with the fixed stop-word list removed (repeats of other tokens
    kept); positions renumbered after removal."""
    d = TB.table(spark, sf, "documents")
    toks = X.remove_stopwords(X.tokenize(F.col("text")))
    return d.select("doc_id", X.posexplode_items(toks).alias("pos", "token")).where(F.col("pos").isNotNull())


@query("html_tokens", sql=_exploded_sql(
    "(SELECT page_id, regexp_replace(html, '<.*?>', '', 'g') AS body_s FROM pages)", "page_id",
    _stop_sql("body_s")))
def html_tokens(spark, sf):
    """Body path of the feature stage: strip HTML, tokenise, drop stop words."""
    p = TB.table(spark, sf, "pages")
    toks = X.remove_stopwords(X.tokenize(X.strip_html(F.col("html"))))
    return p.select("page_id", X.posexplode_items(toks).alias("pos", "token")).where(F.col("pos").isNotNull())
