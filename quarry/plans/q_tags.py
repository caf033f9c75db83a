"""Tag-segmentation queries on ``part``: dictionary = the words of p_name,
glued tags = p_name without spaces."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import tags as TG
from quarry.plans.registry import query
from quarry.sources import tables as TB

_DICT = "dict AS (SELECT DISTINCT w FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part) WHERE length(w) > 0)"
# dictionary whose forward pass gets stuck on some strings: the words plus,
# for each two-word name whose first word is short, the first word glued to
# the first letter of the second
_DICT2 = """dict AS (
  SELECT DISTINCT w FROM (
    SELECT unnest(string_split(p_name, ' ')) AS w FROM part
    UNION ALL
    SELECT split_part(p_name, ' ', 1) || substr(split_part(p_name, ' ', 2), 1, 1) FROM part
    WHERE split_part(p_name, ' ', 2) <> '' AND length(split_part(p_name, ' ', 1)) <= 4)
  WHERE length(w) > 0)"""

_GLUED = "glued AS (SELECT p_partkey AS id, {expr} AS s FROM part)"

_FWD = """fwd(id, s, pos, pieces) AS (
  SELECT id, s, 1, '' FROM glued WHERE length(s) > 0
  UNION ALL
  SELECT f.id, f.s, f.pos + length(m.w), f.pieces || '|' || m.w
  FROM fwd f, LATERAL (SELECT w FROM dict WHERE substr(f.s, f.pos, length(w)) = w
                       ORDER BY length(w) DESC LIMIT 1) m
  WHERE f.pos <= length(f.s))"""

_REV = """rev(id, s, pos, pieces) AS (
  SELECT id, s, length(s), '' FROM glued WHERE length(s) > 0
  UNION ALL
  SELECT r.id, r.s, r.pos - length(m.w), '|' || m.w || r.pieces
  FROM rev r, LATERAL (SELECT w FROM dict WHERE length(w) <= r.pos
                         AND substr(r.s, r.pos - length(w) + 1, length(w)) = w
                       ORDER BY length(w) DESC LIMIT 1) m
  WHERE r.pos > 0)"""

_SEG = """seg AS (
  SELECT g.id, g.s,
         CASE WHEN f.id IS NOT NULL THEN substr(f.pieces, 2)
              WHEN r.id IS NOT NULL THEN substr(r.pieces, 2) END AS split_tags,
         CASE WHEN f.id IS NOT NULL THEN 'forward' WHEN r.id IS NOT NULL THEN 'reverse' END AS pass
  FROM glued g
  LEFT JOIN fwd f ON f.id = g.id AND f.pos = length(g.s) + 1
  LEFT JOIN rev r ON r.id = g.id AND r.pos = 0)"""

_PLAIN = "replace(p_name, ' ', '')"
_WITH_JUNK = "CASE WHEN p_size > 25 THEN replace(p_name, ' ', '') || '#' ELSE replace(p_name, ' ', '') END"


def _dict2(spark, sf):
    p = TB.table(spark, sf, "part")
    w2 = p.select(F.concat(F.split_part("p_name", F.lit(" "), F.lit(1)),
                           F.substring(F.split_part("p_name", F.lit(" "), F.lit(2)), 1, 1)).alias("tag_name"),
                  F.split_part("p_name", F.lit(" "), F.lit(2)).alias("second"),
                  F.length(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("first_len"))
    w2 = w2.where((F.col("second") != "") & (F.col("first_len") <= 4)).select("tag_name")
    return TB.tag_words(spark, sf).unionByName(w2)


def _glued_junk(spark, sf):
    p = TB.table(spark, sf, "part")
    glued = F.regexp_replace("p_name", " ", "")
    return p.select(F.col("p_partkey").alias("id"),
                    F.when(F.col("p_size") > 25, F.concat(glued, F.lit("#"))).otherwise(glued).alias("tags"),
                    "p_brand", "p_size")


@query("tag_dictionary_sorted", sql=f"""
WITH {_DICT}
SELECT row_number() OVER (ORDER BY length(w) DESC, w) - 1 AS rank, w AS tag_name FROM dict
""")
def tag_dictionary_sorted(spark, sf):
    """Dictionary in matching priority: longest first, ties by name."""
    return TG.dictionary_sorted(TB.tag_words(spark, sf)).select("rank", "tag_name")


@query("tag_segment_forward", sql=f"""
WITH RECURSIVE {_DICT}, {_GLUED.format(expr=_WITH_JUNK)}, {_FWD}
SELECT g.id, substr(f.pieces, 2) AS split_tags
FROM glued g LEFT JOIN fwd f ON f.id = g.id AND f.pos = length(g.s) + 1
""")
def tag_segment_forward(spark, sf):
    """Forward pass only: longest tag at each position, null when stuck."""
    g = _glued_junk(spark, sf).select("id", "tags")
    return TG.segment(g, TB.tag_words(spark, sf), passes="forward", on_fail="null").select(
        "id", "split_tags")


@query("tag_segment_reverse", sql=f"""
WITH RECURSIVE {_DICT2}, {_GLUED.format(expr=_WITH_JUNK)}, {_FWD}, {_REV}, {_SEG}
SELECT id, split_tags, pass FROM seg
""")
def tag_segment_reverse(spark, sf):
    """Forward, then the reverse pass where forward gets stuck (dictionary
    with glued word+letter entries so that both passes occur)."""
    g = _glued_junk(spark, sf).select("id", "tags")
    return TG.segment(g, _dict2(spark, sf), on_fail="null", with_pass=True).select(
        "id", "split_tags", "pass")


@query("tag_segment_drop_unmatched", sql=f"""
WITH RECURSIVE {_DICT}, {_GLUED.format(expr=_WITH_JUNK)}, {_FWD}, {_REV}, {_SEG}
SELECT id, split_tags FROM seg WHERE split_tags IS NOT NULL
""")
def tag_segment_drop_unmatched(spark, sf):
    """Strings neither pass can cover are dropped (the sentinel filter)."""
    g = _glued_junk(spark, sf).select("id", "tags")
    return TG.segment(g, TB.tag_words(spark, sf), on_fail="drop").select("id", "split_tags")


@query("tag_segment_sentinel", sql=f"""
WITH RECURSIVE {_DICT}, {_GLUED.format(expr=_WITH_JUNK)}, {_FWD}, {_REV}, {_SEG}
SELECT id, coalesce(split_tags, '*****') AS split_tags FROM seg
""")
def tag_segment_sentinel(spark, sf):
    """Failure value kept as the ``*****`` sentinel instead of dropping."""
    g = _glued_junk(spark, sf).select("id", "tags")
    return TG.segment(g, TB.tag_words(spark, sf), on_fail="sentinel").select("id", "split_tags")


@query("tag_segment_join_back", sql=f"""
WITH RECURSIVE {_DICT}, {_GLUED.format(expr=_WITH_JUNK)}, {_FWD}, {_REV}, {_SEG}
SELECT s.id, s.split_tags, p.p_brand, p.p_size
FROM seg s JOIN part p ON s.id = p.p_partkey WHERE s.split_tags IS NOT NULL
""")
def tag_segment_join_back(spark, sf):
    """Segmented tags next to the post's other columns - computed in place,
    no join back on id."""
    g = _glued_junk(spark, sf)
    return TG.segment(g, TB.tag_words(spark, sf), on_fail="drop").select(
        "id", "split_tags", "p_brand", "p_size")


@query("tag_segment_distributed", sql=f"""
WITH RECURSIVE {_DICT2}, {_GLUED.format(expr=_WITH_JUNK)}, {_FWD}, {_REV}, {_SEG}
SELECT id, split_tags FROM seg WHERE split_tags IS NOT NULL
""")
def tag_segment_distributed(spark, sf):
    """The join-based segmentation used beyond the dictionary-size bound."""
    g = _glued_junk(spark, sf).select("id", "tags")
    return TG.segment_distributed(g, _dict2(spark, sf), on_fail="drop").select("id", "split_tags")


@query("tag_segment_trie", sql=f"""
WITH RECURSIVE {_DICT2}, {_GLUED.format(expr=_WITH_JUNK)}, {_FWD}, {_REV}, {_SEG}
SELECT id, split_tags, pass FROM seg
""")
def tag_segment_trie(spark, sf):
    """The double-array trie used beyond the regex's dictionary bound."""
    g = _glued_junk(spark, sf).select("id", "tags")
    return TG.segment_trie(g, _dict2(spark, sf), on_fail="null", with_pass=True).select(
        "id", "split_tags", "pass")


_PREFIX_SQL = f"""
WITH {_DICT}
SELECT p_partkey AS id, w AS tag_name FROM part JOIN dict ON starts_with(replace(p_name, ' ', ''), w)
"""


@query("tag_prefix_merge", sql=_PREFIX_SQL)
def tag_prefix_merge(spark, sf):
    """The same matches by the merge in string order used beyond the
    dictionary bound."""
    g = TB.glued_tags(spark, sf)
    return TG.prefix_merge(g, TB.tag_words(spark, sf)).select("id", "tag_name")


@query("tag_prefix_theta_join", sql=_PREFIX_SQL)
def tag_prefix_theta_join(spark, sf):
    """Every dictionary tag each glued string starts with (theta join with
    the size-checked broadcast dictionary)."""
    g = TB.glued_tags(spark, sf)
    return TG.prefix_matches(g, TB.tag_words(spark, sf)).select("id", "tag_name")
