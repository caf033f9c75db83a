"""The queries of this subpackage: each applies one operator, with production
parameters, to its whole table.  ``ORACLE_SQL`` has the DuckDB form of those
that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.llm import (decontaminate, embedding, merkle, minhash, negatives, packing, pii, quality, sharding,
                        substrings, tokens, urls, warc)
from quarry.llm.graph import read_table

QUERIES = {}
ORACLE_SQL = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op3_minhash_near_dedup(spark, sf_dir):
    """Near-duplicate documents on 4-word shingles, Jaccard 0.8 or more."""
    docs = read_table(spark, sf_dir, "documents")
    return minhash.near_duplicates(docs, width=4, similarity=(80, 100))


ORACLE_SQL["op3_minhash_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 4 THEN array_to_string(ws, ' ')
                               ELSE array_to_string(ws[i:i + 3], ' ') END AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
                    FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * shared >= 80 * (na.n + nb.n - shared)),
r(doc_id, other) AS (
  SELECT a, b FROM l UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.other = l.a),
c AS (SELECT doc_id, least(doc_id, min(other)) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       coalesce(c.component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(c.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""


@_query
def op9_quality_gam(spark, sf_dir):
    """Quality score of every document by the additive model."""
    docs = read_table(spark, sf_dir, "documents")
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, model)


@_query
def op2_pii_skip_chain(spark, sf_dir):
    """Personal data of every document: base patterns and the field's spans."""
    docs = read_table(spark, sf_dir, "documents")
    return pii.find(docs, pii.learn(docs))


@_query
def op8_conflict_best_fit(spark, sf_dir):
    """All documents packed into bins of 1,024 words."""
    return packing.pack(read_table(spark, sf_dir, "documents"))


@_query
def op1_collision_counting(spark, sf_dir):
    """Near-duplicate vectors: cosine 0.9 or more."""
    return embedding.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@_query
def op4_host_reputation(spark, sf_dir):
    """Every page's url judged by rules and host reputation."""
    return urls.judge(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))


@_query
def op10_positional_index(spark, sf_dir):
    """Benchmark windows of 10 words in all documents."""
    got = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return got.drop("n_near")


ORACLE_SQL["op10_positional_index"] = r"""
WITH low AS (
  SELECT 'd' AS side, CAST(doc_id AS VARCHAR) AS id, row_number() OVER () AS r, text FROM documents
  UNION ALL SELECT 'b', CAST(item_id AS VARCHAR), row_number() OVER (), text FROM benchmark WHERE item_id IS NOT NULL),
w AS (SELECT side, id, r, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM low),
wins AS (SELECT DISTINCT id AS item, len(win) AS n, array_to_string(win, ' ') AS phrase FROM (
  SELECT id, ws[s:s + 9] AS win FROM (SELECT id, ws, unnest(range(1, greatest(len(ws) - 8, 2))) AS s
                                      FROM w WHERE side = 'b' AND len(ws) > 0))),
sizes AS (SELECT DISTINCT n FROM wins),
spots AS (SELECT r, n, s, array_to_string(ws[s:s + n - 1], ' ') AS phrase
  FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM w, sizes WHERE side = 'd' AND len(ws) >= n)),
hits AS (SELECT r, s, spots.n, item FROM spots JOIN wins ON wins.phrase = spots.phrase AND wins.n = spots.n),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY encode(item)) AS list
          FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT d.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM (SELECT doc_id, row_number() OVER () AS r FROM documents) d JOIN w ON w.side = 'd' AND w.r = d.r
LEFT JOIN covered ON covered.r = d.r LEFT JOIN items ON items.r = d.r
"""


@_query
def op5_packed_token_ids(spark, sf_dir):
    """All documents as packed rows of 2,048 token ids, read back as digests."""
    rows = tokens.packed_ids(read_table(spark, sf_dir, "documents"))
    ends = F.hex("cu_seqlens")
    return rows.select("row_id", "n_tokens", F.size("doc_ids").cast("bigint").alias("n_segments"), "doc_ids",
                       "first_tokens", F.sha2("ids", 256).alias("ids_sha256"), ends.alias("cu_seqlens"),
                       F.hex("resets").alias("resets"))


@_query
def op6_seekable_warc(spark, sf_dir):
    """All pages written as an archive and read back."""
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


@_query
def op7_fuzzy_passages(spark, sf_dir):
    """Passages of 50 words or more that documents share."""
    return substrings.repeated_passages(read_table(spark, sf_dir, "documents"))


@_query
def op11_merkle_manifest(spark, sf_dir):
    """Every document's Merkle proof, folded from a copy in which each fifth
    document has its A-Z lower-cased."""
    docs = read_table(spark, sf_dir, "documents")
    touched = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle.audit(docs, tampered={"text": F.when(touched, lowered)})


@_query
def op12_hard_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector, after each seventh one's
    label has moved on by one."""
    vectors = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


ORACLE_SQL["op12_hard_negatives"] = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
             CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


@_query
def op13_differencing_shards(spark, sf_dir):
    """All documents in 8 shards of near equal bytes, equal texts together."""
    return sharding.shards(read_table(spark, sf_dir, "documents"))


def _merkle_sql(levels: int = 8) -> str:
    """The proofs level by level: ``levels`` of both trees are unrolled, enough for 16 ** levels rows."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    value = lambda c: (f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' "  # noqa: E731
                       f"|| CAST({c} AS VARCHAR) END")
    head = " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars"))
    low = f"translate(text, '{upper}', '{lower}')"
    bits = "list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0])"
    crc = (f"xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR),"
           f" ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: list_reduce({bits}, lambda x, y: "
           f"xor(x >> 1, 3988292384 * (x & 1)))))")
    parts = [f"""d AS (
  SELECT doc_id, coalesce('s' || source, '') AS grp, sha256({head} || {value("text")}) AS leaf,
         CASE WHEN text IS NOT NULL AND {crc} % 5 = 0 THEN sha256({head} || {value(low)}) END AS other
  FROM documents),
g0 AS (SELECT grp, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
              leaf AS digest, doc_id, other FROM d)"""]

    def climb(name, first):
        """Paths of all nodes of ``first`` (grp, pos, digest) to the top of their group."""
        parts.append(f"{name}0 AS (SELECT grp, pos, digest FROM {first})")
        for k in range(levels):
            parts.append(f"{name}r{k} AS (SELECT grp, pos // 16 AS run, list(digest ORDER BY pos) AS l, "
                         f"sum(count(*)) OVER (PARTITION BY grp) AS n FROM {name}{k} GROUP BY grp, pos // 16)")
            parts.append(f"{name}{k + 1} AS (SELECT grp, run AS pos, sha256(array_to_string(l, '')) AS digest "
                         f"FROM {name}r{k} WHERE n > 1)")
        tops = " UNION ALL ".join(f"SELECT grp, l[1] AS digest FROM {name}r{k} WHERE n = 1" for k in range(levels))
        parts.append(f"{name}top AS ({tops})")

    def paths(name, source, pos, cur, proof, keep):
        """Proofs and folds of ``source``'s rows along the levels of a tree."""
        parts.append(f"{source}{name}0 AS (SELECT *, {pos} AS spot, {cur} AS cur, {proof} AS prf FROM {source})")
        for k in range(levels):
            parts.append(
                f"{source}{name}{k + 1} AS (SELECT x.* EXCLUDE (spot, cur, prf), spot // 16 AS spot, CASE WHEN r.n > 1 THEN "
                f"sha256(array_to_string(list_concat(r.l[1:spot % 16], [cur], r.l[spot % 16 + 2:]), '')) ELSE cur END AS cur, "
                f"CASE WHEN r.n > 1 THEN prf || array_to_string(list_concat(r.l[1:spot % 16], r.l[spot % 16 + 2:]), '') "
                f"ELSE prf END AS prf FROM {source}{name}{k} x LEFT JOIN {name}r{k} r "
                f"ON r.grp = {keep} AND r.run = spot // 16)")
        return f"{source}{name}{levels}"

    climb("a", "g0")
    parts.append("s0 AS (SELECT '' AS grp, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos, digest, grp AS member FROM atop)")
    climb("b", "s0")
    mid = paths("a", "g0", "pos", "coalesce(other, digest)", "''", "x.grp")
    parts.append(f"m AS (SELECT q.* EXCLUDE (spot), s0.pos AS top, s0.digest AS subroot FROM {mid} q "
                 f"JOIN s0 ON s0.member = q.grp)")
    parts.append("n AS (SELECT * EXCLUDE (cur, prf), cur AS c0, prf AS p0 FROM m)")
    last = paths("b", "n", "top", "c0", "p0", "''")
    sql = "WITH " + ",\n".join(parts)
    return (f"{sql}\nSELECT doc_id, digest AS leaf, subroot, (SELECT digest FROM btop) AS root, sha256(prf) AS proof_sha256, "
            f"cur AS folded_root, cur = (SELECT digest FROM btop) AS verified FROM {last}")


ORACLE_SQL["op11_merkle_manifest"] = _merkle_sql()

ORACLE_SQL["op6_seekable_warc"] = r"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d HAVING count(*) > 1)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f USING (d)
"""

ORACLE_SQL["op1_collision_counting"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: isfinite(x)))
    AND len(list_filter(embedding, lambda x: x IS NULL)) = 0
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
r(vec_id, other) AS (SELECT a, b FROM l UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.other = l.a),
c AS (SELECT vec_id, least(vec_id, min(other)) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, coalesce(c.component_id, e.vec_id) AS component_id,
       e.vec_id = coalesce(c.component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""

ORACLE_SQL["op4_host_reputation"] = r"""
WITH p AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
known AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY doc_id),
h0 AS (SELECT host, count(*) AS n, sum(bad) AS bad, regexp_replace(host, ':[0-9]*$', '') AS name
       FROM p JOIN known ON page_id = doc_id GROUP BY host),
hl AS (SELECT *, CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN [name] ELSE string_split(name, '.') END AS l FROM h0),
he AS (SELECT *, list_transform(range(1, len(l) + 1), lambda i: array_to_string(l[i:], '.')) AS ends FROM hl),
hk AS (SELECT *, coalesce(
    list_max(list_transform(ends, lambda e: CASE WHEN e IN (__EXCEPT__) THEN len(string_split(e, '.')) END)) - 1,
    greatest(list_max(list_transform(ends, lambda e: CASE WHEN e IN (__PLAIN__)
      OR array_to_string(string_split(e, '.')[2:], '.') IN (__WILD__) THEN len(string_split(e, '.')) END)), 1)) AS k FROM he),
hs AS (SELECT host, n, bad, array_to_string(l[-least(k + 1, len(l)):], '.') AS domain,
              array_to_string(l[-least(k, len(l)):], '.') AS suffix FROM hk),
g AS (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) AS mu FROM hs),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT mu FROM g) AS mu FROM hs GROUP BY suffix),
rs AS (SELECT least(greatest((sum(n * (bad / n - mu) * (bad / n - mu)) - sum(mu * (1 - mu)))
        / sum((n - 1) * mu * (1 - mu)), 1e-3), 0.5) AS rho FROM s),
sp AS (SELECT suffix, (mu * (1 / rho - 1) + bad) / (1 / rho - 1 + n) AS mu FROM s, rs),
d AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad, any_value(mu) AS mu
      FROM hs JOIN sp USING (suffix) GROUP BY suffix, domain),
rd AS (SELECT least(greatest((sum(n * (bad / n - mu) * (bad / n - mu)) - sum(mu * (1 - mu)))
        / sum((n - 1) * mu * (1 - mu)), 1e-3), 0.5) AS rho FROM d),
dp AS (SELECT domain, (mu * (1 / rho - 1) + bad) / (1 / rho - 1 + n) AS mu FROM d, rd),
u AS (SELECT host, n, bad, mu FROM hs JOIN dp USING (domain)),
ru AS (SELECT least(greatest((sum(n * (bad / n - mu) * (bad / n - mu)) - sum(mu * (1 - mu)))
        / sum((n - 1) * mu * (1 - mu)), 1e-3), 0.5) AS rho FROM u),
post AS (SELECT host, mu * (1 / rho - 1) + bad AS a, (1 - mu) * (1 / rho - 1) + n - bad AS b FROM u, ru),
blocked AS (SELECT host FROM post
            WHERE a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.25),
r AS (SELECT p.*, b.host IS NOT NULL AS judged,
    CASE WHEN (p.host = 'example.com' OR ends_with(p.host, '.example.com')) AND starts_with(path, '/de/')
           THEN 'example.com/de/'
         WHEN (p.host = 'example.net' OR ends_with(p.host, '.example.net')) AND starts_with(path, '/en/')
           THEN 'example.net/en/'
         WHEN (p.host = 'org' OR ends_with(p.host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (p.host = 'net' OR ends_with(p.host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p LEFT JOIN blocked b ON b.host = p.host)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN judged THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
for _kind, _names in (("__PLAIN__", [r for r in urls.SUFFIXES if r[0] not in "*!"]),
                      ("__WILD__", [r[2:] for r in urls.SUFFIXES if r[0] == "*"]),
                      ("__EXCEPT__", [r[1:] for r in urls.SUFFIXES if r[0] == "!"])):
    ORACLE_SQL["op4_host_reputation"] = ORACLE_SQL["op4_host_reputation"].replace(
        _kind, ", ".join(f"'{n}'" for n in _names))
