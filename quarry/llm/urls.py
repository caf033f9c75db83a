"""URL filter: explicit rules, then an empirical-Bayes host reputation.

Labelled pages give each host a count of outcomes and of bad ones.  The rate
of bad pages is shrunk through beta-binomial priors down the name: all pages
-> public suffix -> registered domain -> host; the prior of a level is
centred on its parent's posterior mean, and its strength is the method of
moments estimate over that level's units.  A host is blocked when the lower
bound of its posterior rate passes ``max_bad``.  Only DataFrame functions are
used; counts are pre-aggregated before the shuffle, so a hot host is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.joins import broadcast_if_small
from quarry.session import write_table

#: suffixes under which names are registered, by default (fixed values; a rule list of any length
#: can be passed instead): ``*`` stands for any label, ``!`` takes a name out of a ``*`` rule; a
#: name without a rule has its last label as suffix
SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp", "co.nz",
            "com.br", "com.cn", "co.in", "co.kr", "co.za", "com.mx", "com.tr", "com.tw", "*.ck", "!www.ck",
            "blogspot.com", "github.io", "gitlab.io", "herokuapp.com", "wordpress.com")
#: (verdict, host/path prefix); a rule fits its host and all subdomains
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
MAX_BAD, Z = 0.25, 1.645
#: bounds of the within-unit correlation, so that a prior is never flat nor fixed
RHO = (1e-3, 0.5)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rule(rules, what: int) -> Column:
    """The longest fitting rule's text (what 1) or verdict (what 0)."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked last, so it wins
        h, _, p = r[1].partition("/")
        fits = ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(f"/{p}")
        out = F.when(fits, F.lit(r[what])).otherwise(out)
    return out


def _labels(h: Column) -> Column:
    """Labels of a host without its port; an IPv4 address is one label."""
    name = F.regexp_replace(h, r":[0-9]*$", "")
    return F.when(name.rlike(r"^[0-9.]+$"), F.array(name)).otherwise(F.split(name, r"\."))


def suffix_size(labels: Column, rules=SUFFIXES) -> Column:
    """How many labels of a name are its public suffix: of the rules that fit
    its end an exception wins (less its first label), else the longest."""
    plain = {r: 0 for r in rules if r[:1] not in "*!"}
    wild = {r[2:] for r in rules if r.startswith("*.")}
    other = {r[1:] for r in rules if r.startswith("!")}
    n = F.size(labels)
    ends = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    among = lambda c, names: c.isin(*names) if names else F.lit(False)
    fits = lambda size: lambda e, i: F.when(size(e, i), n - i)
    behind = lambda e: F.array_join(F.slice(F.split(e, r"\."), 2, n), ".")
    exact = F.transform(ends, fits(lambda e, i: among(e, plain) | among(behind(e), wild)))
    taken = F.transform(ends, fits(lambda e, i: among(e, other)))
    return F.coalesce(F.array_max(taken) - 1, F.greatest(F.array_max(exact), F.lit(1))).cast("int")


def _last(labels: Column, k: Column) -> Column:
    k = F.least(F.size(labels), k)
    return F.array_join(F.slice(labels, F.size(labels) - k + 1, k), ".")


def _posterior(units: DataFrame, unit: str) -> DataFrame:
    """units: (unit, n, bad, mu) -> + a, b, the beta posterior's parameters."""
    v = F.col("mu") * (1 - F.col("mu"))
    off = F.col("bad") / F.col("n") - F.col("mu")
    row = units.agg(F.sum(F.col("n") * off * off).alias("between"), F.sum(v).alias("within"),
                    F.sum((F.col("n") - 1) * v).alias("weight")).first()  # one row
    rho = RHO[0]
    if row["weight"]:
        rho = min(max((row["between"] - row["within"]) / row["weight"], RHO[0]), RHO[1])
    m = 1 / rho - 1
    return units.withColumn("a", F.col("mu") * m + F.col("bad")) \
        .withColumn("b", (1 - F.col("mu")) * m + F.col("n") - F.col("bad"))


def reputation(outcomes: DataFrame, suffixes=SUFFIXES) -> DataFrame:
    """outcomes: (host, bad 0/1) of labelled pages -> ``host, rate, bound``:
    posterior mean and lower bound of the host's rate of bad pages.  A host's
    registered domain is its public suffix and one label more."""
    counted = outcomes.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
    parts = counted.withColumn("labels", _labels(F.col("host")))
    parts = parts.withColumn("size", suffix_size(F.col("labels"), suffixes))
    hosts = write_table(parts.select("host", "n", "bad", _last(F.col("labels"), F.col("size") + 1).alias("domain"),
                                     _last(F.col("labels"), F.col("size")).alias("suffix")), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()  # one row
    mu = ((total["bad"] or 0) + 1) / ((total["n"] or 0) + 2)
    sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    mean = (F.col("a") / (F.col("a") + F.col("b"))).alias("mu")
    tops = _posterior(hosts.groupBy("suffix").agg(*sums).withColumn("mu", F.lit(mu)), "suffix")
    domains = write_table(hosts.groupBy("suffix", "domain").agg(*sums), "domains")
    domains = _posterior(write_table(domains.join(tops.select("suffix", mean), "suffix"), "domains"), "domain")
    units = write_table(hosts.join(domains.select("domain", mean), "domain")
                        .select("host", "n", "bad", "mu"), "units")
    post = _posterior(units, "host")
    a, b = F.col("a"), F.col("b")
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return write_table(post.select("host", (a / (a + b)).alias("rate"),
                                   (a / (a + b) - Z * sd).alias("bound")), "reputation")


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, max_bad: float = MAX_BAD, suffixes=SUFFIXES,
          id_col: str = "page_id", url_col: str = "url", label_id: str = "doc_id") -> DataFrame:
    """Per page: ``id_col, host, path, rule, verdict``.

    A page's outcome is that of the label with its id: bad if of quality 0
    or toxic (several labels of an id: bad if any is).  Hosts without
    labelled pages are allowed unless a rule says otherwise.

    Edge cases: a null url, or one without ``://``, has an empty host and
    path; a null id has no outcome and keeps its row; labels that are null in
    both columns are no outcome; repeated rows are judged (and count) each;
    other columns aren't read; empty tables give an empty result."""
    bad = F.when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(),
                 ((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int"))
    known = (labels.select(F.col(label_id).alias("id"), bad.alias("bad"))
             .where("id IS NOT NULL AND bad IS NOT NULL").groupBy("id").agg(F.max("bad").alias("bad")))
    split = pages.select(F.col(id_col).alias("id"), host(F.col(url_col)).alias("host"),
                         path(F.col(url_col)).alias("path"))
    rep = reputation(split.select("id", "host").join(known, "id").select("host", "bad"), suffixes)
    blocked = write_table(rep.where(F.col("bound") > max_bad).select("host", F.lit("block").alias("judged")), "blocked")
    out = split.join(broadcast_if_small(blocked), "host", "left").select("id", "host", "path", "judged")
    return out.select(F.col("id").alias(id_col), "host", "path", _rule(rules, 1).alias("rule"),
                      F.coalesce(_rule(rules, 0), "judged", F.lit("allow")).alias("verdict"))
