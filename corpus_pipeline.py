"""A corpus pipeline of the operators in ``quarry.llm``.

Every stage works on all rows its predecessor kept, is written as Parquet and
read again as the next stage's input; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.llm import decontaminate, minhash, packing, pii, quality
from quarry.llm.graph import read_table
from quarry.session import write_table


def quality_filter(spark, docs, sf_dir):
    """Documents that the additive model rejects go."""
    return quality.keep_good(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near-duplicates stays (5-word shingles,
    similarity 0.8)."""
    return minhash.keep_first(docs, width=5, similarity=(80, 100))


def decontamination(spark, docs, sf_dir):
    """Documents with a benchmark window of 10 words go."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark, docs, sf_dir):
    """Personal data is replaced by its kind; ``n_chars`` follows the text."""
    out = pii.mask(docs, pii.learn(docs))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text")).cast(kind))
    return out


def pack(spark, docs, sf_dir):
    """Pieces of the documents in bins of 1,024 words."""
    return packing.pack(docs)


STAGES = [("quality_gam", quality_filter), ("minhash_near_dedup", near_dedup),
          ("positional_decontamination", decontamination), ("pii_skip_chain", mask_personal_data),
          ("conflict_best_fit", pack)]

#: none: SQL can't express the classifier; the tests hold run() against a brute-force version
ORACLE_SQL = None


def tables(spark, sf_dir):
    """Every stage's table by its name.  ``pii_skip_chain`` is the cleaned
    corpus, the texts that the last stage's ``first_word`` and ``n_words``
    refer to by ``doc_id``."""
    docs, out = read_table(spark, sf_dir, "documents"), {}
    for name, stage in STAGES:
        docs = out[name] = write_table(stage(spark, docs, sf_dir), name)
    return out


def run(spark, sf_dir):
    """All stages over ``documents``."""
    return tables(spark, sf_dir)[STAGES[-1][0]]
