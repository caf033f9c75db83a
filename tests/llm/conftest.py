"""Small tables with the awkward rows: nulls, empty and very long texts,
repeated rows, shared ids, copies, and extra columns whose names the
operators use inside."""

import random

import pytest
from pyspark.sql import functions as F

EXTRA = ["id", "k", "key", "rep", "hub", "n", "c", "component", "bucket", "kept", "score", "grp", "gone", "hit",
         "other_id", "hit_key", "one_row", "a", "b", "node", "w", "pos", "term"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VOCAB = [f"w{i}" for i in range(400)] + ["Der", "São", "naïve", "Ünï"]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) for _ in range(n))


def edited(text, seed, n):
    r, w = random.Random(seed), text.split(" ")
    for i in r.sample(range(len(w)), n):
        w[i] = f"x{seed}_{i}"
    return " ".join(w)


def document_rows():
    base, other, shared = prose(1, 120), prose(2, 90), prose(3, 60)
    texts = [base, edited(base, 5, 1), edited(base, 6, 2), edited(base, 7, 12), base.upper(), other, other,
             None, "", "  \n\t ", "one", "one", "two words", prose(8, 200) + " " + shared + " " + prose(9, 30),
             shared + "\n" + prose(10, 300), prose(11, 40) + " " + edited(shared, 12, 1) + " " + prose(13, 80),
             prose(14, 60_000), "z" * 300_000, prose(15, 400) + " " + "y" * 5_000,
             "mail jo.doe_x@mail.example.com now, 4539578763621486 and 4539578763621486 4539578763621486 +1 (743) "
             "555-3824 from 10.0.0.255 or 300.1.1.1", "@ a@b @c.d 1.2.3.4.5 +1 2", "0" * 1_500 + " " + "1." * 300]
    texts += [prose(100 + i, 150) for i in range(20)]
    rows = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append(rows[5])                                # a repeated row
    rows.append((0, prose(50, 70), None, None, None))   # an id with another text
    rows += [(None, base, "en", "src0", 7), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(document_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def wide(docs):
    """The documents with clashing extra columns."""
    return docs.select("*", *(F.lit(f"extra {c}").alias(c) for c in EXTRA))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
