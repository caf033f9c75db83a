"""Feature assembly, LibSVM output and linear scoring in long form.

A feature table is a table of cells ``(id, index, value)``.  Every block has
its own indices; a table of at most nine offsets makes them global.  No vector
and no per-term metadata is ever built, so a table may be as wide as its
vocabularies are.  Text terms are counted inside their row, vocabularies are
joined (broadcast only when shown small), and one secondary sort writes the
cells to LibSVM.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import default_stopwords, remove_stopwords, tokenize
from quarry.operators import features as FT
from quarry.operators.joins import broadcast_if_small
from quarry.session import write_table


@dataclass
class Assembled:
    """``cells``: (id, index, value) of the values other than 0, ``widths``:
    the width of every block in order, ``width``: their sum."""
    cells: DataFrame
    widths: dict[str, int]

    @property
    def width(self) -> int:
        return sum(self.widths.values())


def _text_cells(tf: DataFrame, train: DataFrame, others: DataFrame, vocab_size: int):
    """(cells, width) of a text block: (id, index, value), min-max scaled with
    the training rows' extremes.  ``tf``: (id, term, tf) of all rows."""
    fitted = write_table(tf.join(broadcast_if_small(train), "id", "left_semi"), "tf_train")
    voc = write_table(FT.vocabulary(fitted, "id", vocab_size)
                      .join(FT.term_minmax_stats(fitted, train.count()).drop("_df"), "term"), "vocabulary")
    span = F.col("_max") - F.col("_min")
    value = F.when(span == 0, F.lit(0.5)).otherwise((F.col("tf") - F.col("_min")) / span)
    cells = tf.join(broadcast_if_small(voc), "term").select("id", "index", value.alias("value"))
    # terms of every training row: at most as many as the shortest one has
    always = [r.asDict() for r in voc.where("_min > 0").select("term", "index", "_max", "_min").collect()]
    if always:
        entry = F.explode(F.array(*(F.struct(F.lit(a["term"]).alias("term"), F.lit(a["index"]).alias("index"),
                                             F.lit(0.5 if a["_max"] == a["_min"] else -a["_min"] / (a["_max"] - a["_min"]))
                                             .alias("value")) for a in always)))
        lacking = others.select("id", entry.alias("a")).select("id", "a.*").join(tf.select("id", "term"), ["id", "term"], "left_anti")
        cells = cells.unionByName(lacking.select("id", F.col("index").cast("bigint").alias("index"), "value"))
    return cells, voc.count()


def _list_cells(df: DataFrame, col: str, train: DataFrame, vocab_size: int):
    """(cells, width) of the counts of a list column's items."""
    tf = write_table(FT.term_counts_in_row(df, "id", col), "items")
    voc = write_table(FT.vocabulary(tf.join(broadcast_if_small(train), "id", "left_semi"), "id", vocab_size), "vocabulary")
    cells = tf.join(broadcast_if_small(voc.select("term", "index")), "term")
    return cells.select("id", "index", F.col("tf").cast("double").alias("value")), voc.count()


def assemble_long(prepared: DataFrame, train: DataFrame, vocab_size: int = FT.DEFAULT_VOCAB,
                  stopwords=None) -> Assembled:
    """All nine blocks of :func:`features.prepare`'s rows as cells, in the
    order ``features.BLOCKS``; vocabularies (top ``vocab_size`` by count, ties
    by term) and extremes are those of the rows whose ids ``train`` has.

    ``id`` must identify a row.  A term or item that no training row has has
    no index.  A value that scales to 0 has no cell."""
    stops = stopwords if stopwords is not None else default_stopwords()
    train = write_table(train.select("id"), "train_ids")
    others = write_table(prepared.select("id").join(broadcast_if_small(train), "id", "left_anti"), "other_ids")
    fitted = prepared.join(broadcast_if_small(train), "id", "left_semi")
    bounds = fitted.agg(*(f(c).alias(f"{n}_{c}") for c in FT.SCALARS for n, f in (("lo", F.min), ("hi", F.max)))).first()
    made = {}
    for block, col in (("title_f", "title"), ("body_f", "body_s")):
        tokens = prepared.select("id", remove_stopwords(tokenize(F.col(col)), stops).alias("toks"))
        tf = write_table(FT.term_counts_in_row(tokens, "id", "toks"), "tf")
        made[block] = _text_cells(tf, train, others, vocab_size)
    for block, col in (("tags_f", "tags_a"), ("vote_type_id_f", "vote_type_id_a")):
        made[block] = _list_cells(prepared, col, train, vocab_size)
    widths = {b: made[b][1] if b in made else 1 for b in FT.BLOCKS}
    offset, cells, scalars = 0, [], []
    for b in FT.BLOCKS:
        if b in made:
            cells.append(made[b][0].select("id", (F.col("index") + offset).cast("bigint").alias("index"), "value"))
        else:
            c = b.removesuffix("_f")
            lo, hi = bounds[f"lo_{c}"], bounds[f"hi_{c}"]
            value = F.lit(0.5) if lo == hi else (F.col(c) - F.lit(lo)) / F.lit(None if lo is None else hi - lo)
            scalars.append(F.struct(F.lit(offset).cast("bigint").alias("index"), value.cast("double").alias("value")))
        offset += widths[b]
    out = prepared.select("id", F.explode(F.array(*scalars)).alias("c")).select("id", "c.*")
    for part in cells:
        out = out.unionByName(part)
    return Assembled(write_table(out.where("value <> 0"), "cells"), widths)


def _line_task(batches):
    """LibSVM lines of (id, cell) rows sorted by id and index, ``cell`` being
    the text of a cell; the first row of an id has its label."""
    last, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, cells, lines = batch.column(0), batch.column(1).to_pylist(), []
        here, before = ids[1:], ids[:-1]
        new = pc.coalesce(pc.not_equal(here, before), pc.xor(pc.is_null(here), pc.is_null(before)))
        cuts = np.flatnonzero(new.to_numpy(zero_copy_only=False)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cells)], strict=True):
            i = ids[lo].as_py()
            if i != last and parts:
                lines.append(" ".join(parts))
                parts = []
            last = i
            parts += cells[lo:hi]
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array([" ".join(parts)], pa.string())], names=["value"])


def write_libsvm_long(labels: DataFrame, cells: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``labels`` (id, label) and their ``cells`` as LibSVM, a line per
    id, in one shuffle: label and cells are sorted together by id and index."""
    first = labels.select("id", F.lit(-1).cast("bigint").alias("index"), F.col("label").cast("double").alias("value"))
    rows = first.unionByName(cells.select("id", "index", "value"))
    value = F.col("value").cast("string")
    text = F.when(F.col("index") < 0, value).otherwise(F.concat((F.col("index") + 1).cast("string"), F.lit(":"), value))
    rows = rows.repartition("id").sortWithinPartitions("id", "index").select("id", text.alias("cell"))
    rows.mapInArrow(_line_task, "value string").write.mode(mode).text(path)


def score_linear_long(ids: DataFrame, cells: DataFrame, coefficients: DataFrame, intercept: float = 0.0) -> DataFrame:
    """(id, raw, probability, prediction) of a linear model over cells:
    ``raw`` = intercept + sum of value x coefficient, ``coefficients`` being
    (index, coefficient).  The sums are partial in each map task, so a hot id
    is one row per task in the shuffle; an id without cells has the intercept."""
    each = cells.join(broadcast_if_small(coefficients.select("index", "coefficient")), "index")
    sums = each.groupBy("id").agg(F.sum(F.col("value") * F.col("coefficient")).alias("_s"))
    raw = F.coalesce("_s", F.lit(0.0)) + F.lit(float(intercept))
    out = ids.select("id").join(sums, "id", "left").select("id", raw.alias("raw"))
    return out.withColumn("probability", 1 / (1 + F.exp(-F.col("raw")))) \
        .withColumn("prediction", F.when(F.col("raw") > 0, F.lit(1.0)).otherwise(F.lit(0.0)))
