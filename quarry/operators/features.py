"""Step 3 - features.

Two forms of the same computation:

* **long form** (``term_counts_long``, ``vocabulary``, ``minmax_terms_long``):
  ``(doc, term, tf)`` rows, SQL-checkable, sparse by construction.  Min-max
  scaling of a term column never builds a vocabulary-wide array per row:
  ``min = 0 if df < N else min(tf)``, ``value = (tf-min)/(max-min)``,
  ``0.5`` when ``max == min``; a term absent from a document stays 0.
* **vector form** (``feature_pipeline``): the ML pipeline that produces the
  ``(label, features)`` training table - tokenizer, stop-word remover, count
  vectorizer (vocabulary chosen deterministically by the long form), min-max
  scalers and the assembler, in the reference's block order.

The vocabulary is the top ``vocab_size`` terms by total count (ties broken by
term), chosen by a distributed global sort; only the bounded top-V list ever
reaches the driver (as the count-vectorizer model needs it).
"""

from __future__ import annotations

from uuid import uuid4

import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import (CountVectorizer, CountVectorizerModel, HashingTF,
                                MaxAbsScalerModel, MinMaxScaler, MinMaxScalerModel,
                                SQLTransformer, VectorAssembler, VectorSlicer)
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import words
from quarry.functions.text import default_stopwords, split_pipe, strip_html
from quarry.operators.joins import broadcast_if_small

#: CountVectorizer / HashingTF default width
DEFAULT_VOCAB = 1 << 18

#: a top-k whose candidate rows (partitions x k) stay below this is merged in
#: one task; larger ones use the distributed global rank
TOPK_MERGE_ROWS = 2_000_000

#: block order of the assembled feature vector (fixed by the reference)
BLOCKS = ["title_f", "body_f", "creation_date_f", "answer_count_f", "favorite_count_f",
          "score_f", "tags_f", "reputation_f", "vote_type_id_f"]
SCALARS = ["creation_date", "answer_count", "favorite_count", "score", "reputation"]


# --------------------------------------------------------------- filters

def required_not_null(df: DataFrame, cols) -> DataFrame:
    """Keep rows with no null in ``cols`` (a Column predicate, pushable)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def fill_zero(df: DataFrame, cols) -> DataFrame:
    """null -> 0 on the given (typed) columns."""
    return df.select(*[F.coalesce(F.col(c), F.lit(0)).cast(df.schema[c].dataType).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


# --------------------------------------------------------------- long form

def term_counts_long(df: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
    """(id, term, tf): one row per distinct term of each document.  All
    tokens of a document sit in one input row, so the map-side partial
    aggregation already produces exact counts; the shuffle carries only the
    distinct (doc, term) pairs."""
    from quarry.functions.text import explode_items
    return (df.select(id_col, explode_items(F.col(tokens_col)).alias("term"))
            .where(F.col("term").isNotNull())
            .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))


#: tokens of a batch that a task counts at once
COUNT_TOKENS = 1 << 18


def _slices(batches, column: int):
    """The batches in runs of rows that hold some COUNT_TOKENS tokens (or one
    row that holds more), so that a task's memory is that of a run."""
    import numpy as np
    import pyarrow.compute as pc
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at, seen = 0, 0
        while at < batch.num_rows:
            to = max(int(np.searchsorted(ends, seen + COUNT_TOKENS, side="right")), at + 1)
            yield batch.slice(at, to - at)
            at, seen = to, int(ends[to - 1])


def _coded(tokens):
    """(row, code, tf) of the distinct terms of each row of a batch, and the
    term of each code."""
    import pyarrow as pa
    import pyarrow.compute as pc
    terms = pc.list_flatten(tokens).dictionary_encode()
    flat = pa.table({"row": pc.list_parent_indices(tokens), "code": terms.indices})
    flat = flat.filter(pc.is_valid(flat.column("code")))
    return flat.group_by(["row", "code"]).aggregate([([], "count_all")]).rename_columns(["row", "code", "tf"]), terms.dictionary


def _named(coded, terms):
    """``coded`` with its column code replaced by the terms."""
    at = coded.column_names.index("code")
    return coded.set_column(at, "term", terms.take(coded.column("code").combine_chunks()))


def _pairs(tokens):
    """(row, term, tf) of the distinct terms of each row of a batch."""
    return _named(*_coded(tokens))


def term_counts_in_row(df: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
    """(id, term, tf) as :func:`term_counts_long` gives them for rows with ids
    of their own, without a shuffle: a row's tokens are counted where the row
    is.  Rows that share an id are counted each."""
    def count(batches):
        for batch in _slices(batches, 1):
            got = _pairs(batch.column(1)).combine_chunks()
            ids = batch.column(0).take(got.column("row").combine_chunks() if got.num_rows else [])
            for part in got.drop_columns("row").add_column(0, id_col, ids).to_batches():
                yield part
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, tokens_col).mapInArrow(count, f"`{id_col}` {kind}, term string, tf bigint")


#: distinct terms that a task holds before it writes its partial counts
PARTIAL_TERMS = 1_000_000


def term_partials(df: DataFrame, tokens_col: str, stopwords=None) -> DataFrame:
    """(part, term, total, df, most, least): every task's own counts and the
    extremes of a row's count, nothing shuffled; a task with many distinct
    terms writes several parts.  With ``stopwords`` the column holds texts,
    whose words but those are counted where they are found."""
    stops = None if stopwords is None else words.stop_set(stopwords)

    def rows(batches):
        if stops is None:
            yield from (batch.column(0) for batch in _slices(batches, 0))
        else:
            for batch in batches:
                yield from (words.kept_words(texts, stops) for _, texts in words.slices(batch.column(0)))

    def count(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        held, size, part = [], 0, TaskContext.get().partitionId() << 20
        names = ["term", "total", "df", "most", "least"]

        def flush(rows):
            whole = pa.concat_tables(rows).group_by("term").aggregate(
                [("total", "sum"), ("df", "sum"), ("most", "max"), ("least", "min")])
            return whole.rename_columns(names)

        def out(whole, part):
            for b in whole.to_batches():
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(part, pa.int64()), b.num_rows), *b.columns],
                                                 names=["part", *names])

        for tokens in rows(batches):
            coded, terms = _coded(tokens)
            got = _named(coded.group_by("code").aggregate(
                [("tf", "sum"), ([], "count_all"), ("tf", "max"), ("tf", "min")]), terms)
            held.append(got.rename_columns(names))
            size += got.num_rows
            if size >= PARTIAL_TERMS:
                held = [flush(held)]
                size = held[0].num_rows
                if size >= PARTIAL_TERMS // 2:
                    yield from out(held[0], part)
                    held, size, part = [], 0, part + 1
        if held:
            yield from out(flush(held), part)
    return df.select(tokens_col).where(F.col(tokens_col).isNotNull()) \
        .mapInArrow(count, "part bigint, term string, total bigint, df bigint, most bigint, least bigint")


def vocabulary_by_threshold(df: DataFrame, tokens_col: str, vocab_size: int = DEFAULT_VOCAB,
                            min_df: int = 1, stopwords=None) -> DataFrame:
    """(term, total, df, most, least, index) as :func:`vocabulary`, by a
    threshold top-k; ``most`` and ``least`` are the extremes of the term's
    count in the rows that have it.  ``stopwords``: as in :func:`term_partials`.

    Every task counts its terms (distinct terms of a document inside its row),
    and only term rows are ever shuffled.  1. The sums of the largest partial
    counts give a lower bound of the ``vocab_size``-th total.  2. A term all of
    whose partial counts are below bound / parts can't reach it and is left
    out.  3. The others are counted exactly and ranked.  The driver sees
    histograms of at most 512 rows."""
    from quarry.session import write_table
    parts = write_table(term_partials(df, tokens_col, stopwords), "partials")
    m = parts.select("part").distinct().count()
    power = F.floor(F.log2("total")).cast("int")
    many = {r["p"]: r["n"] for r in parts.groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    need, cut = 2 * vocab_size, 0
    for p in sorted(many, reverse=True):
        cut, need = p, need - many[p]
        if need <= 0:
            break
    sums = (parts.where(F.col("total") >= (1 << cut)).groupBy("term")
            .agg(F.sum("total").alias("total"), F.sum("df").alias("df")).where(F.col("df") >= min_df))
    fine = F.floor(F.log2("total") * 8).cast("int")
    hist = {r["p"]: r["n"] for r in sums.groupBy(fine.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    bound, seen = 0, 0
    for p in sorted(hist, reverse=True):
        seen += hist[p]
        if seen >= vocab_size:
            bound = int(2 ** (p / 8) * (1 - 1e-9))  # the bin's lower end
            break
    least = -(-bound // max(m, 1))
    if least > 1:
        able = parts.where(F.col("total") >= least).select("term").distinct()
        parts = parts.join(broadcast_if_small(write_table(able, "able")), "term", "left_semi")
    exact = parts.groupBy("term").agg(F.sum("total").alias("total"), F.sum("df").alias("df"),
                                      F.max("most").alias("most"), F.min("least").alias("least"))
    return rank_global(exact.where(F.col("df") >= min_df), [F.col("total").desc(), F.col("term").asc()], limit=vocab_size)


def term_totals(tf_long: DataFrame, id_col: str) -> DataFrame:
    """term -> total count and document frequency (partial aggregation,
    hot terms included)."""
    return tf_long.groupBy("term").agg(F.sum("tf").alias("total"),
                                       F.count(F.lit(1)).alias("df"))


def rank_global(df: DataFrame, order, limit: int | None = None,
                index_col: str = "index") -> DataFrame:
    """Attach a dense 0-based rank under a total ``order`` without a
    single-partition window: range-partitioned global sort, per-partition
    counts (one small row per partition to the driver), then offsets.

    With ``limit`` only rows of rank < limit are kept.
    """
    spark = df.sparkSession
    from quarry.session import write_table
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if limit is not None and limit * parts <= TOPK_MERGE_ROWS:
        # small top-k: per-partition top-k, merged in one task (at most
        # partitions x limit rows, checked above), ranked over <= limit rows
        from pyspark.sql.window import Window
        top = df.orderBy(*order).limit(limit)
        return top.withColumn(index_col, (F.row_number().over(Window.orderBy(*order)) - 1).cast("long"))
    sorted_df = (df.orderBy(*order)
                 .withColumn("_pid", F.spark_partition_id())
                 .withColumn("_mid", F.monotonically_increasing_id()))
    # contiguous ranges stay in order when AQE coalesces the sorted partitions
    sorted_df = write_table(sorted_df, "rank")
    counts = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("n"),
                                           F.min("_mid").alias("first")).collect()
    rows, acc = [], 0
    for r in sorted(counts, key=lambda r: r["_pid"]):
        rows.append((r["_pid"], acc - r["first"]))
        acc += r["n"]
    # one small row per partition, broadcast by construction
    shift = spark.createDataFrame(rows, "_pid int, _shift long")
    ranked = (sorted_df.join(F.broadcast(shift), "_pid", "inner")
              .withColumn(index_col, F.col("_mid") + F.col("_shift")))
    if limit is not None:
        ranked = ranked.where(F.col(index_col) < limit)
    return ranked.drop("_pid", "_mid", "_shift")


def vocabulary(tf_long: DataFrame, id_col: str, vocab_size: int = DEFAULT_VOCAB,
               min_df: int = 1) -> DataFrame:
    """(term, total, df, index): the top ``vocab_size`` terms by total count,
    ties by term; index 0 = most frequent."""
    t = term_totals(tf_long, id_col).where(F.col("df") >= min_df)
    return rank_global(t, [F.col("total").desc(), F.col("term").asc()], limit=vocab_size)


def count_vector_long(tf_long: DataFrame, vocab: DataFrame) -> DataFrame:
    """(id, term, index, tf) for in-vocabulary terms.  The vocabulary has at
    most ``vocab_size`` rows, so it is broadcast when its estimate is small."""
    v = broadcast_if_small(vocab.select("term", "index"))
    return tf_long.join(v, "term", "inner")


def term_minmax_stats(tf_long: DataFrame, n_docs: int) -> DataFrame:
    """term -> (_max, _min, _df) of its count over all ``n_docs`` documents
    (a document without the term counts 0, so ``_min`` is 0 unless the term
    is in every document)."""
    stats = tf_long.groupBy("term").agg(F.max("tf").alias("_max"), F.min("tf").alias("_minp"),
                                        F.count(F.lit(1)).alias("_df"))
    return stats.select("term", "_max", "_df",
                        F.when(F.col("_df") < n_docs, F.lit(0)).otherwise(F.col("_minp")).alias("_min"))


def minmax_terms_long(tf_long: DataFrame, id_col: str, n_docs: int) -> DataFrame:
    """(id, term, tf, value): per-term min-max scaling of the sparse counts,
    equal to ML ``MinMaxScaler`` over count vectors (absent cells stay 0).
    ``n_docs`` is the number of documents of the corpus, including documents
    left without any term."""
    stats = term_minmax_stats(tf_long, n_docs).drop("_df")
    # one row per term: broadcast when shown small (no shuffle of the long
    # form, so a term found in most documents is no hot partition); else a
    # shuffle join whose hot terms AQE splits
    j = tf_long.join(broadcast_if_small(stats), "term", "inner")
    value = F.when(F.col("_max") == F.col("_min"), F.lit(0.5)).otherwise(
        (F.col("tf") - F.col("_min")) / (F.col("_max") - F.col("_min")))
    return j.select(id_col, "term", "tf", value.alias("value"))


def minmax_scalars(df: DataFrame, cols, suffix: str = "_f") -> DataFrame:
    """Scale each column to [0, 1] with one aggregate job (min/max of all
    columns at once); constant column -> 0.5; null stays null."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    mm = df.agg(*aggs).first()
    out = []
    for c in cols:
        lo, hi = mm[f"min_{c}"], mm[f"max_{c}"]
        if lo is None:
            out.append(F.lit(None).cast("double").alias(c + suffix))
        elif hi == lo:
            out.append(F.when(F.col(c).isNotNull(), F.lit(0.5)).alias(c + suffix))
        else:
            out.append(((F.col(c).cast("double") - F.lit(float(lo))) / F.lit(float(hi - lo))).alias(c + suffix))
    return df.select("*", *out)


# --------------------------------------------------------------- vector form

def prepare(df: DataFrame) -> DataFrame:
    """Feature-stage input -> columns the ML stages consume.

    Required columns are checked (favorite_count may be null and becomes 0),
    HTML is stripped from the body, scalars become doubles and the pipe lists
    become arrays (Java ``split`` semantics).
    """
    from quarry.schemas import REQUIRED_NOT_NULL
    df = required_not_null(df, REQUIRED_NOT_NULL)
    return df.select(
        "id", F.col("label").cast("double").alias("label"), "title",
        strip_html(F.col("body")).alias("body_s"),
        *[(F.coalesce(F.col(c), F.lit(0)) if c == "favorite_count" else F.col(c)).cast("double").alias(c)
          for c in SCALARS],
        split_pipe(F.col("tags").cast("string")).alias("tags_a"),
        split_pipe(F.col("vote_type_id").cast("string")).alias("vote_type_id_a"),
    )


class KeptWords(Transformer):
    """Texts -> their words but ``stopwords``, the result of ML
    ``RegexTokenizer(pattern="\\\\W")`` and ``StopWordsRemover``, over whole
    Arrow batches: the two pass every token through the JVM's strings four
    times, most of the time of a fit."""

    def __init__(self, input_col: str, output_col: str, stopwords):
        super().__init__()
        self.input_col, self.output_col, self.stopwords = input_col, output_col, tuple(stopwords)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        stops = words.stop_set(self.stopwords)

        @F.arrow_udf("array<string>")
        def kept(texts: pa.Array) -> pa.Array:
            parts = [words.kept_words(part, stops) for _, part in words.slices(texts)]
            return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))
        return dataset.withColumn(self.output_col, kept(F.col(self.input_col)))


def _vocab_list(df: DataFrame, col: str, vocab_size: int, stopwords=None) -> list[str]:
    """Deterministic vocabulary (top ``vocab_size`` by count, ties by term)."""
    voc = vocabulary_by_threshold(df, col, vocab_size, stopwords=stopwords)
    # bounded by vocab_size (the model parameter): what CountVectorizer keeps
    return [r["term"] for r in voc.orderBy("index").select("term").collect()]


def count_model(vocabulary: list[str], input_col: str, output_col: str) -> CountVectorizerModel:
    """``CountVectorizerModel.from_vocabulary``, which sends a term per call
    to the JVM; here the terms go as one text that the JVM splits."""
    if not vocabulary or any(not w or "\n" in w for w in vocabulary):
        return CountVectorizerModel.from_vocabulary(vocabulary, inputCol=input_col, outputCol=output_col)
    from pyspark import SparkContext
    cut = SparkContext._active_spark_context._jvm.java.util.regex.Pattern.compile("\n")
    model = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel",
                                                         cut.split("\n".join(vocabulary)))
    return model.setInputCol(input_col).setOutputCol(output_col)


def _sql_str(w: str) -> str:
    return "'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _scaled_text_block(df: DataFrame, src: str, out: str, vocab_size: int, text=None, n_docs: int | None = None):
    """Stages producing ``out`` = min-max scaled count vector of ``src``
    without a vocabulary-wide dense array per row.  The vocabulary is the
    deterministic top ``vocab_size`` by count, ties by term, as in the long
    form; at most that many terms reach the driver.

    A term missing from at least one document has min 0, so its min-max
    value is tf / max: count vectors + ML ``MaxAbsScaler`` (it keeps vectors
    sparse) give exactly that.
    Terms of the vocabulary present in every document are taken out by a SQL
    stage and get an
    exact ML ``MinMaxScaler`` of their own; the two parts are assembled.  The
    block holds the same (term, value) cells as CountVectorizer +
    MinMaxScaler; the always-present terms sit at the end of the block.

    The scalers' extremes come with the vocabulary's counts: fitting them would
    read the texts again and gather vocabulary-wide vectors of all partitions
    in one task.  ``text``: the column of texts whose tokens ``src`` will be,
    and the stop words; ``df`` needn't have ``src`` then.  ``n_docs``: the rows
    of ``df``, if known.
    """
    n_docs = df.count() if n_docs is None else n_docs
    col, stops = text or (src, None)
    voc = vocabulary_by_threshold(df, col, vocab_size, stopwords=stops)
    # bounded by vocab_size, the model parameter
    rows = voc.orderBy("index").select("term", "df", "most", "least").collect()
    ubiq = sorted((r["term"], r["least"], r["most"]) for r in rows if r["df"] >= n_docs)
    terms = [r["term"] for r in rows if r["df"] < n_docs]
    always = [w for w, _, _ in ubiq]
    stages = []
    main = src
    if not terms:
        return [count_model(always, src, out + "_cv1"), _min_max_model(ubiq, out + "_cv1", out)]
    if ubiq:
        main = out + "_tok0"
        arr = "array(" + ", ".join(_sql_str(w) for w in always) + ")"
        stages.append(SQLTransformer(
            statement=f"SELECT *, filter({src}, t -> NOT array_contains({arr}, t)) AS {main} FROM __THIS__"))
    most = DenseVector([r["most"] for r in rows if r["df"] < n_docs])
    stages += [count_model(terms, main, out + "_cv0"),
               _fitted(MaxAbsScalerModel, out + "_cv0", out + "_s0" if ubiq else out, most)]
    if ubiq:
        stages += [count_model(always, src, out + "_cv1"),
                   _min_max_model(ubiq, out + "_cv1", out + "_s1"),
                   VectorAssembler(inputCols=[out + "_s0", out + "_s1"], outputCol=out)]
    return stages


def _fitted(kind, input_col: str, output_col: str, *extremes: DenseVector):
    """The scaler model ``kind`` with given extremes."""
    uid = f"{kind.__name__}_{uuid4().hex[:12]}"
    model = kind._create_from_java_class(f"org.apache.spark.ml.feature.{kind.__name__}", uid, *extremes)
    return model.setInputCol(input_col).setOutputCol(output_col)


def _min_max_model(extremes, input_col: str, output_col: str) -> MinMaxScalerModel:
    """The min-max scaler of count vectors, ``extremes`` being (term, least,
    most) in the order of the vector."""
    return _fitted(MinMaxScalerModel, input_col, output_col, DenseVector([lo for _, lo, _ in extremes]),
                   DenseVector([hi for _, _, hi in extremes]))


def feature_pipeline(df: DataFrame, variant: str = "count", vocab_size: int = DEFAULT_VOCAB,
                     stopwords=None, fit_df: DataFrame | None = None,
                     text_scaler: str = "sparse") -> PipelineModel:
    """Fit the feature pipeline on ``fit_df`` (default: ``df``) and return the
    fitted model.  ``df``/``fit_df`` are outputs of :func:`prepare`.

    variant ``count``: count vectors + min-max on title/body
    (``text_scaler='sparse'``: exact and sparse-preserving; ``'ml'``: ML
    MinMaxScaler over a deterministic vocabulary, dense per row); ``hash``:
    hashed term
    frequency for title/body, no scaling.  Tags and vote types are count
    vectors in both; the five scalars are min-max scaled by one scaler (one
    aggregate job) and sliced into blocks.
    """
    stops = stopwords if stopwords is not None else default_stopwords()
    fit_src = fit_df if fit_df is not None else df
    from quarry.session import write_table
    # every pass over the rows reads, and where scalars are made of them parses, whole texts: the
    # blocks without text are fitted on their few columns, written once
    short = write_table(fit_src.select("tags_a", "vote_type_id_a", *SCALARS), "fit_rows")
    n_docs = short.count()
    stages = [KeptWords("title", "filtered1", stops), KeptWords("body_s", "filtered2", stops)]
    if variant == "count":
        # the vocabularies find the words of titles and bodies themselves, once
        for text, src, mid, out in (("title", "filtered1", "title_cv", "title_f"), ("body_s", "filtered2", "body_cv", "body_f")):
            if text_scaler == "sparse":
                stages += _scaled_text_block(fit_src, src, out, vocab_size, (text, stops), n_docs)
            else:
                stages.append(count_model(_vocab_list(fit_src, text, vocab_size, stops), src, mid))
                stages.append(MinMaxScaler(inputCol=mid, outputCol=out))
    elif variant == "hash":
        stages += [HashingTF(inputCol="filtered1", outputCol="title_f", numFeatures=vocab_size),
                   HashingTF(inputCol="filtered2", outputCol="body_f", numFeatures=vocab_size)]
    else:
        raise ValueError(variant)
    for src, out in (("tags_a", "tags_f"), ("vote_type_id_a", "vote_type_id_f")):
        stages.append(CountVectorizer(inputCol=src, outputCol=out, vocabSize=vocab_size).fit(short))
    scalars = VectorAssembler(inputCols=SCALARS, outputCol="scalars_v")
    stages += [scalars, MinMaxScaler(inputCol="scalars_v", outputCol="scalars_f").fit(scalars.transform(short))]
    for i, c in enumerate(SCALARS):
        stages.append(VectorSlicer(inputCol="scalars_f", outputCol=c + "_f", indices=[i]))
    stages.append(VectorAssembler(inputCols=BLOCKS, outputCol="features"))
    return Pipeline(stages=stages).fit(fit_src)


def training_table(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(id, label double, features vector)."""
    return model.transform(df).select("id", "label", "features")


def hashing_tf_long(df: DataFrame, id_col: str, tokens_col: str,
                    num_features: int = DEFAULT_VOCAB) -> DataFrame:
    """Hashed term frequencies as (id, index, tf) without building the
    ``num_features``-wide vector.

    ``pmod(hash(term), n)`` is Spark SQL's murmur3 (seed 42), the bucket the
    Spark 2.x ``HashingTF`` of the reference assigned.  Spark >= 3 ML
    ``HashingTF`` uses a corrected murmur3 tail and places terms whose UTF-8
    length is not a multiple of 4 elsewhere (same distribution, other
    buckets); the vector form of the pipeline uses the ML transformer."""
    idx = F.pmod(F.hash(F.col("term")), F.lit(num_features)).alias("index")
    from quarry.functions.text import explode_items
    return (df.select(id_col, explode_items(F.col(tokens_col)).alias("term"))
            .where(F.col("term").isNotNull())
            .groupBy(id_col, idx).agg(F.count(F.lit(1)).cast("double").alias("tf")))


def hashing_tf_vectors(df: DataFrame, tokens_col: str, out_col: str = "features",
                       num_features: int = DEFAULT_VOCAB) -> DataFrame:
    """``df`` with the sparse count vector of its tokens' buckets, the buckets
    being those of :func:`hashing_tf_long` (the ML transformer of Spark 3 and
    later places most terms elsewhere).  A count vectorizer counts the bucket
    numbers, so no Python runs; a null list has a null vector."""
    buckets = "_buckets"
    hashed = F.transform(F.filter(F.col(tokens_col), lambda t: t.isNotNull()),
                         lambda t: F.pmod(F.hash(t), F.lit(num_features)).cast("string"))
    counter = count_model([str(i) for i in range(num_features)], buckets, out_col)
    got = counter.transform(df.withColumn(buckets, F.coalesce(hashed, F.array().cast("array<string>"))))
    vector = F.when(F.col(tokens_col).isNotNull(), F.col(out_col))
    # one metadata entry per bucket would travel with every plan
    return got.withColumn(out_col, vector.alias(out_col, metadata={})).drop(buckets)
