"""Benchmark decontamination over a distributed positional inverted index.

The index is a written table of postings (document key, position, term) of
every training token that is a benchmark word; the pass that writes it also
counts every document's words.  Its term counts, over all documents, rank the
words of each benchmark window by rarity.  The lists of a window's rarest
words are shifted by the words' offsets and intersected, as one aggregation by
(window, document, block of shifted positions); the survivors are compared
word by word with the document.  Only DataFrame functions are used.

A window is ``width`` consecutive words of an item (an item of fewer words,
but not none, is one window).  A phrase match is a whole window.  A proximity
match is a window of two words or more whose two rarest words that any
document holds stand in the document less than ``NEAR`` words off the distance
they have in the window, and of whose distinct words ``CLOSE`` percent stand
between ``NEAR`` words before and ``NEAR`` words behind the place where the
window would start and end.  Blocks of starts overlap by half, so no close
pair lies across their edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.graph import fresh
from quarry.operators.joins import broadcast_if_small
from quarry.session import drop_table, write_table

#: words of a window whose lists are intersected before the comparison, and how
#: many words off counts as close (a block has RAREST * 2 * NEAR bits of a long)
RAREST, NEAR = 2, 16
#: percent of a window's distinct words that a proximity match has
CLOSE = 80

_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null has none."""
    cut = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _GAP)
    return F.array_remove(cut, "")


def _windows(bench: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    items = (bench.where(F.col(id_col).isNotNull())
             .select(F.col(id_col).cast("string").alias("item"),
                     words(F.col(text_col).cast("string")).alias("w")).where(F.size("w") > 0))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - width, F.lit(0)))
    return (items.select("item", "w", F.explode(starts).alias("s"))
            .select("item", F.slice("w", F.col("s") + 1, width).alias("phrase"))
            .select(F.xxhash64("phrase").alias("wid"), "item", "phrase").distinct())


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("k", F.xxhash64("id", "text"))


def _index(src: DataFrame, vocab: DataFrame) -> DataFrame:
    """Postings ``term, k, pos`` of the words in ``vocab``, and a row of
    ``pos`` -1 with the document's ``id`` and number of words per document."""
    w = words(F.col("text"))
    every = src.select("id", "k", w.alias("w")).select("id", "k", F.size("w").cast("bigint").alias("n_words"), "w")
    listed = F.concat(F.array(F.lit(None).cast("string")), F.col("w"))
    tokens = every.select("id", "k", "n_words", F.posexplode(listed).alias("at", "word")) \
        .select("id", "k", "n_words", (F.col("at") - 1).alias("pos"),
                F.when(F.col("at") > 0, F.xxhash64("word")).alias("term"))
    known = broadcast_if_small(vocab.withColumn("known", F.lit(True)))
    return write_table(tokens.join(known, "term", "left").where("known OR pos = -1").drop("known"), "postings")


def _search(src: DataFrame, bench: DataFrame, width: int, item_col: str, item_text: str):
    """(docs, found): ``id, k, n_words`` of every row and ``k, wid, item,
    start, kind`` of every match; ``k`` is a hash of the id and the text, so
    rows of equal ids are told apart."""
    wins = write_table(_windows(bench, item_col, item_text, width), "windows")
    phrases = write_table(wins.groupBy("wid").agg(F.first("phrase").alias("phrase")), "phrases")
    places = phrases.select("wid", F.posexplode("phrase").alias("off", "word")) \
        .select("wid", "off", F.xxhash64("word").alias("term"))
    vocab = write_table(places.select("term").distinct(), "vocab")
    index = _index(src, vocab)
    postings = index.where("pos >= 0").select("term", "k", "pos")
    df = write_table(postings.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "counts")
    by_window = Window.partitionBy("wid")
    # words that no document holds come last: the others are ranked
    ranked = (places.join(broadcast_if_small(df), "term", "left")
              .withColumn("rank", F.row_number().over(by_window.orderBy(F.col("n").asc_nulls_last(), "term", "off")) - 1)
              .withColumn("held", F.count("n").over(by_window)).withColumn("size", F.count(F.lit(1)).over(by_window))
              .withColumn("whole", F.col("held") == F.col("size"))
              .where(F.col("n").isNotNull() & (F.col("rank") < RAREST) & (F.col("whole") | (F.col("held") >= RAREST)))
              .select("wid", "term", "off", "rank", F.least("held", F.lit(RAREST)).cast("int").alias("need"), "whole"))
    ranked = write_table(ranked, "ranked")
    # the lists, shifted by the words' offsets; a block holds 2 * NEAR starts and one bit for each of them and
    # each rank, and every start is in two blocks, so one aggregation intersects the lists, exactly or closely
    start, half = F.col("pos") - F.col("off"), F.explode(F.array(F.lit(0), F.lit(1)))
    lists = postings.join(broadcast_if_small(ranked), "term").select("wid", "k", "rank", "need", "whole", start.alias("start"),
                                                                     half.alias("half"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"),
                          F.pmod("start", F.lit(NEAR)) + F.col("half") * NEAR + F.col("rank") * 2 * NEAR)
    mask = (1 << 2 * NEAR) - 1
    # most blocks hold one of the words only: they go before the masks are looked at
    met = write_table(
        lists.groupBy("wid", "k", (F.floor(F.col("start") / NEAR) - F.col("half")).alias("block"))
        .agg(F.bit_or(bit).alias("bits"), F.first("need").alias("need"), F.first("whole").alias("whole"))
        .select("wid", "k", "block", "need", "whole", F.col("bits").bitwiseAND(mask).alias("one"),
                F.call_function("shiftrightunsigned", F.col("bits"), F.lit(2 * NEAR)).alias("two"))
        .where("one <> 0 AND (need = 1 OR two <> 0)"), "met")
    spots = lambda bits: F.filter(F.sequence(F.lit(0), F.lit(2 * NEAR - 1)),
                                  lambda i: F.call_function("shiftright", bits, i).bitwiseAND(1) == 1)
    one, two = F.col("ones"), F.col("twos")
    # a phrase's start in the block's lower half, so that each is taken once
    placed = F.filter(one, lambda i: (i < NEAR) & F.col("whole") & ((F.col("need") == 1) | F.array_contains(two, i)))
    close = F.filter(one, lambda i: (F.col("need") == RAREST) & F.exists(two, lambda j: F.abs(i - j) < NEAR))
    met = (met.withColumn("ones", spots(F.col("one"))).withColumn("twos", spots(F.col("two")))
           .select("wid", "k", "block", placed.alias("placed"), close.alias("close")))
    each = lambda col, kind: met.select("k", "wid", F.lit(kind).alias("kind"), "block", F.explode(col).alias("i")) \
        .select("k", "wid", "kind", (F.col("block") * NEAR + F.col("i")).cast("int").alias("start"))
    cands = each("placed", "phrase").where("start >= 0").unionByName(each("close", "near").distinct())
    cands = write_table(cands.join(broadcast_if_small(phrases), "wid").select("k", "wid", "start", "kind", "phrase"), "cands")
    hit_keys = write_table(cands.select("k").distinct(), "hit_keys")
    # hash of (document, part) spreads a document's candidates, so no row holds them all
    texts = (src.join(broadcast_if_small(hit_keys), "k", "left_semi")
             .select("k", words(F.col("text")).alias("w")).dropDuplicates(["k"]))
    stretch = F.slice("w", F.greatest(F.col("start") - NEAR, F.lit(0)) + 1,
                      F.col("start") + F.size("phrase") + NEAR - F.greatest(F.col("start") - NEAR, F.lit(0)))
    distinct = F.array_distinct("phrase")
    enough = F.size(F.array_intersect(distinct, stretch)) * 100 >= F.size(distinct) * CLOSE
    exact = F.slice("w", F.col("start") + 1, F.size("phrase")) == F.col("phrase")
    right = F.when(F.col("kind") == "phrase", exact).otherwise((F.col("start") + F.size("phrase") + NEAR > 0) & enough)
    found = cands.join(texts, "k").where(right).select("k", "wid", "start", "kind", F.size("phrase").alias("size"))
    found = write_table(found.join(broadcast_if_small(wins.select("wid", "item")), "wid"), "found")
    drop_table(cands, hit_keys, vocab, df, ranked, wins, phrases)
    return index.where("pos = -1").select("id", "k", "n_words"), found


def matches(docs: DataFrame, bench: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Every match: ``id_col, item, start, n_words, kind``: the word of the
    document that the window starts at, the window's words, and ``phrase`` or
    ``near`` (where a near window would start is given by its rarest word and
    may lie before the text).  Each start of a phrase that an item has is one
    row; a phrase is near as well.  Edge cases as in :func:`contamination`."""
    docs_, found = _search(_source(docs, id_col, text_col), bench, width, item_col, item_text)
    return docs_.join(broadcast_if_small(found), "k").select(
        F.col("id").alias(id_col), "item", "start", F.col("size").alias("n_words"), "kind")


def _per_document(found: DataFrame) -> DataFrame:
    """``k, n_hit, items, n_close`` of the documents with any match."""
    phrases = found.where("kind = 'phrase'")
    places = phrases.select("k", F.explode(F.sequence("start", F.col("start") + F.col("size") - 1)).alias("at")).distinct()
    hits = places.groupBy("k").agg(F.count(F.lit(1)).alias("n_hit"))
    items = phrases.groupBy("k").agg(F.sort_array(F.collect_set("item")).alias("items"))
    close = found.select("k", "item").distinct().groupBy("k").agg(F.count(F.lit(1)).alias("n_close"))
    return write_table(hits.join(items, "k").join(close, "k", "full"), "result")


def contamination(docs: DataFrame, bench: DataFrame, width: int = 10, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id_col, n_words, n_hit, n_items, items_sha256,
    contaminated, n_near``; ``n_near`` counts the items with a phrase or
    proximity match.

    Edge cases: a null or empty text has no words and no hits; a null id
    keeps its row; rows that share an id are judged each by their own text;
    items without words or without id are no items, items that share an id
    are one; other columns aren't read; an empty benchmark gives zeros, an
    empty ``docs`` an empty result."""
    out, found = _search(_source(docs, id_col, text_col), bench, width, item_col, item_text)
    result = _per_document(found)
    zero = F.lit(0).cast("bigint")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.join(broadcast_if_small(result), "k", "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", zero).alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
        F.coalesce("n_close", zero).alias("n_near"))


def clean(docs: DataFrame, bench: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without a benchmark window."""
    _, found = _search(_source(docs, id_col, text_col), bench, width, item_col, item_text)
    hit = fresh(docs, "hit_key")
    hits = write_table(found.where("kind = 'phrase'").select(F.col("k").alias(hit)).distinct(), "hits")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.join(broadcast_if_small(hits), F.xxhash64(F.col(id_col), text) == F.col(hit), "left_anti")
