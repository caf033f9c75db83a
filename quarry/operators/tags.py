"""Step 2 - tags: segment glued tag strings with a tag dictionary.

The segmentation column is computed in place (no join back on id).  The
dictionary is compiled into one trie regex (``functions.segment``) after a
size check: it must stay below ``max_dictionary_chars`` characters, the bound
that makes shipping it with the plan safe.  Beyond that bound
``segment_trie`` builds a double-array trie once (``functions.trie``, about
10 bytes per trie state), broadcasts it and walks whole Arrow batches of
strings through it; nothing is shuffled.  Beyond ``MAX_TRIE_CHARS``
``segment_distributed`` computes the same result with joins and shuffles
only: every (string, position, length) candidate piece is matched against
the dictionary with an equi-join, the longest match per position is kept,
and the greedy walk runs as a higher-order ``aggregate`` over each string's
positions.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import trie as TR
from quarry.functions.segment import (dictionary_regex, forward_pieces, reverse_pieces,
                                      segment_tags)
from quarry.functions.text import pipe_join

#: dictionary bound for the regex path (characters over all tags)
MAX_DICTIONARY_CHARS = 4_000_000

#: dictionary bound for the trie path (characters over all tags)
MAX_TRIE_CHARS = 64_000_000

SENTINEL = "*****"


def tag_dictionary(tags: DataFrame, col: str = "tag_name") -> DataFrame:
    """Distinct, non-null, non-empty tag names as ``tag_name`` (a null or
    empty tag would never advance the segmentation)."""
    return (tags.select(F.col(col).cast("string").alias("tag_name"))
            .where(F.col("tag_name").isNotNull() & (F.length("tag_name") > 0)).distinct())


def dictionary_sorted(tags: DataFrame) -> DataFrame:
    """(rank, tag_name): longest first, ties by name - the matching priority."""
    from quarry.operators.features import rank_global
    d = tag_dictionary(tags)
    return rank_global(d, [F.length("tag_name").desc(), F.col("tag_name").asc()],
                       index_col="rank")


def dictionary_words(tags: DataFrame, max_chars: int = MAX_DICTIONARY_CHARS) -> list[str]:
    """The dictionary as a list, after proving its size below ``max_chars``."""
    d = tag_dictionary(tags)
    stats = d.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("tag_name")).alias("chars")).first()
    if (stats["chars"] or 0) > max_chars:
        raise OverflowError(f"tag dictionary has {stats['chars']} chars > {max_chars}; "
                            "use segment_distributed")
    return [r["tag_name"] for r in d.collect()]


def _fail(on_fail: str):
    if on_fail == "sentinel":
        return F.lit(SENTINEL)
    return F.lit(None).cast("string")


def segment(df: DataFrame, tags: DataFrame, col: str = "tags", out: str = "split_tags",
            on_fail: str = "drop", passes: str = "both", as_array: bool = False,
            with_pass: bool = False, max_chars: int = MAX_DICTIONARY_CHARS) -> DataFrame:
    """Add ``out`` = the segmentation of ``col`` as ``a|b|c`` (or an array).

    passes: ``both`` (forward, then reverse on failure) or ``forward``.
    on_fail: ``drop`` the row, ``null``, or the ``sentinel`` string.
    """
    try:
        words = dictionary_words(tags, max_chars)
    except OverflowError:
        try:
            return segment_trie(df, tags, col, out, on_fail, passes, as_array, with_pass)
        except OverflowError:
            return segment_distributed(df, tags, col, out, on_fail, passes, as_array, with_pass)
    s = F.col(col)
    if passes == "forward":
        fwd = forward_pieces(s, dictionary_regex(words))
        ok = F.length(s) > 0
        arr = F.when(ok & (F.length(F.array_join(fwd, "")) == F.length(s)), fwd)
        how = F.when(arr.isNotNull(), F.lit("forward"))
    else:
        arr, how = segment_tags(s, words, with_pass=True)
    val = arr if as_array else pipe_join(arr)
    res = df.withColumn(out, val)
    if with_pass:
        res = res.withColumn("pass", how)
    return _failed(res, out, on_fail, as_array)


def _failed(res: DataFrame, out: str, on_fail: str, as_array: bool) -> DataFrame:
    if on_fail == "drop":
        return res.where(F.col(out).isNotNull())
    if on_fail == "sentinel" and not as_array:
        return res.withColumn(out, F.coalesce(F.col(out), _fail(on_fail)))
    return res


def segment_trie(df: DataFrame, tags: DataFrame, col: str = "tags", out: str = "split_tags",
                 on_fail: str = "drop", passes: str = "both", as_array: bool = False,
                 with_pass: bool = False, max_chars: int = MAX_TRIE_CHARS) -> DataFrame:
    """Segmentation by a double-array trie, one for each pass, broadcast after
    the size check of the dictionary.  The strings stay where they are: each
    Arrow batch of the one column is walked as a whole.

    Null and empty strings fail, as in :func:`segment`; other columns aren't
    touched; an empty dictionary fails every string."""
    words = [w.encode() for w in dictionary_words(tags, max_chars)]
    send = df.sparkSession.sparkContext.broadcast
    forward = send(TR.build(words))
    backward = send(TR.build([w[::-1] for w in words])) if passes == "both" else None

    @F.arrow_udf("pieces array<string>, how string")
    def walk(s: pa.Array) -> pa.Array:
        pieces, how = TR.segment(s, forward.value, backward.value if backward else None)
        return pa.StructArray.from_arrays([pieces, how], names=["pieces", "how"])

    found = "_segmented"
    res = df.withColumn(found, walk(F.col(col).cast("string")))
    pieces = F.col(f"{found}.pieces")
    res = res.withColumn(out, pieces if as_array else pipe_join(pieces))
    if with_pass:
        res = res.withColumn("pass", F.col(f"{found}.how"))
    return _failed(res.drop(found), out, on_fail, as_array)


def segment_distributed(df: DataFrame, tags: DataFrame, col: str = "tags",
                        out: str = "split_tags", on_fail: str = "drop",
                        passes: str = "both", as_array: bool = False,
                        with_pass: bool = False) -> DataFrame:
    """Join-based segmentation for dictionaries too large to ship as a regex.

    Work is done once per distinct tag string (many posts share one) and the
    result is joined back on the string.
    """
    d = tag_dictionary(tags)
    # the lengths that tags have: at most as many numbers as the longest tag has characters
    sizes = sorted(r[0] for r in d.select(F.length("tag_name")).distinct().collect())
    sizes = F.array(*map(F.lit, sizes)) if sizes else F.array().cast("array<int>")
    strings = df.select(F.col(col).alias("_s")).where(F.length("_s") > 0).distinct()

    def longest(strings: DataFrame, direction: str) -> DataFrame:
        # candidate pieces: every position x every length that a tag has
        pos = F.explode(F.sequence(F.lit(1), F.length("_s"))).alias("_p")
        cand = strings.select("_s", pos).select(
            "_s", "_p", F.explode(sizes).alias("_l"))
        if direction == "fwd":
            cand = cand.where(F.col("_p") + F.col("_l") - 1 <= F.length("_s")).withColumn(
                "_piece", F.substring("_s", F.col("_p"), F.col("_l")))
        else:  # _p is the 1-based end position
            cand = cand.where(F.col("_p") - F.col("_l") >= 0).withColumn(
                "_piece", F.substring("_s", F.col("_p") - F.col("_l") + 1, F.col("_l")))
        hit = cand.join(d, cand["_piece"] == d["tag_name"], "left_semi")
        return hit.groupBy("_s", "_p").agg(F.max("_l").alias("_l"))

    def walk(hits: DataFrame, direction: str) -> DataFrame:
        # per string: map position -> longest length, then a greedy walk
        m = hits.groupBy("_s").agg(F.map_from_entries(F.collect_list(F.struct("_p", "_l"))).alias("_m"))
        n = F.length("_s")
        start = F.lit(1) if direction == "fwd" else n
        init = F.struct(start.alias("at"), F.array().cast("array<string>").alias("pieces"),
                        F.lit(True).alias("ok"))

        def step(acc, _):
            at = acc["at"]
            length = F.element_at(F.col("_m"), at)
            done = (at > n) if direction == "fwd" else (at < 1)
            go = acc["ok"] & ~done
            piece = (F.substring("_s", at, length) if direction == "fwd"
                     else F.substring("_s", at - length + 1, length))
            return F.when(~go, acc).when(length.isNull(),
                                          F.struct(at.alias("at"), acc["pieces"].alias("pieces"),
                                                   F.lit(False).alias("ok"))).otherwise(
                F.struct((at + length if direction == "fwd" else at - length).alias("at"),
                         (F.concat(acc["pieces"], F.array(piece)) if direction == "fwd"
                          else F.concat(F.array(piece), acc["pieces"])).alias("pieces"),
                         F.lit(True).alias("ok")))

        res = F.aggregate(F.sequence(F.lit(1), n), init, step)
        return m.select("_s", F.when(res["ok"], res["pieces"]).alias("_arr_" + direction))

    fwd = walk(longest(strings, "fwd"), "fwd").where(F.col("_arr_fwd").isNotNull())
    seg = fwd.select("_s", F.col("_arr_fwd").alias("_arr"), F.lit("forward").alias("pass"))
    if passes == "both":
        # the reverse pass only where the forward one failed
        from quarry.session import write_table
        seg = write_table(seg, "forward")
        failed = strings.join(seg, "_s", "left_anti")
        rev = walk(longest(failed, "rev"), "rev").where(F.col("_arr_rev").isNotNull())
        seg = seg.unionByName(rev.select("_s", F.col("_arr_rev").alias("_arr"), F.lit("reverse").alias("pass")))
    val = F.col("_arr") if as_array else pipe_join(F.col("_arr"))
    seg = seg.select("_s", val.alias(out), *(["pass"] if with_pass else []))
    # one row per distinct tag string; broadcast when shown small, else a
    # shuffle join (a hot tag string is split by AQE's skew handling)
    from quarry.operators.joins import broadcast_if_small
    seg = broadcast_if_small(seg)
    return _failed(df.join(seg, df[col] == seg["_s"], "left").drop("_s"), out, on_fail, as_array)


def prefix_matches(df: DataFrame, tags: DataFrame, col: str = "tags",
                   max_chars: int = MAX_DICTIONARY_CHARS) -> DataFrame:
    """(row, tag_name) for every dictionary tag that ``col`` starts with.

    A dictionary of at most ``max_chars`` characters (counted) is broadcast:
    every prefix of the string up to the longest tag is a hash lookup.  A
    larger one is merged with the strings in order (:func:`prefix_merge`).
    """
    d = tag_dictionary(tags)
    size = d.agg(F.max(F.length("tag_name")).alias("longest"), F.sum(F.length("tag_name")).alias("chars")).first()
    if (size["chars"] or 0) > max_chars:
        return prefix_merge(df, tags, col)
    from quarry.functions.text import explode_items
    pre = df.withColumn("_l", explode_items(F.sequence(F.lit(1), F.least(F.length(col),
                                                                          F.lit(size["longest"] or 0)))))
    pre = pre.where(F.col("_l").isNotNull()).withColumn("_pre", F.substring(col, 1, F.col("_l")))
    return pre.join(F.broadcast(d), pre["_pre"] == d["tag_name"], "inner").drop("_l", "_pre")


#: sampled texts per partition that the cuts of a merge are taken from
CUT_SAMPLE = 64


def _cuts(texts: DataFrame, parts: int) -> list[bytes]:
    """Texts that cut the rows into ``parts`` ranges of about equal size, of a
    bounded sample (ordered by a hash of text and row, so a text stands in it
    as often as in the rows); a text of many rows is a cut several times.
    They decide where rows go, never what is found."""
    deal = F.xxhash64("text", F.monotonically_increasing_id())
    sample = sorted(r["text"].encode() for r in
                    texts.select("text", deal.alias("h")).orderBy("h").limit(CUT_SAMPLE * parts).collect())
    return [sample[k * len(sample) // parts] for k in range(1, parts)] if sample else []


def _merge_task(batches):
    """Rows sorted by part, text and role (tags first): a stack holds the tags
    that are prefixes of the text last read."""
    part, stack = None, []
    for batch in batches:
        rows, found = [], []
        for i, (p, text, is_text) in enumerate(zip(batch.column("part").to_pylist(), batch.column("text").to_pylist(),
                                                   batch.column("is_text").to_pylist(), strict=True)):
            if p != part:
                part, stack = p, []
            while stack and not text.startswith(stack[-1]):
                stack.pop()
            if not is_text:
                stack.append(text)
            else:
                rows += [i] * len(stack)
                found += stack
        yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(rows, pa.int64())),
                                          pa.array(found, pa.string())], names=["row", "tag_name"])


def prefix_merge(df: DataFrame, tags: DataFrame, col: str = "tags") -> DataFrame:
    """The rows of :func:`prefix_matches` by one range-partitioned merge.

    Strings and tags are sorted together in string order; a tag that is a
    prefix of a string stands before it, and between the two stand only
    strings that begin with that tag, so one stack of open prefixes per range
    finds all matches.  A tag that a range's first string may begin with is
    sent to that range as well: per range at most as many tags as the longest
    one has characters.  So the rows moved are the strings, the tags and those
    few.  A string that holds a large share of the rows covers several ranges
    and is dealt over them.  Null and empty strings match nothing."""
    d = tag_dictionary(tags).select(F.col("tag_name").alias("text"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = df.where(F.length(col) > 0).select(F.col(col).cast("string").alias("text"), F.struct("*").alias("row"))
    cuts = _cuts(texts.select("text"), parts)

    def first_and_last(last):
        @F.arrow_udf("first int, last int")
        def ranges(text: pa.Array) -> pa.Array:
            keys = [t.encode() for t in text.to_pylist()]
            low = [bisect_left(cuts, k) for k in keys]
            return pa.StructArray.from_arrays([pa.array(low, pa.int32()), pa.array([last(k) for k in keys], pa.int32())],
                                              names=["first", "last"])
        return ranges(F.col("text"))

    # no valid text has a byte 0xFF: everything that begins with k is below k + 0xFF
    of_tags = d.withColumn("at", first_and_last(lambda k: bisect_left(cuts, k + b"\xff")))
    of_texts = texts.withColumn("at", first_and_last(lambda k: bisect_right(cuts, k)))
    deal = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("at.last") - F.col("at.first") + 1)
    kind = of_texts.schema["row"].dataType
    rows = of_texts.select((F.col("at.first") + deal).cast("int").alias("part"), "text", F.lit(True).alias("is_text"), "row")
    marks = of_tags.select(F.explode(F.sequence("at.first", "at.last")).alias("part"), "text",
                           F.lit(False).alias("is_text"), F.lit(None).cast(kind).alias("row"))
    merged = (marks.unionByName(rows).repartition(parts, "part").sortWithinPartitions("part", "text", "is_text")
              .mapInArrow(_merge_task, f"row {kind.simpleString()}, tag_name string"))
    return merged.select("row.*", "tag_name")
