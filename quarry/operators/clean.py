"""Step 1 - clean: dedupe, attach the owner's reputation and the post's vote
types, label, and bring the answered and unanswered sets together.

Physical plan, designed for skewed votes, owners and duplicated rows:

1. ``vote_lists``: votes -> one row per post with the sorted distinct vote
   types.  ``collect_set`` is partially aggregated map-side, so a post holding
   a third of all votes ships at most (#vote types) values per map task.
2. ``attach_user``: posts x users on the owner key (inner; posts with an
   unknown or null owner vanish).  The users side is broadcast only when its
   size is proven small; otherwise (default ``skew='auto'``) owners holding
   a large share of the posts are split out and served by a broadcast of
   their few user rows, the rest is a shuffle join.
   Posts are made distinct before (``dedupe``): rows with text columns are
   compared by 128-bit fingerprints, and only rows whose fingerprint repeats
   are shuffled whole, so bodies are exchanged once, by post id; if many
   repeat, all are clustered by post id and made distinct there.  Users that
   aren't small are joined with the posts' ids and owners, so that join moves
   no bodies either.
3. ``attach_votes``: a join with the vote lists by post id (inner; posts
   without any vote row vanish), and the per-id version count as a window
   over that id clustering.
4. ``clean`` runs both labelled sets as one plan (tagged and unioned first).

The result equals the reference's join -> distinct -> collect_list -> re-join
-> distinct form, including the case of several distinct versions of one id
(each vote type then appears once per version).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.functions.casts import day_to_unix
from quarry.functions.text import pipe_join
from quarry.operators.joins import broadcast_if_small, hot_key_split_join


def dedupe(df: DataFrame, key: str | None = None) -> DataFrame:
    """Full-row distinct: in two phases where a column has variable width."""
    return distinct_wide(df, key) if any(f.dataType.simpleString() in ("string", "binary") for f in df.schema) \
        else df.distinct()


def _fingerprint(df: DataFrame):
    """Two 64-bit hashes of a row; equal rows have equal ones."""
    # a distinct takes 0.0 and -0.0 for equal
    cols = [F.col(f"`{c}`") + F.lit(0.0).cast(kind) if kind in ("float", "double") else F.col(f"`{c}`")
            for c, kind in df.dtypes]
    return F.struct(F.xxhash64(*cols).alias("f1"), F.xxhash64(F.lit("second"), *cols).alias("f2"))


#: copies of one row that aren't sent to one task
COPIES = 10_000


def distinct_wide(df: DataFrame, key: str | None = None) -> DataFrame:
    """Full-row distinct of rows with text columns.  First the rows' 128-bit
    fingerprints are counted (a shuffle of 16 bytes a row, partially
    aggregated); then only rows whose fingerprint repeats are compared whole
    with a distinct, all others pass without a shuffle.  If too many repeat to
    be broadcast and a later step clusters the rows by ``key``, they are
    clustered by it here and made distinct in place, so a row is shuffled once;
    rows with more than COPIES copies are made distinct before, since partial
    aggregation leaves few of those.  ``df`` is read twice.  Nested columns
    are left to the plain distinct."""
    if any("<" in kind for _, kind in df.dtypes):
        return df.distinct()
    from quarry.session import write_table
    counts = df.select(_fingerprint(df).alias("_fp")).groupBy("_fp.f1", "_fp.f2").agg(F.count(F.lit(1)).alias("n"))
    again = write_table(counts.where("n > 1").select("f1", "f2", "n"), "again")
    if again.isEmpty():
        return df
    marked = df.withColumn("_fp", _fingerprint(df))

    def parted(table):
        t = broadcast_if_small(table.select(F.col("f1").alias("_g1"), F.col("f2").alias("_g2")))
        same = (F.col("_fp.f1") == F.col("_g1")) & (F.col("_fp.f2") == F.col("_g2"))
        once, copies = (marked.join(t, same, how).drop("_fp") for how in ("left_anti", "left_semi"))
        return once.unionByName(copies.distinct())

    fingerprints = again.select("f1", "f2")
    if key is None or broadcast_if_small(fingerprints) is not fingerprints:
        return parted(fingerprints)
    hot = again.where(F.col("n") > COPIES)
    return (df if hot.isEmpty() else parted(write_table(hot, "hot"))).repartition(key).distinct()


def attach_user(posts: DataFrame, users: DataFrame, skew: str = "auto",
                user_key: str = "id", reputation: str = "reputation",
                owner: str = "owner_user_id") -> DataFrame:
    """posts + the owner's ``reputation`` (inner join on owner id).

    skew ``auto``: broadcast the users when their size is shown to be small,
    else split hot owners out (``hot_key_split_join``); ``split``: always
    split; ``aqe``: broadcast when small, else leave skew to AQE.
    """
    u = users.select(F.col(user_key).alias("_uid"), F.col(reputation).alias("reputation"))
    if skew == "split":
        j = hot_key_split_join(posts, u, owner, "_uid")
    else:
        ub = broadcast_if_small(u)
        if ub is u and skew == "auto":
            j = hot_key_split_join(posts, u, owner, "_uid")
        else:
            j = posts.join(ub, posts[owner] == ub["_uid"], "inner")
    return j.drop("_uid")


def vote_lists(votes: DataFrame, post_key: str = "post_id",
               vote_type: str = "vote_type_id") -> DataFrame:
    """post id -> sorted distinct non-null vote types (empty array when a post
    has only null vote types)."""
    return (votes.where(F.col(post_key).isNotNull())
            .groupBy(F.col(post_key).alias("_pid"))
            .agg(F.array_sort(F.collect_set(vote_type)).alias("_types")))


def attach_votes(posts_users: DataFrame, votes: DataFrame, key: str = "id",
                 post_key: str = "post_id", vote_type: str = "vote_type_id",
                 version_group=None, distinct: bool = False) -> DataFrame:
    """Distinct post rows + ``vote_type_id`` as ``a|b|c`` (posts without votes
    vanish).  ``distinct``: the rows are known to be.

    The join with the vote lists clusters the rows by post id, and the count
    of distinct versions per id is a window over that clustering (no further
    exchange).  ``version_group`` extends the id with columns that separate
    independent sets (e.g. ``label`` when both labelled sets run together).
    """
    group = [key] + list(version_group or [])
    versions = posts_users if distinct else posts_users.distinct()
    vl = vote_lists(votes, post_key, vote_type)
    j = versions.join(vl, versions[key] == vl["_pid"], "inner")
    # the join output is clustered by id: the version count needs no exchange
    j = j.withColumn("_k", F.count(F.lit(1)).over(Window.partitionBy(*group)))
    repeated = F.when(F.col("_k") == 1, F.col("_types")).otherwise(
        F.flatten(F.transform("_types", lambda t: F.array_repeat(t, F.col("_k").cast("int")))))
    cols = [c for c in posts_users.columns]
    return j.select(*cols, pipe_join(repeated).alias("vote_type_id"))


def label(df: DataFrame, value: int, date_col: str | None = "creation_date") -> DataFrame:
    """Add the constant ``label`` and turn the creation day into unix seconds."""
    out = df.withColumn("label", F.lit(value).cast("int"))
    if date_col and date_col in df.columns:
        out = out.withColumn(date_col, day_to_unix(F.col(date_col)))
    return out


def nonempty(df: DataFrame, col: str = "title") -> DataFrame:
    """Keep rows whose ``col`` is neither null nor ''."""
    return df.where(F.col(col) != "")


def _posts_users(posts: DataFrame, users: DataFrame, skew: str) -> DataFrame:
    """Distinct posts with their owners' distinct reputations: distinct rows.
    Users that can't be broadcast meet the posts' ids and owners only; whole
    posts are joined with those by id, the key of the vote lists."""
    rows, u = dedupe(posts, "id"), users.select("id", "reputation").distinct()
    if skew != "split" and broadcast_if_small(u) is not u:
        return attach_user(rows, u, skew=skew)
    ids = posts.select("id", F.col("owner_user_id")).where("id IS NOT NULL AND owner_user_id IS NOT NULL").distinct()
    owned = attach_user(ids, u, skew=skew).select(F.col("id").alias("_id"), F.col("owner_user_id").alias("_owner"), "reputation")
    # the owner is no key of the join, so that it clusters the rows by id alone
    owner = (F.col("owner_user_id") <= F.col("_owner")) & (F.col("owner_user_id") >= F.col("_owner"))
    return rows.join(owned, (F.col("id") == F.col("_id")) & owner).drop("_id", "_owner")


def clean_branch(posts: DataFrame, users: DataFrame, votes: DataFrame, value: int,
                 require_title: bool = False, skew: str = "auto") -> DataFrame:
    out = label(attach_votes(_posts_users(posts, users, skew), votes, distinct=True), value)
    # an id's versions are counted with the untitled ones; only then do those go
    return nonempty(out) if require_title else out


def clean(questions: DataFrame, answered: DataFrame, users: DataFrame, votes: DataFrame,
          skew: str = "auto") -> DataFrame:
    """Both labelled sets in one frame: label 0 = unanswered questions,
    label 1 = answered posts (answered rows with an empty title dropped, after
    the versions of their id are counted).

    The two sets run as one plan: they are tagged with their label and
    unioned first, so the user join, the vote-list aggregation and the
    shuffle by post id happen once; versions are counted per (id, label),
    which keeps the two sets independent exactly as two separate runs.
    """
    q = questions.withColumn("label", F.lit(0).cast("int"))
    a = answered.withColumn("label", F.lit(1).cast("int"))
    posts = q.unionByName(a)
    out = attach_votes(_posts_users(posts, users, skew), votes, version_group=["label"], distinct=True)
    out = out.where((F.col("label") == 0) | (F.col("title") != ""))
    cols = [c for c in out.columns if c not in ("vote_type_id", "label")]
    out = out.select(*cols, "vote_type_id", "label")
    if "creation_date" in out.columns:
        out = out.withColumn("creation_date", day_to_unix(F.col("creation_date")))
    return out
