"""Keyed state mutations as pure functions (old table, delta) -> new table.

MUT-1..5 and MUT-9.  Plain Parquet has no MERGE, so each upsert is a
full-outer join on the key with a per-column rule; deletes are anti-joins.
Both sides are shuffled on the key once; AQE splits skewed key partitions
and turns a side into a broadcast only when its measured size is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadkeeper.functions.columns import run_ts_lit
from threadkeeper.params import STATUS_FROZEN, SyncParams
from threadkeeper.schemas import CACHED_COMMENT_COLS, CACHED_POST_COLS, TRACKED_COLS


def _merge(old: DataFrame, new: DataFrame, key: str, cols: list[str], take_new: set[str], coalesce_new: set[str] = frozenset()) -> DataFrame:
    o = old.select(*[F.col(c).alias("o_" + c) for c in cols]).withColumn("o_present", F.lit(True))
    n = new.select(*[F.col(c).alias("n_" + c) for c in cols]).withColumn("n_present", F.lit(True))
    j = o.join(n, F.col("o_" + key) == F.col("n_" + key), "full_outer")
    out = []
    for c in cols:
        oc, nc = F.col("o_" + c), F.col("n_" + c)
        if c == key:
            e = F.coalesce(oc, nc)
        elif c in coalesce_new:
            e = F.when(F.col("n_present").isNull(), oc).otherwise(F.coalesce(nc, oc))
        elif c in take_new:
            e = F.when(F.col("n_present").isNull(), oc).otherwise(nc)
        else:  # first value wins on conflict
            e = F.when(F.col("o_present").isNull(), nc).otherwise(oc)
        out.append(e.alias(c))
    return j.select(*out)


def upsert_tracked(tracked: DataFrame, delta: DataFrame) -> DataFrame:
    """MUT-1: replace last_updated, update_count, status, content_hash; doc id
    = coalesce(new, old); keep subreddit, created_utc, first_scraped."""
    return _merge(
        tracked, delta, "post_id", TRACKED_COLS,
        take_new={"last_updated", "update_count", "status", "content_hash"},
        coalesce_new={"contextual_doc_id"},
    )


POST_VOLATILE = {"score", "upvote_ratio", "num_comments", "last_updated", "update_count"}


def upsert_posts(posts: DataFrame, delta: DataFrame, refresh_content: bool = False) -> DataFrame:
    """MUT-2: on conflict replace score, ratio, comment count, last_updated and
    update_count; text, author and flair keep their first values unless
    ``refresh_content`` (decision Q5, used by re-ingest and repair)."""
    take = set(CACHED_POST_COLS) - {"id", "scraped_at"} if refresh_content else POST_VOLATILE
    return _merge(posts, delta, "id", CACHED_POST_COLS, take_new=take)


def replace_comments(comments: DataFrame, saved_ids: DataFrame, new_comments: DataFrame) -> DataFrame:
    """MUT-3: all comments of saved posts are replaced by the new set."""
    keep = comments.join(saved_ids.select(F.col("id").alias("post_id")).distinct(), "post_id", "left_anti")
    return keep.select(*CACHED_COMMENT_COLS).unionByName(new_comments.select(*CACHED_COMMENT_COLS))


def delete_cascade(posts: DataFrame, comments: DataFrame, tracked: DataFrame, ids: DataFrame):
    """MUT-4: remove comments, post and tracked row of every id in ``ids``.
    Returns (posts, comments, tracked, deleted) where ``deleted`` holds
    (post_id, existed) telling whether a tracked row existed."""
    k = ids.select("post_id").distinct()
    existed = k.join(tracked.select("post_id").withColumn("existed", F.lit(True)), "post_id", "left").select(
        "post_id", F.coalesce(F.col("existed"), F.lit(False)).alias("existed")
    )
    return (
        posts.join(k.withColumnRenamed("post_id", "id"), "id", "left_anti"),
        comments.join(k, "post_id", "left_anti"),
        tracked.join(k, "post_id", "left_anti"),
        existed,
    )


def due_for_freeze(tracked: DataFrame, params: SyncParams):
    """FLT-7."""
    return (F.col("status") != STATUS_FROZEN) & (F.col("update_count") >= params.freeze_at_count)


def freeze(tracked: DataFrame, params: SyncParams) -> DataFrame:
    """MUT-5 / LIFE-7: status frozen and last_updated = run time for due rows."""
    due = due_for_freeze(tracked, params)
    run = run_ts_lit(params.run_micros)
    return tracked.select(
        *[
            F.when(due, F.lit(STATUS_FROZEN)).otherwise(F.col(c)).alias(c)
            if c == "status"
            else F.when(due, run).otherwise(F.col(c)).alias(c)
            if c == "last_updated"
            else F.col(c)
            for c in TRACKED_COLS
        ]
    )


def retention(posts: DataFrame, comments: DataFrame, tracked: DataFrame, params: SyncParams):
    """MUT-9: purge rows first scraped before run - days (strict), then posts
    no remaining tracked row refers to, with their comments (the comment rows
    cascade with their post).  Nothing happens when no tracked row expired
    (orphans then stay) or when days <= 0.

    Returns (posts, comments, tracked, removed_count_column_df).  The "any
    expired" guard is a scalar subquery, so the plan stays lazy.
    """
    if params.cleanup_after_days <= 0:
        return posts, comments, tracked
    cutoff = run_ts_lit(params.run_micros) - F.make_dt_interval(F.lit(params.cleanup_after_days))
    expired = tracked.where(F.col("first_scraped") < cutoff).select("post_id")
    any_expired = expired.select((F.count(F.lit(1)) > 0).alias("x")).scalar()
    new_tracked = tracked.join(expired, "post_id", "left_anti")
    remaining = new_tracked.select(F.col("post_id").alias("id"), F.lit(True).alias("_tracked"))
    flagged = posts.join(remaining, "id", "left")
    new_posts = flagged.where(~any_expired | F.col("_tracked").isNotNull()).drop("_tracked")
    # comments go with expired posts and, by the cascade, with purged orphans
    orphans = flagged.where(any_expired & F.col("_tracked").isNull()).select(F.col("id").alias("post_id"))
    new_comments = comments.join(expired.unionByName(orphans), "post_id", "left_anti")
    return new_posts, new_comments, new_tracked
