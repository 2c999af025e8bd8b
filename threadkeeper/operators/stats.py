"""Statistics: database totals, per-run counters, dry-run report.

AGG-2..10, TOP-3.  All are partial (map-side) aggregations; a source that
holds a third of all rows only makes one of a few small groups bigger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadkeeper.functions.columns import preview

# Run counters and the action outcomes that feed them.
COUNTERS = [
    "posts_scraped", "new_posts", "updated_posts", "frozen_posts", "posts_deleted",
    "documents_ingested", "documents_reingested", "skipped_unchanged", "sync_errors", "queued_for_retry",
]


def db_totals(tracked: DataFrame, comments: DataFrame, queue: DataFrame) -> DataFrame:
    """AGG-2, AGG-5, AGG-6: one row of totals (three aggregates, no join)."""
    t = tracked.agg(F.count(F.lit(1)).alias("total_tracked"))
    c = comments.agg(F.count(F.lit(1)).alias("total_comments"))
    q = queue.agg(F.count_if(F.col("attempts") < F.col("max_attempts")).alias("queue_pending"))
    return t.select("total_tracked", c.select("total_comments").scalar().alias("total_comments"),
                    q.select("queue_pending").scalar().alias("queue_pending"))


def by_status(tracked: DataFrame) -> DataFrame:
    """AGG-3."""
    return tracked.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def by_subreddit(tracked: DataFrame) -> DataFrame:
    """AGG-4."""
    return tracked.groupBy("subreddit").agg(F.count(F.lit(1)).alias("n"))


def db_stats(tracked: DataFrame, comments: DataFrame, queue: DataFrame) -> DataFrame:
    """AGG-2..6 as one row with the two maps (long-form rows first)."""
    st = by_status(tracked).agg(F.map_from_entries(F.collect_list(F.struct("status", "n"))).alias("by_status"))
    sb = by_subreddit(tracked).agg(F.map_from_entries(F.collect_list(F.struct("subreddit", "n"))).alias("by_subreddit"))
    tot = db_totals(tracked, comments, queue)
    return tot.select(
        "total_tracked",
        st.select("by_status").scalar().alias("by_status"),
        sb.select("by_subreddit").scalar().alias("by_subreddit"),
        "total_comments",
        "queue_pending",
    )


def run_counters(actions: DataFrame) -> DataFrame:
    """AGG-8: the ten counters from the action table, one aggregate.

    ``actions`` has one row per (phase, post) with boolean outcome columns
    named like the counters.
    """
    return actions.agg(*[F.count_if(F.col(c)).cast("bigint").alias(c) for c in COUNTERS])


def run_summary(counters: DataFrame, started_micros: int, completed_micros: int | None) -> DataFrame:
    """AGG-9: counters plus the run's start, end and duration (null if not completed)."""
    started = F.timestamp_micros(F.lit(started_micros))
    completed = F.timestamp_micros(F.lit(completed_micros)) if completed_micros is not None else F.lit(None).cast("timestamp")
    dur = (F.unix_micros(completed) - F.unix_micros(started)) / F.lit(1_000_000.0)
    return counters.select(started.alias("started_at"), completed.alias("completed_at"), dur.alias("duration_seconds"), *COUNTERS)


def scraped_new_by_subreddit(observed: DataFrame, newly_tracked: DataFrame) -> DataFrame:
    """AGG-7: scraped counts every observed post; new counts those newly
    tracked with a document id."""
    n = newly_tracked.where(F.col("contextual_doc_id").isNotNull()).select(F.col("post_id").alias("id"), F.lit(True).alias("_new"))
    j = observed.select("id", "subreddit").join(n, "id", "left")
    return j.groupBy("subreddit").agg(F.count(F.lit(1)).alias("scraped"), F.count_if(F.col("_new").isNotNull()).alias("new"))


def dry_run_report(observed: DataFrame) -> DataFrame:
    """AGG-10: observed posts per source, largest first."""
    return observed.groupBy("subreddit").agg(F.count(F.lit(1)).alias("posts")).orderBy(F.col("posts").desc(), "subreddit")


def dry_run_sample(observed: DataFrame, n: int = 5) -> DataFrame:
    """TOP-3: first ``n`` posts (newest first) with a title preview."""
    return (
        observed.orderBy(F.col("created_utc").desc(), F.col("id"))
        .limit(n)
        .select("id", "subreddit", preview("title", 60).alias("title_preview"), "score", "num_comments")
    )
