"""Durable retry queue: enqueue, due batch, success, failure with backoff.

MUT-6..8, FLT-9, TOP-1.  The queue key is (post_id, action); the surrogate
``id`` of a new row is a hash of that key, so ids are assigned in parallel
without a global counter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadkeeper.functions.columns import run_ts_lit
from threadkeeper.params import SyncParams
from threadkeeper.schemas import QUEUE_COLS

KEY = ["post_id", "action"]


def enqueue(queue: DataFrame, requests: DataFrame, params: SyncParams) -> DataFrame:
    """MUT-6: insert, or on key conflict raise the priority to the larger one;
    attempts, schedule and creation time stay as they were."""
    run = run_ts_lit(params.run_micros)
    req = requests.groupBy(*KEY).agg(F.min("subreddit").alias("n_subreddit"), F.max("priority").alias("n_priority"))
    j = queue.join(req, KEY, "full_outer")
    new = F.col("id").isNull() & F.col("subreddit").isNull() & F.col("n_priority").isNotNull()
    return j.select(
        F.when(new, F.abs(F.xxhash64(*KEY))).otherwise(F.col("id")).alias("id"),
        "post_id",
        F.coalesce(F.col("subreddit"), F.col("n_subreddit")).alias("subreddit"),
        "action",
        F.when(new, F.col("n_priority"))
        .when(F.col("n_priority").isNotNull(), F.greatest("priority", "n_priority"))
        .otherwise(F.col("priority"))
        .cast("int")
        .alias("priority"),
        F.when(new, F.lit(0)).otherwise(F.col("attempts")).cast("int").alias("attempts"),
        F.when(new, F.lit(params.queue_max_attempts)).otherwise(F.col("max_attempts")).cast("int").alias("max_attempts"),
        F.when(new, F.lit(None).cast("string")).otherwise(F.col("last_error")).alias("last_error"),
        F.when(new, run).otherwise(F.col("created_at")).alias("created_at"),
        F.when(new, run).otherwise(F.col("scheduled_for")).alias("scheduled_for"),
    )


def is_due(params: SyncParams):
    """FLT-9: attempts left and scheduled at or before the run time."""
    return (F.col("attempts") < F.col("max_attempts")) & (F.col("scheduled_for") <= run_ts_lit(params.run_micros))


def due_batch(queue: DataFrame, params: SyncParams) -> DataFrame:
    """Due items: all of them, or with ``queue_limit`` the first ones by
    priority desc, oldest first (TOP-1).

    With a limit this is a global top-k: each partition keeps its best rows
    and only those are merged (TakeOrderedAndProject), so no full sort.
    """
    due = queue.where(is_due(params))
    if params.queue_limit is None:
        return due
    order = [F.col("priority").desc(), F.col("created_at").asc(), F.col("post_id").asc(), F.col("action").asc()]
    return due.orderBy(*order).limit(params.queue_limit)


def mark_success(queue: DataFrame, done: DataFrame) -> DataFrame:
    """MUT-7: processed items leave the queue."""
    return queue.join(done.select(*KEY).distinct(), KEY, "left_anti")


def mark_failure(queue: DataFrame, failed: DataFrame, params: SyncParams) -> DataFrame:
    """MUT-8: attempts + 1, last error, next try after 5·2^attempts minutes
    (5, 10, 20, 40, 80)."""
    run = run_ts_lit(params.run_micros)
    f = failed.groupBy(*KEY).agg(F.max("error").alias("f_error")).withColumn("f_hit", F.lit(True))
    j = queue.join(f, KEY, "left")
    hit = F.col("f_hit").isNotNull()
    delay = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(params.queue_backoff_minutes) * F.pow(F.lit(2), F.col("attempts")).cast("int"))
    return j.select(
        "id",
        "post_id",
        "subreddit",
        "action",
        "priority",
        F.when(hit, F.col("attempts") + 1).otherwise(F.col("attempts")).cast("int").alias("attempts"),
        "max_attempts",
        F.when(hit, F.col("f_error")).otherwise(F.col("last_error")).alias("last_error"),
        "created_at",
        F.when(hit, run + delay).otherwise(F.col("scheduled_for")).alias("scheduled_for"),
    ).select(*QUEUE_COLS)
