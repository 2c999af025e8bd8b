"""Run inputs derived from the driver tables.

Each scenario gives the state before a run, the landed snapshot and the
delivery results, all computed by Spark from the tables (integer rules on
keys), so the work of every lifecycle query grows with the data.

* docs:   documents -> stored state + changed refresh snapshot (classifier)
* conv:   conversations -> intake with comments, part already tracked
* events: events -> retry queue, tracked rows and cached posts
* orders: orders + lineitem -> a full run at scale (benchmark)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadkeeper.functions import columns as C
from threadkeeper.functions.fingerprint import content_hash
from threadkeeper.params import DOC_ID_PREFIX, SITE, SyncParams
from threadkeeper.plans.lifecycle import Observation, State, observe, refresh_ids
from threadkeeper.session import cut_buckets, cut_lineage
from threadkeeper.schemas import (
    CACHED_COMMENT_COLS,
    CACHED_POST_COLS,
    QUEUE_SCHEMA,
    RAW_COMMENT_SCHEMA,
    SINK_RESULT_SCHEMA,
    TRACKED_COLS,
)
from threadkeeper.sources import adapters as A
from threadkeeper.sources import intake as I

OPS = ("INGEST", "REINGEST", "SET_METADATA", "DELETE")


def empty_queue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], QUEUE_SCHEMA)


def empty_raw_comments(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RAW_COMMENT_SCHEMA)


def empty_comments(spark: SparkSession, params: SyncParams) -> DataFrame:
    return I.normalize_comments(empty_raw_comments(spark), params).select(*CACHED_COMMENT_COLS)


def stored(state: State) -> State:
    """The state as a run finds it: written tables (as read from the store)."""
    return State(
        tracked=cut_lineage(state.tracked), posts=cut_lineage(state.posts), comments=cut_lineage(state.comments), queue=cut_lineage(state.queue)
    )


def cache_rows(posts: DataFrame, scraped_at, update_count) -> DataFrame:
    cols = {"scraped_at": scraped_at, "last_updated": scraped_at, "update_count": update_count}
    return posts.select(*[(cols[c] if c in cols else F.col(c)).alias(c) for c in CACHED_POST_COLS])


def sink_rows(keys: DataFrame, fail, returned=None, error: str = "HTTP 503") -> DataFrame:
    """keys(doc_key, ...) -> sink results for every op: failures where
    ``fail``, otherwise a returned id where ``returned`` is not null."""
    rows = keys.where(fail | (returned.isNotNull() if returned is not None else F.lit(False))).select(
        "doc_key",
        F.explode(F.array(*[F.lit(o) for o in OPS])).alias("op"),
        (~fail).alias("ok"),
        (F.when(~fail, returned) if returned is not None else F.lit(None)).cast("string").alias("returned_doc_id"),
        F.when(fail, F.lit(error)).alias("error"),
    )
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in SINK_RESULT_SCHEMA.fields])


# ---------------------------------------------------------------------------
# docs: snapshot pair for the classifier
# ---------------------------------------------------------------------------
def docs(spark: SparkSession, d: str, params: SyncParams) -> tuple[State, Observation, DataFrame]:
    run = C.run_ts_lit(params.run_micros)
    day_before = run - F.make_dt_interval(F.lit(1))
    base = A.doc_base(spark, d).where(F.col("rule") != 0)
    tracked = base.select(
        "post_id",
        "subreddit",
        (run - F.make_dt_interval(F.lit(0), F.lit(1))).alias("created_utc"),
        day_before.alias("first_scraped"),
        F.when(F.col("rule") == 6, run).otherwise(day_before).alias("last_updated"),
        F.when(F.col("rule") == 7, F.lit(-1)).otherwise(F.lit(0)).cast("int").alias("update_count"),
        F.lit("new").alias("status"),
        F.when(F.col("rule") != 8, F.concat(F.lit(DOC_ID_PREFIX), F.col("post_id"))).alias("contextual_doc_id"),
        content_hash("title", "selftext", F.lit(None).cast("string")).alias("content_hash"),
    )
    cached = base.select(
        F.col("post_id").alias("id"), "subreddit", "author", "title", "selftext",
        F.concat(F.lit(SITE), F.lit("/r/"), F.col("subreddit"), F.lit("/comments/"), F.col("post_id"), F.lit("/")).alias("url"),
        F.concat(F.lit("/r/"), F.col("subreddit"), F.lit("/comments/"), F.col("post_id"), F.lit("/")).alias("permalink"),
        "score", "upvote_ratio", "num_comments",
        (run - F.make_dt_interval(F.lit(0), F.lit(1))).alias("created_utc"),
        F.lit(False).alias("edited"), F.lit(None).cast("string").alias("link_flair_text"), F.lit(True).alias("is_self"),
        day_before.alias("scraped_at"), day_before.alias("last_updated"),
        F.when(F.col("rule") == 7, F.lit(-1)).otherwise(F.lit(0)).cast("int").alias("update_count"),
    )
    state = State(tracked=tracked, posts=cached, comments=empty_comments(spark, params), queue=empty_queue(spark))
    obs = observe(A.doc_observed(spark, d, params.run_micros), empty_raw_comments(spark), params, refresh_ids(state, params))
    k = A.table(spark, d, "documents").select(
        F.concat(F.lit(DOC_ID_PREFIX + "d"), F.col("doc_id")).alias("doc_key"), F.col("doc_id")
    )
    sinks = sink_rows(k, F.col("doc_id") % 7 == 1, F.when(F.col("doc_id") % 7 == 2, F.concat(F.lit("idx-"), F.col("doc_id"))))
    return state, obs, sinks


# ---------------------------------------------------------------------------
# conv: intake of new posts with comments
# ---------------------------------------------------------------------------
def conv(spark: SparkSession, d: str, params: SyncParams) -> tuple[State, Observation, DataFrame]:
    raw = A.conv_raw_posts(spark, d)
    obs = observe(raw, A.conv_raw_comments(spark, d), params)
    run = C.run_ts_lit(params.run_micros)
    known = obs.refresh.where(F.substring("id", 2, 20).cast("bigint") % 4 == 0)
    tracked = known.select(
        F.col("id").alias("post_id"), "subreddit", "created_utc", (run - F.make_dt_interval(F.lit(1))).alias("first_scraped"),
        (run - F.make_dt_interval(F.lit(1))).alias("last_updated"), F.lit(-1).cast("int").alias("update_count"),
        F.lit("new").alias("status"), C.doc_id("id").alias("contextual_doc_id"), "content_hash",
    )
    posts = cache_rows(known, run - F.make_dt_interval(F.lit(1)), F.lit(0))
    comments = obs.comments.join(known.select(F.col("id").alias("post_id")), "post_id", "left_semi").select(*CACHED_COMMENT_COLS)
    state = stored(State(tracked=tracked.select(*TRACKED_COLS), posts=posts, comments=comments, queue=empty_queue(spark)))
    k = A.table(spark, d, "conversations").where(F.col("turn") == 0).select(
        F.concat(F.lit(DOC_ID_PREFIX + "t"), F.col("conv_id")).alias("doc_key"), "conv_id"
    )
    sinks = sink_rows(k, F.col("conv_id") % 9 == 0)
    return state, obs, sinks


# ---------------------------------------------------------------------------
# events: queue processing
# ---------------------------------------------------------------------------
def events(spark: SparkSession, d: str, params: SyncParams) -> tuple[State, Observation, DataFrame]:
    run = C.run_ts_lit(params.run_micros)
    obs = observe(A.event_observations(spark, d), empty_raw_comments(spark), params)
    u = F.substring("id", 2, 20).cast("bigint")
    ref = obs.refresh.withColumn("u", u)
    tracked = ref.where(F.col("u") % 2 == 0).select(
        F.col("id").alias("post_id"), "subreddit", "created_utc",
        (run - F.make_dt_interval(F.lit(2))).alias("first_scraped"),
        F.when(F.col("u") % 8 == 0, run).otherwise(run - F.make_dt_interval(F.lit(1))).alias("last_updated"),
        ((F.floor(F.col("u") / 2) % 4) - 1).cast("int").alias("update_count"),
        F.when(F.col("u") % 10 == 0, F.lit("frozen")).otherwise(F.lit("new")).alias("status"),
        F.when(F.col("u") % 6 != 4, C.doc_id("id")).alias("contextual_doc_id"),
        F.when(F.col("u") % 12 == 2, F.lit("")).when(F.col("u") % 4 == 0, F.col("content_hash"))
        .otherwise(F.concat(F.lit("stale"), F.col("u"))).alias("content_hash"),
    )
    cached = ref.where(F.col("u") % 3 != 0).withColumn("score", F.col("score") - (F.col("u") % 2))
    posts = cache_rows(cached, run - F.make_dt_interval(F.lit(1)), F.lit(0))
    state = State(tracked=tracked, posts=posts, comments=empty_comments(spark, params), queue=A.event_queue(spark, d))
    k = A.table(spark, d, "events").select("user_id").distinct().select(
        F.concat(F.lit(DOC_ID_PREFIX + "e"), F.col("user_id")).alias("doc_key"), "user_id"
    )
    sinks = sink_rows(k, F.col("user_id") % 5 == 1)
    return state, obs, sinks


# ---------------------------------------------------------------------------
# orders: a full run at scale
# ---------------------------------------------------------------------------
def orders(spark: SparkSession, d: str, params: SyncParams) -> tuple[State, Observation, DataFrame]:
    """State: 4 of 5 orders tracked (counts -1..2, some frozen, some with a
    missing or stale hash, some first scraped > 30 days ago); snapshot: every
    order except 1 in 17 (fetch fails), with lineitem comments."""
    run = C.run_ts_lit(params.run_micros)
    raw = A.order_raw_posts(spark, d)
    raw_c = A.lineitem_raw_comments(spark, d)
    k = F.col("o_orderkey")
    keys = A.table(spark, d, "orders").select(F.concat(F.lit("o"), k).alias("id"), k)
    # one observation of everything; the landed snapshot lacks 1 in 17 orders
    seen = observe(raw, raw_c, params, buckets=True)
    gone = keys.where(k % 17 == 3).select("id")
    obs = Observation(
        intake=seen.intake.join(gone, "id", "left_anti"), refresh=seen.refresh.join(gone, "id", "left_anti"), comments=seen.comments, buckets=seen.buckets
    )
    base = seen.refresh.join(keys, "id").where(k % 5 != 0)
    tracked = base.select(
        F.col("id").alias("post_id"), "subreddit", "created_utc",
        (run - F.make_dt_interval((k % 40).cast("int"))).alias("first_scraped"),
        F.when(k % 11 == 0, run).otherwise(run - F.make_dt_interval(F.lit(1))).alias("last_updated"),
        ((k % 4) - 1).cast("int").alias("update_count"),
        F.when(k % 4 == 3, F.lit("updating")).when(k % 29 == 0, F.lit("frozen")).otherwise(F.lit("new")).alias("status"),
        F.when(k % 13 != 6, C.doc_id("id")).alias("contextual_doc_id"),
        F.when(k % 23 == 0, F.lit("")).when(k % 6 == 1, F.lit("stale")).otherwise(F.col("content_hash")).alias("content_hash"),
    )
    posts = cache_rows(base.withColumn("score", F.col("score") - (k % 3 == 0).cast("int")), run - F.make_dt_interval(F.lit(1)), F.lit(0))
    queue_src = keys.where(k % 13 == 0)
    queue = queue_src.select(
        F.abs(F.xxhash64("id")).alias("id"), F.col("id").alias("post_id"), F.lit("queued").alias("subreddit"),
        F.when(k % 2 == 0, F.lit("ingest")).otherwise(F.lit("update")).alias("action"),
        (k % 3).cast("int").alias("priority"), (k % 6).cast("int").alias("attempts"), F.lit(5).alias("max_attempts"),
        F.lit(None).cast("string").alias("last_error"),
        (run - F.make_dt_interval((k % 5).cast("int"))).alias("created_at"),
        (run - F.make_dt_interval(F.lit(0), (k % 3).cast("int") - 1)).alias("scheduled_for"),
    )
    tracked, posts = cut_buckets(tracked, "post_id"), cut_buckets(posts, "id")
    # the cached comments of the tracked posts lie in the observed table already
    comments = obs.comments.join(tracked.select("post_id"), "post_id", "left_semi").select(*CACHED_COMMENT_COLS)
    state = State(tracked=tracked, posts=posts, comments=comments, queue=cut_lineage(queue))
    sk = keys.select(F.concat(F.lit(DOC_ID_PREFIX), F.col("id")).alias("doc_key"), k)
    sinks = sink_rows(sk, k % 19 == 7)
    return state, obs, sinks
