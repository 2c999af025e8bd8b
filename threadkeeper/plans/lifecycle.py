"""Post lifecycle as set-based phases over versioned state.

LIFE-1..13, JN-1/2/4/5, FLT-3/5/6/8/10/11, SNK-6.

A run folds phases over the state (tracked, post cache, comment cache,
queue): queue -> hash repair -> new posts -> updates -> freeze -> queue ->
retention.  ``run`` does it as one fold over a wide row per post
(``plans.onepass``).  The phases below are the same rules as transformations of
whole tables, usable one by one (and for a run with a ``queue_limit``):

* a phase joins *tracked* once with its inputs on ``post_id`` and projects the
  new row with a CASE chain;
* the large *post / comment caches* are never rewritten per phase: phases
  emit save / delete events and ``apply_cache_events`` applies them once;
* a queue phase takes every due item (or ``queue_limit`` of them) in the same
  set-based way; which side of its joins is small is left to the optimizer's
  measured sizes.

Delivery outcomes come from ``sink_results``; a missing result = success.
"""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadkeeper.functions import columns as C
from threadkeeper.functions.fingerprint import comment_fragments, content_hash
from threadkeeper.operators import outbox as O
from threadkeeper.operators import queue as Q
from threadkeeper.operators import state as S
from threadkeeper.operators.stats import COUNTERS, db_stats, run_counters, scraped_new_by_subreddit
from threadkeeper.params import (
    ACTION_INGEST,
    ACTION_UPDATE,
    STATUS_FROZEN,
    STATUS_NEW,
    STATUS_UPDATING,
    SyncParams,
)
from threadkeeper.schemas import CACHED_COMMENT_COLS, CACHED_POST_COLS, POST_COLS, TRACKED_COLS
from threadkeeper.session import cut_buckets, cut_lineage
from threadkeeper.sources import intake as I

log = logging.getLogger("threadkeeper.lifecycle")

# Update classifier outcomes (LIFE-2).
NOOP, SKIP, ENQUEUE, DELETE, REINGEST, SET_METADATA = (
    "NOOP", "SKIP_INCREMENT", "ENQUEUE_UPDATE", "DELETE", "REINGEST", "SET_METADATA",
)


@dataclass
class State:
    tracked: DataFrame
    posts: DataFrame
    comments: DataFrame
    queue: DataFrame


@dataclass
class Observation:
    """What the source shows at run time (built once per run)."""

    intake: DataFrame  # window ∪ hot, latest per id, normalised + content_hash
    refresh: DataFrame  # latest observation of every id, normalised + deleted + content_hash
    comments: DataFrame  # normalised, bot-filtered, capped comments
    rejects: DataFrame | None = None  # malformed rows with the reason (SRC-7)
    buckets: bool = False  # its tables are bucketed by the post's id, and a run's are too


@dataclass
class RunResult:
    state: State
    actions: DataFrame  # one row per (seq, post_id): phase, action, op, ok, counters
    ops: DataFrame  # document operations (seq, post_id, op, doc_key, ok, result_doc_id)
    outbox: DataFrame  # delivered operations with html and metadata (the latest per document)
    documents: DataFrame  # the document index after the run
    pending_deletes: DataFrame  # failed DELETEs, for the next run's redelivery
    counters: DataFrame  # the ten run counters (AGG-8), one row
    by_source: DataFrame  # scraped and newly tracked per source (AGG-7)
    totals: DataFrame  # database totals after the run (AGG-2..6)


# ---------------------------------------------------------------------------
# Observation
# ---------------------------------------------------------------------------
def observe(raw_posts: DataFrame, raw_comments: DataFrame, params: SyncParams, wanted: DataFrame | None = None, buckets: bool = False) -> Observation:
    """Intake and refresh rows of a landing.

    ``wanted`` (post_id) are the posts that the run may refresh (``refresh_ids``);
    only their rows are then reduced, normalised and fingerprinted for it,
    however much history the landing holds.  With ``buckets`` the observation
    is written as bucketed tables (``cut_buckets``), which the run joins by post
    without shuffling them again, and so are the tables that the run writes.
    """
    good, rejects = I.split_rejects(raw_posts)
    comments = _cut(I.normalize_comments(raw_comments, params), buckets, "post_id")
    seen = good if wanted is None else good.join(wanted.select(F.col("post_id").alias("id")).distinct(), "id", "left_semi")
    # FLT-4 runs on the raw row, before the author default is applied.
    refresh = I.normalize_posts(I.latest_observation(seen.withColumn("deleted", C.is_deleted_raw("author", "selftext"))), "deleted")
    window = I.intake_posts(good, params).withColumn("deleted", F.lit(None).cast("boolean"))
    # one join and one write serve both: the kinds are partitions of the written table
    both = refresh.withColumn("kind", F.lit("refresh")).unionByName(window.withColumn("kind", F.lit("window")))
    both = _cut(_with_hash(both, comments), buckets, "id", "kind")
    refresh = both.where(F.col("kind") == "refresh").drop("kind")
    intake = both.where(F.col("kind") == "window").drop("kind", "deleted")
    return Observation(intake=intake, refresh=refresh, comments=comments, rejects=I.quarantine(rejects), buckets=buckets)


def _cut(df: DataFrame, buckets: bool, key: str, *partition_by: str) -> DataFrame:
    return cut_buckets(df, key, *partition_by) if buckets else cut_lineage(df, *partition_by)


def observe_landing(landing: DataFrame, raw_comments: DataFrame, params: SyncParams, state: State, seen: DataFrame) -> Observation:
    """``observe`` over a landing of many days (``intake.read_days``): the window
    reads the days that can hold its posts, the refresh the days on which the
    posts it wants were last seen (``intake.seen_days``, after this landing)."""
    wanted = refresh_ids(state, params)
    since = F.lit(I.first_window_day(params)).cast("date")
    recent = landing.where(F.col("observed_date") >= since)
    older = I.refresh_scan(landing.where(F.col("observed_date") < since), wanted, seen)
    return observe(recent.unionByName(older.select(*recent.columns)).drop("observed_date"), raw_comments, params, wanted)


def refresh_ids(state: State, params: SyncParams) -> DataFrame:
    """Posts whose observation a run may need: due for an update, without a hash, or queued."""
    due = state.tracked.where(due_for_update(params) | missing_hash()).select("post_id")
    return due.union(state.queue.select("post_id"))


def _with_hash(posts: DataFrame, comments: DataFrame) -> DataFrame:
    frags = comment_fragments(comments.select("post_id", "id", "body"))
    j = posts.join(frags.withColumnRenamed("post_id", "id"), "id", "left")
    return j.withColumn("content_hash", content_hash("title", "selftext", "fragments")).drop("fragments", "n_comments")


# ---------------------------------------------------------------------------
# helpers
# ---------------------------------------------------------------------------
def _run(params: SyncParams) -> Column:
    return C.run_ts_lit(params.run_micros)


def _counters(**on: Column) -> list[Column]:
    return [(on[c] if c in on else F.lit(False)).alias(c) for c in COUNTERS]


def _cache_row(p: DataFrame, params: SyncParams, update_count: Column, seq: int, refresh_content: bool) -> DataFrame:
    """Post rows (normalised) -> save events for the post cache."""
    run = _run(params)
    cols = {
        "scraped_at": run,
        "last_updated": run,
        "update_count": update_count.cast("int"),
    }
    return p.select(
        *[cols.get(c, F.col(c)).alias(c) for c in CACHED_POST_COLS],
        F.lit(seq).alias("seq"),
        F.lit(refresh_content).alias("refresh_content"),
        F.lit(False).alias("is_delete"),
    )


def _delete_events(ids: DataFrame, seq: int) -> DataFrame:
    return ids.select(F.col("post_id").alias("id"), F.lit(seq).alias("seq"), F.lit(True).alias("is_delete"))


def today_guard(params: SyncParams) -> Column:
    """FLT-5: last processed on the run's Pacific calendar day."""
    return C.pacific_date("last_updated") == C.pacific_date(_run(params))


def due_for_update(params: SyncParams) -> Column:
    """FLT-6."""
    return (F.col("status") != STATUS_FROZEN) & (F.col("update_count") < params.freeze_at_count)


def missing_hash() -> Column:
    """FLT-8."""
    return (F.col("content_hash").isNull() | (F.col("content_hash") == "")) & (F.col("status") != STATUS_FROZEN)


def in_update_window(params: SyncParams) -> Column:
    """FLT-3: age in days <= window (inclusive)."""
    return C.age_days("created_utc", params.run_micros) <= F.lit(float(params.update_window_days))


# ---------------------------------------------------------------------------
# LIFE-2: the update classifier
# ---------------------------------------------------------------------------
def classify(
    tracked: DataFrame,
    obs: Observation,
    cached_posts: DataFrame,
    params: SyncParams,
    apply_due_filter: bool = True,
) -> DataFrame:
    """tracked rows (FLT-6 applied unless ``apply_due_filter`` is False)
    ⟕ fresh observation ⟕ cached post  ->  one action per row (JN-4)."""
    cand = tracked.where(due_for_update(params)) if apply_due_filter else tracked
    fresh = obs.refresh.select(
        F.col("id").alias("post_id"),
        F.lit(True).alias("f_found"),
        F.col("deleted").alias("f_deleted"),
        F.col("content_hash").alias("f_hash"),
        F.col("score").alias("f_score"),
        F.col("num_comments").alias("f_num_comments"),
        F.col("upvote_ratio").alias("f_upvote_ratio"),
    )
    cached = cached_posts.select(
        F.col("id").alias("post_id"),
        F.lit(True).alias("c_found"),
        F.col("score").alias("c_score"),
        F.col("num_comments").alias("c_num_comments"),
        F.col("upvote_ratio").alias("c_upvote_ratio"),
    )
    j = cand.join(fresh, "post_id", "left").join(cached, "post_id", "left")
    return j.withColumn("action", update_action(params, lambda c: F.col("f_" + c), lambda c: F.col("c_" + c)))


def update_action(params: SyncParams, fresh, cached) -> Column:
    """The classifier's rule over a tracked row's columns; ``fresh`` and ``cached``
    give the columns (found, score, ...) of the observation and the cached post."""
    content_changed = F.coalesce(F.col("content_hash"), F.lit("")) != fresh("hash")  # FLT-11
    meta_changed = cached("found").isNotNull() & (  # FLT-10
        ~cached("score").eqNullSafe(fresh("score"))
        | ~cached("num_comments").eqNullSafe(fresh("num_comments"))
        | ~cached("upvote_ratio").eqNullSafe(fresh("upvote_ratio"))
    )
    return (
        F.when(today_guard(params), F.lit(NOOP))
        .when(F.col("update_count") < params.refresh_at_count, F.lit(SKIP))
        .when(fresh("found").isNull(), F.lit(ENQUEUE))
        .when(fresh("deleted"), F.lit(DELETE))
        .when(F.lit(params.always_reingest_on_refresh) | content_changed, F.lit(REINGEST))
        .when(meta_changed & F.col("contextual_doc_id").isNotNull(), F.lit(SET_METADATA))
        .otherwise(F.lit(SKIP))
    )


def _ops_for(actions: DataFrame) -> DataFrame:
    """Document operation per classified row (LIFE-9 for the re-ingest case)."""
    doc = F.col("contextual_doc_id")
    op = (
        F.when((F.col("action") == REINGEST) & doc.isNull(), F.lit(O.OP_INGEST))
        .when(F.col("action") == REINGEST, F.lit(O.OP_REINGEST))
        .when(F.col("action") == SET_METADATA, F.lit(O.OP_SET_METADATA))
        .when((F.col("action") == DELETE) & doc.isNotNull(), F.lit(O.OP_DELETE))
    )
    key = F.when(op == O.OP_INGEST, C.doc_id("post_id")).otherwise(doc)
    return actions.withColumn("op", op).withColumn("doc_key", F.when(op.isNotNull(), key))


def _deliver(rows: DataFrame, sinks: DataFrame, attempt: int = 1) -> DataFrame:
    """Attach (ok, result_doc_id) to rows with an op; rows without op: ok."""
    with_op = rows.where(F.col("op").isNotNull())
    without = (
        rows.where(F.col("op").isNull())
        .withColumn("error", F.lit(None).cast("string"))
        .withColumn("ok", F.lit(True))
        .withColumn("result_doc_id", F.lit(None).cast("string"))
    )
    return O.delivery(with_op, sinks, attempt).unionByName(without)


def _tracked_from(rows: DataFrame, **set_cols: Column) -> DataFrame:
    return rows.select(*[set_cols.get(c, F.col(c)).alias(c) for c in TRACKED_COLS])


# ---------------------------------------------------------------------------
# Phases
# ---------------------------------------------------------------------------
def apply_updates(
    state: State, obs: Observation, classified: DataFrame, sinks: DataFrame, params: SyncParams, seq: int, phase: str, attempt: int = 1
):
    """LIFE-3..6 for classified rows: new tracked rows, queue requests,
    cache events, document ops and counters."""
    run = _run(params)
    d = cut_lineage(_deliver(_ops_for(classified), sinks, attempt))
    a, ok = F.col("action"), F.col("ok")
    meta_ok = (a == SET_METADATA) & ok
    skip = (a == SKIP) | ((a == SET_METADATA) & ~ok)
    re_ok = (a == REINGEST) & ok
    re_fail = (a == REINGEST) & ~ok
    d = d.withColumn("_meta_ok", meta_ok).withColumn("_skip", skip).withColumn("_re_ok", re_ok).withColumn("_re_fail", re_fail)
    cnt = F.col("update_count") + 1
    changed = d.where(F.col("_meta_ok") | F.col("_skip") | F.col("_re_ok"))
    new_rows = _tracked_from(
        changed,
        last_updated=run,
        update_count=cnt.cast("int"),
        status=F.when(F.col("_re_ok"), F.lit(STATUS_UPDATING)).otherwise(F.col("status")),
        content_hash=F.when(F.col("_re_ok"), F.col("f_hash")).otherwise(F.col("content_hash")),
        contextual_doc_id=F.when(F.col("_re_ok"), F.col("result_doc_id")).otherwise(F.col("contextual_doc_id")),
    )
    deleted = d.where(a == DELETE).select("post_id")
    tracked = S.upsert_tracked(state.tracked, new_rows).join(deleted, "post_id", "left_anti")
    requests = d.where((a == ENQUEUE) | F.col("_re_fail")).select(
        "post_id", "subreddit", F.lit(ACTION_UPDATE).alias("action"), F.lit(0).alias("priority")
    )
    queue = Q.enqueue(state.queue, requests, params)
    # Cache events: metadata-only success saves the post; a re-ingest saves it first.
    saved = d.where(F.col("_meta_ok") | (a == REINGEST)).select("post_id", "update_count", F.col("_meta_ok"))
    fresh = obs.refresh.join(saved.withColumnRenamed("post_id", "id"), "id")
    ev_meta = _cache_row(fresh.where(F.col("_meta_ok")), params, F.col("update_count") + 1, seq, False)
    ev_re = _cache_row(fresh.where(~F.col("_meta_ok")), params, F.col("update_count") + 1, seq, True)
    events = ev_meta.unionByName(ev_re).unionByName(_delete_events(deleted, seq), allowMissingColumns=True)
    actions = d.select(
        F.lit(seq).alias("seq"),
        F.lit(phase).alias("phase"),
        "post_id",
        "action",
        "op",
        "doc_key",
        "ok",
        "result_doc_id",
        *_counters(
            updated_posts=F.col("_meta_ok") | F.col("_re_ok"),
            documents_reingested=F.col("_re_ok"),
            skipped_unchanged=F.col("_skip"),
            posts_deleted=a == DELETE,
            sync_errors=F.col("_re_fail"),
            queued_for_retry=(a == ENQUEUE) | F.col("_re_fail"),
        ),
    )
    return replace(state, tracked=tracked, queue=queue), events, actions


def phase_update(state: State, obs: Observation, sinks: DataFrame, params: SyncParams, seq: int = 40):
    """LIFE-2..6 over every tracked row due for update (FLT-6)."""
    classified = classify(state.tracked, obs, state.posts, params)
    return apply_updates(state, obs, classified, sinks, params, seq, "update")


def phase_new(state: State, obs: Observation, sinks: DataFrame, params: SyncParams, seq: int = 30):
    """LIFE-1 with JN-1/JN-2 and FLT-3: untracked posts in the update window
    are saved and ingested; a failed ingest goes to the queue (priority 1)."""
    run = _run(params)
    cand = obs.intake.where(in_update_window(params))
    new = cand.join(state.tracked.select(F.col("post_id").alias("id")), "id", "left_anti")
    ops = new.select(
        F.col("id").alias("post_id"), "subreddit", "created_utc", "content_hash",
        F.lit(O.OP_INGEST).alias("op"), C.doc_id("id").alias("doc_key"),
    )
    d = cut_lineage(O.delivery(ops, sinks))
    ok = F.col("ok")
    rows = d.where(ok).select(
        "post_id", "subreddit", "created_utc",
        run.alias("first_scraped"), run.alias("last_updated"), F.lit(-1).cast("int").alias("update_count"),
        F.lit(STATUS_NEW).alias("status"), F.col("result_doc_id").alias("contextual_doc_id"), "content_hash",
    )
    tracked = S.upsert_tracked(state.tracked, rows)
    requests = d.where(~ok).select("post_id", "subreddit", F.lit(ACTION_INGEST).alias("action"), F.lit(1).alias("priority"))
    queue = Q.enqueue(state.queue, requests, params)
    events = _cache_row(new, params, F.lit(0), seq, False)
    actions = d.select(
        F.lit(seq).alias("seq"), F.lit("new").alias("phase"), "post_id",
        F.when(ok, F.lit("INGESTED")).otherwise(F.lit("QUEUED")).alias("action"),
        "op", "doc_key", "ok", "result_doc_id",
        *_counters(new_posts=ok, documents_ingested=ok, sync_errors=~ok, queued_for_retry=~ok),
    )
    scraped = obs.intake.select(
        F.lit(seq - 1).alias("seq"), F.lit("scrape").alias("phase"), F.col("id").alias("post_id"),
        F.lit("SCRAPED").alias("action"), F.lit(None).cast("string").alias("op"), F.lit(None).cast("string").alias("doc_key"),
        F.lit(True).alias("ok"), F.lit(None).cast("string").alias("result_doc_id"),
        *_counters(posts_scraped=F.lit(True)),
    )
    return replace(state, tracked=tracked, queue=queue), events, actions.unionByName(scraped)


def phase_freeze(state: State, params: SyncParams, seq: int = 50):
    """LIFE-7: rows that completed their updates become frozen."""
    due = state.tracked.where(S.due_for_freeze(state.tracked, params))
    actions = due.select(
        F.lit(seq).alias("seq"), F.lit("freeze").alias("phase"), "post_id", F.lit("FREEZE").alias("action"),
        F.lit(None).cast("string").alias("op"), F.lit(None).cast("string").alias("doc_key"), F.lit(True).alias("ok"),
        F.lit(None).cast("string").alias("result_doc_id"), *_counters(frozen_posts=F.lit(True)),
    )
    return replace(state, tracked=S.freeze(state.tracked, params)), actions


def phase_repair(state: State, obs: Observation, sinks: DataFrame, params: SyncParams, seq: int = 20):
    """LIFE-8: rows with a missing hash are refreshed and re-synced
    (INGEST when there is no document yet); deleted ones are removed; a
    failed fetch or sync is only logged.  Count and status stay."""
    run = _run(params)
    cand = state.tracked.where(missing_hash())
    fresh = obs.refresh.select(
        F.col("id").alias("post_id"), F.lit(True).alias("f_found"), F.col("deleted").alias("f_deleted"), F.col("content_hash").alias("f_hash")
    )
    j = cand.join(fresh, "post_id", "left")
    action = (
        F.when(F.col("f_found").isNull(), F.lit("FETCH_FAILED"))
        .when(F.col("f_deleted"), F.lit(DELETE))
        .otherwise(F.lit(REINGEST))
    )
    j = j.withColumn("action", action)
    d = cut_lineage(_deliver(_ops_for(j), sinks))
    a, ok = F.col("action"), F.col("ok")
    fixed = d.where((a == REINGEST) & ok)
    rows = _tracked_from(fixed, content_hash=F.col("f_hash"), last_updated=run, contextual_doc_id=F.col("result_doc_id"))
    deleted = d.where(a == DELETE).select("post_id")
    tracked = S.upsert_tracked(state.tracked, rows).join(deleted, "post_id", "left_anti")
    saved = d.where(a == REINGEST).select(F.col("post_id").alias("id"), "update_count")
    events = _cache_row(obs.refresh.join(saved, "id"), params, F.col("update_count"), seq, True).unionByName(
        _delete_events(deleted, seq), allowMissingColumns=True
    )
    actions = d.select(
        F.lit(seq).alias("seq"), F.lit("repair").alias("phase"), "post_id", "action", "op", "doc_key", "ok", "result_doc_id",
        *_counters(documents_reingested=(a == REINGEST) & ok, posts_deleted=a == DELETE),
    )
    return replace(state, tracked=tracked), events, actions


def phase_queue(state: State, obs: Observation, sinks: DataFrame, params: SyncParams, events: DataFrame | None = None, seq: int = 10, attempt: int = 1):
    """LIFE-10 over the due items (all of them unless ``queue_limit`` is set).

    ingest -> cached post (JN-5) -> INGEST; ok sets the doc id, or creates the
    tracked row when there is none (decision Q3); no cached post = no-op.
    update -> the classifier on that tracked row without FLT-6; frozen or
    untracked = no-op (Q17); a failed outcome counts as a failure (Q4).
    Success removes the item (MUT-7), failure backs it off (MUT-8).  A second
    pass of a run reads the delivery results of its own ``attempt``.
    """
    run = _run(params)
    batch = cut_lineage(Q.due_batch(state.queue, params).select("post_id", "action", "subreddit"))
    # --- ingest items, with the post cache as of now
    ing = batch.where(F.col("action") == ACTION_INGEST)
    cached = cache_view(state.posts, events).join(ing.select(F.col("post_id").alias("id")), "id", "left_semi")
    ing_j = ing.join(cached.select(F.col("id").alias("post_id"), F.lit(True).alias("c_found")), "post_id", "left")
    ing_j = ing_j.join(state.tracked.select("post_id", F.lit(True).alias("t_found")), "post_id", "left")
    ing_ops = ing_j.withColumn("op", F.when(F.col("c_found").isNotNull(), F.lit(O.OP_INGEST))).withColumn(
        "doc_key", F.when(F.col("op").isNotNull(), C.doc_id("post_id"))
    )
    ing_d = cut_lineage(_deliver(ing_ops, sinks, attempt))
    ing_ok = ing_d.where(F.col("op").isNotNull() & F.col("ok"))
    # tracked rows: set the doc id, or create (hash from the cached copy and its comments as of now)
    set_rows = state.tracked.join(ing_ok.select("post_id", F.col("result_doc_id").alias("new_doc")), "post_id").select(
        *[F.col("new_doc").alias(c) if c == "contextual_doc_id" else F.col(c) for c in TRACKED_COLS]
    )
    create = ing_ok.where(F.col("t_found").isNull()).select("post_id", "result_doc_id")
    wanted = create.select("post_id")
    cached_hash = _with_hash(
        cached.select("id", "title", "selftext", "subreddit", "created_utc").join(wanted.withColumnRenamed("post_id", "id"), "id", "left_semi"),
        comments_view(state.comments, events, obs.comments).join(wanted, "post_id", "left_semi"),
    )
    create_rows = create.join(cached_hash.withColumnRenamed("id", "post_id"), "post_id").select(
        "post_id", "subreddit", "created_utc", run.alias("first_scraped"), run.alias("last_updated"),
        F.lit(-1).cast("int").alias("update_count"), F.lit(STATUS_NEW).alias("status"),
        F.col("result_doc_id").alias("contextual_doc_id"), "content_hash",
    )
    ing_actions = ing_d.select(
        F.lit(seq).alias("seq"), F.lit("queue").alias("phase"), "post_id",
        F.when(F.col("op").isNull(), F.lit("NOOP")).when(F.col("ok"), F.lit("INGESTED")).otherwise(F.lit("FAILED")).alias("action"),
        "op", "doc_key", "ok", "result_doc_id",
        *_counters(documents_ingested=F.col("op").isNotNull() & F.col("ok")),
    )
    ing_fail = ing_d.where(F.col("op").isNotNull() & ~F.col("ok")).select(
        "post_id", F.lit(ACTION_INGEST).alias("action"), F.coalesce(F.col("error"), F.lit("ingest failed")).alias("error")
    )
    st = replace(state, tracked=cut_lineage(S.upsert_tracked(state.tracked, set_rows.unionByName(create_rows))))
    # --- update items
    upd = batch.where(F.col("action") == ACTION_UPDATE).select("post_id")
    t_upd = st.tracked.join(upd, "post_id", "left_semi").where(F.col("status") != STATUS_FROZEN)
    classified = classify(t_upd, obs, cache_view(state.posts, events), params, apply_due_filter=False)
    st2, upd_events, upd_actions = apply_updates(st, obs, classified, sinks, params, seq, "queue", attempt)
    upd_fail = upd_actions.where((F.col("action") == ENQUEUE) | ((F.col("action") == REINGEST) & ~F.col("ok"))).select(
        "post_id", F.lit(ACTION_UPDATE).alias("action"),
        F.when(F.col("action") == ENQUEUE, F.lit("refresh failed")).otherwise(F.lit("sync failed")).alias("error"),
    )
    failures = ing_fail.unionByName(upd_fail)
    done = batch.select("post_id", "action").join(failures.select("post_id", "action"), ["post_id", "action"], "left_anti")
    queue = Q.mark_failure(Q.mark_success(st2.queue, done), failures, params)
    return replace(st2, queue=queue), upd_events, ing_actions.unionByName(upd_actions)


# ---------------------------------------------------------------------------
# Cache events -> new post and comment caches (one pass per run)
# ---------------------------------------------------------------------------
def apply_cache_events(posts: DataFrame, comments: DataFrame, events: DataFrame, obs_comments: DataFrame):
    """Latest event per post id wins.  A save keeps the first text unless it
    refreshes content (MUT-2 / Q5) and replaces all comments (MUT-3); a
    delete removes post and comments (MUT-4)."""
    ev = events.groupBy("id").agg(
        F.max_by(F.struct(*[F.col(c) for c in CACHED_POST_COLS if c != "id"], "refresh_content", "is_delete"), "seq").alias("e"),
        F.max(F.when(F.col("is_delete"), F.col("seq"))).alias("last_delete"),
        F.max("seq").alias("last_seq"),
    )
    ev = ev.select("id", "e.*", "last_delete", "last_seq")
    o = posts.select(*[F.col(c).alias("o_" + c) for c in CACHED_POST_COLS])
    j = o.join(ev, o["o_id"] == ev["id"], "full_outer")
    has_old = F.col("o_id").isNotNull() & (F.col("last_delete").isNull() | (F.col("last_seq") == F.col("last_delete")))
    has_event = F.col("id").isNotNull()
    volatile = S.POST_VOLATILE
    cols = []
    for c in CACHED_POST_COLS:
        if c == "id":
            cols.append(F.coalesce(F.col("o_id"), F.col("id")).alias("id"))
            continue
        take_new = F.lit(True) if c in volatile else F.col("refresh_content") & F.lit(c != "scraped_at")
        e = F.when(~has_event, F.col("o_" + c)).when(~has_old | take_new, F.col(c)).otherwise(F.col("o_" + c))
        cols.append(e.alias(c))
    gone = has_event & F.col("is_delete")
    new_posts = j.where(~F.coalesce(gone, F.lit(False))).select(*cols)
    touched = ev.select(F.col("id").alias("post_id"), "is_delete")
    keep = comments.join(touched, "post_id", "left_anti")
    saved = touched.where(~F.col("is_delete")).select("post_id")
    new_comments = keep.select(*CACHED_COMMENT_COLS).unionByName(
        obs_comments.join(saved, "post_id", "left_semi").select(*CACHED_COMMENT_COLS)
    )
    return new_posts, new_comments


def cache_view(posts: DataFrame, events: DataFrame | None) -> DataFrame:
    """The post cache as of now: the pre-run cache overlaid with this run's events."""
    if events is None:
        return posts.select(*CACHED_POST_COLS)
    ev = events.groupBy("id").agg(
        F.max_by(F.struct(*[F.col(c) for c in CACHED_POST_COLS if c != "id"], "is_delete"), "seq").alias("e")
    ).select("id", "e.*")
    live_ev = ev.where(~F.col("is_delete")).drop("is_delete")
    untouched = posts.join(ev.select("id"), "id", "left_anti")
    return untouched.select(*CACHED_POST_COLS).unionByName(live_ev.select(*CACHED_POST_COLS))


def comments_view(comments: DataFrame, events: DataFrame | None, observed: DataFrame) -> DataFrame:
    """The comment cache as of now: a post that this run saved has the observed comments."""
    if events is None:
        return comments.select(*CACHED_COMMENT_COLS)
    last = events.groupBy(F.col("id").alias("post_id")).agg(F.max_by("is_delete", "seq").alias("is_delete"))
    saved = last.where(~F.col("is_delete"))
    untouched = comments.join(last.select("post_id"), "post_id", "left_anti")
    return untouched.select(*CACHED_COMMENT_COLS).unionByName(observed.join(saved, "post_id", "left_semi").select(*CACHED_COMMENT_COLS))


# ---------------------------------------------------------------------------
# LIFE-11 / LIFE-12: a whole run
# ---------------------------------------------------------------------------
EMPTY_EVENTS_COLS = CACHED_POST_COLS + ["seq", "refresh_content", "is_delete"]


def document_rows(obs: Observation, posts: DataFrame) -> DataFrame:
    """Posts as documents show them: the observation where there is one, else the cached copy."""
    new = obs.intake.join(obs.refresh.select("id"), "id", "left_anti")
    seen = obs.refresh.select(*POST_COLS).unionByName(new.select(*POST_COLS))
    cached = posts.join(seen.select("id"), "id", "left_anti")
    return seen.unionByName(cached.select(*[c for c in POST_COLS if c in CACHED_POST_COLS]), allowMissingColumns=True)


def delivered_outbox(ops: DataFrame, obs: Observation, posts: DataFrame, comments: DataFrame) -> DataFrame:
    """The latest delivered operation of each document, with its content (SNK-1..4)."""
    # metadata set after a delivery of the content is part of that delivery; in a queue pass the ingest comes first
    done = F.max(F.when(F.col("op").isin(O.OP_INGEST, O.OP_REINGEST), F.col("seq"))).over(Window.partitionBy("doc_key"))
    sent = ops.where("ok").withColumn("_content", done).where((F.col("op") != O.OP_SET_METADATA) | F.col("_content").isNull() | (F.col("seq") < F.col("_content")))
    order = F.struct("seq", (F.col("op") != O.OP_INGEST).alias("after"))
    last = sent.groupBy("doc_key").agg(F.max_by(F.struct("seq", "post_id", "op", "result_doc_id"), order).alias("o")).select("doc_key", "o.*")
    box = O.outbox(last.select("post_id", "op", "doc_key"), document_rows(obs, posts), comments)
    return box.join(last.select("doc_key", "seq", "result_doc_id"), "doc_key")


MODES = {
    "full": ["queue", "repair", "new", "update", "freeze", "queue2", "retention"],
    "scrape": ["new"],
    "update": ["queue", "update", "freeze"],
    "queue": ["queue"],
}
INDEX = "doc_id string, post_id string, html string, metadata_json string, size_bytes bigint, day date"
PENDING = "post_id string, doc_key string, error string, failed_at timestamp, day date"


def run(
    state: State, obs: Observation, sinks: DataFrame, params: SyncParams, mode: str = "full", index: DataFrame | None = None, pending: DataFrame | None = None
) -> RunResult:
    """LIFE-11 (mode 'full') and LIFE-12 ('scrape', 'update', 'queue', 'dry').

    Order: queue -> hash repair -> new -> update -> freeze -> queue ->
    retention, as one fold over a wide row per post (``plans.onepass``), written
    once; the comment cache is the only other table written.  Mode 'dry' writes
    nothing and changes nothing: its actions say what a scrape would ingest.

    ``index`` is the document index before the run and ``pending`` the failed
    DELETEs of earlier runs, which are sent again first (SNK-4).  Documents are
    rendered when outbox or documents are written.  A queue with a
    ``queue_limit`` takes the first items over all posts, which no row can
    decide alone: such a run goes phase by phase (``run_by_phases``).
    """
    from threadkeeper.plans import onepass

    if mode == "dry":
        return dry_run(state, obs, params, index, pending)
    if params.queue_limit is not None:
        return run_by_phases(state, obs, sinks, params, mode, index=index, pending=pending)
    f = onepass.fold(state, obs, sinks, params, MODES[mode], lambda w: _cut(w, obs.buckets, "post_id"))
    # retention takes comments of documents that were delivered before it
    shown = _cut(onepass.comment_rows(f, state.comments, obs.comments), obs.buckets, "post_id")
    comments = shown.where("kept").select(*CACHED_COMMENT_COLS)
    after = State(tracked=onepass.tracked_rows(f), posts=onepass.post_rows(f), comments=comments, queue=onepass.queue_rows(f))
    counters = state.tracked.sparkSession.createDataFrame([tuple(f.counters.values())], ", ".join(f"{c} bigint" for c in COUNTERS))
    days = f.rows.select("post_id", F.to_date("created_utc").alias("day"))
    sent = onepass.sent_rows(f)
    return _result(state, after, obs, sinks, params, onepass.action_rows(f), onepass.outbox_rows(sent, shown), days, counters, onepass.by_source(f), index, pending, sent)


def dry_run(state: State, obs: Observation, params: SyncParams, index: DataFrame | None = None, pending: DataFrame | None = None) -> RunResult:
    """LIFE-12: what a scrape would ingest.  No write, no delivery, no change."""
    spark = state.tracked.sparkSession
    new = obs.intake.where(in_update_window(params)).join(state.tracked.select(F.col("post_id").alias("id")), "id", "left_anti")
    none = F.lit(None).cast("string")
    actions = new.select(
        F.lit(30).alias("seq"), F.lit("dry").alias("phase"), F.col("id").alias("post_id"), F.lit("WOULD_INGEST").alias("action"), none.alias("op"),
        none.alias("doc_key"), F.lit(True).alias("ok"), none.alias("result_doc_id"), none.alias("error"), *_counters(),
    )
    index = spark.createDataFrame([], INDEX) if index is None else index
    pending = spark.createDataFrame([], PENDING) if pending is None else pending
    counters = obs.intake.agg(*[(F.count(F.lit(1)) if c == "posts_scraped" else F.lit(0)).cast("bigint").alias(c) for c in COUNTERS])
    box = spark.createDataFrame([], "doc_key string, post_id string, op string, html string, metadata_json string, size_bytes bigint, seq int, result_doc_id string, day date")
    return RunResult(
        state=state, actions=actions, ops=actions.limit(0), outbox=box, documents=index, pending_deletes=pending, counters=counters,
        by_source=scraped_new_by_subreddit(obs.intake, state.tracked.limit(0)), totals=db_stats(state.tracked, state.comments, state.queue),
    )


def _result(state, after, obs, sinks, params, actions, box, days, counters, by_source, index, pending, sent=None) -> RunResult:
    """``sent``, if given, holds the keys of ``box``, which then has an operation per post and document."""
    ops = actions.where(F.col("op").isNotNull()).select("seq", "phase", "post_id", "op", "doc_key", "ok", "result_doc_id", "error")
    still = O.undelivered_deletes(ops, _run(params)).join(days, "post_id", "left")
    last = None if sent is None else O.still_last(box, sent)
    if pending is not None:
        # SNK-4: DELETEs that failed earlier go out before anything of this run
        again = O.delivery(pending.select("post_id", F.lit(O.OP_DELETE).alias("op"), "doc_key", "day").distinct(), sinks)
        resent = again.where("ok").select(
            "doc_key", "post_id", "op", F.lit(None).cast("string").alias("html"), F.lit(None).cast("string").alias("metadata_json"),
            F.lit(None).cast("bigint").alias("size_bytes"), F.lit(0).alias("seq"), "result_doc_id", "day",
        )
        box = box.unionByName(resent)
        still = O.undelivered_deletes(again, _run(params), "day").unionByName(still)
        if sent is not None:
            last = last.unionByName(resent.dropDuplicates(["doc_key"]).join(sent.select("doc_key"), "doc_key", "left_anti"))
    if sent is None:
        index = state.tracked.sparkSession.createDataFrame([], INDEX) if index is None else index
    # a document that this run put in place again, or deleted, is no longer owed a DELETE
    settled = ops.where("ok").select("doc_key").distinct()
    return RunResult(
        state=after, actions=actions, ops=ops, outbox=box, documents=O.apply_to_index(index, box) if sent is None else O.put(index, last),
        pending_deletes=still.join(settled, "doc_key", "left_anti").dropDuplicates(["doc_key"]).select("post_id", "doc_key", "error", "failed_at", "day"),
        counters=counters, by_source=by_source, totals=db_stats(after.tracked, after.comments, after.queue),
    )


def run_by_phases(
    state: State, obs: Observation, sinks: DataFrame, params: SyncParams, mode: str = "full", checkpoint: bool = True, index: DataFrame | None = None,
    pending: DataFrame | None = None,
) -> RunResult:
    """The same run phase by phase over whole tables.

    The tracked table and queue are cut (reliable checkpoint in the shared
    checkpoint folder) after each phase so the plan stays small and a lost
    executor only recomputes the current phase.
    """
    spark = state.tracked.sparkSession
    before = state.posts, state.comments
    events = spark.createDataFrame([], _events_schema(state))
    actions = None

    def cut(st: State) -> State:
        if not checkpoint:
            return st
        return replace(st, tracked=cut_lineage(st.tracked), queue=cut_lineage(st.queue))

    def add(acc, more):
        return more if acc is None else acc.unionByName(more)

    def events_add(ev):
        return events.unionByName(ev.select(*EMPTY_EVENTS_COLS), allowMissingColumns=False)

    st = state
    for ph in MODES[mode]:
        t0 = time.time()
        if ph in ("queue", "queue2"):
            st, ev, ac = phase_queue(st, obs, sinks, params, events, seq=10 if ph == "queue" else 60, attempt=1 if ph == "queue" else 2)
        elif ph == "repair":
            st, ev, ac = phase_repair(st, obs, sinks, params)
        elif ph == "new":
            st, ev, ac = phase_new(st, obs, sinks, params)
        elif ph == "update":
            st, ev, ac = phase_update(st, obs, sinks, params)
        elif ph == "freeze":
            st, ac = phase_freeze(st, params)
            ev = None
        else:  # retention (MUT-9) runs on the caches after the events
            before = posts, comments = apply_cache_events(st.posts, st.comments, events, obs.comments)
            posts, comments, tracked = S.retention(posts, comments, st.tracked, params)
            st = State(tracked=tracked, posts=posts, comments=comments, queue=st.queue)
            events = None
            break
        # events / actions are unions of per-phase pieces that are already
        # built on materialised inputs, so they grow linearly: no write here.
        if ev is not None:
            events = events_add(ev)
        actions = add(actions, ac)
        st = cut(st)
        log.info("phase %s done in %.1fs", ph, time.time() - t0)
    if events is not None:
        before = posts, comments = apply_cache_events(st.posts, st.comments, events, obs.comments)
        st = replace(st, posts=posts, comments=comments)
    if checkpoint:
        # The new state version: written once per run (caches included).
        st = State(
            tracked=cut_lineage(st.tracked), posts=cut_lineage(st.posts), comments=cut_lineage(st.comments), queue=cut_lineage(st.queue)
        )
    ops = actions.where(F.col("op").isNotNull())
    days = _days(state, obs)
    box = delivered_outbox(ops, obs, *before).join(days, "post_id", "left")
    created = st.tracked.join(state.tracked.select("post_id"), "post_id", "left_anti")
    by_source = scraped_new_by_subreddit(obs.intake, created)
    if "error" not in actions.columns:
        actions = actions.withColumn("error", F.lit(None).cast("string"))
    return _result(state, st, obs, sinks, params, actions, box, days, run_counters(actions), by_source, index, pending)


def _days(state: State, obs: Observation) -> DataFrame:
    """(post_id, day of creation) of every post a run may touch."""
    created = state.tracked.select("post_id", "created_utc").union(state.posts.select("id", "created_utc")).union(obs.intake.select("id", "created_utc"))
    return created.groupBy("post_id").agg(F.to_date(F.min("created_utc")).alias("day"))


def _events_schema(state: State):
    from pyspark.sql import types as T

    fields = [f for f in state.posts.select(*CACHED_POST_COLS).schema.fields]
    return T.StructType(
        fields
        + [
            T.StructField("seq", T.IntegerType()),
            T.StructField("refresh_content", T.BooleanType()),
            T.StructField("is_delete", T.BooleanType()),
        ]
    )
