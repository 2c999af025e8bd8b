"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Each docstring names the survey IDs it covers.  Every query reads the given
tables (through the adapters) over their whole extent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadkeeper.functions import columns as C
from threadkeeper.functions.fingerprint import fingerprint_posts
from threadkeeper.operators import documents as D
from threadkeeper.operators import outbox as O
from threadkeeper.operators import queue as Q
from threadkeeper.operators import state as S
from threadkeeper.operators import stats as ST
from threadkeeper.params import DOC_ID_PREFIX, SyncParams
from threadkeeper.plans import lifecycle as L
from threadkeeper.plans import scenarios as SC
from threadkeeper.schemas import QUEUE_SCHEMA, TRACKED_SCHEMA
from threadkeeper.session import cut_lineage, wall_clock
from threadkeeper.sources import adapters as A
from threadkeeper.sources import intake as I

P = SyncParams()
# Sources configured for the failed-source report: five deliver, two do not.
CONFIGURED_SOURCES = ("src0", "src1", "src2", "src3", "src4", "src5", "gone")


def _conv_posts(spark: SparkSession, d: str) -> DataFrame:
    return I.normalize_posts(A.conv_raw_posts(spark, d))


def _conv_comments(spark: SparkSession, d: str, params: SyncParams = P) -> DataFrame:
    return I.normalize_comments(A.conv_raw_comments(spark, d), params)


def _events_good(spark: SparkSession, d: str) -> DataFrame:
    good, _ = I.split_rejects(A.event_observations(spark, d))
    return good


# ---------------------------------------------------------------------------
# scans / sources
# ---------------------------------------------------------------------------
def src_window_scan(spark, d):
    """SRC-1, FLT-1, SRC-3: chronological-feed rows inside the 26 h window."""
    w = I.window_scan(_events_good(spark, d), P)
    return w.select("id", "subreddit", "feed_pos", C.epoch_to_ts("created_utc").alias("created_utc"), "observed_at")


def src_hot_top50(spark, d):
    """SRC-2, TOP-2: first 50 hot entries per source, then the cutoff."""
    return I.hot_top(_events_good(spark, d), P).select("id", "subreddit", "feed_pos", "observed_at")


def src_hot_polls(spark, d):
    """SRC-2, TOP-2: two polls of every source's hot feed in one day; the 50
    first entries of the later one, none of the earlier, then the cutoff."""
    good, _ = I.split_rejects(A.hot_polls(spark, d))
    return I.hot_top(good, P.with_(time_window_hours=24)).select("id", "subreddit", "feed_pos", "observed_at")


def src_failed_sources(spark, d):
    """SRC-4: configured sources whose poll failed, or that were not polled, by the run's manifest."""
    polled = _events_good(spark, d).select("subreddit").distinct()
    ok = F.col("subreddit") != "src3"
    manifest = polled.select("subreddit", ok.alias("ok"), F.when(~ok, F.lit("HTTP 429")).alias("error"))
    return I.failed_sources(manifest, P.with_(subreddits=CONFIGURED_SOURCES))


def src_configured(spark, d):
    """SRC-3: the window scan of a configured list of sources."""
    return I.window_scan(_events_good(spark, d), P.with_(subreddits=("src1", "src4"))).select("id", "subreddit", "feed_pos", "observed_at")


def src_refresh_outcome(spark, d):
    """SRC-5: FOUND / DELETED / FETCH_FAILED for every tracked id."""
    state, _, _ = SC.docs(spark, d, P)
    snap = A.doc_observed(spark, d, P.run_micros)
    return I.refresh_outcome(state.tracked.select("post_id"), snap).select("post_id", "outcome")


def src_rejects(spark, d):
    """SRC-7: malformed observations are isolated; the others proceed."""
    good, bad = I.split_rejects(A.event_observations(spark, d))
    return good.select(F.lit(True).alias("valid"), "feed_pos").unionByName(bad.select(F.lit(False).alias("valid"), "feed_pos")).groupBy(
        "valid"
    ).agg(F.count(F.lit(1)).alias("n"))


def src_quarantine(spark, d):
    """SRC-7 in a run: rejects with their reasons, committed beside the state."""
    from threadkeeper.plans.store import StateStore

    store = StateStore(spark, _scratch(spark, "quarantine"))
    state = L.State(*[spark.createDataFrame([], x) for x in (TRACKED_SCHEMA, "id string", "post_id string", QUEUE_SCHEMA)])
    obs = L.observe(A.event_observations(spark, d), SC.empty_raw_comments(spark), P)
    store.write(state, "day1", P.run_ts, obs.rejects)
    return store.rejects().groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def src_cached_post(spark, d):
    """SRC-8, JN-3, AGG-1: cached post with its comments nested, best first."""
    state, _, _ = SC.conv(spark, d, P)
    nested = state.comments.groupBy("post_id").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("listing_pos"), F.col("id")))).alias("cs")
    )
    j = state.posts.withColumnRenamed("id", "post_id").join(nested, "post_id", "left")
    cs = F.coalesce(F.col("cs"), F.array().cast("array<struct<s:int,listing_pos:int,id:string>>"))
    return j.select(
        "post_id",
        C.text_or_empty("selftext").alias("selftext"),
        F.size(cs).cast("bigint").alias("n_comments"),
        F.try_element_at(cs, F.lit(1))["id"].alias("top_comment"),
        F.array_join(F.transform(cs, lambda c: c["id"]), ",").alias("comment_order"),
    )


def src_tracked_lookup(spark, d):
    """SRC-9, JN-8: tracked lookup for every observed id; null hash -> ''."""
    state, obs, _ = SC.events(spark, d, P)
    t = state.tracked.select("post_id", F.coalesce("content_hash", F.lit("")).alias("content_hash"), F.lit(True).alias("t"))
    j = obs.refresh.select(F.col("id").alias("post_id")).join(t, "post_id", "left")
    return j.select("post_id", F.col("t").isNotNull().alias("tracked"), "content_hash")


# ---------------------------------------------------------------------------
# projections / functions
# ---------------------------------------------------------------------------
def prj_normalize_post(spark, d):
    """PRJ-1, FN-1..7, FN-9: normalised posts."""
    p = _conv_posts(spark, d)
    return p.select(
        *[c for c in p.columns], C.full_url("permalink").alias("full_url"), C.age_days("created_utc", P.run_micros).alias("age_days")
    )


def prj_normalize_comment(spark, d):
    """PRJ-2, SRC-6, FLT-2, WIN-1, FN-1/3/4/8: normalised capped comments."""
    c = _conv_comments(spark, d)
    return c.select(*c.columns, C.comment_permalink("parent_id", "id").alias("permalink"))


def fn_media_url(spark, d):
    """FN-6: media url when the url ends with a media suffix (case-sensitive)."""
    return A.page_urls(spark, d).select("page_id", "url", C.media_url("url").alias("media_url"))


def fn_permalinks(spark, d):
    """FN-7, FN-8: thread and comment permalinks (large adapter)."""
    c = I.normalize_comments(A.lineitem_raw_comments(spark, d), P)
    return c.select("post_id", "id", C.full_url(F.concat(F.lit("/comments/"), F.col("post_id"))).alias("thread_url"),
                    C.comment_permalink("parent_id", "id").alias("permalink"))


def fn_age_days(spark, d):
    """FN-9, FLT-3: age in days and the update-window test."""
    p = I.normalize_posts(A.order_raw_posts(spark, d))
    age = C.age_days("created_utc", P.run_micros)
    return p.select("id", age.alias("age_days"), (age <= F.lit(float(P.update_window_days))).alias("in_window"))


def _order_instants(spark, d):
    o = A.table(spark, d, "orders")
    k = F.col("o_orderkey")
    micros = F.unix_micros(F.col("o_orderdate").cast("timestamp")) + (k % 24) * 3_600_000_000 + (k % 60) * 60_000_000 + F.when(
        k % 3 == 0, F.lit(0)
    ).otherwise(k % 1_000_000)
    return o.select(k.alias("o_orderkey"), F.timestamp_micros(micros).alias("ts"))


def fn_pacific_date(spark, d):
    """FN-10: Pacific calendar date of an instant."""
    return _order_instants(spark, d).select("o_orderkey", C.pacific_date("ts").alias("pacific_date"))


def fn_dual_time(spark, d):
    """FN-11: 'Mon DD, YYYY at HH:MM AM PST (YYYY-MM-DD HH:MM UTC)'."""
    return _order_instants(spark, d).select("o_orderkey", C.dual_time_label("ts").alias("label"))


def fn_iso_time(spark, d):
    """FN-12: ISO-8601 in UTC and Pacific, fraction only when non-zero."""
    t = _order_instants(spark, d)
    return t.select("o_orderkey", C.iso_utc("ts").alias("iso_utc"), C.iso_pacific("ts").alias("iso_pacific"))


def fn_ratio_bp(spark, d):
    """FN-13: basis points with half-to-even rounding."""
    o = A.table(spark, d, "orders")
    r = (F.col("o_orderkey") % 20001).cast("double") / 20000
    return o.select("o_orderkey", C.ratio_bp(r).alias("ratio_bp"))


def fn_html_escape(spark, d):
    """FN-15: '&', '<', '>' escaped over whole document texts."""
    return A.table(spark, d, "documents").select("doc_id", C.html_escape("text").alias("escaped"))


def fn_comment_tags(spark, d):
    """FN-19: ' [OP, edited, reply depth N]' tags."""
    return _conv_comments(spark, d).select("id", C.comment_tags("is_submitter", "edited", "depth").alias("tags"))


def fn_doc_id(spark, d):
    """FN-16, FN-17, FN-18: document id and file name, byte size, title previews."""
    p = _conv_posts(spark, d)
    return p.select(
        "id", C.doc_id("id").alias("doc_id"), C.doc_file_name("id").alias("file_name"),
        C.size_bytes("selftext").alias("selftext_bytes"), C.preview("title", 50).alias("preview50"),
    )


# ---------------------------------------------------------------------------
# filters
# ---------------------------------------------------------------------------
def flt_bots(spark, d):
    """FLT-2: comments dropped as bots (mixed case, missing author included)."""
    r = A.conv_raw_comments(spark, d)
    return r.where(I.is_bot(C.author_or_deleted("author"))).select("id", C.author_or_deleted("author").alias("author"))


def flt_update_window(spark, d):
    """FLT-3: posts inside the update window (inclusive)."""
    p = I.normalize_posts(A.order_raw_posts(spark, d))
    return p.where(L.in_update_window(P)).select("id")


def flt_deleted(spark, d):
    """FLT-4: deleted = author missing or text '[deleted]' / '[removed]' (raw row)."""
    return A.conv_raw_posts(spark, d).where(C.is_deleted_raw("author", "selftext")).select("id")


def flt_processed_today(spark, d):
    """FLT-5: last processed on the run's Pacific day."""
    state, _, _ = SC.events(spark, d, P)
    return state.tracked.where(L.today_guard(P)).select("post_id")


def flt_due_update(spark, d):
    """FLT-6, SRT-1: rows due for update, in update order."""
    state, _, _ = SC.events(spark, d, P)
    return state.tracked.where(L.due_for_update(P)).select("post_id", "update_count", "first_scraped").orderBy(
        "update_count", "first_scraped", "post_id"
    )


def flt_due_freeze(spark, d):
    """FLT-7: rows due to be frozen."""
    state, _, _ = SC.events(spark, d, P)
    return state.tracked.where(S.due_for_freeze(state.tracked, P)).select("post_id")


def flt_missing_hash(spark, d):
    """FLT-8: hash missing and not frozen."""
    state, _, _ = SC.events(spark, d, P)
    return state.tracked.where(L.missing_hash()).select("post_id")


def flt_queue_due(spark, d):
    """FLT-9: queue items with attempts left and due now."""
    return A.event_queue(spark, d).where(Q.is_due(P)).select("post_id", "action")


# ---------------------------------------------------------------------------
# windows, sets, joins
# ---------------------------------------------------------------------------
def win_first_n_comments(spark, d):
    """WIN-1: first 3 comments per post in listing order, after the bot filter."""
    c = I.normalize_comments(A.lineitem_raw_comments(spark, d), P.with_(max_comments=3))
    return c.select("post_id", "id", "listing_pos")


def win_comment_rank(spark, d):
    """WIN-2, AGG-1: rank by score desc, listing order on ties."""
    disc = _conv_comments(spark, d)
    pieces = disc.groupBy("post_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "listing_pos", "id"))).alias("cs"))
    return pieces.select("post_id", F.posexplode("cs").alias("pos", "c")).select(
        "post_id", F.col("c.id").alias("id"), (F.col("pos") + 1).cast("int").alias("rank")
    )


def win_latest_observation(spark, d):
    """WIN-3: latest observation per post id."""
    return I.latest_observation(_events_good(spark, d)).select("id", "observed_at", "feed", "feed_pos", "score")


def set_new_hot(spark, d):
    """SET-1, SET-2: new-feed window ∪ hot top-50, one row per id."""
    good = _events_good(spark, d)
    both = I.window_scan(good, P).unionByName(I.hot_top(good, P))
    return I.latest_observation(both).select("id", "feed", "feed_pos")


def jn_new_posts(spark, d):
    """JN-1: observed posts in the window that are not tracked."""
    state, obs, _ = SC.conv(spark, d, P)
    return obs.intake.join(state.tracked.select(F.col("post_id").alias("id")), "id", "left_anti").select("id")


def jn_existing(spark, d):
    """JN-2: observed and tracked posts keep their stored document id."""
    state, obs, _ = SC.conv(spark, d, P)
    return obs.intake.select("id").join(state.tracked.select(F.col("post_id").alias("id"), "contextual_doc_id"), "id")


def jn_orphans(spark, d):
    """JN-7: cached posts no tracked row refers to."""
    state, _, _ = SC.events(spark, d, P)
    return state.posts.join(state.tracked.select(F.col("post_id").alias("id")), "id", "left_anti").select("id")


def jn_exists(spark, d):
    """JN-8: (post_id, exists) for every queued post."""
    state, _, _ = SC.events(spark, d, P)
    keys = state.tracked.select("post_id").distinct().withColumn("e", F.lit(True))
    return state.queue.select("post_id").distinct().join(keys, "post_id", "left").select(
        "post_id", F.col("e").isNotNull().alias("exists")
    )


def hash_content(spark: SparkSession, d: str) -> DataFrame:
    """HASH-1 (flagship) with SRC-6, FLT-2, WIN-1, JN-3: fingerprint of every post."""
    posts = _conv_posts(spark, d).select(F.col("id").alias("post_id"), "subreddit", "title", "selftext")
    fp = fingerprint_posts(posts, _conv_comments(spark, d))
    return fp.select("post_id", "subreddit", "n_comments", "content_hash")


# ---------------------------------------------------------------------------
# documents
# ---------------------------------------------------------------------------
def doc_html(spark, d):
    """DOC-1..4, FN-11, FN-15, FN-19, WIN-2: rendered document per post."""
    r = D.render(_conv_posts(spark, d), _conv_comments(spark, d))
    return r.select("id", "html", C.size_bytes("html").alias("size_bytes"))


def doc_metadata(spark, d):
    """MD-1, FN-12..14: metadata record fields (absent optional = null)."""
    return _conv_posts(spark, d).select(*D.metadata_columns())


def doc_metadata_nulls(spark, d):
    """FN-14: landed null counts reach the metadata as zero."""
    raw = A.conv_raw_posts(spark, d)
    raw = raw.withColumn("score", F.when(F.col("feed_pos") % 3 != 0, F.col("score"))).withColumn("num_comments", F.when(F.col("feed_pos") % 5 != 0, F.col("num_comments")))
    raw = raw.withColumn("total_awards_received", F.when(F.col("feed_pos") % 7 != 0, F.col("total_awards_received")))
    return I.normalize_posts(raw).select("id", D.metadata_json().alias("record")).select(
        "id", *[F.get_json_object("record", f"$.{c}").alias(c) for c in ("score", "num_comments", "total_awards_received", "flair")]
    )


# ---------------------------------------------------------------------------
# state mutations
# ---------------------------------------------------------------------------
def mut_upsert_tracked(spark, d):
    """MUT-1: upsert with replace / coalesce / keep column rules."""
    state, obs, _ = SC.events(spark, d, P)
    run = C.run_ts_lit(P.run_micros)
    u = F.substring("id", 2, 20).cast("bigint")
    delta = obs.refresh.where((u % 3 == 0) | (u % 5 == 0)).select(
        F.col("id").alias("post_id"), F.lit("changed").alias("subreddit"), "created_utc",
        run.alias("first_scraped"), run.alias("last_updated"), F.lit(7).alias("update_count"),
        F.lit("updating").alias("status"), F.when(u % 9 != 0, F.concat(F.lit("new_"), F.col("id"))).alias("contextual_doc_id"),
        "content_hash",
    )
    return S.upsert_tracked(state.tracked, delta)


def mut_upsert_posts(spark, d):
    """MUT-2: volatile columns replaced, text keeps its first value."""
    state, obs, _ = SC.events(spark, d, P)
    u = F.substring("id", 2, 20).cast("bigint")
    run = C.run_ts_lit(P.run_micros)
    fresh = SC.cache_rows(obs.refresh.where(u % 4 != 1).withColumn("title", F.lit("new title")), run, F.lit(3))
    return S.upsert_posts(state.posts, fresh).select("id", "title", "score", "num_comments", "upvote_ratio", "update_count", "scraped_at")


def mut_replace_comments(spark, d):
    """MUT-3: comments of saved posts are replaced by the new (2-capped) set."""
    old = _conv_comments(spark, d)
    saved = _conv_posts(spark, d).where(F.substring("id", 2, 20).cast("bigint") % 3 == 0).select("id")
    new = _conv_comments(spark, d, P.with_(max_comments=2)).join(saved.withColumnRenamed("id", "post_id"), "post_id", "left_semi")
    return S.replace_comments(old, saved, new).select("post_id", "id")


def mut_delete_cascade(spark, d):
    """MUT-4: cascade delete of deleted posts, tracked or not: what is left of
    the three tables, and for each deleted post whether a tracked row existed."""
    state, obs, _ = SC.conv(spark, d, P)
    ids = obs.refresh.where(F.col("deleted")).select(F.col("id").alias("post_id"))
    posts, comments, tracked, existed = S.delete_cascade(state.posts, state.comments, state.tracked, ids)

    def rows(df, kind, key, existed=F.lit(None)):
        return df.select(F.lit(kind).alias("kind"), F.col(key).alias("key"), existed.cast("boolean").alias("existed"))

    out = rows(existed, "deleted", "post_id", F.col("existed")).unionByName(rows(tracked, "tracked", "post_id"))
    return out.unionByName(rows(posts, "post", "id")).unionByName(rows(comments, "comment", "id"))


def mut_enqueue(spark, d):
    """MUT-6: enqueue with priority = greatest(old, new) on key conflict."""
    q = A.event_queue(spark, d)
    e = A.table(spark, d, "events")
    req = e.select(
        F.concat(F.lit("e"), F.col("user_id")).alias("post_id"), F.concat(F.lit("src"), F.col("user_id") % 5).alias("subreddit"),
        F.lit("update").alias("action"), (F.col("event_id") % 4).cast("int").alias("priority"),
    )
    out = Q.enqueue(q, req, P)
    return out.drop("id")


def mut_backoff(spark, d):
    """MUT-8: every due item fails once: attempts + 1, 5·2^n minutes later."""
    q = A.event_queue(spark, d)
    failed = q.where(Q.is_due(P)).select("post_id", "action", F.lit("HTTP 503").alias("error"))
    return Q.mark_failure(q, failed, P).drop("id")


def mut_success(spark, d):
    """MUT-7: the due batch succeeds and leaves the queue."""
    q = A.event_queue(spark, d)
    return Q.mark_success(q, Q.due_batch(q, P)).select("post_id", "action")


def _retention_tables(spark, d):
    run = C.run_ts_lit(P.run_micros)
    o = A.table(spark, d, "orders")
    k = F.col("o_orderkey")
    tracked = o.where(k % 5 != 0).select(
        F.concat(F.lit("o"), k).alias("post_id"), (run - F.make_dt_interval((k % 40).cast("int"))).alias("first_scraped")
    )
    posts = o.where(k % 7 != 0).select(F.concat(F.lit("o"), k).alias("id"))
    comments = A.table(spark, d, "lineitem").select(
        F.concat(F.lit("o"), F.col("l_orderkey")).alias("post_id"), F.col("l_partkey"), F.col("l_linenumber")
    )
    return posts, comments, tracked


def mut_retention(spark, d):
    """MUT-9, JN-6, JN-7, FLT-12: retention purge with the orphan rule."""
    posts, comments, tracked = _retention_tables(spark, d)
    p, c, t = S.retention(posts, comments, tracked, P)
    return (
        p.select(F.lit("post").alias("kind"), F.col("id").alias("key"), F.lit(1).cast("bigint").alias("n"))
        .unionByName(t.select(F.lit("tracked").alias("kind"), F.col("post_id").alias("key"), F.lit(1).cast("bigint").alias("n")))
        .unionByName(c.groupBy(F.col("post_id").alias("key")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("comments").alias("kind"), "key", "n"))
    )


def mut_freeze(spark, d):
    """MUT-5, LIFE-7: due rows become frozen at the run time."""
    state, _, _ = SC.events(spark, d, P)
    return S.freeze(state.tracked, P).select("post_id", "status", "last_updated")


# ---------------------------------------------------------------------------
# outbox / delivery / index
# ---------------------------------------------------------------------------
def _docs_ops(spark, d):
    state, obs, sinks = SC.docs(spark, d, P)
    cl = L._ops_for(L.classify(state.tracked, obs, state.posts, P))
    return state, obs, sinks, cl.where(F.col("op").isNotNull())


def snk_outbox(spark, d):
    """SNK-1..4, LIFE-9: outbox rows; HTML only for (re)ingest."""
    state, obs, _, ops = _docs_ops(spark, d)
    box = O.outbox(ops.select("post_id", "op", "doc_key"), obs.refresh, obs.comments)
    return box.select("post_id", "op", "doc_key", "size_bytes", F.md5("html").alias("html_md5"), F.col("metadata_json").isNotNull().alias("has_metadata"))


def snk_delivery(spark, d):
    """SNK-6: delivery outcome per op (missing result = success)."""
    _, _, sinks, ops = _docs_ops(spark, d)
    return O.delivery(ops.select("post_id", "op", "doc_key"), sinks).select("post_id", "op", "ok", "result_doc_id")


def snk_apply_index(spark, d):
    """SNK-5: latest op per document applied to the index."""
    state, obs, sinks, ops = _docs_ops(spark, d)
    index = state.tracked.where(F.col("contextual_doc_id").isNotNull()).select(
        F.col("contextual_doc_id").alias("doc_id"), "post_id", F.lit("v0").alias("html"),
        F.lit("{}").alias("metadata_json"), F.lit(2).cast("bigint").alias("size_bytes"),
    )
    box = O.outbox(ops.select("post_id", "op", "doc_key"), obs.refresh, obs.comments).withColumn("seq", F.lit(1))
    ok = O.delivery(box, sinks).where(F.col("ok"))
    return O.apply_to_index(index, ok).select("doc_id", "post_id", "size_bytes")


def _sink_case(spark, d):
    """Operations and reports over documents: a failure, another id, and a
    report that came twice (a failure, then a success with another id)."""
    k = F.col("doc_id")
    op = F.element_at(F.array(*[F.lit(o) for o in (O.OP_INGEST, O.OP_REINGEST, O.OP_SET_METADATA, O.OP_DELETE)]), (k % 4 + 1).cast("int"))
    base = A.table(spark, d, "documents").select("doc_id")
    ops = base.select(
        F.concat(F.lit("d"), k).alias("post_id"), op.alias("op"),
        F.when(k % 4 == 0, F.concat(F.lit(DOC_ID_PREFIX + "d"), k)).otherwise(F.concat(F.lit("idx-"), k)).alias("doc_key"), "doc_id",
    )
    key = ops.select("doc_key", "op", "doc_id")
    new_id = F.concat(F.lit("new-"), k)
    none = F.lit(None).cast("string")
    failed = key.where((k % 5 == 1) | (k % 5 == 3)).select("doc_key", "op", F.lit(False).alias("ok"), none.alias("returned_doc_id"), F.lit("HTTP 503").alias("error"))
    moved = key.where((k % 5 == 2) | (k % 5 == 3)).select("doc_key", "op", F.lit(True).alias("ok"), new_id.alias("returned_doc_id"), none.alias("error"))
    index = ops.where(F.col("op") != O.OP_INGEST).select(
        F.concat(F.lit("idx-"), k).alias("doc_id"), "post_id", F.lit("v0").alias("html"), F.lit("{}").alias("metadata_json"), F.lit(2).cast("bigint").alias("size_bytes")
    )
    return ops.drop("doc_id"), failed.unionByName(moved), index


def _delivered_index(ops, results, index):
    box = O.delivery(ops, results)
    rows = box.where(F.col("ok")).select(
        "post_id", "op", "doc_key", "result_doc_id", F.lit(1).alias("seq"), F.lit("v1").alias("html"), F.lit("{}").alias("metadata_json"), F.lit(2).cast("bigint").alias("size_bytes")
    )
    return box, O.apply_to_index(index, rows)


def snk_duplicate_results(spark, d):
    """SNK-6: one outcome per operation, however often it was reported."""
    ops, results, _ = _sink_case(spark, d)
    return O.delivery(ops, results).select("post_id", "op", "ok", "result_doc_id")


def snk_ids_agree(spark, d):
    """SNK-3/5: the id that tracked keeps for a post is its document's id in the index."""
    ops, results, index = _sink_case(spark, d)
    box, after = _delivered_index(ops, results, index)
    content = F.col("op").isin(O.OP_INGEST, O.OP_REINGEST)
    tracked = box.where(F.col("op") != O.OP_DELETE).select(
        "post_id", F.when(F.col("ok") & content, F.col("result_doc_id")).when(F.col("op") != O.OP_INGEST, F.col("doc_key")).alias("tracked_id")
    )
    return tracked.join(after.select("post_id", F.col("doc_id").alias("index_id")), "post_id", "left")


def snk_redelivery(spark, d):
    """SNK-4: a failed DELETE is remembered, sent again and then takes effect."""
    ops, results, index = _sink_case(spark, d)
    box, after = _delivered_index(ops, results, index)
    again = O.redelivery(O.undelivered_deletes(box, C.run_ts_lit(P.run_micros)))
    second = O.delivery(again, results, attempt=2).where(F.col("ok"))
    later = O.apply_to_index(after, second.select("post_id", "op", "doc_key", "result_doc_id", F.lit(2).alias("seq"), *[F.lit(None).cast(t).alias(c) for c, t in (("html", "string"), ("metadata_json", "string"), ("size_bytes", "bigint"))]))
    left = later.select("doc_id", F.lit(True).alias("there"))
    return after.select("post_id", "doc_id").join(left, "doc_id", "left").select("post_id", "doc_id", F.col("there").isNull().alias("removed_later"))


# ---------------------------------------------------------------------------
# lifecycle
# ---------------------------------------------------------------------------
def life_classify(spark, d):
    """LIFE-2, JN-4, FLT-5/6/10/11: one action per due tracked row."""
    state, obs, _ = SC.docs(spark, d, P)
    return L.classify(state.tracked, obs, state.posts, P).select("post_id", "action")


def life_new(spark, d):
    """LIFE-1, JN-1/2, FLT-3, SNK-6: new posts ingested or queued."""
    state, obs, sinks = SC.conv(spark, d, P)
    st, _, actions = L.phase_new(state, obs, sinks, P)
    created = st.tracked.join(state.tracked.select("post_id"), "post_id", "left_anti")
    a = actions.where(F.col("phase") == "new").select("post_id", "action")
    q = st.queue.select("post_id", "priority")
    return a.join(created.select("post_id", "contextual_doc_id", "content_hash", "update_count"), "post_id", "left").join(q, "post_id", "left")


def _tracked_out(t: DataFrame) -> DataFrame:
    return t.select("post_id", "update_count", "status", "contextual_doc_id", "content_hash", "last_updated")


def life_reingest(spark, d):
    """LIFE-3..6, LIFE-9, MUT-1/6: the update phase applied with delivery results."""
    state, obs, sinks = SC.docs(spark, d, P)
    st, _, _ = L.phase_update(state, obs, sinks, P)
    q = st.queue.select("post_id", F.col("action").alias("queued"), "priority")
    return _tracked_out(st.tracked).join(q, "post_id", "full_outer")


def life_freeze(spark, d):
    """LIFE-7: update phase followed by the freeze phase."""
    state, obs, sinks = SC.events(spark, d, P)
    st, _, _ = L.phase_update(state, obs, sinks, P)
    st, _ = L.phase_freeze(st, P)
    return _tracked_out(st.tracked)


def life_repair(spark, d):
    """LIFE-8: missing-hash repair (re-sync, delete, or logged failure)."""
    state, obs, sinks = SC.events(spark, d, P)
    st, _, _ = L.phase_repair(state, obs, sinks, P)
    return _tracked_out(st.tracked)


def life_queue(spark, d):
    """LIFE-10, TOP-1, JN-5, MUT-7/8: one pass over the due batch."""
    state, obs, sinks = SC.events(spark, d, P)
    st, _, _ = L.phase_queue(state, obs, sinks, P)
    q = st.queue.select("post_id", "action", "attempts", "last_error", "scheduled_for")
    return q


def life_full_run(spark, d):
    """LIFE-11, MUT-9, SNK-1..5, AGG-8: a full run at scale (orders + lineitem):
    all its state, the rendered documents it leaves and its counters as long rows."""
    state, obs, sinks = SC.orders(spark, d, P)
    res = L.run(state, obs, sinks, P)
    st = res.state

    def rows(df, kind, key, n, value):
        return df.select(F.lit(kind).alias("kind"), key.alias("key"), n.cast("bigint").alias("n"), value.cast("string").alias("value"))

    c = F.col
    age = (F.lit(P.run_micros) - F.unix_micros("last_updated")) / F.lit(3_600_000_000)
    hours = (F.unix_micros("scheduled_for") - F.lit(P.run_micros)) / F.lit(60_000_000)
    tracked = F.concat_ws("|", "status", F.coalesce("contextual_doc_id", F.lit("-")), "content_hash", age.cast("int").cast("string"))
    queued = F.concat_ws("|", "action", c("priority").cast("string"), F.coalesce("last_error", F.lit("-")), hours.cast("int").cast("string"))
    per_post = st.comments.groupBy("post_id").agg(F.count(F.lit(1)).alias("n"))
    counters = res.counters.select(F.explode(F.map_from_arrays(F.array(*[F.lit(x) for x in ST.COUNTERS]), F.array(*ST.COUNTERS))))
    none = F.lit(None)
    out = rows(st.tracked, "tracked", c("post_id"), c("update_count"), tracked)
    out = out.unionByName(rows(st.posts, "post", c("id"), c("score"), c("update_count")))
    out = out.unionByName(rows(per_post, "comments", c("post_id"), c("n"), none))
    out = out.unionByName(rows(st.queue, "queue", c("post_id"), c("attempts"), queued))
    out = out.unionByName(rows(res.documents, "document", c("doc_id"), c("size_bytes"), F.md5("html")))
    return out.unionByName(rows(counters, "counter", c("key"), c("value"), none))


def life_run_state(spark, d):
    """LIFE-11, AGG-8: a whole run over conversations, all its state and
    counters as long rows; ingests that fail in the phase "new" are delivered
    by the second queue pass."""
    state, obs, sinks = SC.conv(spark, d, P)
    res = L.run(state, obs, sinks, P)
    st, n = res.state, lambda c: F.col(c).cast("bigint").alias("n")
    rows = st.tracked.select(F.lit("tracked").alias("kind"), F.col("post_id").alias("key"), n("update_count"))
    rows = rows.unionByName(st.posts.select(F.lit("post").alias("kind"), F.col("id").alias("key"), n("update_count")))
    rows = rows.unionByName(st.comments.groupBy(F.col("post_id").alias("key")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("comments").alias("kind"), "key", "n"))
    rows = rows.unionByName(st.queue.select(F.lit("queue").alias("kind"), F.col("post_id").alias("key"), n("attempts")))
    counters = res.counters.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in ST.COUNTERS]), F.array(*ST.COUNTERS))))
    return rows.unionByName(counters.select(F.lit("counter").alias("kind"), F.col("key"), F.col("value").alias("n")))


def life_documents(spark, d):
    """LIFE-11, SNK-1..5: the document index that a whole run over conversations leaves."""
    state, obs, sinks = SC.conv(spark, d, P)
    return L.run(state, obs, sinks, P).documents.select("doc_id", "post_id", "size_bytes", F.md5("html").alias("html_md5"))


def life_two_days(spark, d):
    """SNK-4, SNK-5, LIFE-11 across runs: two daily runs over documents on a
    document table; the DELETEs that fail on day 1 take effect on day 2."""
    from threadkeeper.plans.doctable import DocumentTable

    state, obs, sinks = SC.docs(spark, d, P)
    state = SC.stored(state)
    table = DocumentTable(spark, _scratch(spark, "doctable"))
    # the index before day 1: the document of every tracked post that has one
    first = state.tracked.where(F.col("contextual_doc_id").isNotNull()).select(
        "post_id", F.lit(O.OP_INGEST).alias("op"), F.col("contextual_doc_id").alias("doc_key"), F.col("contextual_doc_id").alias("result_doc_id"),
        F.lit(0).alias("seq"), F.lit("v0").alias("html"), F.lit("{}").alias("metadata_json"), F.lit(2).cast("bigint").alias("size_bytes"),
        F.to_date("created_utc").alias("day"),
    )
    table.merge(first)
    day1 = L.run(state, obs, sinks, P, mode="update", index=table.documents(), pending=table.pending())
    table.apply(day1)
    after1 = cut_lineage(table.documents().select("doc_id", "post_id", "size_bytes", F.md5("html").alias("html_md5")))
    owed1 = cut_lineage(table.pending().select("doc_key", F.lit(True).alias("owed")))
    # day 2: the index takes everything
    later = P.at(DAYS[1])
    day2 = L.run(SC.stored(day1.state), obs, sinks.where("ok"), later, mode="update", index=table.documents(), pending=table.pending())
    table.apply(day2)
    after2 = table.documents().select("doc_id", F.lit(True).alias("there"))
    j = after1.join(owed1.withColumnRenamed("doc_key", "doc_id"), "doc_id", "left").join(after2, "doc_id", "left")
    left = table.pending().agg(F.count(F.lit(1)).alias("owed_later"))
    return j.select("doc_id", "post_id", "size_bytes", "html_md5", F.coalesce("owed", F.lit(False)).alias("owed"), F.col("there").isNotNull().alias("there_later"),
                    left.select("owed_later").scalar().alias("owed_later"))


def life_queue_tracked(spark, d):
    """LIFE-10, JN-5: ingests that fail in the phase "new" and succeed in the
    queue pass of the same run; the created rows are hashed from this run's
    posts and comments."""
    state, obs, sinks = SC.conv(spark, d, P)
    st, ev, _ = L.phase_new(state, obs, sinks, P)
    st = L.State(tracked=cut_lineage(st.tracked), posts=st.posts, comments=st.comments, queue=cut_lineage(st.queue))
    st, _, _ = L.phase_queue(st, obs, sinks, P, ev.select(*L.EMPTY_EVENTS_COLS), seq=60, attempt=2)
    return _tracked_out(st.tracked)


def life_modes(spark, d):
    """LIFE-12: scrape-only, update-only and queue-only runs."""
    out = None
    for mode in ("scrape", "update", "queue"):
        state, obs, sinks = SC.conv(spark, d, P)
        res = L.run(state, obs, sinks, P, mode=mode)
        t = _tracked_out(res.state.tracked).withColumn("mode", F.lit(mode))
        out = t if out is None else out.unionByName(t)
    return out


def life_queue_mode(spark, d):
    """LIFE-12, LIFE-10: a queue-only run over a filled queue."""
    state, obs, sinks = SC.events(spark, d, P)
    res = L.run(state, obs, sinks, P, mode="queue")
    return res.state.queue.select("post_id", "action", "attempts", "last_error", "scheduled_for")


def life_dry_run(spark, d):
    """LIFE-12: a dry run lists what a scrape would ingest, and changes nothing."""
    state, obs, sinks = SC.conv(spark, d, P)
    res = L.run(state, obs, sinks, P, mode="dry")
    scraped = res.counters.select("posts_scraped").scalar()
    return res.actions.select("post_id", "action", scraped.alias("posts_scraped"))


DAYS = ("2024-01-31 16:00:00", "2024-02-01 16:00:00", "2024-02-02 16:00:00", "2024-02-03 16:00:00")


def life_day_progression(spark, d):
    """LIFE-13: four daily runs over the same snapshot: -1 -> 0 -> 1 -> frozen."""
    state, _, sinks = SC.conv(spark, d, P)
    state = L.State(tracked=state.tracked.limit(0), posts=state.posts.limit(0), comments=state.comments.limit(0), queue=state.queue)
    out = None
    for day, ts in enumerate(DAYS, 1):
        params = P.at(ts).with_(time_window_hours=24 * 5, update_window_days=5)
        obs = L.observe(A.conv_raw_posts(spark, d), A.conv_raw_comments(spark, d), params)
        res = L.run(state, obs, sinks, params)
        state = res.state
        t = state.tracked.select("post_id", "update_count", "status", F.lit(day).alias("day"))
        out = t if out is None else out.unionByName(t)
    return out


def top_queue_batch(spark, d):
    """TOP-1: due items by priority desc, oldest first, limit 50."""
    return Q.due_batch(A.event_queue(spark, d), P.with_(queue_limit=50)).select("post_id", "action", "priority", "created_at")


# ---------------------------------------------------------------------------
# aggregations
# ---------------------------------------------------------------------------
def agg_status(spark, d):
    """AGG-3: tracked rows by status."""
    state, _, _ = SC.events(spark, d, P)
    return ST.by_status(state.tracked)


def agg_subreddit(spark, d):
    """AGG-4: tracked rows by source."""
    o = A.table(spark, d, "orders")
    tracked = o.select(F.col("o_orderpriority").alias("subreddit"))
    return ST.by_subreddit(tracked)


def agg_db_totals(spark, d):
    """AGG-2, AGG-5, AGG-6: totals of tracked, comments, pending queue."""
    state, _, _ = SC.conv(spark, d, P)
    q = A.event_queue(spark, d)
    return ST.db_totals(state.tracked, state.comments, q)


def agg_run_counters(spark, d):
    """AGG-8, AGG-9: run counters of the update phase and the run summary."""
    state, obs, sinks = SC.docs(spark, d, P)
    _, _, actions = L.phase_update(state, obs, sinks, P)
    return ST.run_summary(ST.run_counters(actions), P.run_micros, P.run_micros + 90_000_000)


def agg_scraped_new(spark, d):
    """AGG-7: per source, posts scraped and newly tracked."""
    state, obs, sinks = SC.conv(spark, d, P)
    st, _, _ = L.phase_new(state, obs, sinks, P)
    created = st.tracked.join(state.tracked.select("post_id"), "post_id", "left_anti")
    return ST.scraped_new_by_subreddit(obs.intake, created)


def agg_dry_run(spark, d):
    """AGG-10: dry-run report, observed posts per source."""
    good = _events_good(spark, d)
    both = I.window_scan(good, P).unionByName(I.hot_top(good, P))
    return ST.dry_run_report(I.latest_observation(both))


def top_dry_run_sample(spark, d):
    """TOP-3: dry-run sample of 5 posts (newest first)."""
    obs = I.normalize_posts(I.latest_observation(_events_good(spark, d)))
    return ST.dry_run_sample(obs, 5)


QUERIES = {
    name: fn
    for name, fn in list(globals().items())
    if callable(fn) and getattr(fn, "__module__", None) == __name__ and not name.startswith("_") and name not in ("registered",)
    and name.split("_")[0] in {"src", "prj", "fn", "flt", "win", "set", "jn", "hash", "doc", "mut", "snk", "life", "top", "agg"}
}


def registered() -> dict:
    return {name: (lambda f: (lambda spark, d: wall_clock(f(spark, d))))(f) for name, f in QUERIES.items()}


# ---------------------------------------------------------------------------
# streaming
# ---------------------------------------------------------------------------
def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    import uuid

    from threadkeeper.session import checkpoint_dir

    return f"{checkpoint_dir(spark).rstrip('/')}/threadkeeper-{name}-{uuid.uuid4().hex}"


def str_intake(spark, d):
    """STR-1, SET-1: the intake that the stateful feed streams show once all
    polls have landed, several files at a time and not in order of time."""
    from threadkeeper.streaming.feeds import current_intake, run_feeds

    root = _scratch(spark, "intake")
    A.event_observations(spark, d).repartition(8, F.to_date("observed_at")).write.parquet(f"{root}/landing")
    run_feeds(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", P, files_per_trigger=3)
    return current_intake(spark, f"{root}/out", P)


SYNC_DAYS = ("2024-01-31 16:00:00", "2024-02-01 16:00:00", "2024-02-02 16:00:00")


def str_sync(spark, d):
    """STR-2: three landed daily snapshots; the second lands in two pieces with
    a sync in between, and its manifest with the first.  The state and whether
    the document table holds each post's document."""
    from threadkeeper.plans.doctable import DocumentTable
    from threadkeeper.plans.store import StateStore
    from threadkeeper.streaming.stream import SnapshotSync, write_manifest

    root = _scratch(spark, "sync")
    params = P.with_(time_window_hours=24 * 5, update_window_days=5)
    state, _, sinks = SC.conv(spark, d, params)
    store, documents = StateStore(spark, f"{root}/state"), DocumentTable(spark, f"{root}/documents")
    empty = L.State(tracked=state.tracked.limit(0), posts=state.posts.limit(0), comments=state.comments.limit(0), queue=state.queue)
    store.write(empty, "initial", SYNC_DAYS[0])
    sync = SnapshotSync(spark, f"{root}/landing", f"{root}/manifests", A.conv_raw_comments(spark, d), sinks, store, documents, f"{root}/ckpt", params)
    raw = A.conv_raw_posts(spark, d)
    day1, day2, day3 = [raw.withColumn("observed_at", C.run_ts_lit(params.at(ts).run_micros)) for ts in SYNC_DAYS]
    first_piece = F.xxhash64("id") % 2 == 0
    for files, manifests in ((day1.unionByName(day2.where(first_piece)), day1.unionByName(day2)), (day2.where(~first_piece).unionByName(day3), day3)):
        files.repartition(5).write.mode("append").parquet(f"{root}/landing")
        write_manifest(manifests, f"{root}/manifests")
        sync.run()
    there = documents.documents().select(F.col("doc_id").alias("contextual_doc_id"), F.lit(True).alias("there"))
    rows = store.read().tracked.join(there, "contextual_doc_id", "left")
    return rows.select("post_id", "update_count", "status", "contextual_doc_id", F.coalesce("there", F.lit(False)).alias("has_document"))


QUERIES["str_intake"] = str_intake
QUERIES["str_sync"] = str_sync


def src_landing_json(spark, d):
    """SRC-7 through the file reader: observations landed as JSON lines, one
    line in 89 truncated; malformed lines and rows missing required fields
    become rejects, the rest is read with the fixed schema."""
    from threadkeeper.schemas import RAW_POST_COLS

    root = _scratch(spark, "landing-json")
    obs = A.event_observations(spark, d)
    line = F.to_json(F.struct(*RAW_POST_COLS))
    broken = F.when(F.col("feed_pos") % 89 == 0, F.expr("substring(line, 1, length(line) - 1)")).otherwise(F.col("line"))
    obs.select(line.alias("line"), "feed_pos").select(broken.alias("value")).write.text(f"{root}/landing")
    raw = I.read_landing(spark, f"{root}/landing", "posts", fmt="json")
    good, bad = I.split_rejects(raw)
    return good.select(F.lit(True).alias("valid")).unionByName(bad.select(F.lit(False).alias("valid"))).groupBy("valid").agg(
        F.count(F.lit(1)).alias("n")
    )


def src_landing_pruned(spark, d):
    """SRC-1 over a landing partitioned by the day of observation: only the days
    that can hold posts of the window are read."""
    root = _scratch(spark, "landing-days")
    obs = A.event_observations(spark, d).withColumn("observed_date", F.to_date("observed_at"))
    obs.repartition("observed_date").write.partitionBy("observed_date").parquet(f"{root}/landing")
    good, _ = I.split_rejects(I.read_landing(spark, f"{root}/landing", since=I.first_window_day(P)))
    return I.window_scan(good, P).select("id", "subreddit", "feed_pos", "observed_at")


def src_refresh_pruned(spark, d):
    """SRC-5 over a landing of many days: the last observation of every due post,
    reading the days on which they were last seen only."""
    root = _scratch(spark, "landing-refresh")
    obs = A.event_observations(spark, d).withColumn("observed_date", F.to_date("observed_at"))
    obs.repartition("observed_date").write.partitionBy("observed_date").parquet(f"{root}/landing")
    landing = I.read_days(spark, f"{root}/landing")
    state, _, _ = SC.events(spark, d, P)
    seen = cut_lineage(I.seen_days(None, landing))
    wanted = state.tracked.where(L.due_for_update(P)).select("post_id")
    good, _ = I.split_rejects(I.refresh_scan(landing, wanted, seen))
    return I.latest_observation(good).select("id", "observed_at", "feed", "feed_pos", "url")


QUERIES["src_refresh_pruned"] = src_refresh_pruned
QUERIES["src_landing_json"] = src_landing_json
QUERIES["src_landing_pruned"] = src_landing_pruned
