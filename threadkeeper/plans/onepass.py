"""LIFE-11 in one pass: the whole run as one row per post.

Every phase of a run acts on a post's own rows, so the run is a fold over the
columns of one wide row: tracked row, cached post, window observation, refresh
observation, its two queue items and the delivery reports of its documents,
brought together by one chain of left joins on ``post_id`` (each input is
shuffled once; the left side stays where it is).  A phase is a projection: an
ordered CASE decides the action, the reports say how it ended, and the row's
columns change accordingly.  Actions pile up in the array ``acts``, the last
save or delete of the cached copy in ``ev``.

The folded table is written once.  The run's counters and the number of rows
that retention expires are observed by that write (``DataFrame.observe``), and
tracked table, post cache, queue, actions, outbox and statistics are narrow
projections of what was written; only the comments need one more join.  Over a
bucketed observation both tables that a run writes are bucketed by the post's
id too, so its joins, aggregates and documents move keys, no texts.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from threadkeeper.functions import columns as C
from threadkeeper.operators import outbox as O
from threadkeeper.operators import state as S
from threadkeeper.operators.stats import COUNTERS
from threadkeeper.params import ACTION_INGEST, ACTION_UPDATE, DOC_ID_PREFIX, STATUS_FROZEN, STATUS_NEW, STATUS_UPDATING, SyncParams
from threadkeeper.plans import lifecycle as L
from threadkeeper.schemas import CACHED_COMMENT_COLS, CACHED_POST_COLS, POST_COLS, QUEUE_COLS, TRACKED_COLS

ITEM_COLS = [c for c in QUEUE_COLS if c not in ("post_id", "action")]
TEXTS = ("title", "selftext")
TRACKED = [c for c in TRACKED_COLS if c != "post_id"]
ACT = (
    "struct<seq:int,phase:string,action:string,op:string,doc_key:string,ok:boolean,result_doc_id:string,error:string,"
    + ",".join(f"{c}:boolean" for c in COUNTERS) + ">"
)
EVENT = "struct<seq:int,kind:string,update_count:int>"  # kind: meta, re (saved from the refresh), new (from the window), del
RESULTS = "array<struct<doc_key:string,op:string,attempt:int,ok:boolean,returned_doc_id:string,error:string>>"


# ---------------------------------------------------------------------------
# the wide row
# ---------------------------------------------------------------------------
def reports(sinks: DataFrame, tracked: DataFrame) -> DataFrame:
    """(post_id, s: the reports of the documents the post has or may get).

    A document's key is the post's own, the one tracked keeps, or one that an
    ingest of this run returned; each post has a handful."""
    if "attempt" not in sinks.columns:
        sinks = sinks.withColumn("attempt", F.lit(None).cast("int"))
    one = O.one_result(sinks)
    fields = ["doc_key", "op", "attempt", "ok", "returned_doc_id", "error"]
    own = one.where(F.col("doc_key").startswith(DOC_ID_PREFIX)).withColumn("post_id", F.substring("doc_key", len(DOC_ID_PREFIX) + 1, 1 << 30))
    kept = tracked.where(F.col("contextual_doc_id") != C.doc_id("post_id")).select("post_id", F.col("contextual_doc_id").alias("doc_key"))
    given = own.where((F.col("op") == O.OP_INGEST) & F.col("ok") & F.col("returned_doc_id").isNotNull()).select("post_id", F.col("returned_doc_id").alias("doc_key"))
    named = kept.union(given).distinct()
    rows = own.select("post_id", *fields).union(named.join(one, "doc_key").select("post_id", *fields))
    return rows.groupBy("post_id").agg(F.collect_set(F.struct(*fields)).cast(RESULTS).alias("s"))


def wide_rows(state: L.State, obs: L.Observation, sinks: DataFrame, params: SyncParams) -> DataFrame:
    """One row per post that is tracked, cached, in the window or queued."""
    pid = F.col("id").alias("post_id")
    window = obs.intake.select(pid, F.struct(*POST_COLS, F.col("content_hash").alias("hash")).alias("n"))
    fresh = obs.refresh.select(pid, F.struct(*POST_COLS, "deleted", F.col("content_hash").alias("hash"), F.lit(True).alias("found")).alias("r"))
    cached = state.posts.select(pid, F.struct(*CACHED_POST_COLS, F.lit(True).alias("found")).alias("c"))
    tracked = state.tracked.select("post_id", *TRACKED, F.lit(True).alias("on"))
    item = lambda action: F.max(F.when(F.col("action") == action, F.struct(*ITEM_COLS)))
    queued = state.queue.groupBy("post_id").agg(item(ACTION_INGEST).alias("qi"), item(ACTION_UPDATE).alias("qu"))
    ids = state.tracked.select("post_id").union(state.posts.select(pid)).union(obs.intake.select(pid)).union(state.queue.select("post_id"))
    w = ids.distinct()
    for part in (tracked, cached, window, fresh, queued, reports(sinks, state.tracked), _cached_hashes(state, params)):
        w = w.join(part, "post_id", "left")
    return w.withColumns({
        "on": F.coalesce("on", F.lit(False)), "was_on": F.coalesce("on", F.lit(False)), "s": F.coalesce("s", F.array().cast(RESULTS)),
        "acts": F.array().cast(f"array<{ACT}>"), "ev": F.lit(None).cast(EVENT), "erased": F.lit(False),
    })


def _cached_hashes(state: L.State, params: SyncParams) -> DataFrame:
    """Fingerprint of the cached copy (with its cached comments) of posts that a
    queued ingest may have to track."""
    wanted = state.queue.where(F.col("action") == ACTION_INGEST).select("post_id").distinct()
    wanted = wanted.join(state.tracked.select("post_id"), "post_id", "left_anti")
    posts = state.posts.select("id", "title", "selftext").join(wanted.withColumnRenamed("post_id", "id"), "id", "left_semi")
    hashed = L._with_hash(posts, state.comments.join(wanted, "post_id", "left_semi"))
    return hashed.select(F.col("id").alias("post_id"), F.col("content_hash").alias("cached_hash"))


# ---------------------------------------------------------------------------
# phases: projections of the wide row
# ---------------------------------------------------------------------------
def _deliver(w: DataFrame, op: Column, key: Column, attempt: int) -> DataFrame:
    """_op, _key and how the delivery ended: _ok, _res (the document's id), _err."""
    w = w.withColumns({"_op": op, "_key": F.when(op.isNotNull(), key)})
    same = lambda x: (x["doc_key"] == F.col("_key")) & (x["op"] == F.col("_op")) & (x["attempt"] == attempt)
    w = w.withColumn("_hit", F.get(F.filter("s", same), 0))
    w = w.withColumn("_ok", F.coalesce(F.col("_hit.ok"), F.lit(True)))
    kept = F.coalesce(F.col("_hit.returned_doc_id"), O.fallback_id(F.col("_op"), F.col("_key"), F.col("post_id")))
    return w.withColumns({"_res": F.when(F.col("_op").isNotNull() & F.col("_ok"), kept), "_err": F.col("_hit.error")})


def _act(on: Column, seq: int, phase: str, action: Column, sent: bool = True, **counters: Column) -> Column:
    """``acts`` with one more action where ``on``."""
    none = F.lit(None).cast("string")
    values = [F.lit(seq), F.lit(phase), action, *([F.col("_op"), F.col("_key"), F.col("_ok"), F.col("_res"), F.col("_err")] if sent else [none, none, F.lit(True), none, none])]
    row = F.struct(*values, *[counters.get(c, F.lit(False)) for c in COUNTERS]).cast(ACT)
    return F.when(on, F.concat("acts", F.array(row))).otherwise(F.col("acts"))


def _event(on: Column, seq: int, kind: Column, count: Column, old: Column) -> Column:
    return F.when(on, F.struct(F.lit(seq), kind, count.cast("int")).cast(EVENT)).otherwise(old)


def _seen(name: str):
    """A column of the cached post as of now: the last save of this run, else the stored copy."""
    kind = F.col("ev.kind")
    if name == "found":
        return F.when(kind == "del", F.lit(None)).when(kind.isNotNull(), F.lit(True)).otherwise(F.col("c.found"))
    return F.when(kind == "new", F.col(f"n.{name}")).when(kind.isNotNull() & (kind != "del"), F.col(f"r.{name}")).when(kind.isNull(), F.col(f"c.{name}"))


def _enqueued(old: Column, on: Column, priority: int, params: SyncParams, subreddit: Column) -> Column:
    """MUT-6 on one item."""
    run = L._run(params)
    fields = {c: old[c] for c in ITEM_COLS} | {"priority": F.greatest(old["priority"], F.lit(priority))}
    action = ACTION_INGEST if priority else ACTION_UPDATE
    new = {
        "id": F.abs(F.xxhash64(F.col("post_id"), F.lit(action))), "subreddit": subreddit, "priority": F.lit(priority), "attempts": F.lit(0),
        "max_attempts": F.lit(params.queue_max_attempts), "last_error": F.lit(None).cast("string"), "created_at": run, "scheduled_for": run,
    }
    raised, fresh = F.struct(*[fields[c].alias(c) for c in ITEM_COLS]), F.struct(*[new[c].alias(c) for c in ITEM_COLS])
    return F.when(on & old.isNotNull(), raised).when(on, fresh).otherwise(old)


def _settled(item: Column, due: Column, failed: Column, error: Column, params: SyncParams) -> Column:
    """MUT-7 / MUT-8 on one item of the batch."""
    delay = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(params.queue_backoff_minutes) * F.pow(F.lit(2), item["attempts"]).cast("int"))
    later = {c: item[c] for c in ITEM_COLS} | {"attempts": item["attempts"] + 1, "last_error": error, "scheduled_for": L._run(params) + delay}
    back = F.struct(*[later[c].alias(c) for c in ITEM_COLS])
    return F.when(due & failed, back).when(due, F.lit(None)).otherwise(item)


def _due(item: Column, params: SyncParams) -> Column:
    return F.coalesce((item["attempts"] < item["max_attempts"]) & (item["scheduled_for"] <= L._run(params)), F.lit(False))


def _updates(w: DataFrame, on: Column, cached, params: SyncParams, seq: int, phase: str, attempt: int) -> DataFrame:
    """LIFE-2..6 where ``on``; leaves _a (the action, null elsewhere) and _ok."""
    fresh = lambda c: F.col(f"r.{c}")
    w = w.withColumn("_a", F.when(on & F.col("on"), L.update_action(params, fresh, cached)))
    a, doc = F.col("_a"), F.col("contextual_doc_id")
    op = (
        F.when((a == L.REINGEST) & doc.isNull(), F.lit(O.OP_INGEST)).when(a == L.REINGEST, F.lit(O.OP_REINGEST))
        .when(a == L.SET_METADATA, F.lit(O.OP_SET_METADATA)).when((a == L.DELETE) & doc.isNotNull(), F.lit(O.OP_DELETE))
    )
    w = _deliver(w, op, F.when(op == O.OP_INGEST, C.doc_id("post_id")).otherwise(doc), attempt)
    ok = F.col("_ok")
    flags = {
        "_meta": (a == L.SET_METADATA) & ok, "_skip": (a == L.SKIP) | ((a == L.SET_METADATA) & ~ok),
        "_re": (a == L.REINGEST) & ok, "_lost": (a == L.REINGEST) & ~ok, "_gone": a == L.DELETE, "_wait": a == L.ENQUEUE,
    }
    w = w.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in flags.items()})
    meta, skip, re, lost, gone, wait = (F.col(k) for k in flags)
    changed, again = meta | skip | re, wait | lost
    saved = F.when(meta, F.lit("meta")).otherwise(F.lit("re"))
    count = F.col("update_count")
    return w.withColumns({
        "acts": _act(a.isNotNull(), seq, phase, a, updated_posts=meta | re, documents_reingested=re, skipped_unchanged=skip, posts_deleted=gone, sync_errors=lost, queued_for_retry=again),
        "ev": _event(gone, seq, F.lit("del"), count, _event(meta | re | lost, seq, saved, count + 1, F.col("ev"))),
        "erased": F.col("erased") | gone,
        "qu": _enqueued(F.col("qu"), again, 0, params, F.col("subreddit")),
        "on": F.col("on") & ~gone,
        "last_updated": F.when(changed, L._run(params)).otherwise(F.col("last_updated")),
        "update_count": F.when(changed, count + 1).otherwise(count),
        "status": F.when(re, F.lit(STATUS_UPDATING)).otherwise(F.col("status")),
        "content_hash": F.when(re, F.col("r.hash")).otherwise(F.col("content_hash")),
        "contextual_doc_id": F.when(re, F.coalesce("_res", "contextual_doc_id")).otherwise(doc),
    })


def queue_pass(w: DataFrame, params: SyncParams, seq: int, attempt: int) -> DataFrame:
    """LIFE-10 over every due item."""
    run = L._run(params)
    w = w.withColumns({"_di": _due(F.col("qi"), params), "_du": _due(F.col("qu"), params), "_cf": _seen("found")})
    w = _deliver(w, F.when(F.col("_di") & F.col("_cf").isNotNull(), F.lit(O.OP_INGEST)), C.doc_id("post_id"), attempt)
    sent = F.col("_op").isNotNull()
    kind = F.col("ev.kind")
    seen_hash = F.when(kind == "new", F.col("n.hash")).when(kind.isNotNull(), F.col("r.hash")).otherwise(F.col("cached_hash"))
    outcome = F.when(~sent, F.lit("NOOP")).when(F.col("_ok"), F.lit("INGESTED")).otherwise(F.lit("FAILED"))
    w = w.withColumns({
        "_done": sent & F.col("_ok"), "_fi": sent & ~F.col("_ok"), "_fe": F.coalesce("_err", F.lit("ingest failed")),
        "acts": _act(F.col("_di"), seq, "queue", outcome, documents_ingested=sent & F.col("_ok")),
    })
    made = F.col("_done") & ~F.col("on")
    new = {
        "subreddit": _seen("subreddit"), "created_utc": _seen("created_utc"), "first_scraped": run, "last_updated": run,
        "update_count": F.lit(-1), "status": F.lit(STATUS_NEW), "content_hash": seen_hash,
    }
    w = w.withColumns(
        {c: F.when(made, v).otherwise(F.col(c)) for c, v in new.items()}
        | {"contextual_doc_id": F.when(F.col("_done"), F.col("_res")).otherwise(F.col("contextual_doc_id")), "on": F.col("on") | F.col("_done")}
    )
    w = _updates(w, F.col("_du") & (F.col("status") != STATUS_FROZEN), _seen, params, seq, "queue", attempt)
    error = F.when(F.col("_wait"), F.lit("refresh failed")).otherwise(F.lit("sync failed"))
    return w.withColumns({
        "qi": _settled(F.col("qi"), F.col("_di"), F.col("_fi"), F.col("_fe"), params),
        "qu": _settled(F.col("qu"), F.col("_du"), F.col("_wait") | F.col("_lost"), error, params),
    })


def repair(w: DataFrame, params: SyncParams, seq: int = 20) -> DataFrame:
    """LIFE-8."""
    action = F.when(F.col("r.found").isNull(), F.lit("FETCH_FAILED")).when(F.col("r.deleted"), F.lit(L.DELETE)).otherwise(F.lit(L.REINGEST))
    w = w.withColumn("_a", F.when(F.col("on") & L.missing_hash(), action))
    a, doc = F.col("_a"), F.col("contextual_doc_id")
    op = F.when((a == L.REINGEST) & doc.isNull(), F.lit(O.OP_INGEST)).when(a == L.REINGEST, F.lit(O.OP_REINGEST)).when((a == L.DELETE) & doc.isNotNull(), F.lit(O.OP_DELETE))
    w = _deliver(w, op, F.when(op == O.OP_INGEST, C.doc_id("post_id")).otherwise(doc), 1)
    w = w.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in {"_re": (a == L.REINGEST) & F.col("_ok"), "_try": a == L.REINGEST, "_gone": a == L.DELETE}.items()})
    re, gone = F.col("_re"), F.col("_gone")
    return w.withColumns({
        "acts": _act(a.isNotNull(), seq, "repair", a, documents_reingested=re, posts_deleted=gone),
        "ev": _event(gone, seq, F.lit("del"), F.col("update_count"), _event(F.col("_try"), seq, F.lit("re"), F.col("update_count"), F.col("ev"))),
        "erased": F.col("erased") | gone,
        "on": F.col("on") & ~gone,
        "content_hash": F.when(re, F.col("r.hash")).otherwise(F.col("content_hash")),
        "last_updated": F.when(re, L._run(params)).otherwise(F.col("last_updated")),
        "contextual_doc_id": F.when(re, F.coalesce("_res", "contextual_doc_id")).otherwise(doc),
    })


def new_posts(w: DataFrame, params: SyncParams, seq: int = 30) -> DataFrame:
    """LIFE-1 with JN-1/JN-2 and FLT-3."""
    run = L._run(params)
    young = C.age_days("n.created_utc", params.run_micros) <= F.lit(float(params.update_window_days))
    there = F.col("n").isNotNull()
    w = w.withColumns({"_new": there & ~F.col("on") & F.coalesce(young, F.lit(False)), "acts": _act(there, seq - 1, "scrape", F.lit("SCRAPED"), sent=False, posts_scraped=F.lit(True))})
    w = _deliver(w, F.when(F.col("_new"), F.lit(O.OP_INGEST)), C.doc_id("post_id"), 1)
    ok = F.col("_ok")
    w = w.withColumns({"_made": F.col("_new") & ok, "_lost": F.col("_new") & ~ok})
    made, lost = F.col("_made"), F.col("_lost")
    new = {
        "subreddit": F.col("n.subreddit"), "created_utc": F.col("n.created_utc"), "first_scraped": run, "last_updated": run, "update_count": F.lit(-1),
        "status": F.lit(STATUS_NEW), "contextual_doc_id": F.col("_res"), "content_hash": F.col("n.hash"),
    }
    outcome = F.when(ok, F.lit("INGESTED")).otherwise(F.lit("QUEUED"))
    return w.withColumns({c: F.when(made, v).otherwise(F.col(c)) for c, v in new.items()} | {
        "on": F.col("on") | made,
        "qi": _enqueued(F.col("qi"), lost, 1, params, F.col("n.subreddit")),
        "ev": _event(F.col("_new"), seq, F.lit("new"), F.lit(0), F.col("ev")),
        "acts": _act(F.col("_new"), seq, "new", outcome, new_posts=made, documents_ingested=made, sync_errors=lost, queued_for_retry=lost),
    })


def freeze(w: DataFrame, params: SyncParams, seq: int = 50) -> DataFrame:
    """LIFE-7."""
    w = w.withColumn("_fz", F.coalesce(F.col("on") & S.due_for_freeze(w, params), F.lit(False)))
    due = F.col("_fz")
    return w.withColumns({
        "acts": _act(due, seq, "freeze", F.lit("FREEZE"), sent=False, frozen_posts=F.lit(True)),
        "status": F.when(due, F.lit(STATUS_FROZEN)).otherwise(F.col("status")),
        "last_updated": F.when(due, L._run(params)).otherwise(F.col("last_updated")),
    })


PHASES = {
    "queue": lambda w, p: queue_pass(w, p, 10, 1),
    "repair": repair,
    "new": new_posts,
    "update": lambda w, p: _updates(w, L.due_for_update(p), lambda c: F.col(f"c.{c}"), p, 40, "update", 1),
    "freeze": freeze,
    "queue2": lambda w, p: queue_pass(w, p, 60, 2),
}


# ---------------------------------------------------------------------------
# what the fold leaves
# ---------------------------------------------------------------------------
def cache_copy(params: SyncParams) -> Column:
    """The post's cached copy after the run's last event (MUT-2, Q5), null if there is none."""
    run, kind = L._run(params), F.col("ev.kind")
    has_old = F.col("c").isNotNull() & ~F.col("erased")
    values = {}
    for name in CACHED_POST_COLS:
        if name in ("scraped_at", "last_updated"):
            new = run
        elif name == "update_count":
            new = F.col("ev.update_count")
        else:
            new = F.when(kind == "new", F.col(f"n.{name}")).otherwise(F.col(f"r.{name}"))
        take = F.lit(True) if name in S.POST_VOLATILE else (kind == "re") & F.lit(name != "scraped_at")
        values[name] = F.when(kind.isNull(), F.col(f"c.{name}")).when(~has_old | take, new).otherwise(F.col(f"c.{name}"))
    there = F.when(kind.isNull(), F.col("c").isNotNull()).otherwise(kind != "del")
    return F.when(there, F.struct(*[values[n].alias(n) for n in CACHED_POST_COLS]))


def document_post(cache: Column) -> Column:
    """The post as its document shows it: the refresh, else the window's row, else the cached copy."""
    pick = lambda c: F.when(F.col("r").isNotNull(), F.col(f"r.{c}")).when(F.col("n").isNotNull(), F.col(f"n.{c}")).otherwise(cache[c] if c in CACHED_POST_COLS else F.lit(None))
    return F.struct(*[pick(c).alias(c) for c in POST_COLS])


def last_sent() -> Column:
    """The delivered actions that are the last of their document.  Metadata set
    after a delivery of the content in the same run is part of that delivery."""
    sent = F.filter("acts", lambda a: a["op"].isNotNull() & a["ok"])
    content = lambda a: a["op"].isin(O.OP_INGEST, O.OP_REINGEST)
    before = lambda a, i: F.exists(F.slice(sent, 1, i), lambda b: content(b) & (b["doc_key"] == a["doc_key"]))
    sent = F.filter(sent, lambda a, i: (a["op"] != O.OP_SET_METADATA) | ~before(a, i))
    later = lambda a, i: F.exists(F.slice(sent, i + 2, F.size(sent)), lambda b: b["doc_key"] == a["doc_key"])
    return F.filter(sent, lambda a, i: ~later(a, i))


@dataclass
class Folded:
    """The written fold and what its write observed."""

    rows: DataFrame
    counters: dict[str, int]
    expired: int  # tracked rows that retention removes


def fold(state: L.State, obs: L.Observation, sinks: DataFrame, params: SyncParams, phases: list[str], cut) -> Folded:
    """Run ``phases`` over the wide rows and write the result once (``cut``)."""
    w = wide_rows(state, obs, sinks, params)
    for name in phases:
        if name != "retention":
            w = PHASES[name](w, params)
    w = w.withColumn("cache", cache_copy(params)).withColumn("sent", last_sent())
    cutoff = L._run(params) - F.make_dt_interval(F.lit(params.cleanup_after_days))
    old = F.col("on") & (F.col("first_scraped") < cutoff) & F.lit("retention" in phases and params.cleanup_after_days > 0)
    content = F.exists("sent", lambda a: a["op"] != O.OP_DELETE)
    out = w.select(
        "post_id", "was_on", "on", *TRACKED, "qi", "qu", "acts", "sent", "cache", F.col("n").isNotNull().alias("in_window"), F.col("n.subreddit").alias("window_source"),
        F.col("ev").isNotNull().alias("touched"), F.coalesce(F.col("ev.kind") != "del", F.lit(False)).alias("saved"), F.coalesce(old, F.lit(False)).alias("expired"),
        F.when(content, document_post(F.col("cache"))).alias("doc"),
    )
    # a document shows the cached texts as a rule: these are written once, in the cached copy
    out = out.withColumns({f"_{c}": F.col(f"doc.{c}").eqNullSafe(F.col(f"cache.{c}")) for c in TEXTS})
    for c in TEXTS:
        out = out.withColumn("doc", F.col("doc").withField(c, F.when(~F.col(f"_{c}"), F.col(f"doc.{c}"))))
    seen = Observation(f"run-{uuid.uuid4().hex}")
    count = lambda c: F.sum(F.size(F.filter("acts", lambda a: a[c])))
    counts = [F.coalesce(count(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTERS]
    rows = cut(out.observe(seen, *counts, F.count_if("expired").alias("expired")))
    for c in TEXTS:
        rows = rows.withColumn("doc", F.col("doc").withField(c, F.when(F.col(f"_{c}"), F.col(f"cache.{c}")).otherwise(F.col(f"doc.{c}"))))
    rows = rows.drop(*[f"_{c}" for c in TEXTS])
    got = seen.get
    return Folded(rows, {c: got[c] for c in COUNTERS}, got["expired"])


def tracked_rows(f: Folded) -> DataFrame:
    return f.rows.where(F.col("on") & ~F.col("expired")).select(*TRACKED_COLS)


def post_rows(f: Folded) -> DataFrame:
    """MUT-9: once any row expired, cached posts without a tracked row go."""
    kept = f.rows.where(F.col("cache").isNotNull())
    if f.expired:
        kept = kept.where(F.col("on") & ~F.col("expired"))
    return kept.select("cache.*").select(*CACHED_POST_COLS)


def queue_rows(f: Folded) -> DataFrame:
    """Queue items; an item keeps its key."""
    items = [F.when(F.col(q).isNotNull(), F.struct(F.lit(a).alias("action"), F.col(q).alias("i"))) for q, a in (("qi", ACTION_INGEST), ("qu", ACTION_UPDATE))]
    rows = f.rows.select("post_id", F.explode(F.array_compact(F.array(*items))).alias("x"))
    return rows.select("post_id", "x.action", "x.i.*").select(*QUEUE_COLS)


def comment_rows(f: Folded, comments: DataFrame, observed: DataFrame) -> DataFrame:
    """The comments that the run's documents show: replaced where a post was
    saved (MUT-3), gone where it was deleted (MUT-4).  Those that retention
    takes from the cache (MUT-9) are not ``kept``."""
    gone = F.col("expired") | (F.col("cache").isNotNull() & ~F.col("on") & F.lit(bool(f.expired)))
    any_of = {"touched": F.col("touched"), "saved": F.col("saved"), "gone": gone, "stays": F.col("saved") & ~gone}
    marks = f.rows.groupBy("post_id").agg(*[F.bool_or(v).alias(k) for k, v in any_of.items()])
    old = comments.join(marks.where("touched or gone"), "post_id", "left").where(~F.coalesce("touched", F.lit(False)))
    old = old.select(*CACHED_COMMENT_COLS, (~F.coalesce("gone", F.lit(False))).alias("kept"))
    new = observed.join(marks.where("saved"), "post_id").select(*CACHED_COMMENT_COLS, F.col("stays").alias("kept"))
    return old.unionByName(new)


def action_rows(f: Folded) -> DataFrame:
    return f.rows.select("post_id", F.explode("acts").alias("a")).select("a.seq", "a.phase", "post_id", "a.action", "a.op", "a.doc_key", "a.ok", "a.result_doc_id", "a.error", *[f"a.{c}" for c in COUNTERS])


def sent_rows(f: Folded) -> DataFrame:
    """The last delivered operation of each document of a post, with the post as it shows it."""
    sent = f.rows.where(F.size("sent") > 0).select("post_id", F.explode("sent").alias("a"), "doc", F.to_date("created_utc").alias("day"))
    ops = sent.select("post_id", "a.op", "a.doc_key", "a.seq", "a.result_doc_id", "day", "doc")
    w = Window.partitionBy("post_id", "doc_key").orderBy(*O.newest_first())
    return ops.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def outbox_rows(sent: DataFrame, comments: DataFrame) -> DataFrame:
    """SNK-1..4: the operations of ``sent_rows`` with their content."""
    more = ("seq", "result_doc_id", "day")
    ops = sent.select("op", "doc_key", *more, F.col("post_id").alias("id"), F.col("doc.id").alias("_doc"), *[f"doc.{c}" for c in POST_COLS if c != "id"])
    content = F.col("op").isin(O.OP_INGEST, O.OP_REINGEST)
    return O.filled(ops.where(content & F.col("_doc").isNotNull()), ops.where(~content), comments, *more)


def by_source(f: Folded) -> DataFrame:
    """AGG-7."""
    new = F.col("on") & ~F.col("expired") & ~F.col("was_on") & F.col("contextual_doc_id").isNotNull()
    return f.rows.where("in_window").groupBy(F.col("window_source").alias("subreddit")).agg(F.count(F.lit(1)).alias("scraped"), F.count_if(new).alias("new"))
