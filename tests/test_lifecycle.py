"""Lifecycle decisions on the documents snapshot pair and over several days."""

import pytest
from pyspark.sql import functions as F

from threadkeeper.params import SyncParams
from threadkeeper.plans import lifecycle as L
from threadkeeper.plans import scenarios as SC

EXPECTED = {1: "REINGEST", 2: "SET_METADATA", 3: "DELETE", 4: "DELETE", 5: "ENQUEUE_UPDATE",
            6: "NOOP", 7: "SKIP_INCREMENT", 8: "SKIP_INCREMENT", 9: "SKIP_INCREMENT"}


def test_classifier_snapshot_pair(spark, sf):
    p = SyncParams()
    state, obs, _ = SC.docs(spark, sf, p)
    rows = L.classify(state.tracked, obs, state.posts, p).select("post_id", "action").collect()
    assert rows
    for r in rows:
        rule = int(r.post_id[1:]) % 10
        assert r.action == EXPECTED[rule], (r.post_id, r.action)


def test_update_phase_outcomes(spark, sf):
    p = SyncParams()
    state, obs, sinks = SC.docs(spark, sf, p)
    st, _, actions = L.phase_update(state, obs, sinks, p)
    t = {r.post_id: r for r in st.tracked.collect()}
    q = {r.post_id: r for r in st.queue.collect()}
    for a in actions.collect():
        doc = int(a.post_id[1:])
        if a.action == "DELETE":
            assert a.post_id not in t
        elif a.action == "REINGEST":
            if doc % 7 == 1:  # delivery fails -> queued, tracked unchanged
                assert a.post_id in q and t[a.post_id].update_count == 0
            else:
                assert t[a.post_id].status == "updating" and t[a.post_id].update_count == 1
                assert t[a.post_id].contextual_doc_id == (f"idx-{doc}" if doc % 7 == 2 else f"reddit_post_{a.post_id}")
        elif a.action == "SET_METADATA":
            assert t[a.post_id].status == "new" and t[a.post_id].update_count == 1
        elif a.action == "ENQUEUE_UPDATE":
            assert q[a.post_id].priority == 0
    counters = actions.agg(*[F.sum(F.col(c).cast("int")).alias(c) for c in ("posts_deleted", "queued_for_retry")]).first()
    assert counters.posts_deleted == sum(1 for r in actions.collect() if r.action == "DELETE")


def test_same_day_rerun_is_noop_and_days_progress(spark, sf):
    from threadkeeper.catalog.queries import life_day_progression

    rows = life_day_progression(spark, sf).collect()
    by_post = {}
    for r in rows:
        by_post.setdefault(r.post_id, {})[r.day] = (r.update_count, r.status)
    full = [v for v in by_post.values() if 1 in v and len(v) == 4]
    assert full, "some posts are tracked from day 1"
    for v in full:
        assert v[1] == (-1, "new")
        assert v[2][0] == 0
        assert v[3][0] == 1
        assert v[4] == (2, "frozen")


def test_rerun_same_day_changes_nothing(spark, sf):
    p = SyncParams()
    state, obs, sinks = SC.conv(spark, sf, p)
    first = L.run(state, obs, sinks, p).state
    second = L.run(first, obs, sinks, p).state
    cols = ["post_id", "update_count", "status", "contextual_doc_id", "content_hash", "last_updated"]
    assert sorted(map(tuple, first.tracked.select(*cols).collect())) == sorted(map(tuple, second.tracked.select(*cols).collect()))


@pytest.fixture(scope="module")
def orders_run(spark, sf):
    p = SyncParams()
    state, obs, sinks = SC.orders(spark, sf, p)
    return p, state, obs, sinks, L.run(state, obs, sinks, p)


def rows(df, *without):
    df = df.drop(*without)
    return sorted(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def test_one_pass_equals_the_phases(orders_run):
    p, state, obs, sinks, one = orders_run
    by_phases = L.run_by_phases(state, obs, sinks, p)
    for table in ("tracked", "posts", "comments", "queue"):
        assert rows(getattr(one.state, table)) == rows(getattr(by_phases.state, table)) != []
    for part in ("actions", "outbox", "documents", "counters", "by_source"):
        assert rows(getattr(one, part), "error") == rows(getattr(by_phases, part), "error") != []


def test_a_run_writes_few_tables_and_a_dry_run_none(spark, sf, monkeypatch):
    p = SyncParams()
    state, obs, sinks = SC.conv(spark, sf, p)
    writes = []
    real = L.cut_lineage
    monkeypatch.setattr(L, "cut_lineage", lambda df, *by: writes.append(1) or real(df, *by))
    L.observe(SC.A.conv_raw_posts(spark, sf), SC.A.conv_raw_comments(spark, sf), p, L.refresh_ids(state, p))
    res = L.run(state, obs, sinks, p)
    assert len(writes) <= 6
    assert "acts" not in res.counters.columns and res.counters.count() == 1
    writes.clear()
    dry = L.run(state, obs, sinks, p, mode="dry")
    assert not writes and dry.state is state and dry.ops.count() == 0 and dry.outbox.count() == 0
    would = {r.post_id for r in dry.actions.collect()}
    assert would == {r.post_id for r in res.actions.where("phase = 'new'").collect()} != set()


def test_full_run_invariants(orders_run):
    p, _, obs, _, res = orders_run
    t = res.state.tracked.collect()
    ids = [r.post_id for r in t]
    assert len(ids) == len(set(ids))  # one tracked row per post
    posts = {r.id for r in res.state.posts.select("id").collect()}
    assert set(ids) <= posts  # every tracked post is cached
    assert {r.post_id for r in res.state.comments.select("post_id").distinct().collect()} <= posts
    cutoff = p.run_micros - p.cleanup_after_days * 86_400_000_000
    import datetime as dt

    epoch = dt.datetime(1970, 1, 1)
    frozen_now = {r.post_id for r in res.actions.where(F.col("phase") == "freeze").select("post_id").collect()}
    for r in t:
        assert (r.first_scraped.replace(tzinfo=None) - epoch) // dt.timedelta(microseconds=1) >= cutoff
        if r.post_id in frozen_now:  # frozen by this run: its updates are complete
            assert r.status == "frozen" and r.update_count >= 2
    c = res.actions.agg(*[F.sum(F.col(x).cast("int")).alias(x) for x in ("posts_scraped", "new_posts", "frozen_posts")]).first()
    assert c.posts_scraped == obs.intake.count()
    assert c.frozen_posts == res.actions.where(F.col("phase") == "freeze").count()
    # queue items left are keyed uniquely
    q = [(r.post_id, r.action) for r in res.state.queue.collect()]
    assert len(q) == len(set(q))


def test_a_snapshot_waits_until_it_is_whole(spark, sf):
    """STR-2: pieces, late manifests, order and replays."""
    import uuid

    from threadkeeper.functions import columns as C
    from threadkeeper.plans.doctable import DocumentTable
    from threadkeeper.plans.store import StateStore
    from threadkeeper.session import checkpoint_dir
    from threadkeeper.sources import adapters as A
    from threadkeeper.streaming.stream import SnapshotSync, write_manifest

    root = f"{checkpoint_dir(spark)}/sync-{uuid.uuid4().hex}"
    p = SyncParams().with_(time_window_hours=24 * 5, update_window_days=5)
    state, _, sinks = SC.conv(spark, sf, p)
    store, documents = StateStore(spark, f"{root}/state"), DocumentTable(spark, f"{root}/documents")
    store.write(L.State(state.tracked.limit(0), state.posts.limit(0), state.comments.limit(0), state.queue), "initial", p.run_ts)
    raw = A.conv_raw_posts(spark, sf)
    one, two = [raw.withColumn("observed_at", C.run_ts_lit(p.at(t).run_micros)) for t in ("2024-01-31 16:00:00", "2024-02-01 16:00:00")]
    make = lambda ckpt: SnapshotSync(spark, f"{root}/landing", f"{root}/manifests", A.conv_raw_comments(spark, sf), sinks, store, documents, f"{root}/{ckpt}", p)
    half = F.xxhash64("id") % 2 == 0
    one.where(half).write.mode("append").parquet(f"{root}/landing")
    two.write.mode("append").parquet(f"{root}/landing")
    write_manifest(one.unionByName(two), f"{root}/manifests")
    sync = make("ckpt")
    sync.run()  # the first snapshot lacks rows, the second waits for it
    assert store.current_version() == 0 and sync.waiting().where("landed < n_rows").count() == 1
    one.where(~half).write.mode("append").parquet(f"{root}/landing")
    sync.run()
    assert store.current_version() == 2 and sync.waiting().count() == 0
    young = {r.id for r in L.I.normalize_posts(raw).where(L.in_update_window(p)).collect()}
    assert young <= {r.post_id for r in store.read(1).tracked.collect()}  # no post of either piece is lost
    assert {r.post_id for r in documents.documents().collect()} >= young
    make("other").run()  # a new checkpoint applies nothing twice
    assert store.current_version() == 2


def test_the_written_fold_holds_a_documents_texts_once(spark, sf):
    from threadkeeper.plans import onepass
    from threadkeeper.session import cut_lineage

    written, params = [], SyncParams()

    def cut(df):
        written.append(cut_lineage(df))
        return written[-1]

    state, obs, sinks = SC.docs(spark, sf, params)
    f = onepass.fold(state, obs, sinks, params, L.MODES["update"], cut)
    raw, shown = (r.where("doc is not null and cache is not null") for r in (written[0], f.rows))
    assert raw.count() > 0 and all(p.endswith(".zstd.parquet") for p in raw.inputFiles())
    assert raw.where("doc.title <=> cache.title and doc.title is not null").count() == 0
    assert raw.where("doc.selftext <=> cache.selftext and doc.selftext is not null").count() == 0
    fresh = obs.refresh.selectExpr("id", "title as t", "selftext as s")
    assert shown.select("doc.*").join(fresh, "id").where("not title <=> t or not selftext <=> s").count() == 0
