"""State mutations: upsert rules, queue conflicts and backoff, retention."""

from pyspark.sql import functions as F

from threadkeeper.operators import queue as Q
from threadkeeper.operators import state as S
from threadkeeper.params import SyncParams
from threadkeeper.schemas import QUEUE_SCHEMA, TRACKED_SCHEMA


def _tracked(spark, rows):
    df = spark.createDataFrame(rows, TRACKED_SCHEMA.simpleString().replace(":timestamp", ":bigint"))
    for c in ("created_utc", "first_scraped", "last_updated"):
        df = df.withColumn(c, F.timestamp_micros(c))
    return df


def test_upsert_tracked_column_rules(spark):
    old = _tracked(spark, [("a", "s1", 1, 1, 1, 0, "new", "doc-a", "h1")])
    new = _tracked(spark, [("a", "s2", 2, 2, 2, 1, "updating", None, "h2"), ("b", "s3", 3, 3, 3, -1, "new", "doc-b", "h3")])
    got = {r.post_id: r for r in S.upsert_tracked(old, new).collect()}
    a = got["a"]
    assert (a.subreddit, a.update_count, a.status, a.contextual_doc_id, a.content_hash) == ("s1", 1, "updating", "doc-a", "h2")
    assert a.first_scraped == got["a"].created_utc  # first values kept
    assert got["b"].contextual_doc_id == "doc-b"


def test_enqueue_twice_keeps_higher_priority_and_attempts(spark):
    p = SyncParams()
    q0 = spark.createDataFrame([], QUEUE_SCHEMA)
    q1 = Q.enqueue(q0, spark.createDataFrame([("x", "s", "ingest", 1)], "post_id string, subreddit string, action string, priority int"), p)
    q1 = Q.mark_failure(q1, spark.createDataFrame([("x", "ingest", "boom")], "post_id string, action string, error string"), p)
    q2 = Q.enqueue(q1, spark.createDataFrame([("x", "s", "ingest", 0), ("x", "s", "update", 0)], "post_id string, subreddit string, action string, priority int"), p)
    rows = {(r.post_id, r.action): r for r in q2.collect()}
    assert rows[("x", "ingest")].priority == 1 and rows[("x", "ingest")].attempts == 1
    assert rows[("x", "update")].attempts == 0


def test_backoff_sequence_then_exhausted(spark):
    p = SyncParams()
    q = Q.enqueue(spark.createDataFrame([], QUEUE_SCHEMA), spark.createDataFrame([("x", "s", "update", 0)], "post_id string, subreddit string, action string, priority int"), p)
    fail = spark.createDataFrame([("x", "update", "e")], "post_id string, action string, error string")
    delays = []
    for _ in range(5):
        q = Q.mark_failure(q, fail, p)
        r = q.select(((F.unix_micros("scheduled_for") - p.run_micros) / 60_000_000).alias("m"), "attempts").first()
        delays.append(int(r.m))
    assert delays == [5, 10, 20, 40, 80]
    late = p.at("2024-02-02 16:00:00")
    assert q.where(Q.is_due(late)).count() == 0  # attempts exhausted


def test_retention_boundary_and_orphans(spark):
    p = SyncParams()
    day = 86_400_000_000
    t = _tracked(spark, [("old", "s", 0, p.run_micros - 31 * day, 0, 0, "frozen", None, "h"),
                         ("edge", "s", 0, p.run_micros - 30 * day, 0, 0, "frozen", None, "h")])
    posts = spark.createDataFrame([("old",), ("edge",), ("orphan",)], "id string")
    com = spark.createDataFrame([("old", "c1"), ("edge", "c2"), ("orphan", "c3")], "post_id string, id string")
    np, nc, nt = S.retention(posts, com, t, p)
    assert {r.id for r in np.collect()} == {"edge"}
    assert {r.id for r in nc.collect()} == {"c2"}
    assert {r.post_id for r in nt.collect()} == {"edge"}
    # nothing expired: orphans stay
    np2, _, _ = S.retention(posts, com, t.where(F.col("post_id") == "edge"), p)
    assert {r.id for r in np2.collect()} == {"old", "edge", "orphan"}
    np3, _, _ = S.retention(posts, com, t, p.with_(cleanup_after_days=0))
    assert np3.count() == 3
