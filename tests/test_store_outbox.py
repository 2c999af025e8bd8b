"""Versioned state store and document-index apply."""

from pyspark.sql import functions as F

from threadkeeper.operators import outbox as O
from threadkeeper.plans.lifecycle import State
from threadkeeper.plans.store import StateStore
from threadkeeper.schemas import QUEUE_SCHEMA, TRACKED_SCHEMA
from threadkeeper.session import checkpoint_dir


def _state(spark, n):
    tracked = spark.createDataFrame([(f"p{i}", "s", None, None, None, i, "new", None, "h") for i in range(n)], TRACKED_SCHEMA)
    posts = spark.createDataFrame([(f"p{i}",) for i in range(n)], "id string")
    comments = spark.createDataFrame([(f"p{i}", f"c{i}") for i in range(n)], "post_id string, id string")
    return State(tracked=tracked, posts=posts, comments=comments, queue=spark.createDataFrame([], QUEUE_SCHEMA))


def test_store_versions_and_replay(spark):
    import uuid

    root = f"{checkpoint_dir(spark)}/store-test-{uuid.uuid4().hex}"
    store = StateStore(spark, root)
    assert store.current_version() is None
    assert store.write(_state(spark, 3), "b1", "2024-01-31 16:00:00") == 0
    assert store.write(_state(spark, 5), "b2", "2024-02-01 16:00:00") == 1
    # replaying a committed batch is a no-op
    assert store.write(_state(spark, 9), "b2", "2024-02-01 16:00:00") == 1
    assert store.read().tracked.count() == 5
    assert store.read(0).posts.count() == 3
    assert store.has_batch("b1") and not store.has_batch("b3")


def test_index_apply_semantics(spark):
    index = spark.createDataFrame(
        [("d1", "p1", "old1", "{}", 4), ("d2", "p2", "old2", "{}", 4), ("d3", "p3", "old3", "{}", 4)],
        "doc_id string, post_id string, html string, metadata_json string, size_bytes bigint",
    )
    box = spark.createDataFrame(
        [
            ("p1", "REINGEST", "d1", "d9", "new1", '{"a":1}', 4, 1),
            ("p2", "SET_METADATA", "d2", "d2", None, '{"b":2}', None, 1),
            ("p3", "DELETE", "d3", "d3", None, None, None, 1),
            ("p4", "INGEST", "d4", "d4", "new4", '{"c":3}', 4, 1),
            ("p5", "SET_METADATA", "d5", "d5", None, '{"d":4}', None, 1),
        ],
        "post_id string, op string, doc_key string, result_doc_id string, html string, metadata_json string, size_bytes bigint, seq int",
    )
    out = {r.doc_id: r for r in O.apply_to_index(index, box).collect()}
    assert set(out) == {"d9", "d2", "d4"}  # deleted, replaced and unknown-metadata docs are absent
    assert out["d9"].html == "new1" and out["d9"].metadata_json == '{"a":1}'
    assert out["d2"].html == "old2" and out["d2"].metadata_json == '{"b":2}'  # metadata only
    assert out["d4"].post_id == "p4"


def test_delivery_defaults_to_success(spark):
    ops = spark.createDataFrame([("p1", "INGEST", "d1"), ("p2", "INGEST", "d2"), ("p3", "DELETE", "d3")], "post_id string, op string, doc_key string")
    sinks = spark.createDataFrame(
        [("d1", "INGEST", False, None, "HTTP 503"), ("d2", "INGEST", True, "idx-2", None)],
        "doc_key string, op string, ok boolean, returned_doc_id string, error string",
    )
    got = {r.post_id: (r.ok, r.result_doc_id) for r in O.delivery(ops, sinks).collect()}
    assert got == {"p1": (False, None), "p2": (True, "idx-2"), "p3": (True, "d3")}


def test_reports_of_one_operation_are_reduced_and_belong_to_an_attempt(spark):
    ops = spark.createDataFrame([("p1", "REINGEST", "idx-5"), ("p2", "INGEST", "d2")], "post_id string, op string, doc_key string")
    sinks = spark.createDataFrame(
        [("d2", "INGEST", False, None, "HTTP 503", 1), ("d2", "INGEST", True, "idx-2", None, 1), ("d2", "INGEST", False, None, "HTTP 500", 2)],
        "doc_key string, op string, ok boolean, returned_doc_id string, error string, attempt int",
    )
    first = {r.post_id: (r.ok, r.result_doc_id) for r in O.delivery(ops, sinks).collect()}
    assert first == {"p1": (True, "reddit_post_p1"), "p2": (True, "idx-2")}
    assert {r.post_id: r.ok for r in O.delivery(ops, sinks, attempt=2).collect()} == {"p1": True, "p2": False}
