"""The document table across runs."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from threadkeeper.plans.doctable import DOCUMENTS, DocumentTable
from threadkeeper.session import checkpoint_dir

BOX = "doc_key string, post_id string, op string, html string, metadata_json string, size_bytes long, seq int, result_doc_id string, day date"
DAYS = [dt.date(2024, 1, d) for d in range(1, 6)]


def box(spark, *rows):
    """rows: (doc, op, html, seq, day)"""
    return spark.createDataFrame([(d, "p" + d, op, html, "{}", None, seq, d, day) for d, op, html, seq, day in rows], BOX)


def files(table):
    return {f.split("/documents/")[1] for f in table.documents().inputFiles()}


def test_only_touched_days_are_rewritten(spark):
    table = DocumentTable(spark, f"{checkpoint_dir(spark)}/doctable-{uuid.uuid4().hex}")
    assert table.documents().count() == 0 and table.pending().count() == 0
    rows = [(f"d{i}", "INGEST", f"h{i}", 1, DAYS[i % 5] if i != 7 else None) for i in range(20)]
    assert len(table.merge(box(spark, *rows))) == 6
    before = files(table)
    # day 2: one document replaced, one day emptied, one without a day set to other metadata
    table.merge(box(spark, ("d1", "REINGEST", "new", 1, DAYS[1]), *[(f"d{i}", "DELETE", None, 1, DAYS[3]) for i in (3, 8, 13, 18)], ("d7", "SET_METADATA", None, 1, None)))
    after = files(table)
    day = lambda fs, d: {f for f in fs if f.startswith(f"day={d}")}
    for untouched in (DAYS[0], DAYS[2], DAYS[4]):
        assert day(before, untouched) == day(after, untouched) != set()
    assert not day(before, DAYS[1]) & day(after, DAYS[1]) and not day(after, DAYS[3])
    got = {r.doc_id: r for r in table.documents().collect()}
    assert set(got) == {f"d{i}" for i in range(20)} - {"d3", "d8", "d13", "d18"}
    assert got["d1"].html == "new" and got["d6"].html == "h6" and got["d7"].html == "h7" and got["d7"].day is None
    # the same operations once more change nothing
    table.merge(box(spark, ("d1", "REINGEST", "new", 1, DAYS[1])))
    assert {r.doc_id: r for r in table.documents().collect()} == got


def test_merge_reads_the_touched_days_only(spark):
    table = DocumentTable(spark, f"{checkpoint_dir(spark)}/doctable-{uuid.uuid4().hex}")
    table.merge(box(spark, *[(f"d{i}", "INGEST", "h", 1, DAYS[i]) for i in range(5)]))
    plan = table._of_days([DAYS[2]])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024-01-03" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert table._of_days([DAYS[2]]).count() == 1
    assert table.documents().schema == DOCUMENTS


def test_a_run_owes_failed_deletes_until_they_are_delivered(spark):
    from threadkeeper.params import SyncParams
    from threadkeeper.plans import lifecycle as L
    from threadkeeper.plans import scenarios as SC

    p = SyncParams()
    sf = "/root/testdata/sf0.001"
    state, obs, sinks = SC.docs(spark, sf, p)
    state = SC.stored(state)
    pending = spark.createDataFrame([("x1", "reddit_post_x1", "HTTP 503", None, DAYS[0]), ("x2", "reddit_post_x2", "HTTP 503", None, DAYS[0])], L.PENDING)
    index = spark.createDataFrame([("reddit_post_x1", "x1", "h", "{}", 1, DAYS[0]), ("reddit_post_x2", "x2", "h", "{}", 1, DAYS[0])], L.INDEX)
    fails = spark.createDataFrame([("reddit_post_x2", "DELETE", False, None, "HTTP 500")], "doc_key string, op string, ok boolean, returned_doc_id string, error string")
    res = L.run(state, obs, sinks.unionByName(fails), p, mode="update", index=index, pending=pending)
    assert {r.doc_id for r in res.documents.where(F.col("post_id").startswith("x")).collect()} == {"reddit_post_x2"}
    owed = {r.post_id: r for r in res.pending_deletes.collect()}
    assert "x1" not in owed and owed["x2"].error == "HTTP 500" and owed["x2"].day == DAYS[0]
    mine = {r.post_id for r in res.ops.where("op = 'DELETE' and not ok").collect()}
    assert set(owed) == mine | {"x2"} and mine
