"""What a run shuffles and leaves on disk: texts are dealt by post once, later joins move keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from threadkeeper.operators import outbox as O
from threadkeeper.params import SyncParams
from threadkeeper.plans import lifecycle as L
from threadkeeper.plans import onepass
from threadkeeper.plans import scenarios as SC
from threadkeeper.session import cut_buckets, cut_lineage

TEXTS = {"html", "body", "title", "selftext", "doc", "cache", "discussion", "r", "n", "c"}


@pytest.fixture
def small(spark, tmp_path):
    """Orders and line items: keys that repeat, posts with many comments and with none."""
    day = lambda i: dt.datetime(2024, 1, 31 - i % 3, i % 16)
    orders = [(k, k % 7, "OFP"[k % 3], 100.5 + k, day(k), "1-URGENT") for k in [*range(120), 7, 8]]
    lines = [
        (k, 11 * k + i, 3 * k + i, i, float(i % 9), 10.25 * (k + i), 0.01 * (i % 4), 0.02, "RNA"[k % 3], "OF"[i % 2], day(i))
        for k in range(100) for i in range(k % 6 if k != 9 else 130)
    ]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(
        lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


@pytest.fixture
def plain_plans(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffled(df):
    """The columns of every exchange of the plan."""
    out = []

    def walk(node):
        node = node.initialPlan() if node.nodeName() == "AdaptiveSparkPlan" else node
        if node.nodeName() == "Exchange":
            out.append({node.output().apply(i).name() for i in range(node.output().size())})
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_a_run_shuffles_keys_only(spark, small, plain_plans, monkeypatch):
    p, moved, writes = SyncParams(), [], []
    state, obs, sinks = SC.orders(spark, small, p)
    assert state.tracked.groupBy("post_id").count().where("count > 1").count() > 0
    for name, real in (("cut_buckets", cut_buckets), ("cut_lineage", cut_lineage)):
        monkeypatch.setattr(L, name, lambda df, *by, real=real: moved.extend(shuffled(df)) or writes.append(1) or real(df, *by), raising=False)
    res = L.run(state, obs, sinks, p)
    assert len(writes) == 2
    for df in (res.documents.select("doc_id", F.md5("html")), res.state.comments.groupBy("post_id").count(), res.state.tracked):
        moved += shuffled(df)
    documents = [r.doc_id for r in res.documents.select("doc_id").collect()]
    assert documents and len(documents) == len(set(documents)) and res.state.comments.count() > 0
    assert moved and not [cols for cols in moved if cols & TEXTS]


def test_the_latest_operation_of_a_document_wins(spark):
    box = spark.createDataFrame(
        [("a", "k1", "INGEST", 30, "k1", "old"), ("b", "k1", "REINGEST", 40, "k1", "new"), ("b", "k2", "INGEST", 30, "k2", "b2"),
         ("c", "k3", "INGEST", 30, "k3", "c3"), ("d", "k3", "DELETE", 40, None, None), ("e", "k4", "INGEST", 30, "given", "e4")],
        "post_id string, doc_key string, op string, seq int, result_doc_id string, html string",
    ).withColumns({"metadata_json": F.lit("{}"), "size_bytes": F.lit(3).cast("bigint")})
    empty = spark.createDataFrame([], "doc_id string, post_id string, html string, metadata_json string, size_bytes bigint")
    got = sorted(map(tuple, O.put(None, O.still_last(box, box)).collect()))
    assert got == sorted(map(tuple, O.apply_to_index(empty, box).collect()))
    assert [r[:3] for r in got] == [("given", "e", "e4"), ("k1", "b", "new"), ("k2", "b", "b2")]


def test_documents_show_the_comments_that_retention_takes(spark):
    folded = [("kept", False, False, False), ("saved", True, True, False), ("gone", True, False, False), ("old", False, False, True), ("new_old", True, True, True)]
    rows = spark.createDataFrame(folded, "post_id string, touched boolean, saved boolean, expired boolean").withColumns({"cache": F.lit(1), "on": F.lit(True)})
    comment = lambda text: spark.createDataFrame([(x, f"{text}-{x}") for x in ("kept", "saved", "gone", "old", "new_old", None)], "post_id string, id string")
    whole = lambda df: df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in onepass.CACHED_COMMENT_COLS])
    out = onepass.comment_rows(onepass.Folded(rows.union(rows), {}, 2), whole(comment("was")), whole(comment("seen")))
    assert {(r.id, r.kept) for r in out.collect()} == {("was-kept", True), ("was-None", True), ("seen-saved", True), ("was-old", False), ("seen-new_old", False)}
    assert out.count() == 5


def test_buckets_keep_rows_and_shuffle_files_go(spark, plain_plans):
    files = lambda: [f for f in (str(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n"))).split("\n") if f.endswith(".data")]
    spark._jvm.System.gc()
    df = spark.range(3000).select(F.when(F.col("id") % 10 > 0, F.concat(F.lit("p"), F.col("id") % 50)).alias("post_id"), "id", (F.col("id") % 2).alias("kind"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = set(files())
    cut = cut_buckets(df.repartition(n, "post_id"), "post_id", "kind")
    assert set(files()) <= before
    assert cut.columns == df.columns and sorted(map(str, cut.collect())) == sorted(map(str, df.collect()))
    assert shuffled(cut.groupBy("post_id").count()) == [] and len(cut.inputFiles()) <= 2 * n
    assert set(map(tuple, cut_lineage(df.repartition(3, "id")).collect())) == set(map(tuple, df.collect()))
