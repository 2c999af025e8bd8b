"""A run over a landing of many days."""

from pyspark.sql import functions as F

from threadkeeper.params import SyncParams
from threadkeeper.plans import lifecycle as L
from threadkeeper.plans import scenarios as SC
from threadkeeper.sources import adapters as A
from threadkeeper.sources import intake as I


def test_a_run_reads_the_days_it_needs(spark, sf, tmp_path):
    p = SyncParams()
    obs = A.event_observations(spark, sf).withColumn("observed_date", F.to_date("observed_at"))
    obs.repartition("observed_date").write.partitionBy("observed_date").parquet(f"{tmp_path}/landing")
    landing = I.read_days(spark, f"{tmp_path}/landing")
    days = landing.select("observed_date").distinct().count()
    assert days > 20
    state, whole, _ = SC.events(spark, sf, p)
    seen = I.seen_days(None, landing)
    wanted = L.refresh_ids(state, p)
    scan = I.refresh_scan(landing, wanted, seen)
    assert "dynamicpruning" in scan._jdf.queryExecution().executedPlan().toString()
    # incremental: the last days of earlier runs and the newly landed ones give the same
    before = I.seen_days(None, landing.where("observed_date < '2024-01-15'"))
    assert sorted(map(tuple, I.seen_days(before, landing, "2024-01-15").collect())) == sorted(map(tuple, seen.collect()))
    # a run's observation over those days equals the one over the whole landing
    got = L.observe_landing(landing, SC.empty_raw_comments(spark), p, state, seen)
    ids = wanted.select(F.col("post_id").alias("id")).distinct()
    want = whole.refresh.join(ids, "id", "left_semi")
    cols = ["id", "score", "num_comments", "content_hash", "deleted"]
    assert sorted(map(tuple, got.refresh.join(ids, "id", "left_semi").select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect())) != []
