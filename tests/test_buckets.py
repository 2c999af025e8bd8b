"""State tables as Spark's own bucketed tables."""

import uuid

from threadkeeper.params import SyncParams
from threadkeeper.plans import lifecycle as L
from threadkeeper.plans import onepass
from threadkeeper.plans import scenarios as SC
from threadkeeper.plans.store import StateStore
from threadkeeper.session import checkpoint_dir


def over_buckets(plan):
    """For every bucketed scan of a plan: the operators between it and the join above."""
    lines = plan.split("\n")
    depth = lambda x: len(x) - len(x.lstrip(" :+-*()0123456789"))
    out = []
    for i, line in enumerate(lines):
        if "Bucketed: true" not in line:
            continue
        above, at = [], depth(line)
        for j in range(i - 1, -1, -1):
            if depth(lines[j]) < at:
                at = depth(lines[j])
                if "Join" in lines[j] or "Union" in lines[j]:
                    break
                above.append(lines[j].strip(" :+-"))
        out.append((lines[j], above))
    return out


def test_joins_on_bucketed_state_do_not_shuffle_it(spark, sf):
    p = SyncParams()
    state, obs, sinks = SC.docs(spark, sf, p)
    root = f"{checkpoint_dir(spark)}/buckets-{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    StateStore(spark, root, buckets=n).write(state, "day1", p.run_ts)
    kept = StateStore(spark, root).read()  # the number of buckets comes from the commit log
    for name in ("tracked", "posts"):
        want = getattr(state, name)
        assert sorted(map(str, getattr(kept, name).select(*want.columns).collect())) == sorted(map(str, want.collect()))
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        classified = L.classify(kept.tracked, obs, kept.posts, p)._jdf.queryExecution().executedPlan().toString()
        assert classified.count("Bucketed: true") == 2 and classified.count("Exchange hashpartitioning") == 1  # the observation's
        wide = onepass.wide_rows(kept, obs, sinks, p)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    joined = [above for join, above in over_buckets(wide) if "Join" in join]
    assert len(joined) >= 2 and sum(not any("Exchange" in x for x in above) for above in joined) >= 2


def test_a_new_session_reads_bucketed_tables(spark, sf):
    p = SyncParams()
    state, _, _ = SC.docs(spark, sf, p)
    root = f"{checkpoint_dir(spark)}/buckets-{uuid.uuid4().hex}"
    store = StateStore(spark, root, buckets=3)
    store.write(state, "day1", p.run_ts)
    spark.sql(f"DROP TABLE {store._name('tracked', 0)}")  # external: the files stay
    assert store.read().tracked.count() == state.tracked.count()
