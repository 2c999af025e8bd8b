"""Stateful feed streams against the batch intake."""

import datetime as dt

from pyspark.sql import functions as F

from threadkeeper.params import SyncParams
from threadkeeper.schemas import POST_COLS, RAW_POST_SCHEMA
from threadkeeper.sources import intake as I
from threadkeeper.streaming import feeds

P = SyncParams(hot_limit=3)
RUN = P.run_micros // 1_000_000


def post(id_, feed, pos, hours_ago, created_ago=1.0, source="s", score=1, **more):
    at = None if hours_ago is None else dt.datetime.fromtimestamp(RUN - hours_ago * 3600, dt.timezone.utc)
    row = dict(id=id_, subreddit=source, title=f"t {id_}", url="u", permalink=f"/p/{id_}", score=score, upvote_ratio=0.1, num_comments=score)
    row |= dict(feed=feed, feed_pos=pos, observed_at=at, created_utc=RUN - created_ago * 3600.0) | more
    return tuple(row.get(f.name) for f in RAW_POST_SCHEMA.fields)


def land(spark, root, rows):
    spark.createDataFrame(rows, RAW_POST_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/landing")


def shown(df):
    return sorted([tuple(r) for r in df.select(*POST_COLS).collect()], key=str)


def same_as_batch(spark, root):
    feeds.run_feeds(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", P)
    landed = spark.read.schema(RAW_POST_SCHEMA).parquet(f"{root}/landing")
    want = shown(I.intake_posts(I.split_rejects(landed)[0], P))
    got = shown(feeds.current_intake(spark, f"{root}/out", P))
    assert got == want
    return {r[0]: r[POST_COLS.index("score")] for r in got}


def test_streams_equal_the_batch_after_every_landing(spark, tmp_path):
    root = str(tmp_path)
    land(spark, root, [post("a", "new", 1, 5), post("b", "new", 2, 5, score=7), post("old", "new", 3, 5, created_ago=40), post("bad", "new", 4, 5, url=None), post("n", "new", 5, None)])
    land(spark, root, [post(f"h{i}", "hot", i, 5, score=i) for i in range(5)])
    assert same_as_batch(spark, root) == {"a": 1, "b": 7, "n": 1, "h0": 0, "h1": 1, "h2": 2}
    # a late row of an older poll changes nothing, a newer one goes out again
    land(spark, root, [post("b", "new", 2, 9, score=100), post("a", "new", 1, 2, score=50)])
    # a late file of the same hot snapshot pushes entries out, an older snapshot doesn't
    land(spark, root, [post("front", "hot", -1, 5, score=9), post("past", "hot", -5, 8)])
    assert same_as_batch(spark, root) == {"a": 50, "b": 7, "n": 1, "front": 9, "h0": 0, "h1": 1}
    # a newer hot snapshot replaces the whole feed, posts beyond the cutoff take places but don't show
    land(spark, root, [post("h1", "hot", 0, 1, score=11), post("dead", "hot", 1, 1, created_ago=90), post("x", "hot", 2, 1, source="other"), post("y", "hot", 3, 1), post("z", "hot", 4, 1)])
    assert same_as_batch(spark, root) == {"a": 50, "b": 7, "n": 1, "h1": 11, "x": 1, "y": 1}
    # nothing new landed: nothing changes
    assert same_as_batch(spark, root)["x"] == 1


def test_one_post_observed_by_many_files_in_one_trigger(spark, tmp_path):
    rows = [post("a", "new", i, 9 - i % 7, score=i) for i in range(40)] + [post("b", "new", i, 3, score=i) for i in range(40)]
    spark.createDataFrame(rows, RAW_POST_SCHEMA).repartition(6).write.parquet(f"{tmp_path}/landing")
    assert same_as_batch(spark, str(tmp_path)) == {"a": 34, "b": 39}


def test_a_post_at_the_edge_of_the_window_is_not_late(spark, tmp_path):
    root = str(tmp_path)
    land(spark, root, [post("edge", "new", 1, 5, created_ago=26), post("newest", "new", 2, 5, created_ago=0)])
    assert same_as_batch(spark, root) == {"edge": 1, "newest": 1}
    land(spark, root, [post("edge", "new", 1, 2, created_ago=26, score=8)])
    assert same_as_batch(spark, root) == {"edge": 8, "newest": 1}


def test_state_of_a_post_is_freed_when_it_left_the_window(spark, tmp_path):
    root = str(tmp_path)
    wide = P.with_(time_window_hours=26)
    land(spark, root, [post("a", "new", 1, 5, created_ago=20), post("b", "new", 2, 5, created_ago=-10)])
    feeds.run_feeds(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", wide)
    # newer posts move the watermark past a, not past b
    land(spark, root, [post("c", "new", 3, 0, created_ago=-33), post("d", "new", 4, 0, created_ago=-33)])
    feeds.run_feeds(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", wide)
    land(spark, root, [post("a", "new", 1, 0, created_ago=20, score=99), post("b", "new", 2, 0, created_ago=-10, score=98)])
    feeds.run_feeds(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", wide)
    log = spark.read.parquet(f"{root}/out/post").groupBy("key").agg(F.max("version").alias("v"))
    assert {r["key"]: r["v"] for r in log.collect()} == {"a": 1, "b": 2, "c": 1, "d": 1}


def test_rows_are_reduced_before_the_shuffle(spark):
    import pandas as pd

    f = pd.DataFrame({"id": ["a"] * 1000, "subreddit": "s", "observed": [5] * 999 + [6], "feed_pos": range(1000), "tie": 0, "payload": "{}"})
    assert len(next(feeds._latest_in_batch(iter([f])))) == 1
    assert len(feeds._newest_top(f, 3)) == 1 and len(feeds._newest_top(f[:999], 3)) == 3


def test_a_post_takes_its_latest_row_without_sorting_frames(monkeypatch):
    import pandas as pd

    class State:
        hasTimedOut, exists, kept, timer = False, False, None, None

        def getCurrentWatermarkMs(self):
            return 0

        def update(self, value):
            self.kept = value

        def setTimeoutTimestamp(self, ms):
            self.timer = ms

    def frame(*rows):
        f = pd.DataFrame(rows, columns=["observed", "feed_pos", "tie", "payload"])
        return f.assign(id="a", created_ts=pd.Timestamp("2024-01-31 10:00:00"))

    def refuse(*_, **__):
        raise AssertionError("a frame of a few rows is sorted for every post and micro-batch")

    monkeypatch.setattr(pd.DataFrame, "sort_values", refuse)
    state = State()
    frames = [frame((5, 9, 9, "old"), (6, 1, -4, "late"), (6, 1, 3, "best"), (6, 0, 8, "early")), frame((6, 1, 2, "tie"), (feeds.NO_TIME, 7, 7, "never"))]
    (out,) = feeds._keep_latest(("a",), iter(frames), state)
    assert out["payload"].tolist() == ["best"] and out["version"].tolist() == [1]
    assert state.kept == (6, 1, 3, 1) and state.timer == int(pd.Timestamp("2024-01-31 10:00:00").timestamp() * 1000) + 1
