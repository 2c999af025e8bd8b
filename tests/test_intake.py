"""Intake rules: bot filter, cap after filtering, window boundary, dedup."""

from pyspark.sql import functions as F

from threadkeeper.params import EXCLUDED_AUTHORS, SyncParams
from threadkeeper.schemas import RAW_COMMENT_SCHEMA, RAW_POST_SCHEMA
from threadkeeper.sources import intake as I


def _comments(spark, n, bots=(), placeholders=(), broken=()):
    rows = []
    for i in range(1, n + 1):
        author = "AutoModerator" if i in bots else ("AuToMoDeRaToR" if i in bots and i % 2 else f"u{i}")
        if i in bots and i % 2:
            author = "AuToMoDeRaToR"
        rows.append(("p", f"c{i:03d}", author, None if i in broken else f"body {i}", i % 3, 1.7e9, "t3_p", False, 0.0, 0, i, i in placeholders))
    return spark.createDataFrame(rows, RAW_COMMENT_SCHEMA)


def test_cap_counts_after_bot_filter(spark):
    df = _comments(spark, 105, bots=set(range(1, 11)))
    out = I.normalize_comments(df, SyncParams())
    assert out.count() == 95
    assert out.where(F.lower("author").contains("automoderator")).count() == 0


def test_cap_keeps_first_in_listing_order(spark):
    df = _comments(spark, 150, placeholders={1}, broken={2})
    out = I.normalize_comments(df, SyncParams())
    pos = sorted(r.listing_pos for r in out.collect())
    assert len(pos) == 100 and pos[0] == 3 and pos[-1] == 102
    assert I.normalize_comments(df, SyncParams(max_comments=0)).count() == 0
    assert I.normalize_comments(df, SyncParams(include_comments=False)).count() == 0


def test_missing_author_is_deleted_and_excluded(spark):
    rows = [("p", "a", None, "x", 1, 1.0, "t3_p", False, 0.0, 0, 1, False), ("p", "b", "ok", "y", 1, 1.0, "t3_p", False, 5.0, 1, 2, False)]
    out = I.normalize_comments(spark.createDataFrame(rows, RAW_COMMENT_SCHEMA), SyncParams()).collect()
    assert [(r.id, r.edited) for r in out] == [("b", True)]


def _post(i, created, feed="new", pos=0, observed=0):
    return (f"p{i}", "s", "a", "t", "x", "https://reddit.com/r/s/1", "/r/s/1", 1, 0.5, 0, float(created), 0.0, None, None, 0,
            True, False, False, False, False, False, False, False, "self", feed, pos, observed)


def test_window_boundary_inclusive_and_hot_override(spark):
    p = SyncParams()
    cut = p.run_micros / 1e6 - 26 * 3600
    rows = [_post(1, cut), _post(2, cut - 1), _post(3, cut + 5, "new", 1), _post(3, cut + 5, "hot", 2)]
    schema = RAW_POST_SCHEMA.simpleString().replace("observed_at:timestamp", "observed_at:bigint")
    df = spark.createDataFrame(rows, schema).withColumn("observed_at", F.timestamp_micros(F.lit(p.run_micros)))
    w = {r.id for r in I.window_scan(df, p).collect()}
    assert w == {"p1", "p3"}
    latest = {r.id: r.feed for r in I.latest_observation(df).collect()}
    assert latest["p3"] == "hot"
    got = {r.id for r in I.intake_posts(df, p).collect()}
    assert got == {"p1", "p3"}


def test_hot_post_is_capped_before_the_shuffle(spark):
    """One post holds a third of all comments: the cap is planned as a
    pre-shuffle group limit, so the hot post never travels whole."""
    from pyspark.sql import functions as F

    n = 9000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), (F.col("id") % 100).cast("string"))).alias("post_id"),
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("id"),
        F.lit("someone").alias("author"),
        F.lit("text").alias("body"),
        F.lit(1).alias("score"),
        F.lit(1.7e9).alias("created_utc"),
        F.lit("t3_x").alias("parent_id"),
        F.lit(False).alias("is_submitter"),
        F.lit(0.0).alias("edited"),
        F.lit(0).alias("depth"),
        F.col("id").cast("int").alias("listing_pos"),
        F.lit(False).alias("is_placeholder"),
    )
    out = I.normalize_comments(df.repartition(8), SyncParams())
    counts = {r.post_id: r.n for r in out.groupBy("post_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts["hot"] == 100
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_post_observations_reduce_map_side(spark):
    """A post observed in a third of all rows is de-duplicated with a partial
    aggregate before the shuffle, and the latest observation wins."""
    from pyspark.sql import functions as F

    p = SyncParams()
    n = 9000
    raw = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id").cast("string"))).alias("id"),
        F.lit("s").alias("subreddit"), F.lit("a").alias("author"), F.lit("t").alias("title"), F.lit("x").alias("selftext"),
        F.lit("https://reddit.com/r/s/1").alias("url"), F.lit("/r/s/1").alias("permalink"), F.col("id").cast("int").alias("score"),
        F.lit(0.5).alias("upvote_ratio"), F.lit(0).alias("num_comments"), F.lit(p.run_micros / 1e6).alias("created_utc"),
        F.lit(0.0).alias("edited"), F.lit(None).cast("string").alias("link_flair_text"), F.lit(None).cast("string").alias("link_flair_css_class"),
        F.lit(0).alias("total_awards_received"), F.lit(True).alias("is_self"), F.lit(False).alias("is_video"),
        F.lit(False).alias("is_original_content"), F.lit(False).alias("over_18"), F.lit(False).alias("spoiler"),
        F.lit(False).alias("stickied"), F.lit(False).alias("locked"), F.lit(False).alias("archived"), F.lit("self").alias("thumbnail"),
        F.lit("new").alias("feed"), F.col("id").alias("feed_pos"), F.timestamp_micros(F.col("id") * 1_000_000).alias("observed_at"),
    )
    out = I.latest_observation(raw.repartition(8))
    hot = out.where(F.col("id") == "hot").first()
    assert hot.feed_pos == n - 3  # the latest of the hot post's observations
    assert out.count() == 1 + (n - n // 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_landing_is_pruned_by_day(spark, sf):
    from threadkeeper.catalog.queries import src_landing_pruned

    plan = src_landing_pruned(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(observed_date" in plan and "observed_date" in plan.split("PartitionFilters")[1][:120]


def test_bots_are_found_whatever_their_case(spark):
    names = sorted(EXCLUDED_AUTHORS)
    kelvin = [n.replace("k", "\u212a") for n in names]  # folds to k
    authors = [*names, *map(str.upper, names), *map(str.swapcase, names), *kelvin, "İ" + names[0][1:], names[0] + " ", "someone", "", None]
    df = spark.createDataFrame([(a,) for a in authors], "a string")
    plain = F.lower("a").isin(*{n.lower() for n in names})
    rows = df.select("a", I.is_bot(F.col("a")).alias("got"), plain.alias("want")).collect()
    assert [(r.a, r.got) for r in rows] == [(r.a, r.want) for r in rows] and any(r.got for r in rows)
    # only names of a bot's length are folded
    assert "char_length" in str(I.is_bot(F.col("a")))
