"""Landed-source adapters: the driver tables seen as forum data.

The engine itself reads landed snapshots of posts and comments (see
``intake.read_landing``).  These adapters produce such snapshots from the
generated tables so that every query's work grows with the input.  All
derived values are integer arithmetic on keys, so an independent SQL engine
can derive exactly the same rows.

* small: ``conversations`` -> posts (turn 0) and comments (turn > 0)
* large: ``orders`` -> posts, ``lineitem`` -> comments
* feed:  ``events`` -> repeated feed observations of posts
* queue: ``events`` error rows -> retry-queue rows
* snapshot pair: ``documents`` -> stored state + new observation
* urls: ``pages`` -> post urls
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadkeeper.functions.columns import run_ts_lit
from threadkeeper.params import DOC_ID_PREFIX, SITE, epoch_micros
from threadkeeper.schemas import RAW_COMMENT_SCHEMA, RAW_POST_SCHEMA
from threadkeeper.session import prepare

# Fixed anchor of the generated landings: 2024-01-31 16:00:00 UTC (08:00 Pacific).
ANCHOR_TS = "2024-01-31 16:00:00"
ANCHOR_S = epoch_micros(ANCHOR_TS) // 1_000_000
HOUR_S = 3600
POLL_MICROS = 12 * HOUR_S * 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _shape(exprs: dict[str, Column], schema) -> list[Column]:
    out = []
    for f in schema.fields:
        e = exprs.get(f.name, F.lit(None))
        out.append(e.cast(f.dataType).alias(f.name))
    return out


def _anchor() -> Column:
    return run_ts_lit(ANCHOR_S * 1_000_000)


# ---------------------------------------------------------------------------
# small adapter: conversations
# ---------------------------------------------------------------------------
def conv_raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").where(F.col("turn") == 0)
    k = F.col("conv_id")
    sub = F.concat(F.lit("src"), k % 5)
    is_self = (k % 6) != 2
    permalink = F.concat(F.lit("/r/"), sub, F.lit("/comments/t"), k, F.lit("/post_"), k, F.lit("/"))
    created = (F.lit(ANCHOR_S) - (k % 97) * HOUR_S - (k % 7) * 60).cast("double") + (k % 4) * F.lit(0.25)
    exprs = {
        "id": F.concat(F.lit("t"), k),
        "subreddit": sub,
        "author": F.when(k % 17 != 0, F.concat(F.lit("u"), k % 29)),
        "title": F.col("text"),
        "selftext": F.when(k % 6 == 2, F.lit(None)).when(k % 23 == 5, F.lit("[removed]")).otherwise(F.col("text")),
        "url": F.when(is_self, F.concat(F.lit(SITE), permalink)).otherwise(
            F.concat(F.lit("https://media.example.com/p"), k, F.when(k % 4 == 0, F.lit(".png")).otherwise(F.lit("")))
        ),
        "permalink": permalink,
        "score": (k * 31) % 500,
        "upvote_ratio": ((k * 7) % 10001).cast("double") / 10000,
        "num_comments": (k * 3) % 40,
        "created_utc": created,
        "edited": F.when(k % 19 == 4, F.lit(None)).when(k % 7 == 3, created + 600).otherwise(F.lit(0.0)),
        "link_flair_text": F.when(k % 4 == 1, F.concat(F.lit("Flair "), k % 3)),
        "link_flair_css_class": F.when(k % 4 == 1, F.concat(F.lit("f"), k % 3)),
        "total_awards_received": k % 3,
        "is_self": is_self,
        "is_video": k % 10 == 9,
        "is_original_content": k % 9 == 1,
        "over_18": k % 11 == 0,
        "spoiler": k % 13 == 2,
        "stickied": k % 31 == 0,
        "locked": k % 37 == 1,
        "archived": F.lit(False),
        "thumbnail": F.when(is_self, F.lit("self")).otherwise(F.concat(F.lit("https://thumbs.example.com/"), k, F.lit(".jpg"))),
        "feed": F.lit("new"),
        "feed_pos": k,
        "observed_at": _anchor(),
    }
    return c.select(*_shape(exprs, RAW_POST_SCHEMA))


def conv_raw_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").where(F.col("turn") > 0)
    k, t = F.col("conv_id"), F.col("turn")
    created = (F.lit(ANCHOR_S) - (k % 97) * HOUR_S + t * 60).cast("double")
    exprs = {
        "post_id": F.concat(F.lit("t"), k),
        "id": F.concat(F.lit("c"), k, F.lit("-"), t),
        "author": F.when((k + t) % 11 == 0, F.lit("AutoModerator"))
        .when((k + t) % 13 == 0, F.lit(None))
        .when((k + t) % 17 == 0, F.lit("remindmebot"))
        .otherwise(F.concat(F.col("role"), t)),
        "body": F.when((k * 7 + t) % 29 == 3, F.lit(None)).otherwise(F.col("text")),
        "score": ((k * 31 + t * 17) % 23) % 6,
        "created_utc": created,
        "parent_id": F.when(t == 1, F.concat(F.lit("t3_t"), k)).otherwise(F.concat(F.lit("t1_c"), k, F.lit("-"), t - 1)),
        "is_submitter": F.col("role") == "user",
        "edited": F.when(t % 5 == 0, created + 30).otherwise(F.lit(0.0)),
        "depth": t - 1,
        "listing_pos": t,
        "is_placeholder": (k + t) % 19 == 0,
    }
    return c.select(*_shape(exprs, RAW_COMMENT_SCHEMA))


# ---------------------------------------------------------------------------
# large adapter: orders -> posts, lineitem -> comments
# ---------------------------------------------------------------------------
def order_raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    is_self = (k % 9) != 4
    permalink = F.concat(F.lit("/r/"), F.col("o_orderpriority"), F.lit("/comments/o"), k, F.lit("/order/"))
    created = (F.lit(ANCHOR_S) - (k % 72) * HOUR_S - (cust % 60) * 60).cast("double")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    exprs = {
        "id": F.concat(F.lit("o"), k),
        "subreddit": F.col("o_orderpriority"),
        "author": F.when(cust % 101 != 0, F.concat(F.lit("u"), cust)),
        "title": F.concat(F.lit("Order "), k, F.lit(" for customer "), cust),
        "selftext": F.when(k % 9 == 4, F.lit(None)).otherwise(
            F.concat(F.lit("Status "), F.col("o_orderstatus"), F.lit(", total "), cents, F.lit(" cents"))
        ),
        "url": F.when(is_self, F.concat(F.lit(SITE), permalink)).otherwise(
            F.concat(F.lit("https://shop.example.com/o"), k, F.when(k % 2 == 0, F.lit(".jpg")).otherwise(F.lit("")))
        ),
        "permalink": permalink,
        "score": F.floor(F.col("o_totalprice") / 1000),
        "upvote_ratio": (k % 101).cast("double") / 100,
        "num_comments": k % 13,
        "created_utc": created,
        "edited": F.when(F.col("o_orderstatus") == "F", created + 120).otherwise(F.lit(0.0)),
        "link_flair_text": F.when(F.col("o_orderstatus") == "P", F.lit("pending")),
        "link_flair_css_class": F.when(F.col("o_orderstatus") == "P", F.lit("p")),
        "total_awards_received": cust % 4,
        "is_self": is_self,
        "is_video": F.lit(False),
        "is_original_content": k % 5 == 0,
        "over_18": F.lit(False),
        "spoiler": F.lit(False),
        "stickied": k % 1000 == 0,
        "locked": F.lit(False),
        "archived": F.lit(False),
        "thumbnail": F.when(is_self, F.lit("self")),
        "feed": F.lit("new"),
        "feed_pos": k,
        "observed_at": _anchor(),
    }
    return o.select(*_shape(exprs, RAW_POST_SCHEMA))


def lineitem_raw_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A comment per line item, by row-local rules: the line number is the
    place in the listing, and the id also names part, supplier and price, as
    (orderkey, linenumber) repeats."""
    li = table(spark, sf_dir, "lineitem")
    k, pos, supp = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")
    created = (F.unix_micros(F.col("l_shipdate").cast("timestamp")) / 1_000_000).cast("double")
    body = F.concat(
        F.lit("qty "), F.col("l_quantity").cast("bigint"),
        F.lit(", price "), F.round(F.col("l_extendedprice") * 100).cast("bigint"),
        F.lit(", discount "), F.round(F.col("l_discount") * 100).cast("bigint"),
        F.lit(", tax "), F.round(F.col("l_tax") * 100).cast("bigint"),
        F.lit(", flags "), F.col("l_returnflag"), F.col("l_linestatus"),
    )
    exprs = {
        "post_id": F.concat(F.lit("o"), k),
        "id": F.concat_ws("-", F.concat(F.lit("l"), k), pos, "l_partkey", supp, F.round(F.col("l_extendedprice") * 100).cast("bigint")),
        "author": F.when(supp % 23 == 0, F.lit("AutoModerator"))
        .when(supp % 29 == 0, F.lit("SaveVideo"))
        .when(supp % 31 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("s"), supp)),
        "body": body,
        "score": F.col("l_quantity"),
        "created_utc": created,
        "parent_id": F.when(pos == 1, F.concat(F.lit("t3_o"), k)).otherwise(F.concat(F.lit("t1_l"), k, F.lit("-"), pos - 1)),
        "is_submitter": F.col("l_returnflag") == "R",
        "edited": F.when(F.col("l_linestatus") == "O", created + 60).otherwise(F.lit(0.0)),
        "depth": (pos - 1) % 4,
        "listing_pos": pos,
        "is_placeholder": F.col("l_partkey") % 97 == 0,
    }
    return li.select(*_shape(exprs, RAW_COMMENT_SCHEMA))


# ---------------------------------------------------------------------------
# feed adapter: events -> repeated observations
# ---------------------------------------------------------------------------
def event_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    u = F.col("user_id")
    created = (F.lit(ANCHOR_S) - (u % 50) * HOUR_S - (u % 7) * 60).cast("double")
    permalink = F.concat(F.lit("/r/src"), u % 5, F.lit("/comments/e"), u, F.lit("/"))
    exprs = {
        "id": F.concat(F.lit("e"), u),
        "subreddit": F.concat(F.lit("src"), u % 5),
        "author": F.when(u % 13 != 0, F.concat(F.lit("u"), u)),
        "title": F.concat(F.lit("Post by user "), u),
        "selftext": F.concat(F.lit("Last event "), F.col("event_type"), F.lit(" "), F.col("props")),
        # one observation in 97 arrives without a url: a malformed record
        "url": F.when(F.col("event_id") % 97 != 0, F.concat(F.lit(SITE), permalink)),
        "permalink": permalink,
        "score": F.floor(F.col("value")),
        "upvote_ratio": (F.col("event_id") % 100).cast("double") / 100,
        "num_comments": F.col("event_id") % 17,
        "created_utc": created,
        "edited": F.lit(0.0),
        "total_awards_received": F.lit(0),
        "is_self": F.lit(True),
        "is_video": F.lit(False),
        "is_original_content": F.lit(False),
        "over_18": F.lit(False),
        "spoiler": F.lit(False),
        "stickied": F.lit(False),
        "locked": F.lit(False),
        "archived": F.lit(False),
        "thumbnail": F.lit("self"),
        "feed": F.when(F.col("event_type") == "click", F.lit("hot")).otherwise(F.lit("new")),
        "feed_pos": F.col("event_id"),
        # two polls a day: an event is listed by the poll before it
        "observed_at": F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp")) % POLL_MICROS),
    }
    return e.select(*_shape(exprs, RAW_POST_SCHEMA))


def hot_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an entry of one of two hot feeds of one day: the poll of
    the run time or the one before."""
    late = F.col("feed_pos") % 2 == 0
    at = run_ts_lit(ANCHOR_S * 1_000_000) - F.when(late, F.make_dt_interval()).otherwise(F.make_dt_interval(F.lit(0), F.lit(12)))
    entries = event_observations(spark, sf_dir).withColumn("id", F.concat(F.lit("h"), "feed_pos"))
    return entries.withColumn("feed", F.lit("hot")).withColumn("observed_at", at)


# ---------------------------------------------------------------------------
# queue adapter: events error rows -> queue rows (one per (post_id, action))
# ---------------------------------------------------------------------------
def event_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    e = e.select(
        F.concat(F.lit("e"), F.col("user_id")).alias("post_id"),
        F.concat(F.lit("src"), F.col("user_id") % 5).alias("subreddit"),
        F.when(F.col("event_id") % 2 == 0, F.lit("ingest")).otherwise(F.lit("update")).alias("action"),
        "event_id",
        F.floor(F.col("value")).alias("v"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
    g = e.groupBy("post_id", "subreddit", "action").agg(
        F.min("event_id").alias("id"),
        F.max(F.col("v") % 3).cast("int").alias("priority"),
        F.count(F.lit(1)).alias("n"),
        F.max("event_id").alias("last_event"),
        F.min("ts").alias("created_at"),
        F.max("ts").alias("last_ts"),
    )
    attempts = (F.col("n") % 7).cast("int")
    return g.select(
        "id",
        "post_id",
        "subreddit",
        "action",
        "priority",
        attempts.alias("attempts"),
        F.lit(5).alias("max_attempts"),
        F.when(attempts > 0, F.concat(F.lit("HTTP 5"), F.lpad((F.col("last_event") % 100).cast("string"), 2, "0"))).alias(
            "last_error"
        ),
        "created_at",
        (F.col("last_ts") + F.make_dt_interval((F.col("n") % 3).cast("int"))).alias("scheduled_for"),
    )


# ---------------------------------------------------------------------------
# url adapter: pages
# ---------------------------------------------------------------------------
URL_SUFFIX_CASES = (".jpg", ".jpeg", ".png", ".gif", ".mp4", ".webm", ".JPG", ".png?x=1", ".gifv")


def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    k = F.col("page_id")
    suffix = F.element_at(F.array(*[F.lit(s) for s in URL_SUFFIX_CASES]), ((k / 3).cast("bigint") % len(URL_SUFFIX_CASES) + 1).cast("int"))
    return p.select(
        k.alias("page_id"),
        F.when(k % 3 == 0, F.concat(F.col("url"), suffix)).otherwise(F.col("url")).alias("url"),
    )


# ---------------------------------------------------------------------------
# snapshot pair: documents -> stored state and a new observation
# ---------------------------------------------------------------------------
def doc_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    return d.select(
        k.alias("doc_id"),
        (k % 10).alias("rule"),
        F.concat(F.lit("d"), k).alias("post_id"),
        F.col("source").alias("subreddit"),
        F.concat(F.lit("a"), k % 37).alias("author"),
        F.col("text").alias("title"),
        F.col("text").alias("selftext"),
        (k % 100).cast("int").alias("score"),
        (F.col("n_chars") % 50).cast("int").alias("num_comments"),
        ((k % 100).cast("double") / 100).alias("upvote_ratio"),
    )


def doc_stored(spark: SparkSession, sf_dir: str, run_micros: int) -> tuple[DataFrame, DataFrame]:
    """(tracked, cached posts) before the run: every document except rule 0."""
    from threadkeeper.functions.fingerprint import content_hash

    b = doc_base(spark, sf_dir).where(F.col("rule") != 0)
    run = run_ts_lit(run_micros)
    day_before = run - F.make_dt_interval(F.lit(1))
    tracked = b.select(
        "post_id",
        "subreddit",
        (run - F.make_dt_interval(F.lit(0), F.lit(1))).alias("created_utc"),
        day_before.alias("first_scraped"),
        F.when(F.col("rule") == 6, run).otherwise(day_before).alias("last_updated"),
        F.when(F.col("rule") == 7, F.lit(-1)).otherwise(F.lit(0)).cast("int").alias("update_count"),
        F.lit("new").alias("status"),
        F.when(F.col("rule") != 8, F.concat(F.lit(DOC_ID_PREFIX), F.col("post_id"))).alias("contextual_doc_id"),
        content_hash("title", "selftext", F.lit(None).cast("string")).alias("content_hash"),
    )
    cached = b.select(
        F.col("post_id").alias("id"), "subreddit", "author", "title", "selftext", "score", "upvote_ratio", "num_comments"
    )
    return tracked, cached


def doc_observed(spark: SparkSession, sf_dir: str, run_micros: int) -> DataFrame:
    """Refresh snapshot: every document except rule 5, changed per rule."""
    b = doc_base(spark, sf_dir).where(F.col("rule") != 5)
    r = F.col("rule")
    created = F.lit(run_micros / 1_000_000 - HOUR_S).cast("double")
    permalink = F.concat(F.lit("/r/"), F.col("subreddit"), F.lit("/comments/"), F.col("post_id"), F.lit("/"))
    exprs = {
        "id": F.col("post_id"),
        "subreddit": F.col("subreddit"),
        "author": F.when(r != 3, F.col("author")),
        "title": F.col("title"),
        "selftext": F.when(r.isin(1, 7), F.concat(F.lit("x "), F.col("selftext")))
        .when(r == 4, F.lit("[removed]"))
        .otherwise(F.col("selftext")),
        "url": F.concat(F.lit(SITE), permalink),
        "permalink": permalink,
        "score": F.when(r.isin(2, 8), F.col("score") + 1).otherwise(F.col("score")),
        "upvote_ratio": F.col("upvote_ratio"),
        "num_comments": F.col("num_comments"),
        "created_utc": created,
        "edited": F.lit(0.0),
        "total_awards_received": F.lit(0),
        "is_self": F.lit(True),
        "is_video": F.lit(False),
        "is_original_content": F.lit(False),
        "over_18": F.lit(False),
        "spoiler": F.lit(False),
        "stickied": F.lit(False),
        "locked": F.lit(False),
        "archived": F.lit(False),
        "thumbnail": F.lit("self"),
        "feed": F.lit("refresh"),
        "feed_pos": F.col("doc_id"),
        "observed_at": run_ts_lit(run_micros),
    }
    return b.select(*_shape(exprs, RAW_POST_SCHEMA))
