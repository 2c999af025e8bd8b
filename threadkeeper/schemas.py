"""Column lists and schemas of the domain tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Landed source rows -----------------------------------------------------------
RAW_POST_COLS = [
    "id", "subreddit", "author", "title", "selftext", "url", "permalink",
    "score", "upvote_ratio", "num_comments", "created_utc", "edited",
    "link_flair_text", "link_flair_css_class", "total_awards_received",
    "is_self", "is_video", "is_original_content", "over_18", "spoiler",
    "stickied", "locked", "archived", "thumbnail",
    "feed", "feed_pos", "observed_at",
]

RAW_COMMENT_COLS = [
    "post_id", "id", "author", "body", "score", "created_utc", "parent_id",
    "is_submitter", "edited", "depth", "listing_pos", "is_placeholder",
]

RAW_POST_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("selftext", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("permalink", T.StringType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("upvote_ratio", T.DoubleType()),
        T.StructField("num_comments", T.IntegerType()),
        T.StructField("created_utc", T.DoubleType()),
        T.StructField("edited", T.DoubleType()),
        T.StructField("link_flair_text", T.StringType()),
        T.StructField("link_flair_css_class", T.StringType()),
        T.StructField("total_awards_received", T.IntegerType()),
        T.StructField("is_self", T.BooleanType()),
        T.StructField("is_video", T.BooleanType()),
        T.StructField("is_original_content", T.BooleanType()),
        T.StructField("over_18", T.BooleanType()),
        T.StructField("spoiler", T.BooleanType()),
        T.StructField("stickied", T.BooleanType()),
        T.StructField("locked", T.BooleanType()),
        T.StructField("archived", T.BooleanType()),
        T.StructField("thumbnail", T.StringType()),
        T.StructField("feed", T.StringType()),
        T.StructField("feed_pos", T.LongType()),
        T.StructField("observed_at", T.TimestampType()),
    ]
)

RAW_COMMENT_SCHEMA = T.StructType(
    [
        T.StructField("post_id", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("created_utc", T.DoubleType()),
        T.StructField("parent_id", T.StringType()),
        T.StructField("is_submitter", T.BooleanType()),
        T.StructField("edited", T.DoubleType()),
        T.StructField("depth", T.IntegerType()),
        T.StructField("listing_pos", T.IntegerType()),
        T.StructField("is_placeholder", T.BooleanType()),
    ]
)

# Normalised rows ----------------------------------------------------------------
POST_COLS = [
    "id", "subreddit", "author", "title", "selftext", "url", "permalink",
    "score", "upvote_ratio", "num_comments", "created_utc", "edited",
    "link_flair_text", "link_flair_css_class", "total_awards_received",
    "is_self", "is_video", "is_original_content", "over_18", "spoiler",
    "stickied", "locked", "archived", "thumbnail", "media_url",
]

COMMENT_COLS = [
    "post_id", "id", "author", "body", "score", "created_utc", "parent_id",
    "is_submitter", "edited", "depth", "listing_pos",
]

# State tables -----------------------------------------------------------------------
TRACKED_COLS = [
    "post_id", "subreddit", "created_utc", "first_scraped", "last_updated",
    "update_count", "status", "contextual_doc_id", "content_hash",
]

# The post cache keeps a subset of the post plus bookkeeping columns.
CACHED_POST_COLS = [
    "id", "subreddit", "author", "title", "selftext", "url", "permalink",
    "score", "upvote_ratio", "num_comments", "created_utc", "edited",
    "link_flair_text", "is_self", "scraped_at", "last_updated", "update_count",
]

CACHED_COMMENT_COLS = [
    "post_id", "id", "author", "body", "score", "created_utc", "parent_id",
    "is_submitter", "edited", "depth", "listing_pos",
]

QUEUE_COLS = [
    "id", "post_id", "subreddit", "action", "priority", "attempts",
    "max_attempts", "last_error", "created_at", "scheduled_for",
]

SINK_RESULT_COLS = ["doc_key", "op", "ok", "returned_doc_id", "error"]

TRACKED_SCHEMA = T.StructType(
    [
        T.StructField("post_id", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("created_utc", T.TimestampType()),
        T.StructField("first_scraped", T.TimestampType()),
        T.StructField("last_updated", T.TimestampType()),
        T.StructField("update_count", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("contextual_doc_id", T.StringType()),
        T.StructField("content_hash", T.StringType()),
    ]
)

QUEUE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("post_id", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("priority", T.IntegerType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("max_attempts", T.IntegerType()),
        T.StructField("last_error", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("scheduled_for", T.TimestampType()),
    ]
)

SINK_RESULT_SCHEMA = T.StructType(
    [
        T.StructField("doc_key", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("returned_doc_id", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
