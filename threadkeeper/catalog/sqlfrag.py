"""DuckDB SQL building blocks for the oracle queries.

Each fragment mirrors one adapter or expression of the Spark side, written
independently in SQL so the two engines check each other.  Strings are built
by concatenation (no f-strings) because the SQL itself contains braces.
"""

from __future__ import annotations

from threadkeeper.params import DOC_ID_PREFIX, EXCLUDED_AUTHORS, SITE, epoch_micros

ANCHOR_S = epoch_micros("2024-01-31 16:00:00") // 1_000_000


def lit_ts(micros: int) -> str:
    return "make_timestamp(CAST(" + str(micros) + " AS BIGINT))"


def ts_from_epoch(x: str) -> str:
    return "make_timestamp(CAST(round((" + x + ") * 1000000) AS BIGINT))"


BOTS_SQL = ", ".join("'" + a.lower() + "'" for a in sorted({a.lower() for a in EXCLUDED_AUTHORS}))

_ESC = (
    "CASE ch WHEN '\"' THEN '\\\"' WHEN '\\' THEN '\\\\' "
    "WHEN chr(10) THEN '\\n' WHEN chr(13) THEN '\\r' WHEN chr(9) THEN '\\t' "
    "WHEN chr(8) THEN '\\b' WHEN chr(12) THEN '\\f' "
    "ELSE CASE WHEN unicode(ch) BETWEEN 32 AND 126 THEN ch "
    "WHEN unicode(ch) < 65536 THEN '\\u' || lpad(format('{:x}', unicode(ch)), 4, '0') "
    "ELSE '\\u' || format('{:x}', 55296 + ((unicode(ch) - 65536) >> 10)) "
    "|| '\\u' || format('{:x}', 56320 + ((unicode(ch) - 65536) & 1023)) END END"
)


def json_string(x: str) -> str:
    """JSON literal of a non-null string the way Python's json.dumps writes it."""
    return (
        "('\"' || CASE WHEN regexp_matches(" + x + ", '[^ !#-\\[\\]-~]') THEN coalesce(array_to_string("
        "list_transform(list_filter(string_split(" + x + ", ''), lambda ch: ch <> ''), lambda ch: " + _ESC + "), ''), '') "
        "ELSE " + x + " END || '\"')"
    )


def comment_fragment(id_: str, body: str) -> str:
    return (
        "('{\"body_hash\": \"' || substring(md5(substring(coalesce(" + body + ", ''), 1, 500)), 1, 8) "
        "|| '\", \"id\": ' || " + json_string(id_) + " || '}')"
    )


def content_hash(title: str, selftext: str, fragments: str) -> str:
    return (
        "substring(sha256('{\"comments\": [' || coalesce(" + fragments + ", '') || '], \"selftext\": ' || "
        + json_string("substring(coalesce(" + selftext + ", ''), 1, 2000)")
        + " || ', \"title\": ' || "
        + json_string("coalesce(" + title + ", '')")
        + " || '}'), 1, 16)"
    )


def fragments_cte(name: str, comments: str) -> str:
    return (
        name + " AS (SELECT post_id, string_agg(" + comment_fragment("id", "body") + ", ', ' ORDER BY id) AS fragments, count(*) AS n_comments "
        "FROM " + comments + " GROUP BY post_id)"
    )


# ---------------------------------------------------------------------------
# Adapters
# ---------------------------------------------------------------------------
def conv_raw_posts(name: str = "raw_posts") -> str:
    k = "conv_id"
    sub = "('src' || (" + k + " % 5))"
    perm = "('/r/' || " + sub + " || '/comments/t' || " + k + " || '/post_' || " + k + " || '/')"
    created = "(CAST(" + str(ANCHOR_S) + " - (" + k + " % 97) * 3600 - (" + k + " % 7) * 60 AS DOUBLE) + (" + k + " % 4) * 0.25)"
    return (
        name + " AS (SELECT "
        "'t' || " + k + " AS id, " + sub + " AS subreddit, "
        "CASE WHEN " + k + " % 17 <> 0 THEN 'u' || (" + k + " % 29) END AS author, "
        "text AS title, "
        "CASE WHEN " + k + " % 6 = 2 THEN NULL WHEN " + k + " % 23 = 5 THEN '[removed]' ELSE text END AS selftext, "
        "CASE WHEN " + k + " % 6 <> 2 THEN '" + SITE + "' || " + perm + " "
        "ELSE 'https://media.example.com/p' || " + k + " || CASE WHEN " + k + " % 4 = 0 THEN '.png' ELSE '' END END AS url, "
        + perm + " AS permalink, "
        "CAST((" + k + " * 31) % 500 AS INTEGER) AS score, "
        "CAST((" + k + " * 7) % 10001 AS DOUBLE) / 10000 AS upvote_ratio, "
        "CAST((" + k + " * 3) % 40 AS INTEGER) AS num_comments, "
        + created + " AS created_utc, "
        "CASE WHEN " + k + " % 19 = 4 THEN NULL WHEN " + k + " % 7 = 3 THEN " + created + " + 600 ELSE 0.0 END AS edited, "
        "CASE WHEN " + k + " % 4 = 1 THEN 'Flair ' || (" + k + " % 3) END AS link_flair_text, "
        "CASE WHEN " + k + " % 4 = 1 THEN 'f' || (" + k + " % 3) END AS link_flair_css_class, "
        "CAST(" + k + " % 3 AS INTEGER) AS total_awards_received, "
        "(" + k + " % 6 <> 2) AS is_self, (" + k + " % 10 = 9) AS is_video, (" + k + " % 9 = 1) AS is_original_content, "
        "(" + k + " % 11 = 0) AS over_18, (" + k + " % 13 = 2) AS spoiler, (" + k + " % 31 = 0) AS stickied, "
        "(" + k + " % 37 = 1) AS locked, false AS archived, "
        "CASE WHEN " + k + " % 6 <> 2 THEN 'self' ELSE 'https://thumbs.example.com/' || " + k + " || '.jpg' END AS thumbnail, "
        "'new' AS feed, CAST(" + k + " AS BIGINT) AS feed_pos, " + lit_ts(ANCHOR_S * 1_000_000) + " AS observed_at "
        "FROM conversations WHERE turn = 0)"
    )


def conv_raw_comments(name: str = "raw_comments") -> str:
    k, t = "conv_id", "turn"
    created = "CAST(" + str(ANCHOR_S) + " - (" + k + " % 97) * 3600 + " + t + " * 60 AS DOUBLE)"
    kt = "(" + k + " + " + t + ")"
    return (
        name + " AS (SELECT "
        "'t' || " + k + " AS post_id, 'c' || " + k + " || '-' || " + t + " AS id, "
        "CASE WHEN " + kt + " % 11 = 0 THEN 'AutoModerator' WHEN " + kt + " % 13 = 0 THEN NULL "
        "WHEN " + kt + " % 17 = 0 THEN 'remindmebot' ELSE role || " + t + " END AS author, "
        "CASE WHEN (" + k + " * 7 + " + t + ") % 29 = 3 THEN NULL ELSE text END AS body, "
        "CAST(((" + k + " * 31 + " + t + " * 17) % 23) % 6 AS INTEGER) AS score, "
        + created + " AS created_utc, "
        "CASE WHEN " + t + " = 1 THEN 't3_t' || " + k + " ELSE 't1_c' || " + k + " || '-' || (" + t + " - 1) END AS parent_id, "
        "(role = 'user') AS is_submitter, "
        "CASE WHEN " + t + " % 5 = 0 THEN " + created + " + 30 ELSE 0.0 END AS edited, "
        "CAST(" + t + " - 1 AS INTEGER) AS depth, CAST(" + t + " AS INTEGER) AS listing_pos, "
        "(" + kt + " % 19 = 0) AS is_placeholder "
        "FROM conversations WHERE turn > 0)"
    )


def order_raw_posts(name: str = "raw_posts") -> str:
    k, cust = "o_orderkey", "o_custkey"
    perm = "('/r/' || o_orderpriority || '/comments/o' || " + k + " || '/order/')"
    created = "CAST(" + str(ANCHOR_S) + " - (" + k + " % 72) * 3600 - (" + cust + " % 60) * 60 AS DOUBLE)"
    return (
        name + " AS (SELECT "
        "'o' || " + k + " AS id, o_orderpriority AS subreddit, "
        "CASE WHEN " + cust + " % 101 <> 0 THEN 'u' || " + cust + " END AS author, "
        "'Order ' || " + k + " || ' for customer ' || " + cust + " AS title, "
        "CASE WHEN " + k + " % 9 = 4 THEN NULL ELSE 'Status ' || o_orderstatus || ', total ' || "
        "CAST(round(o_totalprice * 100) AS BIGINT) || ' cents' END AS selftext, "
        "CASE WHEN " + k + " % 9 <> 4 THEN '" + SITE + "' || " + perm + " "
        "ELSE 'https://shop.example.com/o' || " + k + " || CASE WHEN " + k + " % 2 = 0 THEN '.jpg' ELSE '' END END AS url, "
        + perm + " AS permalink, "
        "CAST(floor(o_totalprice / 1000) AS INTEGER) AS score, "
        "CAST(" + k + " % 101 AS DOUBLE) / 100 AS upvote_ratio, "
        "CAST(" + k + " % 13 AS INTEGER) AS num_comments, "
        + created + " AS created_utc, "
        "CASE WHEN o_orderstatus = 'F' THEN " + created + " + 120 ELSE 0.0 END AS edited, "
        "CASE WHEN o_orderstatus = 'P' THEN 'pending' END AS link_flair_text, "
        "CASE WHEN o_orderstatus = 'P' THEN 'p' END AS link_flair_css_class, "
        "CAST(" + cust + " % 4 AS INTEGER) AS total_awards_received, "
        "(" + k + " % 9 <> 4) AS is_self, false AS is_video, (" + k + " % 5 = 0) AS is_original_content, "
        "false AS over_18, false AS spoiler, (" + k + " % 1000 = 0) AS stickied, false AS locked, false AS archived, "
        "CASE WHEN " + k + " % 9 <> 4 THEN 'self' END AS thumbnail, "
        "'new' AS feed, CAST(" + k + " AS BIGINT) AS feed_pos, " + lit_ts(ANCHOR_S * 1_000_000) + " AS observed_at "
        "FROM orders)"
    )


def lineitem_raw_comments(name: str = "raw_comments") -> str:
    k, supp = "l_orderkey", "l_suppkey"
    created = "(CAST(epoch_us(l_shipdate) AS DOUBLE) / 1000000)"
    return (
        name + "_pos AS (SELECT *, l_linenumber AS pos FROM lineitem), "
        + name + " AS (SELECT "
        "'o' || " + k + " AS post_id, 'l' || " + k + " || '-' || pos || '-' || l_partkey || '-' || " + supp
        + " || '-' || CAST(round(l_extendedprice * 100) AS BIGINT) AS id, "
        "CASE WHEN " + supp + " % 23 = 0 THEN 'AutoModerator' WHEN " + supp + " % 29 = 0 THEN 'SaveVideo' "
        "WHEN " + supp + " % 31 = 0 THEN NULL ELSE 's' || " + supp + " END AS author, "
        "'qty ' || CAST(l_quantity AS BIGINT) || ', price ' || CAST(round(l_extendedprice * 100) AS BIGINT) "
        "|| ', discount ' || CAST(round(l_discount * 100) AS BIGINT) || ', tax ' || CAST(round(l_tax * 100) AS BIGINT) "
        "|| ', flags ' || l_returnflag || l_linestatus AS body, "
        "CAST(l_quantity AS INTEGER) AS score, " + created + " AS created_utc, "
        "CASE WHEN pos = 1 THEN 't3_o' || " + k + " ELSE 't1_l' || " + k + " || '-' || (pos - 1) END AS parent_id, "
        "(l_returnflag = 'R') AS is_submitter, "
        "CASE WHEN l_linestatus = 'O' THEN " + created + " + 60 ELSE 0.0 END AS edited, "
        "CAST((pos - 1) % 4 AS INTEGER) AS depth, CAST(pos AS INTEGER) AS listing_pos, "
        "(l_partkey % 97 = 0) AS is_placeholder "
        "FROM " + name + "_pos)"
    )


def event_observations(name: str = "raw_obs") -> str:
    u = "user_id"
    perm = "('/r/src' || (" + u + " % 5) || '/comments/e' || " + u + " || '/')"
    created = "CAST(" + str(ANCHOR_S) + " - (" + u + " % 50) * 3600 - (" + u + " % 7) * 60 AS DOUBLE)"
    return (
        name + " AS (SELECT "
        "'e' || " + u + " AS id, 'src' || (" + u + " % 5) AS subreddit, "
        "CASE WHEN " + u + " % 13 <> 0 THEN 'u' || " + u + " END AS author, "
        "'Post by user ' || " + u + " AS title, "
        "'Last event ' || event_type || ' ' || props AS selftext, "
        "CASE WHEN event_id % 97 <> 0 THEN '" + SITE + "' || " + perm + " END AS url, " + perm + " AS permalink, "
        "CAST(floor(value) AS INTEGER) AS score, CAST(event_id % 100 AS DOUBLE) / 100 AS upvote_ratio, "
        "CAST(event_id % 17 AS INTEGER) AS num_comments, " + created + " AS created_utc, 0.0 AS edited, "
        "CAST(NULL AS VARCHAR) AS link_flair_text, CAST(NULL AS VARCHAR) AS link_flair_css_class, "
        "0 AS total_awards_received, true AS is_self, false AS is_video, false AS is_original_content, "
        "false AS over_18, false AS spoiler, false AS stickied, false AS locked, false AS archived, "
        "'self' AS thumbnail, CASE WHEN event_type = 'click' THEN 'hot' ELSE 'new' END AS feed, "
        "CAST(event_id AS BIGINT) AS feed_pos, make_timestamp(epoch_us(ts) - epoch_us(ts) % 43200000000) AS observed_at FROM events)"
    )


def event_queue(name: str = "queue0") -> str:
    return (
        name + "_g AS (SELECT 'e' || user_id AS post_id, 'src' || (user_id % 5) AS subreddit, "
        "CASE WHEN event_id % 2 = 0 THEN 'ingest' ELSE 'update' END AS action, "
        "min(event_id) AS id, CAST(max(CAST(floor(value) AS BIGINT) % 3) AS INTEGER) AS priority, count(*) AS n, "
        "max(event_id) AS last_event, min(ts) AS created_at, max(ts) AS last_ts "
        "FROM events GROUP BY ALL), "
        + name + " AS (SELECT id, post_id, subreddit, action, priority, CAST(n % 7 AS INTEGER) AS attempts, "
        "5 AS max_attempts, CASE WHEN n % 7 > 0 THEN 'HTTP 5' || lpad(CAST(last_event % 100 AS VARCHAR), 2, '0') END AS last_error, "
        "created_at, last_ts + to_hours(CAST((n % 3) * 24 AS BIGINT)) AS scheduled_for FROM " + name + "_g)"
    )


def doc_base(name: str = "doc_base") -> str:
    return (
        name + " AS (SELECT doc_id, doc_id % 10 AS rule, 'd' || doc_id AS post_id, source AS subreddit, "
        "'a' || (doc_id % 37) AS author, text AS title, text AS selftext, "
        "CAST(doc_id % 100 AS INTEGER) AS score, CAST(n_chars % 50 AS INTEGER) AS num_comments, "
        "CAST(doc_id % 100 AS DOUBLE) / 100 AS upvote_ratio FROM documents)"
    )


def doc_stored(run_micros: int) -> str:
    """CTEs doc_tracked and doc_cached (needs doc_base)."""
    run = lit_ts(run_micros)
    return (
        "doc_tracked AS (SELECT post_id, subreddit, " + run + " - INTERVAL 1 HOUR AS created_utc, "
        + run + " - INTERVAL 1 DAY AS first_scraped, "
        "CASE WHEN rule = 6 THEN " + run + " ELSE " + run + " - INTERVAL 1 DAY END AS last_updated, "
        "CAST(CASE WHEN rule = 7 THEN -1 ELSE 0 END AS INTEGER) AS update_count, 'new' AS status, "
        "CASE WHEN rule <> 8 THEN '" + DOC_ID_PREFIX + "' || post_id END AS contextual_doc_id, "
        + content_hash("title", "selftext", "CAST(NULL AS VARCHAR)") + " AS content_hash "
        "FROM doc_base WHERE rule <> 0), "
        "doc_cached AS (SELECT post_id AS id, subreddit, author, title, selftext, score, upvote_ratio, num_comments "
        "FROM doc_base WHERE rule <> 0)"
    )


def doc_observed(run_micros: int, name: str = "doc_obs") -> str:
    created = "CAST(" + repr(run_micros / 1_000_000 - 3600) + " AS DOUBLE)"
    perm = "('/r/' || subreddit || '/comments/' || post_id || '/')"
    return (
        name + " AS (SELECT post_id AS id, subreddit, CASE WHEN rule <> 3 THEN author END AS author, title, "
        "CASE WHEN rule IN (1, 7) THEN 'x ' || selftext WHEN rule = 4 THEN '[removed]' ELSE selftext END AS selftext, "
        "'" + SITE + "' || " + perm + " AS url, " + perm + " AS permalink, "
        "CASE WHEN rule IN (2, 8) THEN score + 1 ELSE score END AS score, upvote_ratio, num_comments, "
        + created + " AS created_utc, 0.0 AS edited, CAST(NULL AS VARCHAR) AS link_flair_text, "
        "CAST(NULL AS VARCHAR) AS link_flair_css_class, 0 AS total_awards_received, true AS is_self, "
        "false AS is_video, false AS is_original_content, false AS over_18, false AS spoiler, false AS stickied, "
        "false AS locked, false AS archived, 'self' AS thumbnail, 'refresh' AS feed, CAST(doc_id AS BIGINT) AS feed_pos, "
        + lit_ts(run_micros) + " AS observed_at FROM doc_base WHERE rule <> 5)"
    )


URL_SUFFIX_CASES = (".jpg", ".jpeg", ".png", ".gif", ".mp4", ".webm", ".JPG", ".png?x=1", ".gifv")


def page_urls(name: str = "urls") -> str:
    arr = "[" + ", ".join("'" + s + "'" for s in URL_SUFFIX_CASES) + "]"
    return (
        name + " AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url || " + arr + "[CAST((page_id // 3) % "
        + str(len(URL_SUFFIX_CASES)) + " + 1 AS INTEGER)] ELSE url END AS url FROM pages)"
    )


# ---------------------------------------------------------------------------
# Normalisation
# ---------------------------------------------------------------------------
MEDIA_SQL = (
    "CASE WHEN url IS NOT NULL AND url <> '' AND (url LIKE '%.jpg' OR url LIKE '%.jpeg' OR url LIKE '%.png' "
    "OR url LIKE '%.gif' OR url LIKE '%.mp4' OR url LIKE '%.webm') THEN url END"
)


def normalize_posts(src: str, name: str = "posts") -> str:
    return (
        name + " AS (SELECT id, subreddit, coalesce(author, '[deleted]') AS author, title, "
        "coalesce(selftext, '') AS selftext, url, permalink, score, upvote_ratio, num_comments, "
        + ts_from_epoch("created_utc") + " AS created_utc, (coalesce(edited, 0.0) <> 0) AS edited, "
        "link_flair_text, link_flair_css_class, coalesce(total_awards_received, 0) AS total_awards_received, "
        "coalesce(is_self, true) AS is_self, coalesce(is_video, false) AS is_video, "
        "coalesce(is_original_content, false) AS is_original_content, coalesce(over_18, false) AS over_18, "
        "coalesce(spoiler, false) AS spoiler, coalesce(stickied, false) AS stickied, coalesce(locked, false) AS locked, "
        "coalesce(archived, false) AS archived, CASE WHEN thumbnail <> 'self' THEN thumbnail END AS thumbnail, "
        + MEDIA_SQL + " AS media_url FROM " + src + ")"
    )


def normalize_comments(src: str, max_comments: int = 100, name: str = "comments") -> str:
    return (
        name + "_kept AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY post_id ORDER BY listing_pos, id) AS rn FROM " + src + " "
        "WHERE NOT coalesce(is_placeholder, false) AND lower(coalesce(author, '[deleted]')) NOT IN (" + BOTS_SQL + ") "
        "AND id IS NOT NULL AND body IS NOT NULL AND score IS NOT NULL AND created_utc IS NOT NULL "
        "AND parent_id IS NOT NULL AND is_submitter IS NOT NULL AND depth IS NOT NULL), "
        + name + " AS (SELECT post_id, id, coalesce(author, '[deleted]') AS author, body, score, "
        + ts_from_epoch("created_utc") + " AS created_utc, parent_id, is_submitter, "
        "(coalesce(edited, 0.0) <> 0) AS edited, depth, listing_pos FROM " + name + "_kept WHERE rn <= " + str(max_comments) + ")"
    )


# ---------------------------------------------------------------------------
# Shared pieces of the registered-query oracles
# ---------------------------------------------------------------------------
RUN_MICROS = ANCHOR_S * 1_000_000
RUN = lit_ts(RUN_MICROS)
CUTOFF_S = str(float(ANCHOR_S - 26 * 3600))


def pac(ts: str) -> str:
    """Pacific wall clock of a UTC wall-clock timestamp."""
    return "timezone('America/Los_Angeles', timezone('UTC', " + ts + "))"


def pac_offset_hours(ts: str) -> str:
    return "((epoch_us(" + pac(ts) + ") - epoch_us(" + ts + ")) // 3600000000)"


def dual_time(ts: str) -> str:
    return (
        "(strftime(" + pac(ts) + ", '%b %d, %Y at %I:%M %p ') || CASE WHEN " + pac_offset_hours(ts) + " = -8 THEN 'PST' ELSE 'PDT' END "
        "|| ' (' || strftime(" + ts + ", '%Y-%m-%d %H:%M') || ' UTC)')"
    )


def iso_frac(ts: str) -> str:
    return "CASE WHEN epoch_us(" + ts + ") % 1000000 <> 0 THEN '.' || lpad(CAST(epoch_us(" + ts + ") % 1000000 AS VARCHAR), 6, '0') ELSE '' END"


def iso_utc(ts: str) -> str:
    return "(strftime(" + ts + ", '%Y-%m-%dT%H:%M:%S') || " + iso_frac(ts) + " || '+00:00')"


def iso_pacific(ts: str) -> str:
    return (
        "(strftime(" + pac(ts) + ", '%Y-%m-%dT%H:%M:%S') || " + iso_frac(ts) + " || CASE WHEN " + pac_offset_hours(ts)
        + " = -8 THEN '-08:00' ELSE '-07:00' END)"
    )


def pacific_date(ts: str) -> str:
    return "CAST(" + pac(ts) + " AS DATE)"


def html_escape(x: str) -> str:
    return "replace(replace(replace(" + x + ", '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def html_attr(x: str) -> str:
    return "replace(" + html_escape(x) + ", '\"', '&quot;')"


def comment_permalink(parent_id: str, id_: str) -> str:
    return "('" + SITE + "/comments/' || string_split(" + parent_id + ", '_')[-1] || '/_/' || " + id_ + ")"


def comment_tags(is_submitter: str, edited: str, depth: str) -> str:
    t = (
        "concat_ws(', ', CASE WHEN " + is_submitter + " THEN 'OP' END, CASE WHEN " + edited + " THEN 'edited' END, "
        "CASE WHEN " + depth + " > 0 THEN 'reply depth ' || " + depth + " END)"
    )
    return "CASE WHEN " + t + " <> '' THEN ' [' || " + t + " || ']' ELSE '' END"


def age_days(ts: str) -> str:
    return "(CAST(" + str(RUN_MICROS) + " - epoch_us(" + ts + ") AS DOUBLE) / 86400000000.0)"


def latest_cte(name: str, src: str) -> str:
    return (
        name + " AS (SELECT * EXCLUDE (rn_) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY observed_at DESC, "
        "(feed = 'hot') DESC, feed_pos DESC) AS rn_ FROM " + src + ") WHERE rn_ = 1)"
    )


GOOD_SQL = (
    "good AS (SELECT * FROM raw_obs WHERE id IS NOT NULL AND subreddit IS NOT NULL AND title IS NOT NULL AND url IS NOT NULL "
    "AND permalink IS NOT NULL AND score IS NOT NULL AND upvote_ratio IS NOT NULL AND num_comments IS NOT NULL "
    "AND created_utc IS NOT NULL)"
)

WINDOW_SQL = "win AS (SELECT * FROM good WHERE feed = 'new' AND created_utc >= " + CUTOFF_S + ")"
HOT_SQL = (
    "hot AS (SELECT * EXCLUDE (rk_, newest_) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY subreddit ORDER BY feed_pos, id) AS rk_ "
    "FROM (SELECT *, max(observed_at) OVER (PARTITION BY subreddit) AS newest_ FROM good WHERE feed = 'hot') "
    "WHERE observed_at = newest_) WHERE rk_ <= 50 AND created_utc >= " + CUTOFF_S + ")"
)


def events_tracked() -> str:
    """ev_ref (refresh = latest good observation, normalised) and ev_tracked."""
    run = RUN
    return (
        event_observations() + ", " + GOOD_SQL + ", " + latest_cte("ev_latest", "good") + ", "
        + normalize_posts("ev_latest", "ev_norm") + ", "
        "ev_ref AS (SELECT n.*, CAST(substring(n.id, 2) AS BIGINT) AS u, "
        + content_hash("n.title", "n.selftext", "CAST(NULL AS VARCHAR)") + " AS h, "
        "(l.author IS NULL OR coalesce(l.selftext, '') IN ('[deleted]', '[removed]')) AS deleted "
        "FROM ev_norm n JOIN ev_latest l ON l.id = n.id), "
        "ev_tracked AS (SELECT id AS post_id, subreddit, created_utc, " + run + " - INTERVAL 2 DAY AS first_scraped, "
        "CASE WHEN u % 8 = 0 THEN " + run + " ELSE " + run + " - INTERVAL 1 DAY END AS last_updated, "
        "CAST((u // 2) % 4 - 1 AS INTEGER) AS update_count, CASE WHEN u % 10 = 0 THEN 'frozen' ELSE 'new' END AS status, "
        "CASE WHEN u % 6 <> 4 THEN '" + DOC_ID_PREFIX + "' || id END AS contextual_doc_id, "
        "CASE WHEN u % 12 = 2 THEN '' WHEN u % 4 = 0 THEN h ELSE 'stale' || u END AS content_hash, u "
        "FROM ev_ref WHERE u % 2 = 0)"
    )


def order_instants(name: str = "inst") -> str:
    k = "o_orderkey"
    return (
        name + " AS (SELECT " + k + ", make_timestamp(epoch_us(o_orderdate) + (" + k + " % 24) * 3600000000 + (" + k
        + " % 60) * 60000000 + CASE WHEN " + k + " % 3 = 0 THEN 0 ELSE " + k + " % 1000000 END) AS ts FROM orders)"
    )
