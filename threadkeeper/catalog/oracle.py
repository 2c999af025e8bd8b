"""DuckDB oracle SQL for the registered queries (same names, same columns)."""

from __future__ import annotations

from threadkeeper.catalog import sqlfrag as S


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


CONV = (S.conv_raw_posts(), S.conv_raw_comments(), S.normalize_posts("raw_posts"), S.normalize_comments("raw_comments"))

ORACLE: dict[str, str] = {}

ORACLE["hash_content"] = (
    _with(*CONV, S.fragments_cte("frags", "comments"))
    + "SELECT p.id AS post_id, p.subreddit, coalesce(f.n_comments, 0) AS n_comments, "
    + S.content_hash("p.title", "p.selftext", "f.fragments")
    + " AS content_hash FROM posts p LEFT JOIN frags f ON f.post_id = p.id"
)

# ---------------------------------------------------------------------------
# Scans / sources
# ---------------------------------------------------------------------------
EV = (S.event_observations(), S.GOOD_SQL)

ORACLE["src_window_scan"] = (
    _with(*EV, S.WINDOW_SQL)
    + "SELECT id, subreddit, feed_pos, " + S.ts_from_epoch("created_utc") + " AS created_utc, observed_at FROM win"
)
ORACLE["src_landing_pruned"] = (
    _with(*EV, S.WINDOW_SQL)
    + "SELECT id, subreddit, feed_pos, observed_at FROM win WHERE CAST(observed_at AS DATE) >= CAST(make_timestamp(CAST(" + S.CUTOFF_S + " * 1000000 AS BIGINT)) AS DATE)"
)
ORACLE["src_hot_top50"] = _with(*EV, S.HOT_SQL) + "SELECT id, subreddit, feed_pos, observed_at FROM hot"
ORACLE["src_hot_polls"] = (
    _with(S.event_observations(), S.GOOD_SQL)
    + ", r AS (SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY feed_pos) AS rk FROM good WHERE feed_pos % 2 = 0) "
    "SELECT 'h' || feed_pos AS id, subreddit, feed_pos, " + S.RUN + " AS observed_at FROM r WHERE rk <= 50 AND created_utc >= " + str(float(S.ANCHOR_S - 24 * 3600))
)
ORACLE["src_failed_sources"] = (
    _with(*EV)
    + ", manifest AS (SELECT DISTINCT subreddit, subreddit <> 'src3' AS ok FROM good) "
    "SELECT t.subreddit, CASE WHEN m.subreddit IS NULL THEN 'not polled' ELSE 'HTTP 429' END AS error "
    "FROM (VALUES ('src0'), ('src1'), ('src2'), ('src3'), ('src4'), ('src5'), ('gone')) t(subreddit) "
    "LEFT JOIN manifest m ON m.subreddit = t.subreddit WHERE NOT coalesce(m.ok, false)"
)
ORACLE["src_configured"] = (
    _with(*EV, S.WINDOW_SQL)
    + "SELECT id, subreddit, feed_pos, observed_at FROM win WHERE subreddit IN ('src1', 'src4')"
)
ORACLE["src_refresh_outcome"] = (
    _with(S.doc_base(), S.doc_observed(S.RUN_MICROS))
    + "SELECT b.post_id, CASE WHEN o.id IS NULL THEN 'FETCH_FAILED' "
    "WHEN o.author IS NULL OR coalesce(o.selftext, '') IN ('[deleted]', '[removed]') THEN 'DELETED' ELSE 'FOUND' END AS outcome "
    "FROM doc_base b LEFT JOIN doc_obs o ON o.id = b.post_id WHERE b.rule <> 0"
)
ORACLE["src_rejects"] = (
    _with(S.event_observations())
    + "SELECT (id IS NOT NULL AND subreddit IS NOT NULL AND title IS NOT NULL AND url IS NOT NULL AND permalink IS NOT NULL "
    "AND score IS NOT NULL AND upvote_ratio IS NOT NULL AND num_comments IS NOT NULL AND created_utc IS NOT NULL) AS valid, "
    "count(*) AS n FROM raw_obs GROUP BY ALL"
)
ORACLE["src_cached_post"] = (
    _with(*CONV)
    + ", known AS (SELECT * FROM posts WHERE CAST(substring(id, 2) AS BIGINT) % 4 = 0), "
    "agg AS (SELECT post_id, count(*) AS n, first(id ORDER BY score DESC, listing_pos, id) AS top, "
    "string_agg(id, ',' ORDER BY score DESC, listing_pos, id) AS ord FROM comments "
    "WHERE post_id IN (SELECT id FROM known) GROUP BY post_id) "
    "SELECT k.id AS post_id, k.selftext, coalesce(a.n, 0) AS n_comments, a.top AS top_comment, "
    "coalesce(a.ord, '') AS comment_order FROM known k LEFT JOIN agg a ON a.post_id = k.id"
)
ORACLE["src_tracked_lookup"] = (
    _with(S.events_tracked())
    + "SELECT r.id AS post_id, t.post_id IS NOT NULL AS tracked, t.content_hash FROM ev_ref r LEFT JOIN ev_tracked t ON t.post_id = r.id"
)

# ---------------------------------------------------------------------------
# Projections / functions
# ---------------------------------------------------------------------------
ORACLE["prj_normalize_post"] = (
    _with(*CONV) + "SELECT *, '" + S.SITE + "' || permalink AS full_url, " + S.age_days("created_utc") + " AS age_days FROM posts"
)
ORACLE["prj_normalize_comment"] = (
    _with(*CONV) + "SELECT *, " + S.comment_permalink("parent_id", "id") + " AS permalink FROM comments"
)
ORACLE["fn_media_url"] = _with(S.page_urls()) + "SELECT page_id, url, " + S.MEDIA_SQL + " AS media_url FROM urls"
LARGE_C = (S.lineitem_raw_comments("raw_comments"), S.normalize_comments("raw_comments"))
ORACLE["fn_permalinks"] = (
    _with(*LARGE_C)
    + "SELECT post_id, id, '" + S.SITE + "/comments/' || post_id AS thread_url, "
    + S.comment_permalink("parent_id", "id") + " AS permalink FROM comments"
)
LARGE_P = (S.order_raw_posts("raw_posts"), S.normalize_posts("raw_posts"))
ORACLE["fn_age_days"] = (
    _with(*LARGE_P)
    + "SELECT id, " + S.age_days("created_utc") + " AS age_days, " + S.age_days("created_utc") + " <= 2.0 AS in_window FROM posts"
)
ORACLE["fn_pacific_date"] = _with(S.order_instants()) + "SELECT o_orderkey, " + S.pacific_date("ts") + " AS pacific_date FROM inst"
ORACLE["fn_dual_time"] = _with(S.order_instants()) + "SELECT o_orderkey, " + S.dual_time("ts") + " AS label FROM inst"
ORACLE["fn_iso_time"] = (
    _with(S.order_instants()) + "SELECT o_orderkey, " + S.iso_utc("ts") + " AS iso_utc, " + S.iso_pacific("ts") + " AS iso_pacific FROM inst"
)
ORACLE["fn_ratio_bp"] = (
    "SELECT o_orderkey, CAST(round_even(CAST(o_orderkey % 20001 AS DOUBLE) / 20000 * 10000, 0) AS INTEGER) AS ratio_bp FROM orders"
)
ORACLE["fn_html_escape"] = "SELECT doc_id, " + S.html_escape("text") + " AS escaped FROM documents"
ORACLE["fn_comment_tags"] = _with(*CONV) + "SELECT id, " + S.comment_tags("is_submitter", "edited", "depth") + " AS tags FROM comments"
ORACLE["fn_doc_id"] = (
    _with(*CONV)
    + "SELECT id, '" + S.DOC_ID_PREFIX + "' || id AS doc_id, '" + S.DOC_ID_PREFIX + "' || id || '.html' AS file_name, "
    "CAST(strlen(selftext) AS BIGINT) AS selftext_bytes, substring(title, 1, 50) AS preview50 FROM posts"
)

# ---------------------------------------------------------------------------
# Filters
# ---------------------------------------------------------------------------
ORACLE["flt_bots"] = (
    _with(S.conv_raw_comments())
    + "SELECT id, coalesce(author, '[deleted]') AS author FROM raw_comments WHERE lower(coalesce(author, '[deleted]')) IN ("
    + S.BOTS_SQL + ")"
)
ORACLE["flt_update_window"] = _with(*LARGE_P) + "SELECT id FROM posts WHERE " + S.age_days("created_utc") + " <= 2.0"
ORACLE["flt_deleted"] = (
    _with(S.conv_raw_posts()) + "SELECT id FROM raw_posts WHERE author IS NULL OR coalesce(selftext, '') IN ('[deleted]', '[removed]')"
)
ORACLE["flt_processed_today"] = (
    _with(S.events_tracked())
    + "SELECT post_id FROM ev_tracked WHERE " + S.pacific_date("last_updated") + " = " + S.pacific_date(S.RUN)
)
ORACLE["flt_due_update"] = (
    _with(S.events_tracked()) + "SELECT post_id, update_count, first_scraped FROM ev_tracked WHERE status <> 'frozen' AND update_count < 2"
)
ORACLE["flt_due_freeze"] = _with(S.events_tracked()) + "SELECT post_id FROM ev_tracked WHERE status <> 'frozen' AND update_count >= 2"
ORACLE["flt_missing_hash"] = (
    _with(S.events_tracked())
    + "SELECT post_id FROM ev_tracked WHERE (content_hash IS NULL OR content_hash = '') AND status <> 'frozen'"
)
ORACLE["flt_queue_due"] = (
    _with(S.event_queue()) + "SELECT post_id, action FROM queue0 WHERE attempts < max_attempts AND scheduled_for <= " + S.RUN
)

# ---------------------------------------------------------------------------
# Windows, sets, joins
# ---------------------------------------------------------------------------
ORACLE["win_first_n_comments"] = (
    _with(S.lineitem_raw_comments("raw_comments"), S.normalize_comments("raw_comments", 3))
    + "SELECT post_id, id, listing_pos FROM comments"
)
ORACLE["win_comment_rank"] = (
    _with(*CONV)
    + "SELECT post_id, id, CAST(ROW_NUMBER() OVER (PARTITION BY post_id ORDER BY score DESC, listing_pos, id) AS INTEGER) AS rank "
    "FROM comments"
)
ORACLE["win_latest_observation"] = (
    _with(*EV, S.latest_cte("lat", "good")) + "SELECT id, observed_at, feed, feed_pos, score FROM lat"
)
ORACLE["set_new_hot"] = (
    _with(*EV, S.WINDOW_SQL, S.HOT_SQL, "both_ AS (SELECT * FROM win UNION ALL SELECT * FROM hot)", S.latest_cte("lat", "both_"))
    + "SELECT id, feed, feed_pos FROM lat"
)
CONV_INTAKE = (
    S.conv_raw_posts(),
    "good AS (SELECT * FROM raw_posts)",
    S.WINDOW_SQL,
    S.HOT_SQL,
    "both_ AS (SELECT * FROM win UNION ALL SELECT * FROM hot)",
    S.latest_cte("lat", "both_"),
    "conv_tracked AS (SELECT id AS post_id, '" + S.DOC_ID_PREFIX + "' || id AS contextual_doc_id FROM raw_posts "
    "WHERE CAST(substring(id, 2) AS BIGINT) % 4 = 0)",
)
ORACLE["jn_new_posts"] = _with(*CONV_INTAKE) + "SELECT id FROM lat WHERE id NOT IN (SELECT post_id FROM conv_tracked)"
ORACLE["jn_existing"] = _with(*CONV_INTAKE) + "SELECT l.id, t.contextual_doc_id FROM lat l JOIN conv_tracked t ON t.post_id = l.id"
ORACLE["jn_orphans"] = (
    _with(S.events_tracked()) + "SELECT id FROM ev_ref WHERE u % 3 <> 0 AND id NOT IN (SELECT post_id FROM ev_tracked)"
)
ORACLE["jn_exists"] = (
    _with(S.events_tracked(), S.event_queue())
    + "SELECT DISTINCT q.post_id, q.post_id IN (SELECT post_id FROM ev_tracked) AS exists FROM queue0 q"
)

# ---------------------------------------------------------------------------
# Documents
# ---------------------------------------------------------------------------
_HEAD = (
    "('<article class=\"reply\" id=\"c-' || " + S.html_attr("id") + " || '\" data-depth=\"' || depth || '\">\n<header>#')"
)
_TAIL = (
    "(' u/' || " + S.html_escape("author") + " || ' | ' || score || ' points' || " + S.comment_tags("is_submitter", "edited", "depth")
    + " || '</header>\n<p class=\"when\">' || " + S.dual_time("created_utc") + " || ' | <a href=\"' || "
    + S.html_attr(S.comment_permalink("parent_id", "id")) + " || '\">permalink</a></p>\n<blockquote>' || "
    + S.html_escape("body") + " || '</blockquote>\n</article>\n')"
)


def disc_cte(comments: str) -> str:
    return (
        "ranked AS (SELECT post_id, score, listing_pos, id, " + _HEAD + " || ROW_NUMBER() OVER (PARTITION BY post_id ORDER BY score DESC, "
        "listing_pos, id) || " + _TAIL + " AS block FROM " + comments + "), "
        "disc AS (SELECT post_id, count(*) AS n, '<section class=\"discussion\">\n<h2>Discussion: ' || count(*) || ' comments</h2>\n' "
        "|| string_agg(block, '' ORDER BY score DESC, listing_pos, id) || '</section>\n' AS discussion FROM ranked GROUP BY post_id)"
    )


def post_html(p: str, disc: str) -> str:
    furl = "('" + S.SITE + "' || " + p + ".permalink)"
    title = S.html_escape(p + ".title")
    link = (
        "CASE WHEN NOT " + p + ".is_self AND " + p + ".url IS NOT NULL AND " + p + ".url <> '' AND " + p + ".url <> " + furl
        + " THEN '<dt>Links to</dt><dd><a href=\"' || " + S.html_attr(p + ".url") + " || '\">' || " + S.html_escape(p + ".url")
        + " || '</a></dd>\n' ELSE '' END"
    )
    body = (
        "CASE WHEN coalesce(" + p + ".selftext, '') <> '' THEN '<div class=\"text\">' || " + S.html_escape(p + ".selftext")
        + " || '</div>\n' ELSE '<p class=\"empty\">No text: this post links elsewhere.</p>\n' END"
    )
    return (
        "('<!doctype html>\n<html lang=\"en\">\n<head><meta charset=\"utf-8\"><title>' || " + title
        + " || '</title></head>\n<body>\n<main class=\"thread\" id=\"post-' || " + S.html_attr(p + ".id")
        + " || '\" data-source=\"' || " + S.html_attr(p + ".subreddit") + " || '\">\n<h1>' || " + title
        + " || '</h1>\n<dl class=\"facts\">\n<dt>Source</dt><dd>r/' || " + S.html_escape(p + ".subreddit")
        + " || '</dd>\n<dt>Posted by</dt><dd>u/' || " + S.html_escape(p + ".author")
        + " || '</dd>\n<dt>Posted</dt><dd>' || " + S.dual_time(p + ".created_utc")
        + " || '</dd>\n<dt>Thread</dt><dd><a href=\"' || " + S.html_attr(furl) + " || '\">' || " + S.html_escape(furl)
        + " || '</a></dd>\n' || " + link + " || '<dt>Engagement</dt><dd>' || coalesce(" + p + ".score, 0) || ' points, ' || coalesce("
        + p + ".num_comments, 0) || ' comments</dd>\n</dl>\n<section class=\"post\">\n' || " + body
        + " || '</section>\n' || coalesce(" + disc + ", '') || '</main>\n</body>\n</html>\n')"
    )


ORACLE["doc_html"] = (
    _with(*CONV, disc_cte("comments"))
    + "SELECT p.id, h.html, CAST(strlen(h.html) AS BIGINT) AS size_bytes FROM posts p, "
    "LATERAL (SELECT " + post_html("p", "(SELECT discussion FROM disc WHERE disc.post_id = p.id)") + " AS html) h"
)
ORACLE["doc_metadata"] = (
    _with(*CONV)
    + "SELECT '" + S.SITE + "' || permalink AS url, subreddit, author, title, CAST(coalesce(score, 0) AS INTEGER) AS score, "
    "CAST(coalesce(num_comments, 0) AS INTEGER) AS num_comments, "
    "CAST(round_even(upvote_ratio * 10000, 0) AS INTEGER) AS upvote_ratio_bp, "
    + S.iso_utc("created_utc") + " AS created_utc, " + S.iso_pacific("created_utc") + " AS created_pacific, "
    "strftime(" + S.pac("created_utc") + ", '%Y-%m-%d') AS date_pacific, id AS post_id, coalesce(is_self, false) AS is_self, "
    "CAST(coalesce(total_awards_received, 0) AS INTEGER) AS total_awards_received, "
    "CASE WHEN NOT is_self AND url IS NOT NULL AND url <> '' AND url <> '" + S.SITE + "' || permalink THEN url END AS external_url, "
    "link_flair_text AS flair, media_url FROM posts"
)

# ---------------------------------------------------------------------------
# Queue
# ---------------------------------------------------------------------------
BATCH = "batch AS (SELECT * FROM queue0 WHERE attempts < max_attempts AND scheduled_for <= " + S.RUN + ")"
ORACLE["top_queue_batch"] = (
    _with(S.event_queue(), BATCH)
    + "SELECT post_id, action, priority, created_at FROM batch ORDER BY priority DESC, created_at ASC, post_id ASC, action ASC LIMIT 50"
)
ORACLE["mut_success"] = (
    _with(S.event_queue(), BATCH)
    + "SELECT post_id, action FROM queue0 q WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.post_id = q.post_id AND b.action = q.action)"
)
ORACLE["mut_backoff"] = (
    _with(S.event_queue())
    + ", f AS (SELECT *, attempts < max_attempts AND scheduled_for <= " + S.RUN + " AS hit FROM queue0) "
    "SELECT post_id, subreddit, action, priority, CAST(CASE WHEN hit THEN attempts + 1 ELSE attempts END AS INTEGER) AS attempts, "
    "max_attempts, CASE WHEN hit THEN 'HTTP 503' ELSE last_error END AS last_error, created_at, "
    "CASE WHEN hit THEN " + S.RUN + " + to_minutes(CAST(5 * pow(2, attempts) AS BIGINT)) ELSE scheduled_for END AS scheduled_for FROM f"
)
ORACLE["mut_enqueue"] = (
    _with(S.event_queue())
    + ", req AS (SELECT 'e' || user_id AS post_id, min('src' || (user_id % 5)) AS n_subreddit, 'update' AS action, "
    "CAST(max(event_id % 4) AS INTEGER) AS n_priority FROM events GROUP BY 1, 3) "
    "SELECT coalesce(q.post_id, r.post_id) AS post_id, coalesce(q.subreddit, r.n_subreddit) AS subreddit, "
    "coalesce(q.action, r.action) AS action, "
    "CAST(CASE WHEN q.post_id IS NULL THEN r.n_priority WHEN r.post_id IS NOT NULL THEN greatest(q.priority, r.n_priority) "
    "ELSE q.priority END AS INTEGER) AS priority, CAST(coalesce(q.attempts, 0) AS INTEGER) AS attempts, "
    "CAST(coalesce(q.max_attempts, 5) AS INTEGER) AS max_attempts, q.last_error, "
    "coalesce(q.created_at, " + S.RUN + ") AS created_at, coalesce(q.scheduled_for, " + S.RUN + ") AS scheduled_for "
    "FROM queue0 q FULL OUTER JOIN req r ON q.post_id = r.post_id AND q.action = r.action"
)

# ---------------------------------------------------------------------------
# State mutations
# ---------------------------------------------------------------------------
_TR = ["post_id", "subreddit", "created_utc", "first_scraped", "last_updated", "update_count", "status", "contextual_doc_id", "content_hash"]


def _merge_sql(old: str, new: str, key: str, cols: list[str], take_new: set[str], coalesce_new: set[str] = frozenset()) -> str:
    out = []
    for c in cols:
        if c == key:
            out.append("coalesce(o." + c + ", n." + c + ") AS " + c)
        elif c in coalesce_new:
            out.append("CASE WHEN n." + key + " IS NULL THEN o." + c + " ELSE coalesce(n." + c + ", o." + c + ") END AS " + c)
        elif c in take_new:
            out.append("CASE WHEN n." + key + " IS NULL THEN o." + c + " ELSE n." + c + " END AS " + c)
        else:
            out.append("CASE WHEN o." + key + " IS NULL THEN n." + c + " ELSE o." + c + " END AS " + c)
    return "SELECT " + ", ".join(out) + " FROM " + old + " o FULL OUTER JOIN " + new + " n ON o." + key + " = n." + key


ORACLE["mut_upsert_tracked"] = (
    _with(S.events_tracked())
    + ", delta AS (SELECT id AS post_id, 'changed' AS subreddit, created_utc, " + S.RUN + " AS first_scraped, " + S.RUN
    + " AS last_updated, 7 AS update_count, 'updating' AS status, CASE WHEN u % 9 <> 0 THEN 'new_' || id END AS contextual_doc_id, "
    "h AS content_hash FROM ev_ref WHERE u % 3 = 0 OR u % 5 = 0) "
    + _merge_sql("ev_tracked", "delta", "post_id", _TR, {"last_updated", "update_count", "status", "content_hash"}, {"contextual_doc_id"})
)
_PC = ["id", "title", "score", "num_comments", "upvote_ratio", "update_count", "scraped_at"]
ORACLE["mut_upsert_posts"] = (
    _with(S.events_tracked())
    + ", cached AS (SELECT id, title, score - (u % 2) AS score, num_comments, upvote_ratio, 0 AS update_count, "
    + S.RUN + " - INTERVAL 1 DAY AS scraped_at FROM ev_ref WHERE u % 3 <> 0), "
    "fresh AS (SELECT id, 'new title' AS title, score, num_comments, upvote_ratio, 3 AS update_count, " + S.RUN + " AS scraped_at "
    "FROM ev_ref WHERE u % 4 <> 1) "
    + _merge_sql("cached", "fresh", "id", _PC, {"score", "num_comments", "upvote_ratio", "update_count"})
)
ORACLE["mut_replace_comments"] = (
    _with(*CONV, S.normalize_comments("raw_comments", 2, "comments2"))
    + ", saved AS (SELECT id FROM posts WHERE CAST(substring(id, 2) AS BIGINT) % 3 = 0) "
    "SELECT post_id, id FROM comments WHERE post_id NOT IN (SELECT id FROM saved) "
    "UNION ALL SELECT post_id, id FROM comments2 WHERE post_id IN (SELECT id FROM saved)"
)
ORACLE["mut_delete_cascade"] = (
    _with(*CONV)
    + ", known AS (SELECT id FROM posts WHERE CAST(substring(id, 2) AS BIGINT) % 4 = 0), "
    "del AS (SELECT id FROM raw_posts WHERE author IS NULL OR coalesce(selftext, '') IN ('[deleted]', '[removed]')), "
    "left_ AS (SELECT id FROM known WHERE id NOT IN (SELECT id FROM del)) "
    "SELECT 'deleted' AS kind, id AS key, id IN (SELECT id FROM known) AS existed FROM del "
    "UNION ALL SELECT unnest(['tracked', 'post']), id, CAST(NULL AS BOOLEAN) FROM left_ "
    "UNION ALL SELECT 'comment', id, NULL FROM comments WHERE post_id IN (SELECT id FROM left_)"
)
ORACLE["mut_retention"] = (
    "WITH tr AS (SELECT 'o' || o_orderkey AS post_id, o_orderkey % 40 AS age FROM orders WHERE o_orderkey % 5 <> 0), "
    "expired AS (SELECT post_id FROM tr WHERE age > 30), rem AS (SELECT post_id FROM tr WHERE age <= 30) "
    "SELECT 'post' AS kind, 'o' || o_orderkey AS key, CAST(1 AS BIGINT) AS n FROM orders WHERE o_orderkey % 7 <> 0 "
    "AND ((SELECT count(*) FROM expired) = 0 OR 'o' || o_orderkey IN (SELECT post_id FROM rem)) "
    "UNION ALL SELECT 'tracked', post_id, CAST(1 AS BIGINT) FROM rem "
    "UNION ALL SELECT 'comments', 'o' || l_orderkey, count(*) FROM lineitem "
    "WHERE 'o' || l_orderkey NOT IN (SELECT post_id FROM expired) AND NOT ((SELECT count(*) FROM expired) > 0 "
    "AND 'o' || l_orderkey IN (SELECT 'o' || o_orderkey FROM orders WHERE o_orderkey % 7 <> 0) "
    "AND 'o' || l_orderkey NOT IN (SELECT post_id FROM rem)) GROUP BY 2"
)
ORACLE["mut_freeze"] = (
    _with(S.events_tracked())
    + "SELECT post_id, CASE WHEN status <> 'frozen' AND update_count >= 2 THEN 'frozen' ELSE status END AS status, "
    "CASE WHEN status <> 'frozen' AND update_count >= 2 THEN " + S.RUN + " ELSE last_updated END AS last_updated FROM ev_tracked"
)

# ---------------------------------------------------------------------------
# Lifecycle: classifier, delivery, outbox (documents snapshot pair)
# ---------------------------------------------------------------------------
DOCS = (
    S.doc_base(),
    S.doc_stored(S.RUN_MICROS),
    S.doc_observed(S.RUN_MICROS),
    S.normalize_posts("doc_obs", "doc_norm"),
    "doc_fresh AS (SELECT n.*, " + S.content_hash("n.title", "n.selftext", "CAST(NULL AS VARCHAR)") + " AS f_hash, "
    "(o.author IS NULL OR coalesce(o.selftext, '') IN ('[deleted]', '[removed]')) AS f_deleted "
    "FROM doc_norm n JOIN doc_obs o ON o.id = n.id)",
    "classified AS (SELECT t.*, f.f_hash, CASE "
    "WHEN " + S.pacific_date("t.last_updated") + " = " + S.pacific_date(S.RUN) + " THEN 'NOOP' "
    "WHEN t.update_count < 0 THEN 'SKIP_INCREMENT' WHEN f.id IS NULL THEN 'ENQUEUE_UPDATE' WHEN f.f_deleted THEN 'DELETE' "
    "WHEN coalesce(t.content_hash, '') <> f.f_hash THEN 'REINGEST' "
    "WHEN c.id IS NOT NULL AND (c.score IS DISTINCT FROM f.score OR c.num_comments IS DISTINCT FROM f.num_comments "
    "OR c.upvote_ratio IS DISTINCT FROM f.upvote_ratio) AND t.contextual_doc_id IS NOT NULL THEN 'SET_METADATA' "
    "ELSE 'SKIP_INCREMENT' END AS action FROM doc_tracked t LEFT JOIN doc_fresh f ON f.id = t.post_id "
    "LEFT JOIN doc_cached c ON c.id = t.post_id WHERE t.status <> 'frozen' AND t.update_count < 2)",
    "ops AS (SELECT *, CASE WHEN action = 'REINGEST' AND contextual_doc_id IS NULL THEN 'INGEST' WHEN action = 'REINGEST' THEN 'REINGEST' "
    "WHEN action = 'SET_METADATA' THEN 'SET_METADATA' WHEN action = 'DELETE' AND contextual_doc_id IS NOT NULL THEN 'DELETE' END AS op "
    "FROM classified)",
    "ops2 AS (SELECT *, CASE WHEN op = 'INGEST' THEN '" + S.DOC_ID_PREFIX + "' || post_id ELSE contextual_doc_id END AS doc_key "
    "FROM ops WHERE op IS NOT NULL)",
    "sinks AS (SELECT '" + S.DOC_ID_PREFIX + "d' || doc_id AS doc_key, doc_id % 7 <> 1 AS ok, "
    "CASE WHEN doc_id % 7 = 2 THEN 'idx-' || doc_id END AS returned_doc_id FROM documents WHERE doc_id % 7 IN (1, 2))",
    "delivered AS (SELECT o.*, coalesce(s.ok, true) AS ok, CASE WHEN coalesce(s.ok, true) THEN coalesce(s.returned_doc_id, "
    "CASE WHEN o.op = 'REINGEST' THEN '" + S.DOC_ID_PREFIX + "' || o.post_id ELSE o.doc_key END) END "
    "AS result_doc_id FROM ops2 o LEFT JOIN sinks s ON s.doc_key = o.doc_key)",
)
ORACLE["life_classify"] = _with(*DOCS) + "SELECT post_id, action FROM classified"
ORACLE["snk_delivery"] = _with(*DOCS) + "SELECT post_id, op, ok, result_doc_id FROM delivered"
ORACLE["snk_outbox"] = (
    _with(*DOCS)
    + ", rendered AS (SELECT o.post_id, o.op, o.doc_key, " + post_html("p", "CAST(NULL AS VARCHAR)") + " AS html "
    "FROM ops2 o JOIN doc_fresh p ON p.id = o.post_id WHERE o.op IN ('INGEST', 'REINGEST')) "
    "SELECT post_id, op, doc_key, CAST(strlen(html) AS BIGINT) AS size_bytes, md5(html) AS html_md5, true AS has_metadata FROM rendered "
    "UNION ALL SELECT post_id, op, doc_key, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), op = 'SET_METADATA' FROM ops2 "
    "WHERE op NOT IN ('INGEST', 'REINGEST')"
)

# ---------------------------------------------------------------------------
# Aggregations
# ---------------------------------------------------------------------------
ORACLE["agg_status"] = _with(S.events_tracked()) + "SELECT status, count(*) AS n FROM ev_tracked GROUP BY status"
ORACLE["agg_subreddit"] = "SELECT o_orderpriority AS subreddit, count(*) AS n FROM orders GROUP BY 1"
ORACLE["agg_db_totals"] = (
    _with(*CONV, S.event_queue())
    + ", known AS (SELECT id FROM posts WHERE CAST(substring(id, 2) AS BIGINT) % 4 = 0) "
    "SELECT (SELECT count(*) FROM known) AS total_tracked, "
    "(SELECT count(*) FROM comments WHERE post_id IN (SELECT id FROM known)) AS total_comments, "
    "(SELECT count(*) FROM queue0 WHERE attempts < max_attempts) AS queue_pending"
)
ORACLE["agg_dry_run"] = (
    _with(*EV, S.WINDOW_SQL, S.HOT_SQL, "both_ AS (SELECT * FROM win UNION ALL SELECT * FROM hot)", S.latest_cte("lat", "both_"))
    + "SELECT subreddit, count(*) AS posts FROM lat GROUP BY subreddit"
)
ORACLE["top_dry_run_sample"] = (
    _with(*EV, S.latest_cte("lat", "good"), S.normalize_posts("lat", "np"))
    + "SELECT id, subreddit, substring(title, 1, 60) AS title_preview, score, num_comments FROM np "
    "ORDER BY created_utc DESC, id LIMIT 5"
)
ORACLE["str_intake"] = (
    _with(*EV, S.WINDOW_SQL, S.HOT_SQL, "both_ AS (SELECT * FROM win UNION ALL SELECT * FROM hot)", S.latest_cte("lat", "both_"), S.normalize_posts("lat", "np"))
    + "SELECT * FROM np"
)


# ---------------------------------------------------------------------------
# Lifecycle phases
# ---------------------------------------------------------------------------
ORACLE["life_new"] = (
    _with(*CONV, S.fragments_cte("frags", "comments"), "good AS (SELECT * FROM raw_posts)", S.WINDOW_SQL, S.HOT_SQL,
          "both_ AS (SELECT * FROM win UNION ALL SELECT * FROM hot)", S.latest_cte("lat", "both_"), S.normalize_posts("lat", "intake_n"))
    + ", cand AS (SELECT n.id, " + S.content_hash("n.title", "n.selftext", "f.fragments") + " AS content_hash, "
    "CAST(substring(n.id, 2) AS BIGINT) % 9 <> 0 AS ok FROM intake_n n LEFT JOIN frags f ON f.post_id = n.id "
    "WHERE " + S.age_days("n.created_utc") + " <= 2.0 AND CAST(substring(n.id, 2) AS BIGINT) % 4 <> 0) "
    "SELECT id AS post_id, CASE WHEN ok THEN 'INGESTED' ELSE 'QUEUED' END AS action, "
    "CASE WHEN ok THEN '" + S.DOC_ID_PREFIX + "' || id END AS contextual_doc_id, CASE WHEN ok THEN content_hash END AS content_hash, "
    "CASE WHEN ok THEN CAST(-1 AS INTEGER) END AS update_count, CASE WHEN NOT ok THEN CAST(1 AS INTEGER) END AS priority FROM cand"
)
ORACLE["life_repair"] = (
    _with(S.events_tracked())
    + ", cand AS (SELECT t.post_id, r.deleted, r.h, t.u FROM ev_tracked t JOIN ev_ref r ON r.id = t.post_id "
    "WHERE (t.content_hash IS NULL OR t.content_hash = '') AND t.status <> 'frozen'), "
    "fixed AS (SELECT post_id, h FROM cand WHERE NOT deleted AND u % 5 <> 1) "
    "SELECT t.post_id, t.update_count, t.status, "
    "CASE WHEN f.post_id IS NOT NULL THEN '" + S.DOC_ID_PREFIX + "' || t.post_id ELSE t.contextual_doc_id END AS contextual_doc_id, "
    "CASE WHEN f.post_id IS NOT NULL THEN f.h ELSE t.content_hash END AS content_hash, "
    "CASE WHEN f.post_id IS NOT NULL THEN " + S.RUN + " ELSE t.last_updated END AS last_updated "
    "FROM ev_tracked t LEFT JOIN fixed f ON f.post_id = t.post_id "
    "WHERE t.post_id NOT IN (SELECT post_id FROM cand WHERE deleted)"
)
ORACLE["life_reingest"] = (
    _with(*DOCS)
    + ", dl AS (SELECT c.*, coalesce(d.ok, true) AS ok, d.result_doc_id FROM classified c LEFT JOIN delivered d ON d.post_id = c.post_id), "
    "newt AS (SELECT post_id, "
    "CASE WHEN action IN ('SKIP_INCREMENT', 'SET_METADATA') OR (action = 'REINGEST' AND ok) THEN update_count + 1 ELSE update_count END "
    "AS update_count, CASE WHEN action = 'REINGEST' AND ok THEN 'updating' ELSE status END AS status, "
    "CASE WHEN action = 'REINGEST' AND ok THEN coalesce(result_doc_id, contextual_doc_id) ELSE contextual_doc_id END AS contextual_doc_id, "
    "CASE WHEN action = 'REINGEST' AND ok THEN f_hash ELSE content_hash END AS content_hash, "
    "CASE WHEN action IN ('SKIP_INCREMENT', 'SET_METADATA') OR (action = 'REINGEST' AND ok) THEN " + S.RUN + " ELSE last_updated END "
    "AS last_updated FROM dl WHERE action <> 'DELETE'), "
    "q AS (SELECT post_id, 'update' AS queued, 0 AS priority FROM dl WHERE action = 'ENQUEUE_UPDATE' OR (action = 'REINGEST' AND NOT ok)) "
    "SELECT coalesce(t.post_id, q.post_id) AS post_id, t.update_count, t.status, t.contextual_doc_id, t.content_hash, t.last_updated, "
    "q.queued, q.priority FROM newt t FULL OUTER JOIN q ON q.post_id = t.post_id"
)

_INTAKE_NEW = (
    ", cand2 AS (SELECT n.id, n.subreddit, CAST(substring(n.id, 2) AS BIGINT) % 4 <> 0 AS untracked, "
    + S.age_days("n.created_utc") + " <= 2.0 AS in_win, CAST(substring(n.id, 2) AS BIGINT) % 9 <> 0 AS ok FROM intake_n n) "
)
ORACLE["agg_scraped_new"] = (
    _with(*CONV, "good AS (SELECT * FROM raw_posts)", S.WINDOW_SQL, S.HOT_SQL,
          "both_ AS (SELECT * FROM win UNION ALL SELECT * FROM hot)", S.latest_cte("lat", "both_"), S.normalize_posts("lat", "intake_n"))
    + _INTAKE_NEW
    + "SELECT subreddit, count(*) AS scraped, count_if(untracked AND in_win AND ok) AS new FROM cand2 GROUP BY subreddit"
)
_COUNTER_EXPRS = {
    "posts_scraped": "false", "new_posts": "false",
    "updated_posts": "(action = 'SET_METADATA' AND ok) OR (action = 'REINGEST' AND ok)", "frozen_posts": "false",
    "posts_deleted": "action = 'DELETE'", "documents_ingested": "false", "documents_reingested": "action = 'REINGEST' AND ok",
    "skipped_unchanged": "action = 'SKIP_INCREMENT' OR (action = 'SET_METADATA' AND NOT ok)",
    "sync_errors": "action = 'REINGEST' AND NOT ok", "queued_for_retry": "action = 'ENQUEUE_UPDATE' OR (action = 'REINGEST' AND NOT ok)",
}
ORACLE["agg_run_counters"] = (
    _with(*DOCS)
    + ", dl AS (SELECT c.*, coalesce(d.ok, true) AS ok FROM classified c LEFT JOIN delivered d ON d.post_id = c.post_id) "
    "SELECT " + S.RUN + " AS started_at, " + S.lit_ts(S.RUN_MICROS + 90_000_000) + " AS completed_at, CAST(90.0 AS DOUBLE) AS duration_seconds, "
    + ", ".join("CAST(count_if(" + e + ") AS BIGINT) AS " + c for c, e in _COUNTER_EXPRS.items())
    + " FROM dl"
)
ORACLE["snk_apply_index"] = (
    _with(*DOCS)
    + ", idx AS (SELECT contextual_doc_id AS doc_id, post_id, CAST(2 AS BIGINT) AS size_bytes FROM doc_tracked WHERE contextual_doc_id IS NOT NULL), "
    "rendered AS (SELECT o.post_id, o.op, o.doc_key, CAST(strlen(" + post_html("p", "CAST(NULL AS VARCHAR)") + ") AS BIGINT) AS size_bytes "
    "FROM ops2 o JOIN doc_fresh p ON p.id = o.post_id WHERE o.op IN ('INGEST', 'REINGEST') "
    "UNION ALL SELECT post_id, op, doc_key, CAST(NULL AS BIGINT) FROM ops2 WHERE op NOT IN ('INGEST', 'REINGEST')), "
    "okbox AS (SELECT r.*, d.result_doc_id FROM rendered r JOIN delivered d ON d.doc_key = r.doc_key AND d.op = r.op WHERE d.ok), "
    "made AS (SELECT result_doc_id AS doc_id, post_id, size_bytes FROM okbox WHERE op IN ('INGEST', 'REINGEST')) "
    "SELECT doc_id, post_id, size_bytes FROM idx WHERE doc_id NOT IN (SELECT doc_key FROM okbox WHERE op <> 'SET_METADATA') "
    "AND doc_id NOT IN (SELECT doc_id FROM made) UNION ALL SELECT doc_id, post_id, size_bytes FROM made"
)

# Day 1 applies the delivered operations to the index of all stored documents; a failed DELETE leaves its document there, owed,
# and day 2 removes it.  Day 2 also re-ingests the posts that day 1 only skipped (rule 7); the index moves those of doc_id % 7 = 2 to another id.
ORACLE["life_two_days"] = (
    _with(*DOCS)
    + ", idx AS (SELECT contextual_doc_id AS doc_id, post_id, CAST(2 AS BIGINT) AS size_bytes, md5('v0') AS html_md5 FROM doc_tracked WHERE contextual_doc_id IS NOT NULL), "
    "html AS (SELECT o.post_id, o.doc_key, o.op, " + post_html("p", "CAST(NULL AS VARCHAR)") + " AS html "
    "FROM ops2 o JOIN doc_fresh p ON p.id = o.post_id WHERE o.op IN ('INGEST', 'REINGEST')), "
    "made AS (SELECT d.result_doc_id AS doc_id, h.post_id, CAST(strlen(h.html) AS BIGINT) AS size_bytes, md5(h.html) AS html_md5 "
    "FROM html h JOIN delivered d ON d.doc_key = h.doc_key AND d.op = h.op WHERE d.ok), "
    "gone AS (SELECT doc_key FROM delivered WHERE ok AND op IN ('DELETE', 'REINGEST') UNION SELECT doc_id FROM made), "
    "one AS (SELECT * FROM idx WHERE doc_id NOT IN (SELECT doc_key FROM gone) UNION ALL SELECT * FROM made) "
    "SELECT one.*, d.doc_key IS NOT NULL AS owed, d.doc_key IS NULL AND NOT (k.rule = 7 AND k.doc_id % 7 = 2) AS there_later, CAST(0 AS BIGINT) AS owed_later FROM one "
    "JOIN doc_base k ON k.post_id = one.post_id LEFT JOIN (SELECT doc_key FROM delivered WHERE op = 'DELETE' AND NOT ok) d ON d.doc_key = one.doc_id"
)

# Deliveries over documents: operations by doc_id % 4, reports by doc_id % 5 (1 failed, 2 another id, 3 a failure and then another id).
SINK_CASE = (
    "sops AS (SELECT doc_id % 4 AS k, 'd' || doc_id AS post_id, doc_id, CASE doc_id % 4 WHEN 0 THEN 'INGEST' WHEN 1 THEN 'REINGEST' "
    "WHEN 2 THEN 'SET_METADATA' ELSE 'DELETE' END AS op, CASE WHEN doc_id % 4 = 0 THEN '" + S.DOC_ID_PREFIX + "d' ELSE 'idx-' END || doc_id AS doc_key "
    "FROM documents)",
    "sdel AS (SELECT *, doc_id % 5 <> 1 AS ok, CASE WHEN doc_id % 5 = 1 THEN NULL WHEN doc_id % 5 IN (2, 3) THEN 'new-' || doc_id "
    "WHEN op = 'REINGEST' THEN '" + S.DOC_ID_PREFIX + "' || post_id ELSE doc_key END AS result_doc_id FROM sops)",
    "sindex AS (SELECT 'idx-' || doc_id AS doc_id, post_id FROM sops WHERE op <> 'INGEST')",
    "snext AS (SELECT doc_id, post_id FROM sindex WHERE doc_id NOT IN (SELECT doc_key FROM sdel WHERE ok AND op <> 'SET_METADATA') "
    "UNION ALL SELECT result_doc_id, post_id FROM sdel WHERE ok AND op IN ('INGEST', 'REINGEST'))",
)
ORACLE["snk_duplicate_results"] = _with(*SINK_CASE) + "SELECT post_id, op, ok, result_doc_id FROM sdel"
ORACLE["snk_ids_agree"] = (
    _with(*SINK_CASE)
    + "SELECT d.post_id, CASE WHEN d.ok AND op IN ('INGEST', 'REINGEST') THEN result_doc_id WHEN op <> 'INGEST' THEN 'idx-' || d.doc_id END AS tracked_id, "
    "n.doc_id AS index_id FROM sdel d LEFT JOIN snext n ON n.post_id = d.post_id WHERE op <> 'DELETE'"
)
ORACLE["snk_redelivery"] = (
    _with(*SINK_CASE)
    + "SELECT post_id, doc_id, post_id IN (SELECT post_id FROM sdel WHERE op = 'DELETE' AND NOT ok) AS removed_later FROM snext"
)

_CHANGED = "action IN ('SKIP_INCREMENT', 'SET_METADATA') OR (action = 'REINGEST' AND ok)"
ORACLE["life_freeze"] = (
    _with(S.events_tracked())
    + ", cls AS (SELECT t.*, r.h AS f_hash, CASE WHEN " + S.pacific_date("t.last_updated") + " = " + S.pacific_date(S.RUN)
    + " THEN 'NOOP' WHEN t.update_count < 0 THEN 'SKIP_INCREMENT' WHEN r.id IS NULL THEN 'ENQUEUE_UPDATE' WHEN r.deleted THEN 'DELETE' "
    "WHEN coalesce(t.content_hash, '') <> r.h THEN 'REINGEST' "
    "WHEN c.id IS NOT NULL AND (c.score IS DISTINCT FROM r.score OR c.num_comments IS DISTINCT FROM r.num_comments "
    "OR c.upvote_ratio IS DISTINCT FROM r.upvote_ratio) AND t.contextual_doc_id IS NOT NULL THEN 'SET_METADATA' ELSE 'SKIP_INCREMENT' END "
    "AS action FROM ev_tracked t LEFT JOIN ev_ref r ON r.id = t.post_id "
    "LEFT JOIN (SELECT id, score - (u % 2) AS score, num_comments, upvote_ratio FROM ev_ref WHERE u % 3 <> 0) c ON c.id = t.post_id "
    "WHERE t.status <> 'frozen' AND t.update_count < 2), "
    "dl AS (SELECT *, CASE WHEN action IN ('REINGEST', 'SET_METADATA') OR (action = 'DELETE' AND contextual_doc_id IS NOT NULL) "
    "THEN u % 5 <> 1 ELSE true END AS ok FROM cls), "
    "upd AS (SELECT post_id, CASE WHEN " + _CHANGED + " THEN update_count + 1 ELSE update_count END AS update_count, "
    "CASE WHEN action = 'REINGEST' AND ok THEN 'updating' ELSE status END AS status, "
    "CASE WHEN action = 'REINGEST' AND ok THEN '" + S.DOC_ID_PREFIX + "' || post_id ELSE contextual_doc_id END AS contextual_doc_id, "
    "CASE WHEN action = 'REINGEST' AND ok THEN f_hash ELSE content_hash END AS content_hash, "
    "CASE WHEN " + _CHANGED + " THEN " + S.RUN + " ELSE last_updated END AS last_updated, action FROM dl), "
    "allt AS (SELECT post_id, update_count, status, contextual_doc_id, content_hash, last_updated FROM upd WHERE action <> 'DELETE' "
    "UNION ALL SELECT post_id, update_count, status, contextual_doc_id, content_hash, last_updated FROM ev_tracked "
    "WHERE NOT (status <> 'frozen' AND update_count < 2)) "
    "SELECT post_id, update_count, CASE WHEN status <> 'frozen' AND update_count >= 2 THEN 'frozen' ELSE status END AS status, "
    "contextual_doc_id, content_hash, CASE WHEN status <> 'frozen' AND update_count >= 2 THEN " + S.RUN + " ELSE last_updated END "
    "AS last_updated FROM allt"
)

ORACLE["life_queue"] = (
    _with(S.events_tracked(), S.event_queue(), BATCH)
    + ", cachedp AS (SELECT id, score - (u % 2) AS score, num_comments, upvote_ratio FROM ev_ref WHERE u % 3 <> 0), "
    "ing AS (SELECT b.post_id, c.id IS NOT NULL AS has_post, CAST(substring(b.post_id, 2) AS BIGINT) % 5 <> 1 AS ok "
    "FROM batch b LEFT JOIN cachedp c ON c.id = b.post_id WHERE b.action = 'ingest'), "
    "t1 AS (SELECT t.post_id, t.update_count, t.status, t.last_updated, t.content_hash, "
    "CASE WHEN i.post_id IS NOT NULL THEN '" + S.DOC_ID_PREFIX + "' || t.post_id ELSE t.contextual_doc_id END AS contextual_doc_id, t.u "
    "FROM ev_tracked t LEFT JOIN (SELECT post_id FROM ing WHERE has_post AND ok) i ON i.post_id = t.post_id "
    "UNION ALL SELECT post_id, -1, 'new', " + S.RUN + ", CAST(NULL AS VARCHAR), '" + S.DOC_ID_PREFIX + "' || post_id, "
    "CAST(substring(post_id, 2) AS BIGINT) FROM ing WHERE has_post AND ok AND post_id NOT IN (SELECT post_id FROM ev_tracked)), "
    "cls AS (SELECT t.post_id, t.u, CASE WHEN " + S.pacific_date("t.last_updated") + " = " + S.pacific_date(S.RUN)
    + " THEN 'NOOP' WHEN t.update_count < 0 THEN 'SKIP_INCREMENT' WHEN r.id IS NULL THEN 'ENQUEUE_UPDATE' WHEN r.deleted THEN 'DELETE' "
    "WHEN coalesce(t.content_hash, '') <> r.h THEN 'REINGEST' "
    "WHEN c.id IS NOT NULL AND (c.score IS DISTINCT FROM r.score OR c.num_comments IS DISTINCT FROM r.num_comments "
    "OR c.upvote_ratio IS DISTINCT FROM r.upvote_ratio) AND t.contextual_doc_id IS NOT NULL THEN 'SET_METADATA' ELSE 'SKIP_INCREMENT' END "
    "AS action FROM t1 t JOIN (SELECT post_id FROM batch WHERE action = 'update') b ON b.post_id = t.post_id "
    "LEFT JOIN ev_ref r ON r.id = t.post_id LEFT JOIN cachedp c ON c.id = t.post_id WHERE t.status <> 'frozen'), "
    "fails AS (SELECT post_id, 'ingest' AS action, 'HTTP 503' AS error FROM ing WHERE has_post AND NOT ok "
    "UNION ALL SELECT post_id, 'update', CASE WHEN action = 'ENQUEUE_UPDATE' THEN 'refresh failed' ELSE 'sync failed' END "
    "FROM cls WHERE action = 'ENQUEUE_UPDATE' OR (action = 'REINGEST' AND u % 5 = 1)) "
    "SELECT q.post_id, q.action, CAST(CASE WHEN f.post_id IS NOT NULL THEN q.attempts + 1 ELSE q.attempts END AS INTEGER) AS attempts, "
    "CASE WHEN f.post_id IS NOT NULL THEN f.error ELSE q.last_error END AS last_error, "
    "CASE WHEN f.post_id IS NOT NULL THEN " + S.RUN + " + to_minutes(CAST(5 * pow(2, q.attempts) AS BIGINT)) ELSE q.scheduled_for END "
    "AS scheduled_for FROM queue0 q LEFT JOIN fails f ON f.post_id = q.post_id AND f.action = q.action "
    "WHERE f.post_id IS NOT NULL OR NOT EXISTS (SELECT 1 FROM batch b WHERE b.post_id = q.post_id AND b.action = q.action)"
)
ORACLE["src_landing_json"] = (
    "SELECT (event_id % 89 <> 0 AND event_id % 97 <> 0) AS valid, count(*) AS n FROM events GROUP BY 1"
)

_H = S.content_hash
ORACLE["life_modes"] = (
    _with(*CONV, S.fragments_cte("frags", "comments"), "good AS (SELECT * FROM raw_posts)", S.WINDOW_SQL, S.HOT_SQL,
          "both_ AS (SELECT * FROM win UNION ALL SELECT * FROM hot)", S.latest_cte("lat", "both_"), S.normalize_posts("lat", "intake_n"))
    + ", ct AS (SELECT p.id AS post_id, " + _H("p.title", "p.selftext", "f.fragments") + " AS content_hash FROM posts p "
    "LEFT JOIN frags f ON f.post_id = p.id WHERE CAST(substring(p.id, 2) AS BIGINT) % 4 = 0), "
    "created AS (SELECT n.id AS post_id, " + _H("n.title", "n.selftext", "f.fragments") + " AS content_hash FROM intake_n n "
    "LEFT JOIN frags f ON f.post_id = n.id WHERE " + S.age_days("n.created_utc") + " <= 2.0 "
    "AND CAST(substring(n.id, 2) AS BIGINT) % 4 <> 0 AND CAST(substring(n.id, 2) AS BIGINT) % 9 <> 0) "
    "SELECT post_id, CAST(-1 AS INTEGER) AS update_count, 'new' AS status, '" + S.DOC_ID_PREFIX + "' || post_id AS contextual_doc_id, "
    "content_hash, " + S.RUN + " - INTERVAL 1 DAY AS last_updated, 'scrape' AS mode FROM ct "
    "UNION ALL SELECT post_id, CAST(-1 AS INTEGER), 'new', '" + S.DOC_ID_PREFIX + "' || post_id, content_hash, " + S.RUN + ", 'scrape' "
    "FROM created "
    "UNION ALL SELECT post_id, CAST(0 AS INTEGER), 'new', '" + S.DOC_ID_PREFIX + "' || post_id, content_hash, " + S.RUN + ", 'update' FROM ct "
    "UNION ALL SELECT post_id, CAST(-1 AS INTEGER), 'new', '" + S.DOC_ID_PREFIX + "' || post_id, content_hash, " + S.RUN
    + " - INTERVAL 1 DAY, 'queue' FROM ct"
)

_CONV_RUN = (
    _with(*CONV, S.fragments_cte("frags", "comments"), disc_cte("comments"), "good AS (SELECT * FROM raw_posts)", S.WINDOW_SQL, S.HOT_SQL,
          "both_ AS (SELECT * FROM win UNION ALL SELECT * FROM hot)", S.latest_cte("lat", "both_"), S.normalize_posts("lat", "intake_n"))
    + ", known AS (SELECT p.id, " + _H("p.title", "p.selftext", "f.fragments") + " AS content_hash FROM posts p LEFT JOIN frags f ON f.post_id = p.id "
    "WHERE CAST(substring(p.id, 2) AS BIGINT) % 4 = 0), "
    "cand AS (SELECT n.*, " + _H("n.title", "n.selftext", "f.fragments") + " AS content_hash, CAST(substring(n.id, 2) AS BIGINT) % 9 <> 0 AS ok "
    "FROM intake_n n LEFT JOIN frags f ON f.post_id = n.id WHERE " + S.age_days("n.created_utc") + " <= 2.0 AND CAST(substring(n.id, 2) AS BIGINT) % 4 <> 0) "
)
ORACLE["life_run_state"] = (
    _CONV_RUN
    + "SELECT 'tracked' AS kind, id AS key, CAST(0 AS BIGINT) AS n FROM known UNION ALL SELECT 'tracked', id, -1 FROM cand "
    "UNION ALL SELECT 'post', id, 0 FROM known UNION ALL SELECT 'post', id, 0 FROM cand "
    "UNION ALL SELECT 'comments', post_id, count(*) FROM comments WHERE post_id IN (SELECT id FROM known UNION SELECT id FROM cand) GROUP BY 2 "
    "UNION ALL SELECT 'counter', 'posts_scraped', count(*) FROM intake_n "
    "UNION ALL SELECT 'counter', unnest(['new_posts', 'documents_ingested', 'sync_errors', 'queued_for_retry']), "
    "unnest([count_if(ok), count(*), count_if(NOT ok), count_if(NOT ok)]) FROM cand "
    "UNION ALL SELECT 'counter', 'skipped_unchanged', count(*) FROM known "
    "UNION ALL SELECT 'counter', unnest(['updated_posts', 'frozen_posts', 'posts_deleted', 'documents_reingested']), 0"
)
ORACLE["life_documents"] = (
    _CONV_RUN
    + "SELECT '" + S.DOC_ID_PREFIX + "' || p.id AS doc_id, p.id AS post_id, CAST(strlen(h.html) AS BIGINT) AS size_bytes, md5(h.html) AS html_md5 "
    "FROM cand p, LATERAL (SELECT " + post_html("p", "(SELECT discussion FROM disc WHERE disc.post_id = p.id)") + " AS html) h"
)
ORACLE["life_queue_tracked"] = (
    _CONV_RUN
    + "SELECT id AS post_id, CAST(-1 AS INTEGER) AS update_count, 'new' AS status, '" + S.DOC_ID_PREFIX + "' || id AS contextual_doc_id, content_hash, "
    + S.RUN + " - INTERVAL 1 DAY AS last_updated FROM known "
    "UNION ALL SELECT id, -1, 'new', '" + S.DOC_ID_PREFIX + "' || id, content_hash, " + S.RUN + " FROM cand"
)

# Four daily runs (window and update window 5 days) over the conversation posts (an ingest that fails in the
# phase "new" is delivered by the second queue pass of the same run): a post ingested on
# day 1 is skipped on day 2, refreshed on day 3 (deleted if the source shows it deleted) and frozen
# on day 4; a post deleted on day 3 is ingested again on day 4 while still inside the window.
ORACLE["life_day_progression"] = (
    "WITH f AS (SELECT 't' || conv_id AS post_id, "
    "(conv_id % 17 = 0) OR (conv_id % 23 = 5 AND conv_id % 6 <> 2) AS del, "
    "(conv_id % 97) * 3600 + (conv_id % 7) * 60 - (conv_id % 4) * 0.25 AS age0 FROM conversations WHERE turn = 0), "
    "t AS (SELECT * FROM f WHERE age0 <= 432000) "
    "SELECT post_id, CAST(-1 AS INTEGER) AS update_count, 'new' AS status, 1 AS day FROM t "
    "UNION ALL SELECT post_id, CAST(0 AS INTEGER), 'new', 2 FROM t "
    "UNION ALL SELECT post_id, CAST(1 AS INTEGER), 'new', 3 FROM t WHERE NOT del "
    "UNION ALL SELECT post_id, CAST(2 AS INTEGER), 'frozen', 4 FROM t WHERE NOT del "
    "UNION ALL SELECT post_id, CAST(-1 AS INTEGER), 'new', 4 FROM t WHERE del AND age0 + 3 * 86400 <= 432000"
)

# Three landed daily snapshots synced by the stream end in the day-3 state of the progression above.
ORACLE["str_sync"] = (
    "WITH f AS (SELECT 't' || conv_id AS post_id, "
    "(conv_id % 17 = 0) OR (conv_id % 23 = 5 AND conv_id % 6 <> 2) AS del, "
    "(conv_id % 97) * 3600 + (conv_id % 7) * 60 - (conv_id % 4) * 0.25 AS age0 FROM conversations WHERE turn = 0) "
    "SELECT post_id, CAST(1 AS INTEGER) AS update_count, 'new' AS status, '" + S.DOC_ID_PREFIX + "' || post_id AS contextual_doc_id, true AS has_document "
    "FROM f WHERE age0 <= 432000 AND NOT del"
)


# ---------------------------------------------------------------------------
# A whole run over orders: one row per order, a CTE per step.  Documents keep
# the deterministic id; deliveries of attempt 1 fail for k % 19 = 7.
# ---------------------------------------------------------------------------
def _run_step(name: str, src: str, **cols: str) -> str:
    """``src`` with columns replaced or added."""
    return name + " AS (SELECT * REPLACE (" + ", ".join(v + " AS " + c for c, v in cols.items()) + ") FROM " + src + ")"


def _sent(src: str, name: str, cond: str, ok: str, c_found: str, c_diff: str) -> str:
    """Classify where ``cond`` holds (LIFE-2): a = action, ok = its delivery."""
    return (
        name + " AS (SELECT * EXCLUDE (a, ok), CASE WHEN NOT coalesce(is_on AND (" + cond + "), false) THEN NULL WHEN today THEN 'NOOP' WHEN cnt < 0 THEN 'SKIP' "
        "WHEN NOT found THEN 'WAIT' WHEN gone THEN 'DEL' WHEN coalesce(h, '') <> f_hash THEN 'RE' "
        "WHEN " + c_found + " AND " + c_diff + " AND hasdoc THEN 'META' ELSE 'SKIP' END AS a, " + ok + " AS ok FROM " + src + ")"
    )


_UPD = "(a = 'SKIP' OR a = 'META' OR (a = 'RE' AND ok))"


def _updated(src: str, name: str, **more: str) -> str:
    t = lambda c, x: "CASE WHEN coalesce(" + c + ", false) THEN " + x
    add = lambda col, c: col + " + CASE WHEN coalesce(" + c + ", false) THEN 1 ELSE 0 END"
    again = "(a = 'WAIT' OR (a = 'RE' AND NOT ok))"
    cols = dict(
        cnt=t(_UPD, "cnt + 1 ELSE cnt END"), today=t(_UPD, "true ELSE today END"), st=t("a = 'RE' AND ok", "'updating' ELSE st END"),
        h=t("a = 'RE' AND ok", "f_hash ELSE h END"), is_on="is_on AND coalesce(a <> 'DEL', true)",
        content=t("a = 'RE' AND ok", "true WHEN coalesce(a = 'DEL' AND hasdoc AND ok, false) THEN false ELSE content END"),
        hasdoc="hasdoc OR coalesce(a = 'RE' AND ok, false)",
        ev="CASE WHEN a = 'DEL' THEN 'del' WHEN a = 'META' AND ok THEN 'meta' WHEN a = 'RE' THEN 're' ELSE ev END",
        ev_cnt="CASE WHEN (a = 'META' AND ok) OR a = 'RE' THEN cnt + 1 ELSE ev_cnt END",
        u_there="u_there OR coalesce(" + again + ", false)", u_sched=t(again + " AND NOT u_there", "0 ELSE u_sched END"),
        u_prio=t(again + " AND NOT u_there", "0 ELSE u_prio END"), u_att=t(again + " AND NOT u_there", "0 ELSE u_att END"),
        n_updated=add("n_updated", "(a = 'META' AND ok) OR (a = 'RE' AND ok)"), n_re=add("n_re", "a = 'RE' AND ok"),
        n_skip=add("n_skip", "a = 'SKIP' OR (a = 'META' AND NOT ok)"), n_del=add("n_del", "a = 'DEL'"),
        n_err=add("n_err", "a = 'RE' AND NOT ok"), n_queued=add("n_queued", again),
    )
    return _run_step(name, src, **(cols | more))


def _queue_pass(src: str, n: str, ok: str) -> list[str]:
    due = "coalesce({0}_there AND {0}_att < 5 AND {0}_sched <= 0, false)"
    seen = "(CASE WHEN ev IS NULL THEN c_found ELSE ev <> 'del' END)"
    ing = "di AND " + seen
    made = "(" + ing + " AND " + ok + " AND NOT is_on)"
    back = lambda q, f, e: dict([
        (q + "_there", q + "_there AND (NOT d" + q + " OR coalesce(" + f + ", false))"), (q + "_att", "CASE WHEN d" + q + " AND coalesce(" + f + ", false) THEN " + q + "_att + 1 ELSE " + q + "_att END"),
        (q + "_err", "CASE WHEN d" + q + " AND coalesce(" + f + ", false) THEN " + e + " ELSE " + q + "_err END"),
        (q + "_sched", "CASE WHEN d" + q + " AND coalesce(" + f + ", false) THEN 5 * CAST(pow(2, " + q + "_att) AS BIGINT) ELSE " + q + "_sched END"),
    ])
    return [
        _run_step(n + "a", src, di=due.format("i"), du=due.format("u")),
        _run_step(
            n + "b", n + "a", n_ing="n_ing + CASE WHEN " + ing + " AND " + ok + " THEN 1 ELSE 0 END", content="content OR (" + ing + " AND " + ok + ")",
            hasdoc="hasdoc OR (" + ing + " AND " + ok + ")", is_on="is_on OR " + made, cnt="CASE WHEN " + made + " THEN -1 ELSE cnt END",
            st="CASE WHEN " + made + " THEN 'new' ELSE st END", today="today OR " + made, h="CASE WHEN " + made + " THEN f_hash ELSE h END",
            age="CASE WHEN " + made + " THEN 0 ELSE age END", **back("i", "(" + seen + " AND NOT " + ok + ")", "'HTTP 503'"),
        ),
        _sent(n + "b", n + "c", "du AND st <> 'frozen'", ok, seen, "(k % 3 = 0 AND ev IS NULL)"),
        _updated(n + "c", n + "d"),
        _run_step(n, n + "d", **back("u", "(a = 'WAIT' OR (a = 'RE' AND NOT ok))", "CASE WHEN a = 'WAIT' THEN 'refresh failed' ELSE 'sync failed' END")),
    ]


_OK1 = "(k % 19 <> 7)"
_MISSING = "(is_on AND coalesce(h, '') = '' AND st <> 'frozen')"
_NEW = "(in_win AND NOT is_on)"
FULL_RUN = (
    *LARGE_P, *LARGE_C, S.fragments_cte("frags", "comments"), disc_cte("comments"),
    "w0 AS (SELECT p.*, o_key AS k, " + S.content_hash("p.title", "p.selftext", "f.fragments") + " AS f_hash, o_key % 17 <> 3 AS found, "
    "p.author = '[deleted]' OR p.selftext IN ('[deleted]', '[removed]') AS gone FROM (SELECT *, CAST(substring(id, 2) AS BIGINT) AS o_key FROM posts) p "
    "LEFT JOIN frags f ON f.post_id = p.id)",
    "w1 AS (SELECT *, found AND epoch_us(created_utc) >= " + S.CUTOFF_S + " * 1000000 AS in_win, k % 5 <> 0 AS is_on, k % 5 <> 0 AS c_found, "
    "CAST(k % 4 - 1 AS INTEGER) AS cnt, CASE WHEN k % 4 = 3 THEN 'updating' WHEN k % 29 = 0 THEN 'frozen' ELSE 'new' END AS st, "
    "k % 11 = 0 AS today, k % 40 AS age, k % 5 <> 0 AND k % 13 <> 6 AS hasdoc, CASE WHEN k % 23 = 0 THEN '' WHEN k % 6 = 1 THEN 'stale' ELSE f_hash END AS h, "
    "k % 13 = 0 AND k % 2 = 0 AS i_there, k % 13 = 0 AND k % 2 = 1 AS u_there, CAST(k % 6 AS INTEGER) AS i_att, CAST(k % 6 AS INTEGER) AS u_att, "
    "CAST(k % 3 AS INTEGER) AS i_prio, CAST(k % 3 AS INTEGER) AS u_prio, (1 - k % 3) * 60 AS i_sched, (1 - k % 3) * 60 AS u_sched, "
    "CAST(NULL AS VARCHAR) AS i_err, CAST(NULL AS VARCHAR) AS u_err, CAST(NULL AS VARCHAR) AS ev, 0 AS ev_cnt, false AS content, CAST(NULL AS VARCHAR) AS a, false AS ok, "
    "false AS di, false AS du, 0 AS n_new, 0 AS n_updated, 0 AS n_frozen, 0 AS n_del, 0 AS n_ing, 0 AS n_re, 0 AS n_skip, 0 AS n_err, 0 AS n_queued FROM w0)",
    *_queue_pass("w1", "q1", _OK1),
    "r0 AS (SELECT * EXCLUDE (a, ok), CASE WHEN NOT " + _MISSING + " THEN NULL WHEN NOT found THEN 'FAIL' WHEN gone THEN 'DEL' ELSE 'RE' END AS a, " + _OK1 + " AS ok FROM q1)",
    _run_step(
        "r1", "r0", h="CASE WHEN a = 'RE' AND ok THEN f_hash ELSE h END", today="today OR coalesce(a = 'RE' AND ok, false)", is_on="is_on AND coalesce(a <> 'DEL', true)",
        content="CASE WHEN a = 'RE' AND ok THEN true WHEN a = 'DEL' AND hasdoc AND ok THEN false ELSE content END", hasdoc="hasdoc OR coalesce(a = 'RE' AND ok, false)",
        ev="CASE WHEN a = 'DEL' THEN 'del' WHEN a = 'RE' THEN 're' ELSE ev END", ev_cnt="CASE WHEN a = 'RE' THEN cnt ELSE ev_cnt END",
        n_re="n_re + CASE WHEN a = 'RE' AND ok THEN 1 ELSE 0 END", n_del="n_del + CASE WHEN a = 'DEL' THEN 1 ELSE 0 END",
    ),
    _run_step(
        "n1", "r1", is_on="is_on OR (" + _NEW + " AND " + _OK1 + ")", cnt="CASE WHEN " + _NEW + " AND " + _OK1 + " THEN -1 ELSE cnt END",
        st="CASE WHEN " + _NEW + " AND " + _OK1 + " THEN 'new' ELSE st END", today="today OR (" + _NEW + " AND " + _OK1 + ")",
        age="CASE WHEN " + _NEW + " AND " + _OK1 + " THEN 0 ELSE age END", h="CASE WHEN " + _NEW + " AND " + _OK1 + " THEN f_hash ELSE h END",
        hasdoc="CASE WHEN " + _NEW + " THEN " + _OK1 + " OR hasdoc ELSE hasdoc END", content="content OR (" + _NEW + " AND " + _OK1 + ")",
        ev="CASE WHEN " + _NEW + " THEN 'new' ELSE ev END", ev_cnt="CASE WHEN " + _NEW + " THEN 0 ELSE ev_cnt END",
        i_there="i_there OR (" + _NEW + " AND NOT " + _OK1 + ")",
        i_att="CASE WHEN NOT i_there AND " + _NEW + " AND NOT " + _OK1 + " THEN 0 ELSE i_att END",
        i_prio="CASE WHEN " + _NEW + " AND NOT " + _OK1 + " THEN CASE WHEN i_there THEN greatest(i_prio, 1) ELSE 1 END ELSE i_prio END",
        i_sched="CASE WHEN NOT i_there AND " + _NEW + " AND NOT " + _OK1 + " THEN 0 ELSE i_sched END",
        n_new="n_new + CASE WHEN " + _NEW + " AND " + _OK1 + " THEN 1 ELSE 0 END", n_ing="n_ing + CASE WHEN " + _NEW + " AND " + _OK1 + " THEN 1 ELSE 0 END",
        n_err="n_err + CASE WHEN " + _NEW + " AND NOT " + _OK1 + " THEN 1 ELSE 0 END", n_queued="n_queued + CASE WHEN " + _NEW + " AND NOT " + _OK1 + " THEN 1 ELSE 0 END",
    ),
    _sent("n1", "u0", "st <> 'frozen' AND cnt < 2", _OK1, "c_found", "(k % 3 = 0)"),
    _updated("u0", "u1"),
    _run_step("z1", "u1", st="CASE WHEN is_on AND cnt >= 2 THEN 'frozen' ELSE st END", today="today OR (is_on AND st <> 'frozen' AND cnt >= 2)",
              n_frozen="n_frozen + CASE WHEN is_on AND st <> 'frozen' AND cnt >= 2 THEN 1 ELSE 0 END"),
    *_queue_pass("z1", "q2", "true"),
    "fin AS (SELECT *, is_on AND age > 30 AS expired, CASE WHEN ev IS NULL THEN c_found ELSE ev <> 'del' END AS cached FROM q2)",
)
ORACLE["life_full_run"] = (
    _with(*FULL_RUN)
    + "SELECT 'tracked' AS kind, id AS key, CAST(cnt AS BIGINT) AS n, concat_ws('|', st, CASE WHEN hasdoc THEN '" + S.DOC_ID_PREFIX + "' || id ELSE '-' END, h, "
    "CASE WHEN today THEN '0' ELSE '24' END) AS value FROM fin WHERE is_on AND NOT expired "
    "UNION ALL SELECT 'post', id, CASE WHEN ev IS NULL THEN score - CAST(k % 3 = 0 AS INTEGER) ELSE score END, CAST(CASE WHEN ev IS NULL THEN 0 ELSE ev_cnt END AS VARCHAR) "
    "FROM fin WHERE cached AND (NOT (SELECT bool_or(expired) FROM fin) OR (is_on AND NOT expired)) "
    "UNION ALL SELECT 'comments', c.post_id, count(*), NULL FROM comments c JOIN fin ON fin.id = c.post_id WHERE cached AND NOT expired "
    "AND (is_on OR NOT (SELECT bool_or(expired) FROM fin)) GROUP BY 2 "
    "UNION ALL SELECT 'queue', id, i_att, concat_ws('|', 'ingest', i_prio, coalesce(i_err, '-'), i_sched) FROM fin WHERE i_there "
    "UNION ALL SELECT 'queue', id, u_att, concat_ws('|', 'update', u_prio, coalesce(u_err, '-'), u_sched) FROM fin WHERE u_there "
    "UNION ALL SELECT 'document', '" + S.DOC_ID_PREFIX + "' || p.id, CAST(strlen(x.html) AS BIGINT), md5(x.html) "
    "FROM (SELECT * REPLACE (CASE WHEN found THEN score ELSE score - CAST(k % 3 = 0 AS INTEGER) END AS score) FROM fin WHERE content) p, "
    "LATERAL (SELECT " + post_html("p", "(SELECT discussion FROM disc WHERE disc.post_id = p.id)") + " AS html) x "
    "UNION ALL SELECT 'counter', unnest(['posts_scraped', 'new_posts', 'updated_posts', 'frozen_posts', 'posts_deleted', 'documents_ingested', "
    "'documents_reingested', 'skipped_unchanged', 'sync_errors', 'queued_for_retry']), unnest([count_if(in_win), sum(n_new), sum(n_updated), sum(n_frozen), sum(n_del), "
    "sum(n_ing), sum(n_re), sum(n_skip), sum(n_err), sum(n_queued)]), NULL FROM fin"
)

ORACLE["life_queue_mode"] = ORACLE["life_queue"]
ORACLE["life_dry_run"] = (
    _CONV_RUN + "SELECT id AS post_id, 'WOULD_INGEST' AS action, (SELECT count(*) FROM intake_n) AS posts_scraped FROM cand"
)
ORACLE["src_quarantine"] = "SELECT 'missing url' AS reason, count(*) AS n FROM events WHERE event_id % 97 = 0 HAVING count(*) > 0"
ORACLE["doc_metadata_nulls"] = (
    _with(*CONV)
    + "SELECT id, CAST(CASE WHEN k % 3 = 0 THEN 0 ELSE score END AS VARCHAR) AS score, CAST(CASE WHEN k % 5 = 0 THEN 0 ELSE num_comments END AS VARCHAR) AS num_comments, "
    "CAST(CASE WHEN k % 7 = 0 THEN 0 ELSE total_awards_received END AS VARCHAR) AS total_awards_received, link_flair_text AS flair "
    "FROM (SELECT *, CAST(substring(id, 2) AS BIGINT) AS k FROM posts)"
)

ORACLE["src_refresh_pruned"] = (
    _with(S.events_tracked())
    + "SELECT l.id, l.observed_at, l.feed, l.feed_pos, l.url FROM ev_latest l JOIN ev_tracked t ON t.post_id = l.id WHERE t.status <> 'frozen' AND t.update_count < 2"
)
