"""Run parameters and fixed values.

Parameters are read once on the driver and passed down as a frozen dataclass;
transformations never read the environment.
"""

from __future__ import annotations

import calendar
import datetime as _dt
from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# Fixed values (must equal the behaviour being reproduced)
# ---------------------------------------------------------------------------
# Comment authors that are dropped (compared case-insensitively, after a
# missing author has become "[deleted]").
EXCLUDED_AUTHORS = (
    "AutoModerator",
    "automoderator",
    "ModeratorBot",
    "BotDefense",
    "RemindMeBot",
    "SaveVideo",
    "vredditdownloader",
    "[deleted]",
)
# A post url ending (case-sensitively) with one of these is also its media url.
MEDIA_SUFFIXES = (".jpg", ".jpeg", ".png", ".gif", ".mp4", ".webm")
# Placeholders for a missing author and for removed text.
DELETED_AUTHOR = "[deleted]"
REMOVED_TEXTS = ("[deleted]", "[removed]")
SITE = "https://reddit.com"
DOC_ID_PREFIX = "reddit_post_"
PACIFIC = "America/Los_Angeles"
# Fingerprint caps (code points).
HASH_BODY_CHARS = 500
HASH_SELFTEXT_CHARS = 2000

# Lifecycle values.
STATUS_NEW, STATUS_UPDATING, STATUS_FROZEN = "new", "updating", "frozen"
ACTION_INGEST, ACTION_UPDATE = "ingest", "update"


def epoch_micros(ts: str) -> int:
    """'YYYY-MM-DD HH:MM:SS' (UTC) -> microseconds since the epoch."""
    t = _dt.datetime.strptime(ts, "%Y-%m-%d %H:%M:%S")
    return calendar.timegm(t.timetuple()) * 1_000_000


@dataclass(frozen=True)
class SyncParams:
    """Everything a run depends on.  ``run_ts`` replaces the wall clock."""

    run_ts: str = "2024-01-31 16:00:00"  # UTC instant of the run (08:00 Pacific)
    subreddits: tuple[str, ...] = ()  # empty = every source present in the landing
    time_window_hours: int = 26
    update_window_days: float = 2
    max_comments: int = 100
    include_comments: bool = True
    hot_limit: int = 50
    refresh_at_count: int = 0
    freeze_at_count: int = 2
    always_reingest_on_refresh: bool = False
    cleanup_after_days: int = 30
    queue_limit: int | None = None  # due items a queue pass takes; None = all
    queue_max_attempts: int = 5
    queue_backoff_minutes: int = 5

    @property
    def window_hours(self) -> int:
        # "hours or default": 0 or None falls back to the configured default.
        return self.time_window_hours or 26

    @property
    def run_micros(self) -> int:
        return epoch_micros(self.run_ts)

    def at(self, run_ts: str) -> "SyncParams":
        return replace(self, run_ts=run_ts)

    def with_(self, **kw) -> "SyncParams":
        return replace(self, **kw)
