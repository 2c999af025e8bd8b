"""Run parameters (no Spark needed)."""

from threadkeeper.params import EXCLUDED_AUTHORS, SyncParams, epoch_micros


def test_defaults():
    p = SyncParams()
    assert (p.time_window_hours, p.max_comments, p.cleanup_after_days, p.update_window_days) == (26, 100, 30, 2)
    assert (p.refresh_at_count, p.freeze_at_count, p.always_reingest_on_refresh) == (0, 2, False)
    assert (p.queue_limit, p.queue_max_attempts, p.queue_backoff_minutes, p.hot_limit) == (None, 5, 5, 50)


def test_zero_hours_falls_back_to_default():
    assert SyncParams(time_window_hours=0).window_hours == 26
    assert SyncParams(time_window_hours=48).window_hours == 48


def test_run_time_is_explicit_and_utc():
    p = SyncParams().at("2024-02-01 16:00:00")
    assert p.run_micros - SyncParams().run_micros == 86_400_000_000
    assert epoch_micros("1970-01-01 00:00:00") == 0


def test_excluded_authors_cover_deleted_and_case_variants():
    lowered = {a.lower() for a in EXCLUDED_AUTHORS}
    assert "[deleted]" in lowered and "automoderator" in lowered and len(lowered) == 7
