"""Driver contract."""

import __spark_entry__ as E


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.columns == ["post_id", "subreddit", "n_comments", "content_hash"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
