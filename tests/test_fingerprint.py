"""HASH-1: fixed digests for awkward texts, and the SQL oracle over the fixture."""

import json

import duckdb
from pyspark.sql import functions as F

from threadkeeper.functions import fingerprint
from threadkeeper.functions.fingerprint import fingerprint_posts, json_string

TRICKY = [
    ('Quote " and \\ backslash', "line\nbreak\r\ttab\b\f end\n"),
    ("ctrl \x01\x1f del \x7f", "accents éàü and emoji 😀🎉 and CJK 漢字"),
    ("", ""),
    ("<script>alert(1)</script>", None),
    ("x" * 70, "y" * 1999 + "é" + "z" * 10),
]


# Fingerprints of TRICKY with the comments below.
DIGESTS = ["71a3bfa9113d3f84", "cd8fc7c7f1b9b7fb", "e234566aab49ccff", "4a45fbf7b225fe0b", "b9bfcf5b7aa71b2f"]


def test_hash_of_tricky_text(spark):
    posts = spark.createDataFrame([(f"p{i}", t, s) for i, (t, s) in enumerate(TRICKY)], "post_id string, title string, selftext string")
    coms = [("p0", "c2", "body 2"), ("p0", "c1", "é" * 600), ("p1", "z", "😀" * 501), ("p1", "a", "\"q\"")]
    cdf = spark.createDataFrame(coms, "post_id string, id string, body string")
    got = {r.post_id: r.content_hash for r in fingerprint_posts(posts, cdf).collect()}
    assert got == {f"p{i}": d for i, d in enumerate(DIGESTS)}


def test_hash_ignores_metadata_and_text_past_caps(spark):
    base = "a" * 2000
    posts = spark.createDataFrame(
        [("p", "T", base + "tail one"), ("q", "T", base + "tail two"), ("r", "T", base[:-1] + "b")], "post_id string, title string, selftext string"
    )
    got = {r.post_id: r.content_hash for r in fingerprint_posts(posts, spark.createDataFrame([], "post_id string, id string, body string")).collect()}
    assert got["p"] == got["q"]  # past 2,000 code points: invisible
    assert got["p"] != got["r"]  # inside the cap: visible
    p2 = spark.createDataFrame([("p", "T", base + "tail one", 5), ("p2", "T", base + "tail one", 99)], "post_id string, title string, selftext string, score int")
    h = {r.post_id: r.content_hash for r in fingerprint_posts(p2, spark.createDataFrame([], "post_id string, id string, body string")).collect()}
    assert h["p"] == h["p2"]  # score is not part of the fingerprint


def test_flagship_matches_sql_on_fixture(spark, sf):
    from threadkeeper.catalog.oracle import ORACLE
    from threadkeeper.catalog.queries import hash_content

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    want = {r[0]: r[1] for r in con.sql(ORACLE["hash_content"]).select("post_id, content_hash").fetchall()}
    got = {r.post_id: r.content_hash for r in hash_content(spark, sf).collect()}
    assert got == want and got


def test_only_texts_that_need_it_are_escaped(spark):
    """The check takes every character for safe or not as Python's JSON does, wherever it stands."""
    some = [chr(i) for i in range(1, 0x300)] + ["\u2028", "\uffff", "😀"]
    texts = [t for c in some for t in (c, f"ab{c}", f"{c}ab", f"a{c}b")] + ["", "plain text", "a]b^c-d&&e[f"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", json_string("t").alias("j"), F.col("t").rlike(fingerprint._SAFE_ONLY).alias("safe"))
    rows = df.collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        want = None if r.t is None else json.dumps(r.t).replace("\x7f", "\\u007f")
        assert (r.j, r.safe) == (want, None if r.t is None else want == f'"{r.t}"')
