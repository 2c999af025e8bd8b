"""Scalar functions against Python's own datetime / rounding / string rules."""

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from threadkeeper.functions import columns as C

PAC = ZoneInfo("America/Los_Angeles")


INSTANTS = [
    "2026-03-08 09:59:59",  # last PST second
    "2026-03-08 10:00:00",  # first PDT second
    "2025-11-02 08:30:00",  # PDT
    "2025-11-02 09:30:00",  # PST again
    "2026-01-25 10:30:00",
    "2024-01-31 06:00:00",  # Pacific day differs from UTC day
]


def _ts_df(spark, values):
    from threadkeeper.params import epoch_micros

    rows = [(i, epoch_micros(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "i int, m long").select("i", F.timestamp_micros("m").alias("ts"))


def test_dual_time_label_around_dst(spark):
    got = {r.i: r.l for r in _ts_df(spark, INSTANTS).select("i", C.dual_time_label("ts").alias("l")).collect()}
    assert [got[i] for i in range(len(INSTANTS))] == [
        "Mar 08, 2026 at 01:59 AM PST (2026-03-08 09:59 UTC)",
        "Mar 08, 2026 at 03:00 AM PDT (2026-03-08 10:00 UTC)",
        "Nov 02, 2025 at 01:30 AM PDT (2025-11-02 08:30 UTC)",
        "Nov 02, 2025 at 01:30 AM PST (2025-11-02 09:30 UTC)",
        "Jan 25, 2026 at 02:30 AM PST (2026-01-25 10:30 UTC)",
        "Jan 30, 2024 at 10:00 PM PST (2024-01-31 06:00 UTC)",
    ]


def test_iso_strings_and_pacific_date(spark):
    vals = INSTANTS + ["2024-05-01 12:00:00"]
    df = _ts_df(spark, vals).withColumn("ts", F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.when(F.col("i") == 6, F.lit(0.123456)).otherwise(F.lit(0.0))))
    rows = df.select("i", C.iso_utc("ts").alias("u"), C.iso_pacific("ts").alias("p"), C.pacific_date("ts").alias("d")).collect()
    for r in rows:
        t = dt.datetime.strptime(vals[r.i], "%Y-%m-%d %H:%M:%S").replace(tzinfo=dt.timezone.utc)
        if r.i == 6:
            t = t + dt.timedelta(microseconds=123456)
        assert r.u == t.isoformat()
        assert r.p == t.astimezone(PAC).isoformat()
        assert r.d == t.astimezone(PAC).date()


def test_ratio_basis_points_half_even(spark):
    ratios = [0.95, 0.00005, 0.00015, 0.00025, 0.5, 1.0]
    df = spark.createDataFrame([(r,) for r in ratios] + [(None,)], "r double")
    got = [x.bp for x in df.select(C.ratio_bp("r").alias("bp")).collect()]
    assert got == [int(round(r * 10000)) for r in ratios] + [None]


def test_html_escape_order_and_tags(spark):
    df = spark.createDataFrame([("<script>a & b</script>", True, True, 2), ("plain", False, False, 0)], "t string, s boolean, e boolean, d int")
    rows = df.select(C.html_escape("t").alias("h"), C.comment_tags("s", "e", "d").alias("g")).collect()
    assert rows[0].h == "&lt;script&gt;a &amp; b&lt;/script&gt;"
    assert rows[0].g == " [OP, edited, reply depth 2]"
    assert rows[1].g == ""


def test_media_url_permalinks_and_deleted(spark):
    urls = ["a.jpg", "a.JPG", "a.png?x=1", "b.webm", "", None, "x.gif\n"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r.m for r in df.select(C.media_url("u").alias("m")).collect()]
    exp = [u if u and any(u.endswith(s) for s in (".jpg", ".jpeg", ".png", ".gif", ".mp4", ".webm")) else None for u in urls]
    assert got == exp
    p = spark.createDataFrame([("t1_abc", "def")], "p string, i string").select(C.comment_permalink("p", "i").alias("x")).first().x
    assert p == "https://reddit.com/comments/abc/_/def"
    dd = spark.createDataFrame([(None, "x"), ("a", "[removed]"), ("a", None), ("a", "")], "a string, s string")
    assert [r.x for r in dd.select(C.is_deleted_raw("a", "s").alias("x")).collect()] == [True, True, False, False]


def test_age_days_inclusive_window(spark):
    from threadkeeper.params import SyncParams, epoch_micros

    p = SyncParams()
    run = p.run_micros
    df = spark.createDataFrame([(run - 2 * 86_400_000_000,), (run - 2 * 86_400_000_000 - 1,), (run - 12 * 3_600_000_000,)], "m long")
    rows = df.select((C.age_days(F.timestamp_micros("m"), run) <= 2.0).alias("w")).collect()
    assert [r.w for r in rows] == [True, False, True]
    assert epoch_micros("2024-01-31 16:00:00") == run
