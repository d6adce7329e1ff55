"""Q5-Q8 batch hand-made cases and ad-log line decoding."""

import datetime as dt

from pyspark.sql import functions as F

from clickflow.functions import floor_time, time_text
from clickflow.operators import ads as A
from clickflow.sources import adlog

from .helpers import ad_df, ad_row

T = dt.datetime(2024, 1, 2, 12, 0, 0, tzinfo=dt.timezone.utc)


def _clicks(userid, adid, n, start, eid0, step_s=1):
    return [ad_row(eid0 + i, start + dt.timedelta(seconds=i * step_s), userid, adid) for i in range(n)]


def test_threshold_inclusive(spark):
    rows = _clicks("u99", "1", 99, T, 0) + _clicks("u100", "1", 100, T, 1000) + _clicks("u101", "1", 101, T, 2000)
    got = sorted(r.userid for r in A.ad_blacklist(ad_df(spark, rows), 100).collect())
    assert got == ["u100", "u101"]


def test_two_ads_and_midnight_not_listed(spark):
    midnight = dt.datetime(2024, 1, 3, 0, 0, 0, tzinfo=dt.timezone.utc)
    rows = (_clicks("two", "1", 60, T, 0) + _clicks("two", "2", 60, T, 100)
            + _clicks("mid", "1", 60, midnight - dt.timedelta(seconds=60), 200)
            + _clicks("mid", "1", 60, midnight, 300))
    assert A.ad_blacklist(ad_df(spark, rows), 100).count() == 0


def test_blacklist_filter_admits_up_to_crossing(spark):
    rows = _clicks("u", "1", 5, T, 0) + _clicks("v", "1", 2, T, 10)
    log = ad_df(spark, rows)
    kept = sorted(r.event_id for r in A.ad_blacklist_filter(log, 3).collect())
    assert kept == [0, 1, 2, 10, 11]   # u listed at its 3rd click; v never


def test_top3_and_json(spark):
    rows = []
    eid = 0
    for adid, n in [("1", 2), ("2", 5), ("3", 5), ("4", 1)]:
        for _ in range(n):
            rows.append(ad_row(eid, T, "u", adid))
            eid += 1
    log = ad_df(spark, rows)
    top = A.ad_top3_by_area(log).orderBy("rank").collect()
    assert [(r.rank, r.adid, r.n) for r in top] == [(1, "2", 5), (2, "3", 5), (3, "1", 2)]
    js = A.ad_top3_json(log).collect()
    assert js[0].top_ads == '{"2":5,"3":5,"1":2}'


def test_bucket_edge(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 15, 11, 9, 999000, tzinfo=dt.timezone.utc),),
         (dt.datetime(2024, 1, 1, 15, 11, 10, tzinfo=dt.timezone.utc),)], "ts timestamp")
    got = [r[0] for r in df.select(time_text(floor_time(F.col("ts"), 10))).collect()]
    assert got == ["2024-01-01 15:11:00", "2024-01-01 15:11:10"]


def test_sliding_trend_windows(spark):
    rows = [ad_row(0, dt.datetime(2024, 1, 1, 15, 11, 5, tzinfo=dt.timezone.utc)),
            ad_row(1, dt.datetime(2024, 1, 1, 15, 11, 7, tzinfo=dt.timezone.utc))]
    out = A.ad_click_trend_sliding(ad_df(spark, rows)).orderBy("window_start").collect()
    assert [r.window_start for r in out] == [f"2024-01-01 15:{m}" for m in
                                             ("10:10", "10:20", "10:30", "10:40", "10:50", "11:00")]
    assert all(r.bucket == "2024-01-01 15:11:00" and r.n == 2 for r in out)


def test_decode_lines(spark):
    lines = spark.createDataFrame([
        (1, "1704067200000 AFRICA NATION_0 7 3"),
        (2, "1704067200000 AFRICA NATION_0 7"),        # four fields
        (3, "x1704067200000 AFRICA NATION_0 7 3"),     # non-numeric time
        (4, "1704067200000 AFRICA NATION_0 7 3 extra"),  # extra field ignored
        (5, "1704067200000 AFRICA NATION_0 7 "),       # trailing empty field dropped
        (6, None),
    ], "event_id long, line string")
    ok = {r.event_id: r for r in adlog.parsed_ad_log(lines).collect()}
    assert sorted(ok) == [1, 4]
    assert ok[1].date == "2024-01-01" and ok[1].adid == "3" and ok[1].ts_ms == 1704067200000
    rej = {r.event_id: r.reason for r in adlog.ad_log_rejects(lines).collect()}
    assert rej == {2: "missing_field", 3: "bad_timestamp", 5: "missing_field", 6: "missing_field"}


def test_crossings_above_group_limit_threshold(spark):
    """Thresholds above Spark's group-limit threshold take the skew-proof position path."""
    rows = _clicks("u", "1", 5, T, 0) + _clicks("v", "1", 2, T, 10) + _clicks("w", "2", 4, T, 20)
    log = ad_df(spark, rows)
    want = sorted(map(tuple, A.ad_blacklist_crossings(log, 3).collect()))
    old = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "2")
    try:
        got = sorted(map(tuple, A.ad_blacklist_crossings(log, 3).collect()))
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", old)
    assert got == want and [g[0] for g in got] == ["u", "w"]


def test_hot_user_crossing_matches_brute_force(spark):
    """One (day, ad, user) group with thousands of clicks spread over many partitions."""
    rows = _clicks("hot", "1", 3000, T, 0) + _clicks("cold", "2", 150, T, 10_000) + _clicks("few", "3", 20, T, 20_000)
    log = ad_df(spark, rows).repartition(16)
    got = {r.userid: r.cross_event_id for r in A.ad_blacklist_crossings(log, 100).collect()}
    want = {}
    for user in ("hot", "cold", "few"):
        mine = sorted((r[1], r[0]) for r in rows if r[6] == user)
        if len(mine) >= 100:
            want[user] = mine[99][1]
    assert got == want
    kept = A.ad_blacklist_filter(log, 100).where(F.col("userid") == "hot").count()
    assert kept == 100


def test_blacklist_filter_with_a_high_threshold(spark):
    """A threshold above Spark's group limit takes the same path and gives the same result as brute force."""
    rows = _clicks("hot", "1", 1300, T, 0) + _clicks("cold", "1", 30, T, 5000)
    got = {r.event_id for r in A.ad_blacklist_filter(ad_df(spark, rows), 1200).collect()}
    assert got == set(range(1200)) | set(range(5000, 5030))


def test_times_out_of_range_are_rejected(spark):
    lines = spark.createDataFrame([(1, "9999999999999999 A C 1 2"), (2, "-9999999999999999 A C 1 2"),
                                   (3, "-1 A C 1 2"), (4, "1704067210123 A C 1 2")], "event_id long, line string")
    assert {(r.event_id, r.reason) for r in adlog.ad_log_rejects(lines).collect()} == {(1, "bad_timestamp"), (2, "bad_timestamp")}
    assert {(r.event_id, r.date) for r in adlog.parsed_ad_log(lines).collect()} == {(3, "1969-12-31"), (4, "2024-01-01")}
