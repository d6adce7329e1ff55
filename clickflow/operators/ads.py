"""Batch forms of the ad-log analyses (Q5-Q8). The streaming forms in
:mod:`clickflow.streaming.ads` are checked against these."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import floor_time, time_text
from ..session import written

# Fixed defaults of the reference jobs.
BLACKLIST_THRESHOLD = 100
TOP_ADS = 3
TREND_WINDOW_SECONDS = 60
TREND_SLIDE_SECONDS = 10

USER_GRAIN = ("date", "adid", "userid")
CITY_GRAIN = ("date", "area", "city", "adid")


def ad_click_counts(log: DataFrame, grain=USER_GRAIN) -> DataFrame:
    """Click counts per ``grain`` (default ``(date, adid, userid)``); column ``n``."""
    return log.groupBy(*grain).agg(F.count(F.lit(1)).alias("n"))


def ad_click_counts_by_city(log: DataFrame) -> DataFrame:
    return ad_click_counts(log, CITY_GRAIN)


def ad_blacklist(log: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Users with at least ``threshold`` clicks on one ad in one day (distinct ``userid``).

    Filtering out listed users' later clicks never changes this set (those users are already
    listed), so it is a plain HAVING over the whole log."""
    return (ad_click_counts(log).where(F.col("n") >= int(threshold))
            .select("userid").distinct())


def candidate_clicks(log: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Clicks of the (day, ad, user) groups whose total reaches ``threshold``: only these can
    cross. The groups come from a partial hash aggregate and are few; the log is semi-joined to
    them (the planner picks the join by size)."""
    groups = (log.groupBy(*USER_GRAIN).agg(F.count(F.lit(1)).alias("_n"))
                 .where(F.col("_n") >= int(threshold)).select(*USER_GRAIN))
    return log.select(*USER_GRAIN, "ts", "event_id").join(groups, list(USER_GRAIN), "left_semi")


def ad_blacklist_crossings(log: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """(userid, cross_ts, cross_event_id): the event at which each listed user first reaches
    ``threshold`` clicks on one (day, ad).

    The candidate clicks are written once (two scans of the log: totals, clicks), and numbered
    by the skew-proof :func:`~clickflow.operators.sequence.with_position`, whatever the
    threshold."""
    from .sequence import with_position

    pos = with_position(written(candidate_clicks(log, threshold), "candidates"), list(USER_GRAIN),
                        "ts", "event_id", name="_rn")
    hit = pos.where(F.col("_rn") == int(threshold))
    # earliest crossing per user: one row per user survives a partial group limit (a min over
    # a struct would plan as a sort-based aggregate)
    first = Window.partitionBy("userid").orderBy("ts", "event_id")
    return (hit.withColumn("_f", F.row_number().over(first)).where(F.col("_f") == 1)
               .select("userid", F.col("ts").alias("cross_ts"), F.col("event_id").alias("cross_event_id")))


def ad_blacklist_filter(log: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Events admitted by the dynamic blacklist, decided per event: a user's events up to and
    including the one that lists them pass, later ones are dropped. (The reference decides per
    micro-batch, so it also admits the rest of the batch that crosses the threshold.)

    The crossings (one row per listed user) are written once and read back, so the planner
    knows their bytes: broadcast where they are small, else a shuffle join in which AQE splits a
    hot user. The log is scanned three times in all."""
    x = written(ad_blacklist_crossings(log, threshold), "crossings")
    j = log.join(x, "userid", "left")
    keep = (F.col("cross_ts").isNull()
            | (F.struct("ts", "event_id") <= F.struct(F.col("cross_ts").alias("ts"),
                                                      F.col("cross_event_id").alias("event_id"))))
    return j.where(keep).select(*log.columns)


def ad_area_counts(log: DataFrame) -> DataFrame:
    """(date, area, adid, n)."""
    return ad_click_counts(log, ("date", "area", "adid"))


def rank_top_ads(counts: DataFrame, k: int = TOP_ADS) -> DataFrame:
    """Top ``k`` ads per (date, area) from (date, area, adid, n); ties: smaller adid (text)."""
    w = Window.partitionBy("date", "area").orderBy(F.desc("n"), F.asc("adid"))
    return (counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= int(k))
                  .select("date", "area", F.col("rank").cast("bigint").alias("rank"), "adid", "n"))


def ad_top3_by_area(log: DataFrame, k: int = TOP_ADS) -> DataFrame:
    """(date, area, rank, adid, n): the ``k`` most clicked ads of each day and area."""
    return rank_top_ads(ad_area_counts(log), k)


def top_ads_json(ranked: DataFrame) -> DataFrame:
    """(date, area, top_ads): ranked rows folded into one compact JSON object per (date, area),
    ``{"adid": n, ...}`` in rank order. Each group holds at most ``k`` rows by construction."""
    entries = F.array_sort(F.collect_list(F.struct("rank", "adid", "n")))
    as_map = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["adid"], e["n"])))
    return ranked.groupBy("date", "area").agg(F.to_json(as_map).alias("top_ads"))


def ad_top3_json(log: DataFrame, k: int = TOP_ADS) -> DataFrame:
    return top_ads_json(ad_top3_by_area(log, k))


def ad_click_trend(log: DataFrame, span_seconds: int = TREND_WINDOW_SECONDS,
                   bucket_seconds: int = TREND_SLIDE_SECONDS) -> DataFrame:
    """(bucket, n): clicks per ``bucket_seconds`` bucket over the last ``span_seconds`` before
    the latest event. The latest event time is a scalar subquery, not a driver round trip."""
    latest = log.select(F.max("ts")).scalar()
    return ad_click_buckets(log.where(F.col("ts") > latest - F.make_interval(secs=F.lit(int(span_seconds)))),
                            bucket_seconds)


def ad_click_buckets(recent: DataFrame, bucket_seconds: int = TREND_SLIDE_SECONDS) -> DataFrame:
    """(bucket, n): clicks per bucket of a log that a reader has already bounded in time
    (``ad_log(..., last_seconds=...)``)."""
    b = floor_time(F.col("ts"), bucket_seconds)
    return (recent.groupBy(b.alias("_b")).agg(F.count(F.lit(1)).alias("n"))
                  .select(time_text("_b").alias("bucket"), "n"))


def ad_click_trend_sliding(log: DataFrame, window_seconds: int = TREND_WINDOW_SECONDS,
                           slide_seconds: int = TREND_SLIDE_SECONDS) -> DataFrame:
    """(window_start, bucket, n): for every sliding window (length ``window_seconds``, every
    ``slide_seconds``), clicks per ``slide_seconds`` bucket inside it.

    Events are first counted per bucket (partial aggregation), then each bucket row, not each
    event, is copied into the ``window_seconds / slide_seconds`` windows that contain it."""
    if window_seconds % slide_seconds:
        raise ValueError("window_seconds must be a multiple of slide_seconds")
    per = window_seconds // slide_seconds
    b = floor_time(F.col("ts"), slide_seconds)
    buckets = log.groupBy(b.alias("_b")).agg(F.count(F.lit(1)).alias("n"))
    starts = F.explode(F.sequence(F.lit(0), F.lit(per - 1))).alias("_i")
    return (buckets.select("_b", "n", starts)
                   .select(time_text(F.col("_b") - F.make_interval(secs=F.col("_i") * slide_seconds)).alias("window_start"),
                           time_text("_b").alias("bucket"), "n"))
