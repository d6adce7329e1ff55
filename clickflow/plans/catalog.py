"""Registry of runnable queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the shipped tables (through the adapters) over their whole extent; the
parameters are the fixed test parameters of :mod:`clickflow.plans.params`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import session as S
from ..functions import (epoch_ms_to_string, epoch_text_to_string, floor_time, non_blank, split_ids, string_to_epoch_ms,
                         time_text)
from ..operators import ads as A
from ..operators import category as C
from ..operators import pageflow as PF
from ..sources import adapters as src
from ..sources import adlog
from ..sources.sinks import with_task_id
from . import params as P

Query = Callable[[SparkSession, str], DataFrame]


def _va(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    S.prepare(spark)
    return src.visit_actions(spark, sf_dir, **kw)


def _ad(spark: SparkSession, sf_dir: str) -> DataFrame:
    S.prepare(spark)
    return src.ad_log(spark, sf_dir)


def _visit_text(df: DataFrame) -> DataFrame:
    """visit actions with the action time as ``yyyy-MM-dd HH:mm:ss`` text, as the reference stores it."""
    return df.withColumn("action_time", time_text("action_time"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    S.prepare(spark)
    return src.ad_log_lines(spark, sf_dir, plant_errors=True)


def batch_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    q["visit_actions"] = lambda s, d: _visit_text(_va(s, d))
    q["visit_date_range"] = lambda s, d: _visit_text(_va(s, d, start_date=P.START_DATE, end_date=P.END_DATE))

    q["category_action_events"] = lambda s, d: C.category_action_events(_va(s, d))
    q["category_metric_counts"] = lambda s, d: C.category_metric_counts(_va(s, d))
    q["category_funnel_counts"] = lambda s, d: C.category_funnel_counts(_va(s, d))
    q["category_top10"] = lambda s, d: C.category_top10(_va(s, d), k=P.TOP_CATEGORIES)

    def top_clicks(s, d):
        va = _va(s, d)
        return C.top_category_clicks(va, C.category_top10(va, k=P.TOP_CATEGORIES))

    q["top_category_clicks"] = top_clicks
    q["category_session_clicks"] = lambda s, d: C.category_session_clicks(top_clicks(s, d))
    q["category_session_top10"] = lambda s, d: C.category_session_top10(_va(s, d), k=P.TOP_SESSIONS)

    q["session_page_paths"] = lambda s, d: PF.session_page_paths(_va(s, d))
    q["session_path_text"] = lambda s, d: PF.session_path_text(_va(s, d))
    q["session_page_hops"] = lambda s, d: PF.session_page_hops(_va(s, d))
    q["page_visit_counts"] = lambda s, d: PF.page_visit_counts(_va(s, d), P.TARGET_FLOW)
    q["page_hop_counts"] = lambda s, d: PF.page_hop_counts(_va(s, d), P.TARGET_FLOW)
    q["page_conversion_rate"] = lambda s, d: PF.page_conversion_rate(_va(s, d), P.TARGET_FLOW)
    q["page_dwell_intervals"] = lambda s, d: PF.page_dwell_intervals(_va(s, d))
    q["page_dwell_time"] = lambda s, d: PF.page_dwell_time(_va(s, d))

    q["ad_log_parse"] = lambda s, d: adlog.parsed_ad_log(_lines(s, d)).drop("ts")
    q["ad_log_rejects"] = lambda s, d: adlog.ad_log_rejects(_lines(s, d))
    q["ad_click_counts"] = lambda s, d: A.ad_click_counts(_ad(s, d))
    q["ad_click_counts_by_city"] = lambda s, d: A.ad_click_counts_by_city(_ad(s, d))
    q["ad_area_counts"] = lambda s, d: A.ad_area_counts(_ad(s, d))
    q["ad_blacklist"] = lambda s, d: A.ad_blacklist(_ad(s, d), P.BLACKLIST_THRESHOLD)
    q["ad_blacklist_filter"] = lambda s, d: A.ad_blacklist_filter(_ad(s, d), P.BLACKLIST_THRESHOLD).select("event_id")
    q["ad_top3_by_area"] = lambda s, d: A.ad_top3_by_area(_ad(s, d), P.TOP_ADS)
    q["ad_top3_json"] = lambda s, d: A.ad_top3_json(_ad(s, d), P.TOP_ADS)
    q["ad_click_trend"] = lambda s, d: A.ad_click_buckets(
        src.ad_log(S.prepare(s), d, last_seconds=P.TREND_SPAN_SECONDS), P.TREND_SLIDE_SECONDS)
    q["ad_click_trend_sliding"] = lambda s, d: A.ad_click_trend_sliding(
        _ad(s, d), P.TREND_WINDOW_SECONDS, P.TREND_SLIDE_SECONDS)

    q["fn_epoch_to_string"] = lambda s, d: _ad(s, d).select("event_id", epoch_ms_to_string("ts_ms").alias("value"))
    q["fn_string_to_epoch"] = lambda s, d: _ad(s, d).select(
        "event_id", string_to_epoch_ms(time_text("ts")).alias("value"))
    q["fn_floor_10s"] = lambda s, d: _ad(s, d).select(
        "event_id", time_text(floor_time(F.col("ts"), P.TREND_SLIDE_SECONDS)).alias("value"))
    q["fn_split_ids"] = lambda s, d: _va(s, d).select(
        "event_id", F.explode(split_ids("order_category_ids")).alias("value"))
    q["fn_non_blank"] = lambda s, d: _va(s, d).select("event_id", non_blank(_blank_cases()).alias("value"))
    q["fn_epoch_text"] = lambda s, d: _lines(s, d).select(
        "event_id", epoch_text_to_string(F.substring_index("line", " ", 1)).alias("value"))
    q["category_top10_records"] = lambda s, d: with_task_id(
        C.category_top10(_va(s, d), k=P.TOP_CATEGORIES), P.TASK_ID)
    q["category_session_top10_records"] = lambda s, d: with_task_id(
        C.category_session_top10(_va(s, d), k=P.TOP_SESSIONS), P.TASK_ID)
    return q


def _blank_cases():
    """Order id lists with some replaced by a tab, a newline, blanks and nothing."""
    case = F.col("event_id") % 7
    return (F.when(case == 0, "\t").when(case == 1, "\n").when(case == 2, "  ").when(case == 3, "\t7 ")
             .when(case == 4, "").otherwise(F.col("order_category_ids")))


def _stream_lines(spark: SparkSession, sf_dir: str, plant_errors: bool = False) -> DataFrame:
    S.prepare(spark)
    return src.ad_log_lines(spark, sf_dir, plant_errors=plant_errors)


# progress statistics of the latest replay per stream name (read by bench.py)
LAST_REPLAY_STATS: dict[str, dict] = {}


def _replay(spark, sf_dir, name, build, plant_errors=False, late=False, **kw):
    """Replay the ad log of ``sf_dir`` through the stream queries ``build(root)`` returns; with ``late``, every
    LATE_EVERY-th event arrives in the last slice, up to the whole log's span behind the others."""
    from ..streaming.replay import replay

    root = S.work_dir(spark, name)
    queries = build(root)
    lines = _stream_lines(spark, sf_dir, plant_errors)
    if late:
        last = _ad(spark, sf_dir).agg(F.max("event_id")).first()[0]
        lines = lines.withColumn("slot", F.when(F.col("event_id") % P.LATE_EVERY == 0, F.lit(last)).otherwise(F.col("event_id")))
    LAST_REPLAY_STATS[name] = replay(lines, f"{root}/landing", queries, slices=P.REPLAY_SLICES,
                                     order_col="slot" if late else "event_id", **kw)
    return root


def io_queries() -> dict[str, Query]:
    """Sinks and streams: each writes through the real sink, then reads back what it wrote."""
    from ..sources import sinks
    from ..streaming import ads as SA
    from ..streaming import listing as L
    from ..streaming.keyed import KeyedTable
    from ..streaming.replay import FailsAfterWrite, replay_live

    q: dict[str, Query] = {}

    def table_roundtrip(s, d):
        root = S.work_dir(s, "sink_table")
        name = "category_top10_" + root.rsplit("-", 1)[-1]
        sinks.replace_table(C.category_top10(_va(s, d), k=P.TOP_CATEGORIES), name, f"{root}/{name}")
        return s.table(name)

    def keyed_upsert(s, d):
        # counts written in two batches that overlap on keys; the read-back keeps the last
        counts = A.ad_click_counts(_ad(s, d))
        t = KeyedTable(S.work_dir(s, "sink_keyed") + "/t", ["date", "adid", "userid"], counts.schema)
        t.write(counts.withColumn("n", F.lit(-1).cast("bigint")), 0)
        t.write(counts, 1)
        return t.current(s)

    q["sink_table_roundtrip"] = table_roundtrip
    q["sink_keyed_upsert"] = keyed_upsert

    def log_scan(s, d):
        root = _replay(s, d, "stream_scan", lambda r: [
            (lambda st: SA.decoded_to_files(st, f"{r}/decoded"), f"{r}/ckpt")], plant_errors=True)
        out = s.read.parquet(f"{root}/decoded")
        return out.where(F.col("reject_reason").isNull()).select(
            "event_id", "ts_ms", "date", "area", "city", "userid", "adid")

    def rejects_stream(s, d):
        root = _replay(s, d, "stream_rejects", lambda r: [
            (lambda st: SA.decoded_to_files(st, f"{r}/decoded"), f"{r}/ckpt")], plant_errors=True)
        out = s.read.parquet(f"{root}/decoded")
        return out.where(F.col("reject_reason").isNotNull()).select(
            "event_id", "line", F.col("reject_reason").alias("reason"))

    def counts_stream(grain, name, table=KeyedTable, **kw):
        def run(s, d):
            holder = {}

            def build(r):
                holder["t"] = table(f"{r}/counts", ["date", *grain], SA.counts_schema(grain), ["date"])
                return [(lambda st: SA.counts_to_table(SA.parse_stream(st), holder["t"], grain), f"{r}/ckpt")]
            _replay(s, d, name, build, **kw)
            return holder["t"].current(s).select("date", *grain, "n")
        return run

    def increments_stream(name="stream_increments", table=KeyedTable, **kw):
        def run(s, d):
            grain = ("adid", "userid")
            holder = {}

            def build(r):
                holder["t"] = table(f"{r}/counts", ["date", *grain], SA.counts_schema(grain), ["date"],
                                    merge="sum", sum_cols=["n"])
                return [(lambda st: SA.increments_to_table(SA.parse_stream(st), holder["t"], grain), f"{r}/ckpt")]
            _replay(s, d, name, build, **kw)
            return holder["t"].current(s).select("date", *grain, "n")
        return run

    def live(s, d, name, start, r):
        """The log through a query on the real trigger, with bounded intake, twice until it is idle."""
        seen = replay_live(_stream_lines(s, d), f"{r}/landing", start, f"{r}/ckpt", files=P.LIVE_FILES,
                           files_per_batch=P.LIVE_FILES_PER_BATCH)
        LAST_REPLAY_STATS[name] = {k: sum(x[k] for x in seen) for k in ("batches", "input_rows")}

    def live_counts(s, d):
        grain, r = ("adid", "userid"), S.work_dir(s, "stream_live_counts")
        t = KeyedTable(f"{r}/counts", ["date", *grain], SA.counts_schema(grain), ["date"])
        live(s, d, "stream_live_counts", lambda st: SA.counts_to_table(SA.parse_stream(st), t, grain), r)
        return t.current(s).select("date", *grain, "n")

    def live_list(s, d):
        r = S.work_dir(s, "stream_live_list")
        t = KeyedTable(f"{r}/blacklist", ["userid"], SA.BLACKLIST_SCHEMA)
        live(s, d, "stream_live_list", lambda st: SA.blacklist_to_table(SA.parse_stream(st), t, P.BLACKLIST_THRESHOLD), r)
        return t.history(s).select("userid").distinct()

    def top3_stream(name="stream_top3", table=KeyedTable, **kw):
        def run(s, d):
            holder = {}

            def build(r):
                holder["c"] = table(f"{r}/counts", ["date", "area", "adid"],
                                    SA.counts_schema(("area", "adid")), ["date"])
                holder["t"] = table(f"{r}/top", ["date", "area"], SA.TOP_SCHEMA)
                return [(lambda st: SA.top_ads_to_tables(SA.parse_stream(st), holder["c"], holder["t"], P.TOP_ADS),
                         f"{r}/ckpt")]
            _replay(s, d, name, build, **kw)
            return SA.top_ads_rows(holder["t"], s)
        return run

    def blacklist_stream(name="stream_blacklist", table=KeyedTable, **kw):
        def run(s, d):
            holder = {}

            def build(r):
                holder["b"] = table(f"{r}/blacklist", ["userid"], SA.BLACKLIST_SCHEMA)
                return [(lambda st: SA.blacklist_to_table(SA.parse_stream(st), holder["b"], P.BLACKLIST_THRESHOLD),
                         f"{r}/ckpt")]
            _replay(s, d, name, build, **kw)
            return holder["b"].history(s).select("userid").distinct()
        return run

    def state_filter_stream(s, d):
        root = _replay(s, d, "stream_state_filter", lambda r: [
            (lambda st: SA.to_files(L.admitted(SA.parse_stream(st), P.BLACKLIST_THRESHOLD), f"{r}/admitted"), f"{r}/ckpt")],
            settings=L.STATE_STORE)
        return s.read.parquet(f"{root}/admitted").select("event_id")

    def state_list_stream(s, d):
        root = _replay(s, d, "stream_state_list", lambda r: [
            (lambda st: L.admitted(SA.parse_stream(st), P.BLACKLIST_THRESHOLD).writeStream.format("noop"), f"{r}/ckpt")],
            late=True, settings=L.STATE_STORE)
        return L.listed_users(s, f"{root}/ckpt").select("userid")

    def state_counts_stream(s, d):
        grain = ("area", "adid")
        root = _replay(s, d, "stream_state_counts", lambda r: [
            (lambda st: L.running_counts(SA.parse_stream(st), grain).writeStream.outputMode("update").format("noop"), f"{r}/ckpt")],
            late=True)
        return L.counts_in_state(s, f"{root}/ckpt", grain)

    def unlisted_stream(s, d):
        listed = S.written(A.ad_blacklist(_ad(s, d), P.BLACKLIST_THRESHOLD), "listed")
        root = _replay(s, d, "stream_unlisted", lambda r: [
            (lambda st: SA.to_files(L.against_list(SA.parse_stream(st), listed), f"{r}/passed"), f"{r}/ckpt")])
        return s.read.parquet(f"{root}/passed").select("event_id")

    def trend_sorted_stream(s, d):
        root = _replay(s, d, "stream_trend_sorted", lambda r: [
            (lambda st: SA.trend_sorted_to_folder(SA.parse_stream(st), f"{r}/trend", P.TREND_SLIDE_SECONDS), f"{r}/ckpt")])
        return s.read.parquet(f"{root}/trend").select(F.col("batch").cast("int").alias("batch"), "position", "bucket", "n")

    def metrics(s, d):
        # counted by the pass that writes the ranking's input, not by one of their own
        seen = Observation("visit_actions")
        actions = C.action_metrics(_va(s, d), seen)
        S.written(C.category_metric_counts(actions), "observed")
        return s.createDataFrame([(k, int(v)) for k, v in seen.get.items()], "metric string, n bigint")

    def line_metrics(s, d):
        def watched(st, r):
            lines = adlog.decode_ad_lines(st).drop("ts")
            kinds = {"good": F.col("reject_reason").isNull(), **{k: F.col("reject_reason") == k for k in (
                adlog.REASON_MISSING_FIELD, adlog.REASON_BAD_TIMESTAMP)}}
            return SA.to_files(lines.observe("lines", *[F.count(F.when(c, 1)).alias(k) for k, c in kinds.items()]), f"{r}/decoded")

        _replay(s, d, "stream_line_metrics", lambda r: [(lambda st: watched(st, r), f"{r}/ckpt")], plant_errors=True)
        return s.createDataFrame(sorted(LAST_REPLAY_STATS["stream_line_metrics"]["observed"].items()), "metric string, n bigint")

    def dwell_bucketed(s, d):
        root = S.work_dir(s, "sessions")
        name = "visit_actions_by_session_" + root.rsplit("-", 1)[-1]
        sinks.session_table(_va(s, d), name, f"{root}/{name}", P.SESSION_BUCKETS)
        return PF.page_dwell_time(s.table(name), split=None)

    def blacklist_filter_stream(s, d):
        holder = {}
        grain = ("adid", "userid")

        def build(r):
            holder["c"] = KeyedTable(f"{r}/counts", ["date", *grain], SA.counts_schema(grain), ["date"],
                                     merge="sum", sum_cols=["n"])
            holder["b"] = KeyedTable(f"{r}/blacklist", ["userid"], SA.BLACKLIST_SCHEMA)
            holder["a"] = f"{r}/admitted"
            return [(lambda st: SA.per_event_blacklist_filter(SA.parse_stream(st), holder["c"], holder["b"],
                                                              holder["a"], P.BLACKLIST_THRESHOLD), f"{r}/ckpt")]
        _replay(s, d, "stream_blacklist_filter", build)
        return s.read.parquet(holder["a"]).select("event_id")

    def batch_filter_stream(s, d):
        holder = {}

        def build(r):
            holder["b"] = KeyedTable(f"{r}/blacklist", ["userid"], SA.BLACKLIST_SCHEMA)
            holder["a"] = f"{r}/admitted"
            return [(lambda st: SA.admitted_to_folder(SA.parse_stream(st), holder["b"], holder["a"]), f"{r}/c1"),
                    (lambda st: SA.blacklist_to_table(SA.parse_stream(st), holder["b"], P.BLACKLIST_THRESHOLD), f"{r}/c2")]
        _replay(s, d, "stream_batch_filter", build)
        return s.read.parquet(holder["a"]).select("event_id")

    def trend_stream(s, d):
        root = _replay(s, d, "stream_trend", lambda r: [
            (lambda st: SA.to_files(SA.trend_stream(SA.parse_stream(st), P.TREND_WINDOW_SECONDS,
                                                    P.TREND_SLIDE_SECONDS, P.WATERMARK_DELAY), f"{r}/trend"),
             f"{r}/ckpt")])
        return s.read.parquet(f"{root}/trend")

    q["ad_log_stream_scan"] = log_scan
    q["ad_log_rejects_stream"] = rejects_stream
    q["ad_click_counts_stream"] = counts_stream(("adid", "userid"), "stream_counts")
    q["ad_area_counts_stream"] = counts_stream(("area", "adid"), "stream_area_counts")
    q["ad_click_counts_by_city_stream"] = counts_stream(("area", "city", "adid"), "stream_city_counts")
    q["ad_click_counts_increments_stream"] = increments_stream()
    q["ad_top3_stream"] = top3_stream()
    q["ad_top3_json_stream"] = lambda s, d: A.top_ads_json(top3_stream()(s, d))
    q["ad_blacklist_stream"] = blacklist_stream()
    user = ("adid", "userid")
    q["ad_click_counts_late_stream"] = counts_stream(user, "stream_late_counts", late=True)
    q["ad_top3_late_stream"] = top3_stream("stream_late_top3", late=True)
    q["ad_blacklist_late_stream"] = blacklist_stream("stream_late_blacklist", late=True)
    lost = {"table": FailsAfterWrite, "failures": 2}
    q["ad_click_counts_recovered_stream"] = counts_stream(user, "stream_lost_counts", **lost)
    q["ad_click_counts_increments_recovered_stream"] = increments_stream("stream_lost_increments", **lost)
    q["ad_top3_recovered_stream"] = top3_stream("stream_lost_top3", **lost)
    q["ad_blacklist_recovered_stream"] = blacklist_stream("stream_lost_blacklist", **lost)
    q["ad_click_counts_live_stream"] = live_counts
    q["ad_blacklist_live_stream"] = live_list
    q["ad_blacklist_state_filter_stream"] = state_filter_stream
    q["ad_blacklist_state_stream"] = state_list_stream
    q["ad_area_counts_state_stream"] = state_counts_stream
    q["ad_unlisted_stream"] = unlisted_stream
    q["ad_click_trend_sorted_stream"] = trend_sorted_stream
    q["ad_line_metrics_stream"] = line_metrics
    q["visit_metrics_observed"] = metrics
    q["page_dwell_time_bucketed"] = dwell_bucketed
    q["ad_blacklist_filter_stream"] = blacklist_filter_stream
    q["ad_blacklist_batch_filter_stream"] = batch_filter_stream
    q["ad_click_trend_stream"] = trend_stream
    return q
