"""Command-line runner for the eight analyses.

Batch jobs read a stored ``user_visit_action`` or ad log (``--table``, ``--path``), or derive it from
the test tables under ``--data``, and either show the result or write it as parquet
(``--out``). Stream jobs read ad-log lines from a topic (``--servers``) or arriving as
parquet files in ``--landing`` and run
with a processing-time trigger (default 5 seconds) or, with ``--once``, until the files present
are consumed. Results and checkpoints go under ``--out`` (default: the session's checkpoint
folder).

    python -m clickflow category-top10 --data /root/testdata/sf0.1 --start 2024-01-05 --end 2024-01-20
    python -m clickflow page-conversion --data /root/testdata/sf0.1 --flow 1,2,3,4,5,6,7
    python -m clickflow ad-top3 --landing /data/ads_landing --out /data/ads_out --once
"""

from __future__ import annotations

import argparse
import sys

BATCH = ["category-top10", "category-session-top10", "page-conversion", "page-dwell",
         "ad-blacklist", "ad-blacklist-filter", "ad-click-counts", "ad-top3", "ad-trend"]
STREAM = ["ad-blacklist", "ad-blacklist-filter", "ad-click-counts", "ad-top3", "ad-trend"]


def _batch(spark, a) -> "object":
    from .operators import ads as A
    from .operators import category as C
    from .operators import pageflow as PF
    from .sources import adapters as src

    if a.job.startswith(("category", "page")):
        va = (src.visit_actions(spark, a.data, start_date=a.start, end_date=a.end) if a.data else
              src.read_visit_actions(spark, a.path, a.table, start_date=a.start, end_date=a.end))
        if a.job == "category-top10":
            return C.category_top10(va, k=a.k or 10)
        if a.job == "category-session-top10":
            return C.category_session_top10(va, k=a.k or 10)
        if a.job == "page-conversion":
            return PF.page_conversion_rate(va, a.flow, include_zero=a.include_zero)
        return PF.page_dwell_time(va)
    log = src.ad_log(spark, a.data) if a.data else src.read_ad_log(spark, a.path, a.table)
    if a.job == "ad-blacklist":
        return A.ad_blacklist(log, a.threshold)
    if a.job == "ad-blacklist-filter":
        return A.ad_blacklist_filter(log, a.threshold)
    if a.job == "ad-click-counts":
        return A.ad_click_counts(log)
    if a.job == "ad-top3":
        return A.ad_top3_json(log, a.k or 3)
    return A.ad_click_trend_sliding(log, a.window, a.slide)


def _stream(spark, a, out: str):
    from .streaming import ads as SA
    from .streaming.keyed import KeyedTable
    from .streaming.replay import kafka_ad_lines, landing_stream

    lines = landing_stream(spark, a.landing) if a.landing else kafka_ad_lines(spark, a.servers, a.topic, a.offsets)
    parsed = SA.parse_stream(lines)
    if a.job == "ad-click-counts":
        grain = ("adid", "userid")
        t = KeyedTable(f"{out}/counts", ["date", *grain], SA.counts_schema(grain), ["date"])
        return SA.counts_to_table(parsed, t, grain, a.delay)
    if a.job == "ad-top3":
        c = KeyedTable(f"{out}/area_counts", ["date", "area", "adid"], SA.counts_schema(("area", "adid")), ["date"])
        t = KeyedTable(f"{out}/top", ["date", "area"], SA.TOP_SCHEMA)
        return SA.top_ads_to_tables(parsed, c, t, a.k or 3, a.delay)
    if a.job == "ad-blacklist":
        b = KeyedTable(f"{out}/blacklist", ["userid"], SA.BLACKLIST_SCHEMA)
        return SA.blacklist_to_table(parsed, b, a.threshold, a.delay)
    if a.job == "ad-blacklist-filter":
        grain = ("adid", "userid")
        c = KeyedTable(f"{out}/counts", ["date", *grain], SA.counts_schema(grain), ["date"],
                       merge="sum", sum_cols=["n"])
        b = KeyedTable(f"{out}/blacklist", ["userid"], SA.BLACKLIST_SCHEMA)
        return SA.per_event_blacklist_filter(parsed, c, b, f"{out}/admitted", a.threshold)
    trend = SA.trend_stream(parsed, a.window, a.slide, a.delay or SA.DEFAULT_DELAY)
    if a.console:
        return SA.to_console_sorted(trend, ["window_start", "bucket"])
    return SA.to_files(trend, f"{out}/trend")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="python -m clickflow", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("job", choices=sorted(set(BATCH + STREAM)))
    p.add_argument("--data", help="folder with the input tables (batch)")
    p.add_argument("--table", help="stored user_visit_action or ad log: a catalog table (batch)")
    p.add_argument("--path", help="the same, as a parquet folder (batch)")
    p.add_argument("--servers", help="bootstrap servers of the ad-log topic (stream; needs the connector)")
    p.add_argument("--topic", default="ads_log", help="ad-log topic (stream)")
    p.add_argument("--offsets", default="latest", help="starting offsets of the topic (stream)")
    p.add_argument("--landing", help="folder where ad-log line files arrive (stream)")
    p.add_argument("--out", help="output folder (parquet result, or stream tables + checkpoint)")
    p.add_argument("--start"), p.add_argument("--end")
    p.add_argument("--flow", default="1,2,3,4,5,6,7")
    p.add_argument("--include-zero", action="store_true")
    p.add_argument("-k", type=int)
    p.add_argument("--threshold", type=int, default=100)
    p.add_argument("--window", type=int, default=60)
    p.add_argument("--slide", type=int, default=10)
    p.add_argument("--delay", help="watermark delay (stream); without one, counts keep all days and lose no late click")
    p.add_argument("--interval", default="5 seconds", help="micro-batch interval (stream)")
    p.add_argument("--once", action="store_true", help="stream: consume the files present, then stop")
    p.add_argument("--console", action="store_true", help="trend stream: print each batch sorted")
    p.add_argument("--rows", type=int, default=20)
    a = p.parse_args(argv)

    from pyspark.sql import SparkSession

    from .session import prepare, shared_root

    spark = prepare(SparkSession.builder.appName(f"clickflow-{a.job}").getOrCreate())
    if a.landing or a.servers:
        if a.job not in STREAM:
            p.error(f"{a.job} has no stream form")
        out = (a.out or f"{shared_root(spark)}/clickflow/{a.job}").rstrip("/")
        w = _stream(spark, a, out).option("checkpointLocation", f"{out}/_checkpoint")
        w = w.trigger(availableNow=True) if a.once else w.trigger(processingTime=a.interval)
        w.queryName(f"clickflow_{a.job.replace('-', '_')}").start().awaitTermination()
        return 0
    if sum(x is not None for x in (a.data, a.table, a.path)) != 1:
        p.error("one of --data, --table, --path (batch) or --landing, --servers (stream) is required")
    df = _batch(spark, a)
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        df.show(a.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
