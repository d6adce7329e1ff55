"""The command-line runner: a batch job to parquet, a stream job over a landing folder."""

from clickflow import session as S
from clickflow.__main__ import main
from clickflow.operators import ads as A
from clickflow.operators import category as C
from clickflow.sources import adapters as src
from clickflow.streaming import ads as SA
from clickflow.streaming.keyed import KeyedTable

from .conftest import SF_SMALL


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_batch_job_to_parquet(spark):
    out = S.work_dir(spark, "cli_batch")
    assert main(["category-top10", "--data", SF_SMALL, "--out", out]) == 0
    assert _rows(spark.read.parquet(out)) == _rows(C.category_top10(src.visit_actions(spark, SF_SMALL)))


def test_stream_job_once(spark):
    root = S.work_dir(spark, "cli_stream")
    src.ad_log_lines(spark, SF_SMALL).write.parquet(f"{root}/landing")
    assert main(["ad-top3", "--landing", f"{root}/landing", "--out", f"{root}/out", "--once"]) == 0
    top = KeyedTable(f"{root}/out/top", ["date", "area"], SA.TOP_SCHEMA)
    assert _rows(SA.top_ads_rows(top, spark)) == _rows(A.ad_top3_by_area(src.ad_log(spark, SF_SMALL)))


def test_every_batch_job_runs(spark):
    from clickflow.__main__ import BATCH

    for job in BATCH:
        out = S.work_dir(spark, "cli_" + job)
        args = [job, "--data", SF_SMALL, "--out", out]
        if job == "ad-blacklist":
            args += ["--threshold", "3"]
        assert main(args) == 0, job
        assert spark.read.parquet(out).count() > 0, job


def test_other_stream_jobs_once(spark):
    from pyspark.sql import functions as F

    root = S.work_dir(spark, "cli_streams")
    src.ad_log_lines(spark, SF_SMALL).write.parquet(f"{root}/landing")
    log = src.ad_log(spark, SF_SMALL)

    assert main(["ad-click-counts", "--landing", f"{root}/landing", "--out", f"{root}/c", "--once"]) == 0
    grain = ("adid", "userid")
    counts = KeyedTable(f"{root}/c/counts", ["date", *grain], SA.counts_schema(grain), ["date"])
    assert _rows(counts.current(spark).select("date", *grain, "n")) == _rows(A.ad_click_counts(log))

    assert main(["ad-blacklist", "--landing", f"{root}/landing", "--out", f"{root}/b", "--once",
                 "--threshold", "3"]) == 0
    bl = KeyedTable(f"{root}/b/blacklist", ["userid"], SA.BLACKLIST_SCHEMA)
    assert _rows(bl.history(spark).select("userid").distinct()) == _rows(A.ad_blacklist(log, 3))

    assert main(["ad-trend", "--landing", f"{root}/landing", "--out", f"{root}/t", "--once"]) == 0
    trend = spark.read.parquet(f"{root}/t/trend")
    closed = A.ad_click_trend_sliding(log).where(
        F.to_timestamp("bucket") + F.expr("INTERVAL 10 SECONDS")
        <= log.select(F.max("ts")).scalar() - F.expr("INTERVAL 10 MINUTES"))
    assert _rows(trend) == _rows(closed)


def test_blacklist_filter_job_batch_and_stream(spark):
    root = S.work_dir(spark, "cli_filter")
    log = src.ad_log(spark, SF_SMALL)
    want = _rows(A.ad_blacklist_filter(log, 3).select("event_id"))
    assert main(["ad-blacklist-filter", "--data", SF_SMALL, "--out", f"{root}/batch", "--threshold", "3"]) == 0
    assert _rows(spark.read.parquet(f"{root}/batch").select("event_id")) == want
    src.ad_log_lines(spark, SF_SMALL).write.parquet(f"{root}/landing")
    assert main(["ad-blacklist-filter", "--landing", f"{root}/landing", "--out", f"{root}/s", "--once",
                 "--threshold", "3"]) == 0
    assert _rows(spark.read.parquet(f"{root}/s/admitted").select("event_id")) == want


def test_stored_tables_and_paths(spark):
    """A stored visit table (without event ids) and stored ad-log lines give the adapters' results."""
    root = S.work_dir(spark, "cli_stored")
    va = src.visit_actions(spark, SF_SMALL)
    va.drop("event_id").write.option("path", f"{root}/va").saveAsTable("user_visit_action_cli")
    try:
        assert main(["category-top10", "--table", "user_visit_action_cli", "--out", f"{root}/a"]) == 0
    finally:
        spark.sql("DROP TABLE user_visit_action_cli")
    assert _rows(spark.read.parquet(f"{root}/a")) == _rows(C.category_top10(va))
    src.ad_log_lines(spark, SF_SMALL).write.parquet(f"{root}/log")
    assert main(["ad-top3", "--path", f"{root}/log", "--out", f"{root}/b"]) == 0
    assert _rows(spark.read.parquet(f"{root}/b")) == _rows(A.ad_top3_json(src.ad_log(spark, SF_SMALL)))
