"""Scale properties of the physical plans, kept as regression tests."""

import re
import uuid

import pytest

from clickflow.plans.catalog import batch_queries

from .conftest import SF_SMALL

QUERIES = batch_queries()
FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "FlatMapGroupsInPandas", "MapInPandas"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_or_pairwise_operators(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert not [op for op in FORBIDDEN if op in plan]


@pytest.mark.parametrize("name", ["category_session_top10", "ad_top3_by_area"])
def test_per_group_top_k_is_limited_before_the_shuffle(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_date_range_reaches_the_scan(spark):
    plan = _plan(QUERIES["visit_date_range"](spark, SF_SMALL))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "GreaterThanOrEqual(ts," in pushed and "LessThan(ts," in pushed


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(QUERIES["category_top10"](spark, SF_SMALL))
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", plan).group(1)
    assert "value" not in schema and "event_id" in schema


def test_dimension_join_is_broadcast(spark):
    plan = _plan(QUERIES["ad_click_counts"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_session_order_is_split_at_every_size(spark):
    """The small input takes the plan that a large one would: one hash exchange of the rows of all but the
    heavy sessions, range chunks of the heavy ones, which alone are written."""
    from clickflow.operators.pageflow import page_dwell_time
    from clickflow.sources.adapters import visit_actions

    plan = _plan(page_dwell_time(visit_actions(spark, SF_SMALL)))
    assert "rangepartitioning(_tb" in plan and "sequence-chunks" in plan and "LeftAnti" in plan
    # exchanges by hash: rows by session, edge rows of heavy sessions, the per-page partial aggregate
    assert plan.count("Exchange hashpartitioning") == 3
    assert len(re.findall(r"FileScan parquet[^\n]*events.parquet", plan)) == 1


def test_no_size_checks_in_the_package():
    import pathlib

    import clickflow

    root = pathlib.Path(clickflow.__file__).parent
    for path in root.rglob("*.py"):
        if path.parent.name != "llm":
            text = path.read_text()
            assert "inputFiles(" not in text and not re.search(r"limit\([^)]*\)\.count\(", text), path


def _jobs(spark, build):
    """Number of jobs that building a query runs."""
    sc, group = spark.sparkContext, f"counted-{uuid.uuid4()}"
    sc.setJobGroup(group, group)
    try:
        build()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_building_a_query_runs_no_job(spark):
    """Only the operators that write an intermediate table run jobs while they are built."""
    eager = {"session_page_paths", "session_path_text", "session_page_hops", "page_hop_counts", "page_conversion_rate",
             "page_dwell_intervals", "page_dwell_time", "ad_blacklist_filter"}
    QUERIES["ad_click_counts"](spark, SF_SMALL)       # schemas read before anything is counted
    for name in sorted(set(QUERIES) - eager):
        QUERIES[name](spark, SF_SMALL)
        reads = 5      # a job or so to read each table's schema
        assert _jobs(spark, lambda n=name: QUERIES[n](spark, SF_SMALL)) <= reads, name


def test_trend_bound_is_on_the_stored_column(spark):
    """The bound compares the stored timestamp in the scan's own filter, before the join."""
    plan = _plan(QUERIES["ad_click_trend"](spark, SF_SMALL))
    scan = next(x for x in plan.split("FileScan parquet")[1:] if "user_id" in x)
    assert re.search(r"DataFilters: \[[^\]]*\(ts#\d+ > Subquery", scan)


def test_blacklist_filter_scans_the_log_three_times(spark):
    """Two scans to write the candidate clicks (totals, clicks) and one in the final plan."""
    from clickflow.operators import ads as A
    from clickflow.sources import adapters as src

    log = src.ad_log(spark, SF_SMALL)
    candidates = _plan(A.candidate_clicks(log, 3))
    final = _plan(A.ad_blacklist_filter(log, 3))
    events = r"FileScan parquet \[event_id[^\n]*events.parquet|FileScan parquet[^\n]*events.parquet"
    assert len(re.findall(events, candidates)) == 2
    assert len(re.findall(events, final)) == 1


def test_sessions_of_a_bucketed_table_need_no_exchange(spark):
    """Below the window, that is: the per-page partial aggregate still has its own."""
    from clickflow.plans.catalog import io_queries

    plan = _plan(io_queries()["page_dwell_time_bucketed"](spark, SF_SMALL))
    below = plan[plan.index("Window"):]
    assert "Exchange" not in below and "Bucketed: true" in below


def test_metrics_are_observed_by_the_pass_that_writes(spark):
    from pyspark.sql import Observation

    from clickflow.operators.category import action_metrics, category_metric_counts
    from clickflow.sources.adapters import visit_actions

    seen = Observation()
    counts = category_metric_counts(action_metrics(visit_actions(spark, SF_SMALL), seen))
    plan = _plan(counts)
    assert "CollectMetrics" in plan and plan.count("FileScan parquet") == 1
    rows = counts.collect()
    assert seen.get["click"] == sum(r.n for r in rows if r.metric == "click") and sum(seen.get.values()) == 1000
