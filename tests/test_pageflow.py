"""Q3/Q4 hand-made cases and the bucketed sequence operator against a plain window."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clickflow.operators import pageflow as PF
from clickflow.operators.sequence import _divided, _pieces, with_next, with_position

from .helpers import T0, action, actions_df


def test_single_action_session(spark):
    df = actions_df(spark, [action(1, page=1)])
    assert PF.session_page_hops(df).count() == 0
    assert PF.page_dwell_intervals(df).count() == 0
    assert [tuple(r) for r in PF.page_visit_counts(df, "1,2").collect()] == [(1, 1)]


def test_dwell_rounding(spark):
    rows = [action(1, "s1", 5, 0), action(2, "s1", 6, 1),
            action(3, "s2", 5, 0), action(4, "s2", 6, 2),
            action(5, "s3", 5, 0), action(6, "s3", 6, 2)]
    r = PF.page_dwell_time(actions_df(spark, rows)).collect()
    assert len(r) == 1 and r[0].page_id == 5 and r[0].n == 3
    assert r[0].avg_ms == 1666.0
    assert r[0].avg_ms_exact == pytest.approx(1666.6667, abs=1e-3)


def test_order_by_time_not_storage(spark):
    rows = [action(2, "s", 2, 30), action(1, "s", 1, 0)]   # stored in reverse
    d = PF.page_dwell_intervals(actions_df(spark, rows)).collect()
    assert [(r.event_id, r.page_id, r.dwell_ms) for r in d] == [(1, 1, 30_000)]


def test_hop_never_taken(spark):
    df = actions_df(spark, [action(1, "s", 1, 0), action(2, "s", 2, 1)])
    assert PF.page_conversion_rate(df, "1,9").count() == 0
    z = PF.page_conversion_rate(df, "1,9", include_zero=True).collect()
    assert [(r.page_id, r.next_page_id, r.hops, r.visits, r.rate) for r in z] == [(1, 9, 0, 1, 0.0)]


def test_conversion_rate_small(spark):
    rows = [action(1, "a", 1, 0), action(2, "a", 2, 1), action(3, "a", 3, 2),
            action(4, "b", 1, 0), action(5, "b", 3, 1)]
    r = {(x.page_id, x.next_page_id): (x.hops, x.visits, x.rate)
         for x in PF.page_conversion_rate(actions_df(spark, rows), "1,2,3").collect()}
    assert r == {(1, 2): (1, 2, 0.5), (2, 3): (1, 1, 1.0)}


def test_flow_needs_two_pages():
    with pytest.raises(ValueError):
        PF.parse_flow("3")
    assert PF.parse_flow(" 1, 2 ,3") == [1, 2, 3]


@pytest.mark.parametrize("split,kw", [("time", {"bucket_seconds": 60}), ("range", {"chunks": 7}),
                                      ("range", {"chunks": 1}), ("heavy", {"heavy_rows": 40, "chunks": 5}),
                                      ("heavy", {"heavy_rows": 0}), ("heavy", {})])
def test_split_sequence_equals_plain_window(spark, split, kw):
    """A hot session spread over many pieces, a burst of one session inside one second,
    ties on time, and sparse sessions."""
    rnd = random.Random(7)
    rows = []
    eid = 0
    for s, n, spread in [("hot", 400, 4000), ("burst", 300, 1), ("b", 5, 100), ("c", 1, 10), ("d", 30, 20)]:
        for _ in range(n):
            eid += 1
            rows.append((s, eid, T0 + dt.timedelta(seconds=rnd.randrange(spread)), rnd.randrange(1, 8)))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "s string, e long, t timestamp, p long")
    got = with_next(df, ["s"], "t", "e", ["p", "t"], split=split, **kw)
    want = with_next(df, ["s"], "t", "e", ["p", "t"], split=None)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    gp = with_position(df, ["s"], "t", "e", split=split, **kw)
    wp = with_position(df, ["s"], "t", "e", split=None)
    assert sorted(map(tuple, gp.collect())) == sorted(map(tuple, wp.collect()))
    assert gp.where(F.col("s") == "hot").agg(F.max("step")).first()[0] == 400


def test_hot_session_is_split_evenly(spark):
    """A third of all actions forced into one session: tasks (not only chunks) stay balanced, the
    session spans several, and the result still equals the plain window."""
    from clickflow.operators.sequence import _pieces
    from clickflow.sources.adapters import visit_actions

    from .conftest import SF_MID

    va = visit_actions(spark, SF_MID).select("session_id", "event_id", "action_time", "page_id")
    hot = va.withColumn("session_id", F.when(F.col("event_id") % 3 == 0, F.lit("hot"))
                        .otherwise(F.col("session_id")))
    n = hot.count()
    p = _pieces(hot, ["session_id"], "action_time", "event_id", "range", 300, chunks=32)
    tasks = [r["count"] for r in p.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert sum(tasks) == n and max(tasks) <= 2 * n / len(tasks) and len(tasks) >= 6
    dealt = p.groupBy("_tb", F.spark_partition_id().alias("task")).count()
    assert dealt.count() == p.select("_tb").distinct().count()        # a chunk is in one task
    assert p.where(F.col("session_id") == "hot").select("_tb").distinct().count() >= 8
    got = with_next(hot, ["session_id"], "action_time", "event_id", ["page_id"])
    want = with_next(hot, ["session_id"], "action_time", "event_id", ["page_id"], split=None)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_visit_counts_include_last(spark):
    df = actions_df(spark, [action(1, "s", 1, 0), action(2, "s", 2, 1), action(3, "t", 2, 0)])
    assert sorted(map(tuple, PF.page_visit_counts(df, "1,2").collect())) == [(1, 1)]
    assert sorted(map(tuple, PF.page_visit_counts(df, "1,2", include_last=True).collect())) == [(1, 1), (2, 2)]


def test_range_split_with_two_group_columns(spark):
    rnd = random.Random(11)
    rows = []
    for e in range(600):
        g1 = "hot" if e % 2 else rnd.choice(["a", "b"])
        rows.append((g1, e % 3 if g1 != "hot" else 0, e, T0 + dt.timedelta(seconds=rnd.randrange(50)), e % 7))
    df = spark.createDataFrame(rows, "g1 string, g2 long, e long, t timestamp, p long")
    for fn, kw in [(with_position, {}), (with_next, {"carry": ["p"]})]:
        got = fn(df, ["g1", "g2"], "t", "e", split="range", chunks=6, **kw)
        want = fn(df, ["g1", "g2"], "t", "e", split=None, **kw)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_sequence_operators_on_empty_input(spark):
    df = spark.createDataFrame([], "s string, e long, t timestamp, p long")
    assert with_position(df, ["s"], "t", "e").count() == 0
    assert with_next(df, ["s"], "t", "e", ["p"]).count() == 0


def test_heavy_groups_alone_are_cut_into_chunks(spark):
    """Null keys are a group too, heavy or not; the two branches divide the rows."""
    rows = [(None if i % 3 == 0 else "hot" if i % 3 == 1 else f"s{i % 40}", i // 7, i) for i in range(900)]
    df = spark.createDataFrame(rows, "s string, t bigint, e bigint")
    heavy, light, chunks = _divided(df, ["s"], 100)
    assert chunks == 24 and _divided(df, ["s"], 10_000)[2] == 8  # 600 rows, four chunks to 100 of them; two tasks
    assert {r.s for r in heavy.select("s").distinct().collect()} == {None, "hot"} and light.count() == 300
    for limit, chunks in ((100, 6), (100, None), (10_000, 6)):
        got = with_next(df, ["s"], "t", "e", ["e"], heavy_rows=limit, chunks=chunks)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, with_next(df, ["s"], "t", "e", ["e"], split=None).collect()))
        got = with_position(df, ["s"], "t", "e", heavy_rows=limit, chunks=chunks)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, with_position(df, ["s"], "t", "e", split=None).collect()))


def test_path_text_of_a_hot_session_is_joined_in_order(spark):
    acts = actions_df(spark, [action(i, session="hot" if i % 2 else f"s{i % 6}", page=i % 9, secs=i // 3) for i in range(400)])
    want = {}
    for r in sorted(acts.collect(), key=lambda r: (r.action_time, r.event_id)):
        want.setdefault(r.session_id, []).append(str(r.page_id))
    for part in (1, 7, 100_000):
        got = PF.session_path_text(acts, pages_per_part=part)
        assert dict(map(tuple, got.collect())) == {k: ">".join(v) for k, v in want.items()}
    assert PF.session_path_text(acts.limit(0)).count() == 0
