"""Streams against their batch twins: late data, restarts, replay safety, blacklist feedback."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Row
from pyspark.sql import functions as F

from clickflow import session as S
from clickflow.operators import ads as A
from clickflow.sources import adapters as src
from clickflow.streaming import ads as SA
from clickflow.streaming import listing as L
from clickflow.streaming.keyed import KeyedTable
from clickflow.streaming.replay import FailsAfterWrite, landing_stream, replay, replay_live, slice_bounds

from .conftest import SF_SMALL

GRAIN = ("adid", "userid")


def _rows(df):
    return sorted(map(tuple, df.collect()))


def _counts_via_stream(spark, lines, slices, order_col="event_id", delay="10 minutes", stats=None):
    root = S.work_dir(spark, "test_counts")
    t = KeyedTable(f"{root}/counts", ["date", *GRAIN], SA.counts_schema(GRAIN), ["date"])
    st = replay(lines, f"{root}/landing",
                [(lambda st: SA.counts_to_table(SA.parse_stream(st), t, GRAIN, delay), f"{root}/ckpt")],
                slices=slices, order_col=order_col)
    if stats is not None:
        stats.update(st)
    return t.current(spark).select("date", *GRAIN, "n")


def test_slice_bounds_cover_all(spark):
    df = spark.range(0, 103).withColumnRenamed("id", "event_id")
    b = slice_bounds(df, "event_id", 4)
    assert b[0][0] == 0 and b[-1][1] == 103 and all(x[1] == y[0] for x, y in zip(b, b[1:]))


def test_one_slice_equals_four_slices_equals_batch(spark):
    lines = src.ad_log_lines(spark, SF_SMALL)
    batch = _rows(A.ad_click_counts(src.ad_log(spark, SF_SMALL)))
    assert _rows(_counts_via_stream(spark, lines, 1)) == batch
    assert _rows(_counts_via_stream(spark, lines, 4)) == batch


def test_late_events_are_dropped(spark):
    log = src.ad_log(spark, SF_SMALL)
    lines = src.encode_ad_lines(log)
    first = [r.event_id for r in log.orderBy("event_id").limit(5).collect()]
    hi = log.agg(F.max("event_id")).first()[0]
    # the five earliest events arrive with the last slice, days after their own day closed
    late = lines.withColumn("slot", F.when(F.col("event_id").isin(first), F.lit(hi)).otherwise(F.col("event_id")))
    stats = {}
    got = _rows(_counts_via_stream(spark, late, 4, order_col="slot", stats=stats))
    want = _rows(A.ad_click_counts(log.where(~F.col("event_id").isin(first))))
    assert got == want
    # counted, per group after partial aggregation: between 1 and 5 rows for 5 late events
    assert 1 <= stats["dropped_by_watermark"] <= 5
    assert stats["input_rows"] == log.count() and stats["slices"] == 4


def test_keyed_table_replay_is_idempotent(spark):
    root = S.work_dir(spark, "test_keyed")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    t = KeyedTable(f"{root}/t", ["k"], df.schema)
    t.write(df, 0)
    t.write(spark.createDataFrame([("a", 5)], "k string, v long"), 1)
    t.write(spark.createDataFrame([("a", 5)], "k string, v long"), 1)   # batch 1 retried
    assert _rows(t.current(spark)) == [("a", 5), ("b", 2)]
    assert _rows(t.current(spark, before_epoch=1)) == [("a", 1), ("b", 2)]


def test_blacklist_stream_feedback(spark):
    """Per-batch filtering admits every event the per-event batch rule admits, plus only
    clicks of users listed by the batch (slice) in which they crossed."""
    threshold = 3
    log = src.ad_log(spark, SF_SMALL)
    root = S.work_dir(spark, "test_blacklist")
    bl = KeyedTable(f"{root}/bl", ["userid"], SA.BLACKLIST_SCHEMA)
    replay(src.encode_ad_lines(log), f"{root}/landing", [
        (lambda st: SA.admitted_to_folder(SA.parse_stream(st), bl, f"{root}/admitted"), f"{root}/c1"),
        (lambda st: SA.blacklist_to_table(SA.parse_stream(st), bl, threshold), f"{root}/c2"),
    ], slices=4)
    listed = {r.userid for r in bl.history(spark).collect()}
    assert listed == {r.userid for r in A.ad_blacklist(log, threshold).collect()}
    admitted = {r.event_id for r in spark.read.parquet(f"{root}/admitted").collect()}
    per_event = {r.event_id for r in A.ad_blacklist_filter(log, threshold).collect()}
    assert per_event <= admitted
    extra = log.where(F.col("event_id").isin(sorted(admitted - per_event))).select("userid").distinct().collect()
    assert {r.userid for r in extra} <= listed


def test_processing_time_start_and_sorted_console(spark, capsys):
    root = S.work_dir(spark, "test_console")
    lines = src.encode_ad_lines(src.ad_log(spark, SF_SMALL))
    lines.write.parquet(f"{root}/landing")
    from clickflow.streaming.replay import landing_stream

    trend = SA.trend_stream(SA.parse_stream(landing_stream(spark, f"{root}/landing")))
    q = SA.start(SA.to_console_sorted(trend, ["window_start", "bucket"], rows=5), f"{root}/ckpt",
                 interval="1 second", name="trend_console_test")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert q.exception() is None
    assert q.lastProgress is not None and q.lastProgress["numInputRows"] >= 0


def test_counts_stream_of_five_slices(spark):
    lines = src.ad_log_lines(spark, SF_SMALL)
    root = S.work_dir(spark, "test_counts_gen")
    t = KeyedTable(f"{root}/counts", ["date", *GRAIN], SA.counts_schema(GRAIN), ["date"])
    replay(lines, f"{root}/landing",
           [(lambda st: SA.counts_to_table(SA.parse_stream(st), t, GRAIN), f"{root}/ckpt")], slices=5)
    got = _rows(t.current(spark).select("date", *GRAIN, "n"))
    assert got == _rows(A.ad_click_counts(src.ad_log(spark, SF_SMALL)))


def test_increment_table_sums_and_replays(spark):
    root = S.work_dir(spark, "test_incr")
    schema = spark.createDataFrame([], "k string, n long").schema
    t = KeyedTable(f"{root}/t", ["k"], schema, merge="sum", sum_cols=["n"])
    t.write(spark.createDataFrame([("a", 1), ("b", 2)], schema), 0)
    t.write(spark.createDataFrame([("a", 3)], schema), 1)
    t.write(spark.createDataFrame([("a", 3)], schema), 1)       # retried: overwrites, no double add
    t.write(spark.createDataFrame([("b", 5)], schema), 2)
    assert sorted(map(tuple, t.current(spark).collect())) == [("a", 4), ("b", 7)]
    assert sorted(map(tuple, t.current(spark, before_epoch=1).collect())) == [("a", 1), ("b", 2)]


def test_per_event_filter_stream_equals_batch(spark):
    """Per-event stream filter = batch filter, for any slicing of an in-order log."""
    threshold = 3
    log = src.ad_log(spark, SF_SMALL)
    want = sorted(r.event_id for r in A.ad_blacklist_filter(log, threshold).collect())
    for slices in (2, 5):
        root = S.work_dir(spark, "test_filter_event")
        grain = ("adid", "userid")
        c = KeyedTable(f"{root}/c", ["date", *grain], SA.counts_schema(grain), ["date"], merge="sum",
                       sum_cols=["n"])
        b = KeyedTable(f"{root}/b", ["userid"], SA.BLACKLIST_SCHEMA)
        stats = replay(src.encode_ad_lines(log), f"{root}/landing", [
            (lambda st: SA.per_event_blacklist_filter(SA.parse_stream(st), c, b, f"{root}/adm", threshold),
             f"{root}/ckpt")], slices=slices)
        assert stats["input_rows"] == log.count()       # every batch is read once
        got = sorted(r.event_id for r in spark.read.parquet(f"{root}/adm").collect())
        assert got == want
        assert {r.userid for r in b.history(spark).collect()} == {r.userid for r in A.ad_blacklist(log, threshold).collect()}


def test_keyed_table_with_skipped_epochs(spark):
    """Batches that write nothing leave reads correct."""
    root = S.work_dir(spark, "test_keyed_skip")
    schema = spark.createDataFrame([], "k string, n long").schema
    t = KeyedTable(f"{root}/t", ["k"], schema, merge="sum", sum_cols=["n"])
    t.write(spark.createDataFrame([("a", 1)], schema), 0)
    # epoch 1 wrote nothing
    t.write(spark.createDataFrame([("a", 2), ("b", 1)], schema), 2)
    assert sorted(map(tuple, t.current(spark, before_epoch=3).collect())) == [("a", 3), ("b", 1)]
    t.write(spark.createDataFrame([("b", 4)], schema), 3)
    t.write(spark.createDataFrame([("a", 10)], schema), 4)
    assert sorted(map(tuple, t.current(spark, before_epoch=5).collect())) == [("a", 13), ("b", 5)]
    assert sorted(map(tuple, t.current(spark).collect())) == [("a", 13), ("b", 5)]


def test_a_schema_error_is_not_an_empty_table(spark):
    import pytest
    from pyspark.errors import PySparkException

    root = S.work_dir(spark, "test_keyed_error")
    t = KeyedTable(f"{root}/t", ["k"], spark.createDataFrame([], "k string, v long").schema)
    t.write(spark.createDataFrame([("a", 1)], "k string, v long"), 0)
    t.partition_by = []
    t.schema = spark.createDataFrame([], "k string, v long, V int").schema      # ambiguous
    with pytest.raises(PySparkException):
        t.current(spark, before_epoch=1).collect()


def test_pinned_list_epoch_survives_later_listings(spark):
    root = S.work_dir(spark, "test_keyed_pinned")
    b = KeyedTable(f"{root}/b", ["userid"], SA.BLACKLIST_SCHEMA)
    assert b.pinned(spark, f"{root}/mark0") == -1
    b.write(spark.createDataFrame([("u", 0)], SA.BLACKLIST_SCHEMA), 0)
    assert b.pinned(spark, f"{root}/mark1") == 0
    b.write(spark.createDataFrame([("w", 1)], SA.BLACKLIST_SCHEMA), 1)
    assert b.pinned(spark, f"{root}/mark1") == 0 and b.pinned(spark, f"{root}/mark0") == -1
    assert b.pinned(spark, f"{root}/mark2") == 1


def test_increments_lose_no_late_event(spark):
    """Clicks that arrive days late are counted: increments drop nothing."""
    log = src.ad_log(spark, SF_SMALL)
    first = [r.event_id for r in log.orderBy("event_id").limit(5).collect()]
    hi = log.agg(F.max("event_id")).first()[0]
    late = src.encode_ad_lines(log).withColumn(
        "slot", F.when(F.col("event_id").isin(first), F.lit(hi)).otherwise(F.col("event_id")))
    root = S.work_dir(spark, "test_late_increments")
    t = KeyedTable(f"{root}/c", ["date", *GRAIN], SA.counts_schema(GRAIN), ["date"], merge="sum", sum_cols=["n"])
    replay(late, f"{root}/landing", [(lambda st: SA.increments_to_table(SA.parse_stream(st), t, GRAIN), f"{root}/ckpt")],
           slices=4, order_col="slot")
    assert _rows(t.current(spark).select("date", *GRAIN, "n")) == _rows(A.ad_click_counts(log))


def _latest_upserts(t, spark, batches, schema):
    seen = {}
    for e, rows in enumerate(batches):
        t.write(spark.createDataFrame(rows, schema), e)
        seen.update(dict(rows))
        assert _rows(t.current(spark, before_epoch=e + 1)) == sorted(seen.items())
    return seen


def test_keyed_table_keeps_the_latest_row(spark):
    root = S.work_dir(spark, "test_keyed_latest")
    schema = "k string, v long"
    t = KeyedTable(f"{root}/t", ["k"], spark.createDataFrame([], schema).schema)
    assert _rows(t.current(spark)) == []
    seen = _latest_upserts(t, spark, [[("a", 1), ("b", 1)], [("a", 2)], [("c", 3)], [("b", 4), ("c", None)]], schema)
    assert _rows(t.current(spark, before_epoch=2)) == [("a", 2), ("b", 1)] and seen["b"] == 4


def _listing(spark, log, threshold, slices):
    root = S.work_dir(spark, "test_listing")
    replay(src.encode_ad_lines(log), f"{root}/landing", [
        (lambda st: SA.to_files(L.admitted(SA.parse_stream(st), threshold), f"{root}/out"), f"{root}/ckpt")],
        slices=slices, settings=L.STATE_STORE)
    return spark.read.parquet(f"{root}/out"), L.listed_users(spark, f"{root}/ckpt")


def test_stateful_listing_of_a_hot_user(spark):
    """One user with a third of all clicks, in ties of time; in one batch and in several with restarts between."""
    import datetime as dt

    from .helpers import ad_df, ad_row

    t0 = dt.datetime(2024, 1, 1, 10)
    rows = [ad_row(i, t0 + dt.timedelta(hours=i // 40), userid="hot" if i % 3 == 0 else str(i % 11), adid=str(i % 4)) for i in range(240)]
    log = ad_df(spark, rows)
    for threshold, slices in ((5, 1), (5, 3), (1, 2), (500, 2)):
        out, listed = _listing(spark, log, threshold, slices)
        want = A.ad_blacklist_filter(log, threshold)
        assert sorted(r.event_id for r in out.collect()) == sorted(r.event_id for r in want.collect())
        crossing = {r.userid: r.cross_event_id for r in A.ad_blacklist_crossings(log, threshold).collect()}
        assert dict(map(tuple, listed.collect())) == crossing
        assert {r.userid: r.event_id for r in out.where("lists_user").collect()} == crossing


def test_anti_join_with_a_fixed_list_is_a_streaming_join(spark):
    root = S.work_dir(spark, "test_anti")
    src.ad_log_lines(spark, SF_SMALL).write.parquet(f"{root}/landing")
    from clickflow.streaming.replay import landing_stream

    listed = spark.createDataFrame([("5",), ("8",)], "userid string")
    df = L.against_list(SA.parse_stream(landing_stream(spark, f"{root}/landing")), listed)
    assert df.isStreaming and "LeftAnti" in df._jdf.queryExecution().analyzed().toString()
    q = SA.to_files(df, f"{root}/out").option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    want = src.ad_log(spark, SF_SMALL).where("userid NOT IN ('5', '8')").count()
    assert spark.read.parquet(f"{root}/out").count() == want


def test_late_clicks_count_without_a_delay(spark):
    """The same late log that a watermark would cut is counted whole, and the progress reports no dropped row."""
    log = src.ad_log(spark, SF_SMALL)
    hi = log.agg(F.max("event_id")).first()[0]
    late = src.encode_ad_lines(log).withColumn("slot", F.when(F.col("event_id") % 5 == 0, F.lit(hi)).otherwise(F.col("event_id")))
    stats = {}
    assert _rows(_counts_via_stream(spark, late, 3, order_col="slot", delay=None, stats=stats)) == _rows(A.ad_click_counts(log))
    assert stats["dropped_by_watermark"] == 0


def test_processing_time_run_ends_when_idle(spark):
    root = S.work_dir(spark, "test_live")
    lines = src.ad_log_lines(spark, SF_SMALL)
    t = KeyedTable(f"{root}/counts", ["date", *GRAIN], SA.counts_schema(GRAIN), ["date"])
    seen = replay_live(lines, f"{root}/landing", lambda st: SA.counts_to_table(SA.parse_stream(st), t, GRAIN),
                       f"{root}/ckpt", runs=2, files=4, files_per_batch=1, interval="200 milliseconds")
    total = lines.count()
    # each run reads its own slice only, file by file
    assert [x["batches"] for x in seen] == [4, 4] and sum(x["input_rows"] for x in seen) == total
    assert max(x["largest"] for x in seen) < total / 4
    assert not spark.streams.active
    assert _rows(t.current(spark).select("date", *GRAIN, "n")) == _rows(A.ad_click_counts(src.ad_log(spark, SF_SMALL)))


def test_processing_time_run_raises_what_the_query_raises(spark):
    root = S.work_dir(spark, "test_live_fails")
    lines = src.ad_log_lines(spark, SF_SMALL)
    t = FailsAfterWrite(f"{root}/counts", ["date", *GRAIN], SA.counts_schema(GRAIN), ["date"])

    with pytest.raises(StreamingQueryException):
        replay_live(lines, f"{root}/landing", lambda st: SA.counts_to_table(SA.parse_stream(st), t, GRAIN),
                    f"{root}/ckpt", runs=1, files=2, files_per_batch=2, interval="200 milliseconds")
    assert not spark.streams.active
    # the lost batch is made again from the checkpoint
    SA.run_until_idle(SA.counts_to_table(SA.parse_stream(landing_stream(spark, f"{root}/landing")), t, GRAIN),
                      spark, f"{root}/ckpt", "200 milliseconds", reports=1)
    assert _rows(t.current(spark).select("date", *GRAIN, "n")) == _rows(A.ad_click_counts(src.ad_log(spark, SF_SMALL)))


class _Held:
    """A processor's state, held here and counting each call to it."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def _called(self, found=None):
        self.calls += 1
        return found

    def getMapState(self, *_):
        return self

    def getValueState(self, *_):
        self.listed = _Held()
        return self.listed

    def containsKey(self, key):
        return self._called(key in self.held)

    def getValue(self, key):
        return self._called(self.held[key])

    def updateValue(self, key, value):
        self._called(self.held.update({key: value}))

    def clear(self):
        self._called(self.held.clear())

    def exists(self):
        return self._called(bool(self.held))

    def update(self, value):
        self._called(self.held.update({(): value}))


class _Clock:
    now = 0

    def getCurrentProcessingTimeInMs(self):
        return self.now


def _given(processor, clicks, clock=None):
    rows = (Row(event_id=i, at=at, date=date, adid=adid, userid="u") for i, at, date, adid in clicks)
    return [(r.event_id, r.lists_user) for r in processor.handleInputRows(("u",), rows, clock)]


def test_listing_calls_the_state_by_month_and_lets_late_clicks_go():
    days = [f"2024-{m:02d}-{d:02d}" for m in (1, 2) for d in range(1, 29)]
    state, processor = _Held(), L.Listing(3, None)
    processor.init(state)
    cells = [(day, str(ad)) for day in days for ad in range(6)]
    for part in (0, 1):                                         # twice each of 336 (day, ad)
        clicks = [(i, i, *cell) for i, cell in enumerate(cells, part * len(cells))]
        assert _given(processor, clicks) == [(i, False) for i, *_ in clicks]
    assert state.calls + state.listed.calls <= 2 * (1 + 3 * 2)  # before: three calls a (day, ad)
    # the third click of a (day, ad), among many later ones in any order
    many = [(10_000 + (7 * i) % 50_021, 10_000 + (7 * i) % 50_021, *cells[i % 9]) for i in range(50_021)]
    assert _given(processor, many) == [(10_000, True)]
    assert not state.held and state.listed.held == {(): (10_000,)}
    assert _given(processor, many) == []


def test_listing_counts_expire_each_by_its_own_last_click():
    state, processor, clock = _Held(), L.Listing(3, 1000), _Clock()
    processor.init(state)
    assert len(_given(processor, [(1, 1, "2024-01-01", "a"), (2, 2, "2024-01-01", "a"), (3, 3, "2024-01-02", "a")], clock)) == 3
    clock.now = 600
    assert len(_given(processor, [(4, 4, "2024-01-02", "a")], clock)) == 1
    clock.now = 1000                                            # the first day's two clicks are gone, the second day's stay
    assert _given(processor, [(5, 5, "2024-01-01", "a"), (6, 6, "2024-01-02", "a"), (7, 7, "2024-01-01", "a")], clock) == [
        (5, False), (6, True)]


def test_listing_takes_clicks_without_id_or_ad():
    processor = L.Listing(3, None)
    processor.init(_Held())
    assert _given(processor, [(None, 1, "2024-01-01", None), (5, 1, "2024-01-01", None), (6, 2, "2024-01-01", None)]) == [
        (5, False), (None, False), (6, True)]
