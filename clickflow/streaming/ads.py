"""Structured Streaming forms of the ad-log analyses (Q5-Q8).

Running counts are kept for ever unless a watermark ``delay`` is given, as the reference keeps them: no click is
late, and the state is as large as the result, a row per (day, key). With a delay they group by an event-time
window (1 day), state of closed days is evicted, and clicks behind the watermark are dropped and counted in the
query's progress; ``increments_to_table`` has neither state nor loss. The trend needs its delay (a bucket is
emitted once, when it is closed). Results go through ``foreachBatch`` into :class:`~clickflow.streaming.keyed.KeyedTable` folders (replay
safe) or through the exactly-once file sink.
"""

from __future__ import annotations

import threading

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from ..functions import day_of, floor_time, time_text
from ..operators.ads import BLACKLIST_THRESHOLD, TOP_ADS, rank_top_ads
from ..sources.adlog import decode_ad_lines, parsed_ad_log
from .keyed import KeyedTable
from .listing import running_counts

DEFAULT_DELAY = "10 minutes"


MAX_LISTED_DAYS = 64


def in_days_of(table: DataFrame, rows: DataFrame) -> DataFrame:
    """``table`` where ``date`` is between the days of ``rows``, and one of them where they are few:
    at most ``MAX_LISTED_DAYS`` + 1 values and two bounds reach the driver. It only prunes folders;
    a join with ``rows`` decides."""
    days = [r.date for r in rows.select("date").distinct().limit(MAX_LISTED_DAYS + 1).collect()]
    if len(days) <= MAX_LISTED_DAYS:
        return table.where(F.col("date").isin(days) if days else F.lit(False))
    lo, hi = rows.agg(F.min("date"), F.max("date")).first()
    return table.where(F.col("date").between(lo, hi))


def parse_stream(lines: DataFrame) -> DataFrame:
    """Decoded good lines of a stream of wire lines (bad lines are dropped here; see
    :func:`decoded_to_files` to keep them)."""
    return parsed_ad_log(lines)


def day_counts(parsed: DataFrame, grain, delay: str | None = None) -> DataFrame:
    """Running clicks per (day, *grain). With a ``delay``, grouping on the day *window* of the event time (not
    on a date string) lets the watermark evict a day's state once the day is closed."""
    if delay is None:
        return running_counts(parsed, grain)
    agg = (parsed.withWatermark("ts", delay)
                 .groupBy(F.window("ts", "1 day").alias("day"), *grain)
                 .agg(F.count(F.lit(1)).alias("n")))
    return agg.select(day_of(F.col("day.start")).alias("date"), *grain, "n")


def counts_schema(grain) -> T.StructType:
    return T.StructType([T.StructField("date", T.StringType()),
                         *[T.StructField(g, T.StringType()) for g in grain],
                         T.StructField("n", T.LongType())])


def counts_to_table(parsed: DataFrame, table: KeyedTable, grain, delay: str | None = None) -> DataStreamWriter:
    """Running counts, written as keyed upserts (update mode: each batch writes the keys it
    changed, with their new totals)."""
    return (day_counts(parsed, grain, delay).writeStream.outputMode("update")
            .foreachBatch(lambda df, epoch_id: table.write(df, epoch_id)))


def increments_to_table(parsed: DataFrame, table: KeyedTable, grain) -> DataStreamWriter:
    """Per-batch counts per (date, *grain) written as increments (``merge="sum"`` table): the
    reference's per-batch count added to an external counter, without a state store. Each
    batch's counts are aggregated map-side before its shuffle; nothing is ever late, since a
    batch only adds its own rows; a retried batch overwrites its own increment."""

    def on_batch(df: DataFrame, epoch_id: int) -> None:
        table.write(df.groupBy("date", *grain).agg(F.count(F.lit(1)).alias("n")), epoch_id)

    return parsed.writeStream.outputMode("append").foreachBatch(on_batch)


def top_ads_to_tables(parsed: DataFrame, counts: KeyedTable, top: KeyedTable, k: int = TOP_ADS,
                      delay: str | None = None) -> DataStreamWriter:
    """Top ``k`` ads per (day, area) on running totals.

    A streaming query cannot rank or aggregate twice, so each micro-batch (1) upserts the
    changed (day, area, ad) totals, then (2) re-ranks only the (day, area) groups this batch
    touched, reading their current totals back from the written table (only the touched days'
    folders, see :func:`in_days_of`)."""

    def on_batch(df: DataFrame, epoch_id: int) -> None:
        spark = df.sparkSession
        counts.write(df, epoch_id)
        written = spark.read.schema(counts.schema).parquet(counts.epoch_path(epoch_id))
        touched = written.select("date", "area").distinct()
        cur = (in_days_of(counts.current(spark, before_epoch=epoch_id + 1), touched)
               .join(touched, ["date", "area"], "left_semi"))
        ranked = rank_top_ads(cur, k)
        folded = ranked.groupBy("date", "area").agg(
            F.array_sort(F.collect_list(F.struct("rank", "adid", "n"))).alias("top"))
        top.write(folded, epoch_id)

    return (day_counts(parsed, ("area", "adid"), delay).writeStream.outputMode("update")
            .foreachBatch(on_batch))


TOP_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()), T.StructField("area", T.StringType()),
    T.StructField("top", T.ArrayType(T.StructType([
        T.StructField("rank", T.LongType()), T.StructField("adid", T.StringType()),
        T.StructField("n", T.LongType())]))),
])


def top_ads_rows(top: KeyedTable, spark) -> DataFrame:
    """(date, area, rank, adid, n) from the current top table."""
    cur = top.current(spark)
    return cur.select("date", "area", F.inline("top")).select("date", "area", "rank", "adid", "n")


BLACKLIST_SCHEMA = T.StructType([T.StructField("userid", T.StringType()),
                                 T.StructField("listed_epoch", T.LongType())])


def blacklist_to_table(parsed: DataFrame, table: KeyedTable, threshold: int = BLACKLIST_THRESHOLD,
                       delay: str | None = None) -> DataStreamWriter:
    """Users whose running count on one (day, ad) reaches ``threshold``; a listing is permanent.

    Each batch appends the users it newly lists (anti-join with the users listed by earlier
    epochs, so a retried batch writes the same rows). The counts are the query's state, the list itself is
    kept in the table and read back in every batch; :func:`~clickflow.streaming.listing.admitted` keeps both
    in the state store."""

    def on_batch(df: DataFrame, epoch_id: int) -> None:
        spark = df.sparkSession
        hit = df.where(F.col("n") >= int(threshold)).select("userid").distinct()
        known = table.history(spark, before_epoch=epoch_id).select("userid")
        new = hit.join(known, "userid", "left_anti").withColumn("listed_epoch", F.lit(int(epoch_id)).cast("bigint"))
        table.write(new, epoch_id)

    return (day_counts(parsed, ("adid", "userid"), delay).writeStream.outputMode("update")
            .foreachBatch(on_batch))


def admitted_to_folder(parsed: DataFrame, blacklist: KeyedTable, folder: str) -> DataStreamWriter:
    """Events not from listed users, checked once per micro-batch against the blacklist as
    written so far (the reference's per-batch semantics: a user's clicks in the batch that
    lists them are still admitted). The list's last epoch is recorded before a batch's first
    attempt reads it, so a retried batch sees the same list."""

    def on_batch(df: DataFrame, epoch_id: int) -> None:
        spark = df.sparkSession
        last = blacklist.pinned(spark, f"{folder}/_list/epoch={int(epoch_id)}")
        known = blacklist.history(spark, before_epoch=last + 1).select("userid")
        (df.join(known, "userid", "left_anti")
           .write.mode("overwrite").parquet(f"{folder}/epoch={int(epoch_id)}"))

    return parsed.writeStream.outputMode("append").foreachBatch(on_batch)


def per_event_blacklist_filter(parsed: DataFrame, counts: KeyedTable, blacklist: KeyedTable, folder: str,
                               threshold: int = BLACKLIST_THRESHOLD) -> DataStreamWriter:
    """Admitted events decided per event, as the batch :func:`~clickflow.operators.ads.ad_blacklist_filter`:
    a user's clicks pass up to and including the one that lists them.

    Per micro-batch, with no state store: the batch is kept while it is worked on, so its source
    is read once. ``counts`` (a ``merge="sum"`` table of clicks per (day, ad, user)) gives the
    clicks before this batch, reduced to the batch's own groups before they are summed; the
    batch's counts show which groups cross ``threshold`` now, and only their clicks are numbered
    by the skew-proof :func:`~clickflow.operators.sequence.with_position`; the click whose running
    total reaches ``threshold`` lists its user. A user's events pass unless the user was listed
    by an earlier batch or the event comes after the user's first crossing in this batch. All that
    is written is a function of the batch and of earlier epochs, so a retry writes the same. Equal
    to the batch result when batches arrive in event-time order."""
    from ..operators.sequence import with_position

    keys = ["date", "adid", "userid"]

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        df = batch.persist()
        kept = [df]

        def held(part: DataFrame, _name: str) -> DataFrame:
            """A part of the batch that is read twice, kept on the executors until the batch is done."""
            kept.append(part.persist(StorageLevel.DISK_ONLY))
            return kept[-1]

        try:
            counts.write(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), epoch_id)
            own = counts.written(spark, epoch_id)
            earlier = in_days_of(counts.history(spark, before_epoch=epoch_id), own).join(
                own.select(*keys), keys, "left_semi")
            prior = earlier.groupBy(*keys).agg(F.sum("n").alias("_prior"))
            before = F.coalesce(F.col("_prior"), F.lit(0))
            crossing = held(own.join(prior, keys, "left")
                               .where((before < int(threshold)) & (before + F.col("n") >= int(threshold)))
                               .select(*keys, before.alias("_before")), "stream-crossing")
            clicks = held(df.select("event_id", "ts", *keys).join(crossing, keys), "stream-clicks")
            hits = (with_position(clicks, keys, "ts", "event_id", name="_step")
                    .where(F.col("_before") + F.col("_step") == int(threshold)))
            first = Window.partitionBy("userid").orderBy("ts", "event_id")
            cross = (hits.withColumn("_f", F.row_number().over(first)).where(F.col("_f") == 1)
                         .select("userid", F.col("ts").alias("_cts"), F.col("event_id").alias("_cid")))
            cross = held(cross, "stream-crossings")       # read twice below
            listed = blacklist.history(spark, before_epoch=epoch_id).select("userid")
            keep = (F.col("_cts").isNull()
                    | (F.struct("ts", "event_id") <= F.struct(F.col("_cts").alias("ts"), F.col("_cid").alias("event_id"))))
            admitted = (df.join(listed, "userid", "left_anti").join(cross, "userid", "left")
                          .where(keep).drop("_cts", "_cid"))
            admitted.write.mode("overwrite").parquet(f"{folder}/epoch={int(epoch_id)}")
            new = (cross.select("userid").join(listed, "userid", "left_anti")
                        .withColumn("listed_epoch", F.lit(int(epoch_id)).cast("bigint")))
            blacklist.write(new, epoch_id)
        finally:
            for part in kept:
                part.unpersist()

    return parsed.writeStream.outputMode("append").foreachBatch(on_batch)


def trend_stream(parsed: DataFrame, window_seconds: int = 60, slide_seconds: int = 10,
                 delay: str = DEFAULT_DELAY) -> DataFrame:
    """Clicks per ``slide_seconds`` bucket inside each sliding event-time window.

    State holds one row per bucket (a tumbling window). In append mode a bucket is emitted once
    the watermark passes its end; its row, not its events, is then copied into the
    ``window_seconds / slide_seconds`` windows that contain it, as in the batch form."""
    if window_seconds % slide_seconds:
        raise ValueError("window_seconds must be a multiple of slide_seconds")
    agg = (parsed.withWatermark("ts", delay)
                 .groupBy(F.window("ts", f"{int(slide_seconds)} seconds").alias("w"))
                 .agg(F.count(F.lit(1)).alias("n")))
    copies = F.explode(F.sequence(F.lit(0), F.lit(window_seconds // slide_seconds - 1))).alias("_i")
    b = F.col("_b")
    return (agg.select(F.col("w.start").alias("_b"), "n", copies)
               .select(time_text(b - F.make_interval(secs=F.col("_i") * slide_seconds)).alias("window_start"),
                       time_text(b).alias("bucket"), "n"))


def trend_sorted_to_folder(parsed: DataFrame, folder: str, bucket_seconds: int = 10) -> DataStreamWriter:
    """The whole trend so far after every batch, in order: (batch, position, bucket, n) rows, one folder per
    batch. Complete mode: the state is a row per bucket, and each batch ranks all of them (the reference's
    sorted print of its window state)."""
    buckets = parsed.groupBy(floor_time(F.col("ts"), bucket_seconds).alias("_b")).agg(F.count(F.lit(1)).alias("n"))

    def on_batch(df: DataFrame, epoch_id: int) -> None:
        # a bucket's place is its rank among all: positions within a day, and days before it
        day = F.to_date("_b").alias("_day")
        rows = df.select("_b", "n", day)
        days = rows.groupBy("_day").agg(F.count(F.lit(1)).alias("_size"))
        before = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
        days = days.select("_day", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
        place = F.row_number().over(Window.partitionBy("_day").orderBy("_b"))
        out = rows.withColumn("_place", place).join(days, "_day")
        out = out.select((F.col("_before") + F.col("_place")).cast("bigint").alias("position"), time_text("_b").alias("bucket"), "n")
        out.orderBy("position").write.mode("overwrite").parquet(f"{folder}/batch={int(epoch_id)}")

    return buckets.writeStream.outputMode("complete").foreachBatch(on_batch)


def to_console_sorted(df: DataFrame, order: list[str], rows: int = 20, mode: str = "append") -> DataStreamWriter:
    """Print each micro-batch's result sorted by ``order`` (at most ``rows`` rows reach the
    driver per batch): the reference's sorted per-batch print of the trend."""

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        batch.orderBy(*order).show(rows, truncate=False)

    return df.writeStream.outputMode(mode).foreachBatch(on_batch)


def start(writer: DataStreamWriter, checkpoint: str, interval: str = "5 seconds",
          name: str | None = None):
    """Start a long-running query: micro-batches every ``interval`` (the reference's 5 s batch
    interval), offsets and state in ``checkpoint`` (a shared, durable folder)."""
    w = writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval)
    if name:
        w = w.queryName(name)
    return w.start()


class _Watch(StreamingQueryListener):
    """What each query of the session has read, how often in a row it has reported itself idle (a trigger that
    found no new data, at most one report each ``spark.sql.streaming.noDataProgressEventInterval``), and
    whether it has ended."""

    def __init__(self):
        self.changed = threading.Condition()
        self.seen: dict[str, dict] = {}

    def of(self, query_id) -> dict:
        return self.seen.setdefault(str(query_id), {"batches": 0, "input_rows": 0, "largest": 0, "idle": 0, "ended": False})

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        rows = event.progress.numInputRows
        with self.changed:
            got = self.of(event.progress.id)
            got.update(batches=got["batches"] + (rows > 0), input_rows=got["input_rows"] + rows,
                       largest=max(got["largest"], rows), idle=0)

    def onQueryIdle(self, event) -> None:
        with self.changed:
            self.of(event.id)["idle"] += 1
            self.changed.notify_all()

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.of(event.id)["ended"] = True
            self.changed.notify_all()


def run_until_idle(writer: DataStreamWriter, spark: SparkSession, checkpoint: str, interval: str = "5 seconds",
                   reports: int = 2, timeout_s: float = 900, name: str | None = None) -> dict[str, int]:
    """Run a query on its processing-time trigger, as :func:`start`, and stop it once its source has brought
    nothing new for ``reports`` idle reports in a row. Bound the intake at the source (``maxFilesPerTrigger``).
    All batches are committed by then, and a later run goes on from ``checkpoint``. An error of the query is
    raised; so is a run that is not idle after ``timeout_s``, which is stopped between two batches or inside
    one (its checkpoint holds either way). Returns the batches with data, their rows, and the largest's."""
    watch = _Watch()
    spark.streams.addListener(watch)
    try:
        query = start(writer, checkpoint, interval, name)
        with watch.changed:
            got = watch.of(query.id)
            done = watch.changed.wait_for(lambda: got["ended"] or got["idle"] >= reports, timeout_s)
        query.stop()
        if query.exception() is not None:
            raise query.exception()
        if not done:
            raise TimeoutError(f"stream over {checkpoint} was not idle within {timeout_s}s")
        return {k: got[k] for k in ("batches", "input_rows", "largest")}
    finally:
        spark.streams.removeListener(watch)


def to_files(df: DataFrame, folder: str, mode: str = "append") -> DataStreamWriter:
    """Exactly-once parquet file sink (the sink's own log records committed files)."""
    return df.writeStream.outputMode(mode).format("parquet").option("path", folder)


def decoded_to_files(lines: DataFrame, folder: str) -> DataStreamWriter:
    """Every decoded line, good and bad (``reject_reason``), to a parquet file sink."""
    return to_files(decode_ad_lines(lines).drop("ts"), folder)
