"""Stream sources for the ad log, and a replay harness for tests and benchmarks.

Production reads the log from a Kafka topic (:func:`kafka_ad_lines`). Tests replay the log
derived from the shipped tables instead: the lines are cut into ordered slices; each slice is
landed in a folder by its own write job and then consumed by one ``availableNow`` run of the
streaming query, which stops and restarts from its checkpoint before the next slice. So every
slice is one micro-batch, slices arrive in event order whatever the file times are, and every
run after the first exercises recovery from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from .. import schemas
from .ads import run_until_idle
from .keyed import KeyedTable


def kafka_ad_lines(spark: SparkSession, bootstrap_servers: str, topic: str = "ads_log",
                   starting_offsets: str = "latest") -> DataFrame:
    """Ad-log lines from a Kafka topic (needs the Kafka connector on the classpath, which
    this environment lacks). Offsets are tracked in the query checkpoint.

    ``event_id`` comes from the record's position, ``partition * 2^40 + offset``: unique within
    the topic (while a partition holds fewer than 2^40 records), which the ordering operators
    need as their tie-breaker."""
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", bootstrap_servers)
           .option("subscribe", topic)
           .option("startingOffsets", starting_offsets)
           .load())
    event_id = F.col("partition").cast("bigint") * F.lit(1 << 40) + F.col("offset")
    return raw.select(event_id.alias("event_id"), F.col("value").cast("string").alias("line"))


def landing_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Ad-log lines arriving as parquet files in ``folder``."""
    r = spark.readStream.schema(schemas.AD_LOG_LINE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(folder)


class FailsAfterWrite(KeyedTable):
    """A table that loses its batch the first time each epoch is written: the rows are there, the batch is not
    committed, and the query starts again from its checkpoint."""

    def write(self, df: DataFrame, epoch_id: int) -> None:
        super().write(df, epoch_id)
        lost = self.__dict__.setdefault("_lost", set())
        if epoch_id not in lost:
            lost.add(epoch_id)
            raise RuntimeError(f"planted failure after the write of epoch {epoch_id}")


def slice_bounds(df: DataFrame, order_col: str, slices: int) -> list[tuple[int, int]]:
    """``slices`` contiguous half-open ranges of ``order_col`` covering all rows (one
    aggregate row comes back to the driver)."""
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    if lo is None:
        return []
    step = max(1, -(-(hi - lo + 1) // slices))
    return [(lo + i * step, min(lo + (i + 1) * step, hi + 1)) for i in range(slices) if lo + i * step <= hi]


def replay(lines: DataFrame, folder: str,
           queries: list[tuple[Callable[[DataFrame], DataStreamWriter], str]], slices: int = 4,
           order_col: str = "event_id", timeout_s: float = 900, state_partitions: int | None = None,
           settings: dict[str, str] | None = None, failures: int = 0) -> dict:
    """Land ``lines`` in ``folder`` slice by slice. After each slice, run every query in
    ``queries`` - pairs of (builder given the stream DataFrame, checkpoint folder) - in the
    given order with ``availableNow``, each until it has consumed all landed files.

    A stateful query fixes its number of state partitions from ``spark.sql.shuffle.partitions``
    when its checkpoint is created; the replay starts its queries with ``state_partitions``
    (default: the cluster's default parallelism) and restores the session setting afterwards.
    So it does with ``settings``. A query that fails starts again from its checkpoint, ``failures`` times a
    slice at most. Returns run statistics summed over all micro-batches (see :func:`_add_progress`)."""
    spark = lines.sparkSession
    with _settings(spark, state_partitions, settings):
        return _replay_slices(lines, folder, queries, slices, order_col, timeout_s, failures)


@contextmanager
def _settings(spark: SparkSession, state_partitions: int | None, settings: dict[str, str] | None) -> Iterator[None]:
    """The session with the settings of a replay, which are put back at the end."""
    own = {"spark.sql.shuffle.partitions": str(int(state_partitions or spark.sparkContext.defaultParallelism)), **(settings or {})}
    saved = {key: spark.conf.get(key, None) for key in own}
    for key, value in own.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in saved.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def replay_live(lines: DataFrame, folder: str, start: Callable[[DataFrame], DataStreamWriter], checkpoint: str,
                runs: int = 2, files: int = 6, files_per_batch: int = 2, interval: str = "1 second",
                order_col: str = "event_id", timeout_s: float = 900, state_partitions: int | None = None) -> list[dict]:
    """The long-running form of :func:`replay`: ``lines`` land in ``runs`` slices of ``files`` files each, and
    after each one the query runs on its processing-time trigger, at most ``files_per_batch`` files a batch,
    until its source is idle; the next run goes on from the checkpoint. Returns what each run has read (see
    :func:`~clickflow.streaming.ads.run_until_idle`)."""
    spark = lines.sparkSession
    seen = []
    with _settings(spark, state_partitions, {"spark.sql.streaming.noDataProgressEventInterval": "1000"}):
        for lo, hi in slice_bounds(lines, order_col, runs):
            part = lines.where((F.col(order_col) >= lo) & (F.col(order_col) < hi))
            part.repartition(files, F.col(order_col)).write.mode("append").parquet(folder)
            stream = landing_stream(spark, folder, files_per_batch)
            seen.append(run_until_idle(start(stream), spark, checkpoint, interval, timeout_s=timeout_s))
    return seen


def _add_progress(stats: dict, progress: list[dict]) -> None:
    """Fold micro-batch progress reports into ``stats``: input rows, rows dropped by the
    watermark (counted after partial aggregation, so per group, not per event), batch time, and
    the sums of observed metrics."""
    for p in progress:
        stats["batches"] += 1
        stats["input_rows"] += int(p.get("numInputRows") or 0)
        stats["batch_ms"] += int((p.get("durationMs") or {}).get("triggerExecution") or 0)
        for row in (p.get("observedMetrics") or {}).values():
            for name, value in row.asDict().items():
                stats["observed"][name] = stats["observed"].get(name, 0) + int(value or 0)
        for op in p.get("stateOperators") or []:
            stats["dropped_by_watermark"] += int(op.get("numRowsDroppedByWatermark") or 0)


def _run(start, spark, folder: str, checkpoint: str, timeout_s: float):
    """One ``availableNow`` run of a query over all landed files; raises what the query raises."""
    q = (start(landing_stream(spark, folder)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    if not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream run over {folder} did not finish in {timeout_s}s")
    return q


def _replay_slices(lines, folder, queries, slices, order_col, timeout_s, failures) -> dict:
    spark = lines.sparkSession
    stats = {"observed": {}, "failed": 0, "slices": 0, "batches": 0, "input_rows": 0, "dropped_by_watermark": 0, "batch_ms": 0}
    for lo, hi in slice_bounds(lines, order_col, slices):
        lines.where((F.col(order_col) >= lo) & (F.col(order_col) < hi)).write.mode("append").parquet(folder)
        for start, checkpoint in queries:
            for left in range(failures, -1, -1):
                try:
                    q = _run(start, spark, folder, checkpoint, timeout_s)
                    break
                except StreamingQueryException:
                    if not left:
                        raise
                    stats["failed"] += 1
            _add_progress(stats, q.recentProgress)
        stats["slices"] += 1
    return stats
