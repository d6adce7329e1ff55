"""Sinks: managed tables and relational databases (batch). Stream sinks are in
:mod:`clickflow.streaming`."""

from __future__ import annotations

from pyspark.sql import DataFrame


def replace_table(df: DataFrame, name: str, path: str | None = None, partition_by: list[str] | None = None) -> None:
    """Replace table ``name`` with ``df`` (parquet). With ``path`` the table's files live there
    (an external table in a shared folder) rather than in the session's warehouse."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def session_table(actions: DataFrame, name: str, path: str | None = None, buckets: int = 200) -> None:
    """Store visit actions by session: each of ``buckets`` files holds whole sessions, sorted as they are read.
    The session-order operators then plan without an exchange (with ``split=None``: a session is in one file,
    so one with too many actions for a task is better left unbucketed and split)."""
    w = (actions.repartition(int(buckets), "session_id").write.mode("overwrite").format("parquet")
         .bucketBy(int(buckets), "session_id").sortBy("session_id", "action_time", "event_id"))
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "append", batch_size: int = 1000, num_partitions: int | None = None) -> None:
    """Insert ``df`` into a relational table: every task writes its partition over one
    connection in batches of ``batch_size`` rows; ``num_partitions`` caps concurrent
    connections (a shuffle, so the stage before keeps its own parallelism). Not exercised here: it needs a database server, and none is started."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    if num_partitions:
        df = df.repartition(int(num_partitions))
    df.write.jdbc(url, table, mode=mode, properties=props)


def with_task_id(df: DataFrame, task_id: str | None = None, name: str = "task_id") -> DataFrame:
    """Prefix result records with the run id they were produced by (a fresh UUID by default),
    the shape the reference's relational sinks insert."""
    import uuid

    from pyspark.sql import functions as F

    tid = task_id or str(uuid.uuid4())
    return df.select(F.lit(tid).alias(name), *df.columns)
