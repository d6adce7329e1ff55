"""Results of micro-batches as plain parquet folders, one ``epoch=<id>`` folder per batch, overwritten when a
batch is retried (no double counting, unlike an external increment). Readers take, per key, the row of the
highest epoch (upserts) or the sum over all epochs (increments). What a stream has to remember is the state
store's business (:mod:`clickflow.streaming.listing`); a table here only grows by what its batches write.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = "epoch"


class KeyedTable:
    """``merge="latest"``: a batch's row replaces earlier rows of its key. ``merge="sum"``: a batch's rows are
    increments; a key's value is the sum of the ``sum_cols`` over all batches. ``partition_by``: a folder
    layout inside each epoch (by day, say) that readers can prune."""

    def __init__(self, path: str, keys: list[str], schema: T.StructType, partition_by: list[str] | None = None,
                 merge: str = "latest", sum_cols: list[str] | None = None):
        if merge not in ("latest", "sum"):
            raise ValueError(f"unknown merge {merge!r}")
        self.path, self.keys, self.schema, self.merge = path.rstrip("/"), list(keys), schema, merge
        self.sum_cols, self.partition_by = list(sum_cols or []), list(partition_by or [])

    def epoch_path(self, epoch_id: int) -> str:
        return f"{self.path}/{EPOCH}={int(epoch_id)}"

    def write(self, df: DataFrame, epoch_id: int) -> None:
        """Overwrite this batch's folder with ``df`` (keys + values)."""
        df.write.mode("overwrite").partitionBy(*self.partition_by).parquet(self.epoch_path(epoch_id))

    def written(self, spark: SparkSession, epoch_id: int) -> DataFrame:
        """The rows that batch ``epoch_id`` wrote."""
        return spark.read.schema(self.schema).parquet(self.epoch_path(epoch_id))

    def history(self, spark: SparkSession, before_epoch: int | None = None) -> DataFrame:
        """All batches' rows with their ``epoch``, optionally only of epochs before ``before_epoch``."""
        # explicit types: folder names such as date=2024-01-05 must stay text
        schema = T.StructType([*self.schema.fields, T.StructField(EPOCH, T.LongType())])
        try:
            df = spark.read.schema(schema).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)
        return df if before_epoch is None else df.where(F.col(EPOCH) < int(before_epoch))

    def current(self, spark: SparkSession, before_epoch: int | None = None) -> DataFrame:
        """Value per key: of the latest epoch, or the sum of the increments; both by one hash aggregate with
        partial aggregation."""
        df = self.history(spark, before_epoch)
        if self.merge == "sum":
            agg = [F.sum(c).cast("bigint").alias(c) for c in self.sum_cols]
        else:
            agg = [F.max_by(f.name, EPOCH).alias(f.name) for f in self.schema.fields if f.name not in self.keys]
        return df.groupBy(*self.keys).agg(*agg).select(*[f.name for f in self.schema.fields])

    def pinned(self, spark: SparkSession, mark: str) -> int:
        """The last epoch with rows so far (-1: none), recorded in folder ``mark`` the first time and read from
        there ever after."""
        schema = "last long"
        try:
            rows = spark.read.schema(schema).parquet(mark).collect()
            if rows:
                return rows[0][0]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        last = self.history(spark).agg(F.max(EPOCH)).first()[0]
        last = -1 if last is None else last
        spark.createDataFrame([(last,)], schema).coalesce(1).write.mode("overwrite").parquet(mark)
        return last
