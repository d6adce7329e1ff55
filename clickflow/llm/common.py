"""What the operators share: reading tables, written intermediate tables, whole texts as numpy bytes.

Texts reach Python tasks as Arrow batches. ``text_chunks`` cuts a batch into runs of whole texts of
a few MB, so that the numpy scratch of a task is bounded by the longest text, not by the batch.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.session import work_dir

CHUNK_BYTES = 2 << 20
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder."""
    python_path(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_path(spark: SparkSession) -> None:
    """Let this session's Python workers import the package from where the driver has it
    (on a cluster the package is installed on the executors)."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, have)])


def columns_but(df: DataFrame, *names: str) -> list[Column]:
    """The columns of ``df`` except those of the given names, in any case (as Spark compares them)."""
    gone = {n.lower() for n in names}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in gone]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder of ``spark.checkpoint.dir`` and read back: the lineage ends
    there, a lost executor takes nothing with it, and the planner knows the size."""
    path = work_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_text(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column as UTF-8 bytes; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary()).fill_null(b"")


def text_chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets) of runs of whole texts of about ``size`` bytes."""
    n = len(texts)
    if not n:
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        end = min(end, n)
        yield at, end, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end
