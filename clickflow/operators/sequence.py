"""Ordered-sequence operators over keyed groups (sessions), written to survive a hot key.

A plain ``lead(x) over (partition by session order by t)`` sends every row of a session to
one task; if one session held a third of all rows, one task would sort a third of the data.
Both operators below cut each group into pieces ``(group, piece)`` whose order follows the
sort order, then:

1. a window over ``(group, piece)`` does the per-row work inside each piece;
2. a few rows per piece carry the work across pieces: for ``with_next`` the piece's edge rows
   (first and last), for ``with_position`` its size (a partial hash aggregate);
3. a window over ``group`` runs on those per-piece rows only (a hot group costs one task a
   few rows per piece, not its row count): the row after a piece's last row is the next
   piece's first row, and a piece's offset is the running size of the earlier pieces;
4. ``with_next`` unions the rows finished in step 1 with the edge rows finished in step 3;
   ``with_position`` joins the offsets back (range split: one row per chunk, on the chunk
   id alone).

How groups are cut (``split``):

- ``"heavy"`` (default): groups of over ``heavy_rows`` rows are found by one partial aggregate (a row per
  group and task is moved) and written; these few keys divide the rows by a semi and an anti join. Rows of
  all other groups take one hash exchange and the plain window, whose groups are bounded then; rows of heavy
  groups alone take range chunks. Both branches are in every plan; the joins are null-safe, so rows with a
  null key are a group like any other.
- ``"range"``: range chunks, for all rows, of the full sort key
  ``(group, time, tie)``. The key is unique, so no value can be hot: any group, even one holding
  a third of all rows within one second, is cut into chunks of equal size. The chunked rows are
  written once to the shared folder and read back, which pins the chunk ids for all branches
  (they are partition indexes, and two evaluations of a range exchange sample different bounds)
  and cuts the lineage. ``CHUNKS_PER_TASK`` chunks go to each task, dealt by ranges of the chunk
  id, so tasks are as even as the chunks are: no hashing of a few large keys. That range
  partitioning also satisfies the window on ``(group, chunk)``. Unless ``chunks`` is given, heavy
  groups get as many as leave a task about ``heavy_rows`` rows, from the rows counted (one number read by
  the driver), two tasks at least, and not over ``CHUNKS_PER_TASK`` for each of ``spark.sql.shuffle.partitions``, the
  number for ``"range"`` itself.
- ``"time"``: fixed time buckets of ``bucket_seconds``; no sampling pass, but a burst of one
  group inside one bucket stays in one task.
- ``None``: the plain single window, kept for comparison in tests.

Results equal the plain window exactly (ties broken by ``tie_col``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_dir, written

DEFAULT_BUCKET_SECONDS = 300
DEFAULT_SPLIT = "heavy"
HEAVY_ROWS = 250_000
CHUNKS_PER_TASK = 4


def chunks_for(spark: SparkSession) -> int:
    """Chunks where the caller names no number: ``CHUNKS_PER_TASK`` for each shuffle partition."""
    return CHUNKS_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _bucket(time_col: str, bucket_seconds: int):
    """Start of the row's time bucket, in epoch micros (exact integer floor)."""
    m = F.unix_micros(F.col(time_col))
    return m - F.pmod(m, F.lit(int(bucket_seconds) * 1_000_000))


def _pieces(df: DataFrame, by: list[str], time_col: str, tie_col: str, split: str,
            bucket_seconds: int, chunks: int | None) -> DataFrame:
    """``df`` with a ``_tb`` piece id that is non-decreasing in ``(time, tie)`` within a group."""
    if split == "time":
        return df.withColumn("_tb", _bucket(time_col, bucket_seconds))
    if split == "range":
        spark = df.sparkSession
        cols = [*[F.col(c) for c in by], F.col(time_col), F.col(tie_col)]
        n = int(chunks) if chunks else chunks_for(spark)
        path = work_dir(spark, "sequence-chunks")
        df.repartitionByRange(n, *cols).withColumn("_tb", F.spark_partition_id().cast("bigint")).write.parquet(path)
        return spark.read.parquet(path).repartitionByRange(-(-n // CHUNKS_PER_TASK), "_tb")
    raise ValueError(f"unknown split {split!r}")


def _heavy_groups(df: DataFrame, by: list[str], rows: int) -> DataFrame:
    """The keys of groups of over ``rows`` rows, one row each, with columns ``_heavy_<key>`` and ``_heavy_n``, the
    group's rows; at most one for every ``rows`` rows of the input."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_heavy_n")).where(F.col("_heavy_n") > int(rows))
    return written(counts.select(*[F.col(c).alias("_heavy_" + c) for c in by], "_heavy_n"), "heavy-groups")


def _divided(df: DataFrame, by: list[str], rows: int) -> tuple[DataFrame, DataFrame, int]:
    """(rows of heavy groups, all other rows, chunks for the heavy groups)."""
    heavy = _heavy_groups(df, by, rows)
    total = heavy.agg(F.sum("_heavy_n")).first()[0] or 0
    wanted = -(-total * CHUNKS_PER_TASK // max(1, int(rows)))
    same = [F.col(c).eqNullSafe(F.col("_heavy_" + c)) for c in by]
    return (df.join(heavy, same, "left_semi"), df.join(heavy, same, "left_anti"),
            max(2 * CHUNKS_PER_TASK, min(wanted, chunks_for(df.sparkSession))))


def with_next(df: DataFrame, by: list[str], time_col: str, tie_col: str, carry: list[str],
              prefix: str = "next_", split: str | None = DEFAULT_SPLIT,
              bucket_seconds: int = DEFAULT_BUCKET_SECONDS, chunks: int | None = None,
              heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Add ``<prefix><c>`` for each ``c`` in ``carry``: the value of the following row of the
    same ``by`` group in ``(time_col, tie_col)`` order; null on a group's last row.
    ``tie_col`` must be non-null and unique (it completes the order and marks whether a next
    row exists).

    Rows whose successor is in their own piece are done after the first window. Only the edge
    rows of each piece (its first and last row, at most two per piece) go through a second
    window per group ordered by piece: there the row after a piece's last row is the first
    row of the group's next non-empty piece. The two parts are unioned, so the rows are never
    joined or shuffled again."""
    order = [F.col(time_col), F.col(tie_col)]
    if split is None:
        w = Window.partitionBy(*by).orderBy(*order)
        return df.select(*df.columns, *[F.lead(c).over(w).alias(prefix + c) for c in carry])
    if split == "heavy":
        heavy, light, enough = _divided(df, by, heavy_rows)
        given = (by, time_col, tie_col, carry, prefix)
        return with_next(light, *given, split=None).unionByName(
            with_next(heavy, *given, split="range", chunks=chunks or enough))
    keys = [*by, "_tb"]
    cols = list(dict.fromkeys([tie_col, *carry]))
    w = Window.partitionBy(*keys).orderBy(*order)
    # per-column leads inside each piece; no struct is built before any shuffle
    x = _pieces(df, by, time_col, tie_col, split, bucket_seconds, chunks).select(
        *df.columns, "_tb",
        *[F.lead(c).over(w).alias("_in_" + c) for c in cols],
        F.row_number().over(w).alias("_pos"))
    last_in_piece = F.col("_in_" + tie_col).isNull()
    inner = x.where(~last_in_piece).select(
        *df.columns, *[F.col("_in_" + c).alias(prefix + c) for c in carry])
    edges = x.where(last_in_piece | (F.col("_pos") == 1)).withColumn("_last", last_in_piece)
    across = Window.partitionBy(*by).orderBy("_tb", *order)
    lasts = (edges.select(*df.columns, "_last", *[F.lead(c).over(across).alias(prefix + c) for c in carry])
                  .where(F.col("_last")).drop("_last"))
    return inner.unionByName(lasts)


def with_position(df: DataFrame, by: list[str], time_col: str, tie_col: str, name: str = "step",
                  split: str | None = DEFAULT_SPLIT, bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                  chunks: int | None = None, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Add ``name``: the 1-based position of each row in its ``by`` group, ordered by
    ``(time_col, tie_col)`` (``row_number`` semantics)."""
    order = [F.col(time_col), F.col(tie_col)]
    if split is None:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("bigint"))
    if split == "heavy":
        heavy, light, enough = _divided(df, by, heavy_rows)
        given = (by, time_col, tie_col, name)
        return with_position(light, *given, split=None).unionByName(
            with_position(heavy, *given, split="range", chunks=chunks or enough))
    keys = [*by, "_tb"]
    p = _pieces(df, by, time_col, tie_col, split, bucket_seconds, chunks)
    x = p.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    sizes = p.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1)
    if split != "range":
        offsets = sizes.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
        return (x.join(offsets, on=keys, how="left")
                 .select(*df.columns, (F.col("_off") + F.col("_rn")).cast("bigint").alias(name)))
    # Range chunks are contiguous key ranges: a group that continues from earlier chunks is
    # the last group of each earlier chunk it touches and the first group of the chunk it
    # continues in. So only each chunk's first and last groups matter (at most two rows per
    # chunk), only a chunk's first group can have a non-zero offset, and the offsets come down
    # to one row per chunk, joined on the chunk id alone.
    grp = F.struct(*[F.col(c) for c in by])
    asc = Window.partitionBy("_tb").orderBy(*[F.col(c).asc() for c in by])
    desc = Window.partitionBy("_tb").orderBy(*[F.col(c).desc() for c in by])
    edges = (sizes.withColumn("_a", F.row_number().over(asc)).withColumn("_d", F.row_number().over(desc))
                  .where((F.col("_a") == 1) | (F.col("_d") == 1)))
    firsts = (edges.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
                   .where(F.col("_a") == 1)
                   .select("_tb", grp.alias("_fg"), "_off"))
    own = F.when(grp.eqNullSafe(F.col("_fg")), F.col("_off")).otherwise(F.lit(0))
    return (x.join(firsts, on="_tb", how="left")
             .select(*df.columns, (own + F.col("_rn")).cast("bigint").alias(name)))
