"""Readers for the clickstream and ad-log data model.

The shipped test tables do not hold the reference tables themselves, so the two adapters
below derive them from ``events``, ``nation`` and ``region``. Operators only depend on the
schemas in :mod:`clickflow.schemas`, never on how an adapter built them; a deployment with
real ``user_visit_action`` / ad-log tables reads those instead (:func:`read_visit_actions`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import day_of


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _stored(spark: SparkSession, table: str | None, path: str | None) -> DataFrame:
    if (table is None) == (path is None):
        raise ValueError("give either a table name or a path")
    return spark.table(table) if table else spark.read.parquet(path)


def read_visit_actions(spark: SparkSession, path: str | None = None, table: str | None = None,
                       start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """A stored ``user_visit_action``: a catalog table or a parquet folder. Without an ``event_id``
    column the hash of the row takes its place: it only orders actions of one session and time, and
    rows that are equal in all columns are interchangeable."""
    df = visit_date_range(_stored(spark, table, path), start_date, end_date)
    if "event_id" not in df.columns:
        df = df.withColumn("event_id", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    return schemas.conform(df, schemas.VISIT_ACTION)


def read_ad_log(spark: SparkSession, path: str | None = None, table: str | None = None) -> DataFrame:
    """A stored ad log: a catalog table or a parquet folder of wire lines (``line``, perhaps
    ``event_id``) or of decoded records."""
    from .adlog import parsed_ad_log

    df = _stored(spark, table, path)
    if "event_id" not in df.columns:
        df = df.withColumn("event_id", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    if "line" in df.columns:
        df = parsed_ad_log(df.select("event_id", "line"))
    return schemas.conform(df, schemas.AD_LOG)


def _k(props: Column) -> Column:
    return F.regexp_extract(props, r"([0-9]+)", 1).cast("int")


def _bounds_filter(ts: Column, start_date: str | None, end_date: str | None) -> Column:
    """Inclusive day range on a raw timestamp, written so parquet can push it down."""
    cond = F.lit(True)
    if start_date is not None and str(start_date).strip():
        cond = cond & (ts >= F.to_timestamp_ntz(F.lit(str(start_date).strip())))
    if end_date is not None and str(end_date).strip():
        cond = cond & (ts < F.date_add(F.to_date(F.lit(str(end_date).strip())), 1).cast("timestamp_ntz"))
    return cond


def visit_actions(spark: SparkSession, sf_dir: str, start_date: str | None = None,
                  end_date: str | None = None) -> DataFrame:
    """``user_visit_action`` rows derived from ``events`` (mapping fixed in FIXTURES.md).

    ``start_date`` / ``end_date`` (inclusive, ``yyyy-MM-dd``, blank = open) are applied to the
    raw timestamp so the parquet scan prunes row groups.
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    ev = ev.where(_bounds_filter(F.col("ts"), start_date, end_date))
    k = F.col("k")
    ts = F.col("ts").cast("timestamp")
    date = day_of(ts)
    etype = F.col("event_type")
    eid = F.col("event_id")

    def pair(a: Column, b: Column) -> Column:
        return F.concat(a.cast("string"), F.lit(","), b.cast("string"))

    out = ev.withColumn("k", _k(F.col("props"))).select(
        eid.alias("event_id"),
        date.alias("date"),
        F.col("user_id"),
        F.concat(F.col("user_id").cast("string"), F.lit(":"), date).alias("session_id"),
        (F.lit(1) + k % 7).cast("bigint").alias("page_id"),
        F.date_trunc("second", ts).alias("action_time"),
        F.when(etype == "view", F.concat(F.lit("kw"), (k % 6).cast("string"))).alias("search_keyword"),
        F.when(etype == "click", F.lit(1) + k % 20).otherwise(-1).cast("bigint").alias("click_category_id"),
        F.when(etype == "click", F.lit(1) + k).otherwise(-1).cast("bigint").alias("click_product_id"),
        F.when(etype == "purchase", pair(1 + k % 20, 1 + eid % 20)).alias("order_category_ids"),
        F.when(etype == "purchase", pair(1 + k % 100, 1 + eid % 100)).alias("order_product_ids"),
        F.when(etype == "signup", (1 + eid % 20).cast("string")).alias("pay_category_ids"),
        F.when(etype == "signup", (1 + eid % 100).cast("string")).alias("pay_product_ids"),
        (F.lit(1) + F.col("user_id") % 26).cast("bigint").alias("city_id"),
    )
    return schemas.conform(visit_date_range(out, start_date, end_date), schemas.VISIT_ACTION)


def visit_date_range(actions: DataFrame, start_date: str | None = None,
                     end_date: str | None = None) -> DataFrame:
    """Keep actions whose ``date`` lies in ``[start_date, end_date]``; a blank bound is open.
    ISO day text sorts like the dates it names, so the bounds compare as text."""
    if start_date is not None and str(start_date).strip():
        actions = actions.where(F.col("date") >= F.lit(str(start_date).strip()))
    if end_date is not None and str(end_date).strip():
        actions = actions.where(F.col("date") <= F.lit(str(end_date).strip()))
    return actions


def ad_log(spark: SparkSession, sf_dir: str, last_seconds: int | None = None) -> DataFrame:
    """Decoded ad-click log derived from ``events`` + ``nation`` + ``region``; with ``last_seconds``
    only events of that span before the latest one, compared on the stored timestamp before any
    cast or join, so the bound reaches the scan.

    The two dimension tables are joined to each other first (small x small), so the events
    table is joined once. No hint: the planner broadcasts the dimension while its byte estimate
    is under ``spark.sql.autoBroadcastJoinThreshold``, else AQE decides on the measured size.
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "props")
    if last_seconds is not None:
        latest = read_table(spark, sf_dir, "events").select(F.max("ts")).scalar()
        ev = ev.where(F.col("ts") > latest - F.make_dt_interval(secs=F.lit(int(last_seconds))))
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    dims = (nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
                  .select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"),
                          F.replace(F.col("r_name"), F.lit(" "), F.lit("-")).alias("area"),
                          F.replace(F.col("n_name"), F.lit(" "), F.lit("-")).alias("city")))
    ts = F.col("ts").cast("timestamp")
    j = ev.join(dims, (F.col("user_id") % 25) == F.col("n_nationkey"))
    return schemas.conform(j.select(
        F.col("event_id"),
        ts.alias("ts"),
        F.unix_millis(ts).alias("ts_ms"),
        day_of(ts).alias("date"),
        F.col("area"),
        F.col("city"),
        F.col("user_id").cast("string").alias("userid"),
        (F.lit(1) + _k(F.col("props")) % 6).cast("string").alias("adid"),
    ), schemas.AD_LOG)


def encode_ad_lines(log: DataFrame) -> DataFrame:
    """Ad-log records -> wire lines ``"<ms> <area> <city> <userid> <adid>"``."""
    return log.select(
        "event_id",
        F.concat_ws(" ", F.col("ts_ms").cast("string"), "area", "city", "userid", "adid").alias("line"),
    )


def ad_log_lines(spark: SparkSession, sf_dir: str, plant_errors: bool = False) -> DataFrame:
    """Wire lines of the ad log. With ``plant_errors`` some lines are damaged on purpose
    (FIXTURES.md): ids divisible by 97 lose their last field, ids divisible by 101 get an
    ``x`` in front of the time, ids divisible by 103 a time far past, and ids divisible by 107 one
    far before, any timestamp."""
    lines = encode_ad_lines(ad_log(spark, sf_dir))
    if not plant_errors:
        return lines
    eid = F.col("event_id")
    line = F.col("line")
    line = F.when(eid % 97 == 0, F.regexp_replace(line, r" [^ ]*$", "")).otherwise(line)
    line = F.when(eid % 101 == 0, F.concat(F.lit("x"), line)).otherwise(line)
    line = F.when(eid % 103 == 0, F.regexp_replace(line, r"^x?[0-9]+", "9999999999999999")).otherwise(line)
    line = F.when(eid % 107 == 0, F.regexp_replace(line, r"^x?[0-9]+", "-9999999999999999")).otherwise(line)
    return lines.select("event_id", line.alias("line"))


__all__ = [
    "read_table", "read_visit_actions", "read_ad_log", "visit_actions", "visit_date_range", "ad_log",
    "encode_ad_lines", "ad_log_lines",
]
