"""Q1 (top categories by click, order, pay) and Q2 (most active sessions per top category)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import non_blank, real_id, split_ids

# Metric names, in the order used for ranking.
CLICK, ORDER, PAY = "click", "order", "pay"


def category_action_events(actions: DataFrame) -> DataFrame:
    """One row per (action, category, metric).

    Classification is first-match: a real click counts as a click only; otherwise a
    non-blank order list counts once per listed category; otherwise a non-blank pay list.
    A null click id counts as "no click". Blank list tokens are dropped; repeated ids count
    again each time they are listed.
    """
    click = F.col("click_category_id")
    orders, pays = F.col("order_category_ids"), F.col("pay_category_ids")
    is_click = real_id(click)
    is_order = ~is_click & non_blank(orders)
    is_pay = ~is_click & ~is_order & non_blank(pays)
    metric = F.when(is_click, F.lit(CLICK)).when(is_order, F.lit(ORDER)).when(is_pay, F.lit(PAY))
    ids = (F.when(is_click, F.array(click.cast("string")))
            .when(is_order, split_ids(orders))
            .when(is_pay, split_ids(pays)))
    return (actions.where(is_click | is_order | is_pay)
                   .select("event_id", metric.alias("metric"), F.explode(ids).alias("category_id"))
                   .select("event_id", "category_id", "metric"))


def category_metric_counts(actions: DataFrame) -> DataFrame:
    """(category_id, metric, n): the keyed counter of the reference, as a hash aggregate."""
    return (category_action_events(actions).groupBy("category_id", "metric")
            .agg(F.count(F.lit(1)).alias("n")))


def category_funnel_counts(actions: DataFrame) -> DataFrame:
    """(category_id, click_count, order_count, pay_count), missing metrics = 0, one pass."""
    m = F.col("metric")
    return (category_action_events(actions).groupBy("category_id").agg(
        F.count_if(m == CLICK).alias("click_count"),
        F.count_if(m == ORDER).alias("order_count"),
        F.count_if(m == PAY).alias("pay_count")))


def category_top10(actions: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` categories by clicks, then orders, then payments (all descending); remaining
    ties go to the smaller id in text order. Columns: rank, category_id and the three counts.

    The global sort + limit plans as ``TakeOrderedAndProject`` (per-partition top-k, then a
    merge of k rows per partition), never a full sort.
    """
    top = (category_funnel_counts(actions)
           .orderBy(F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id"))
           .limit(int(k)))
    # ranks over at most k rows (the limit output is one partition already)
    w = Window.orderBy(F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id"))
    return top.select(F.row_number().over(w).cast("bigint").alias("rank"), "category_id",
                      "click_count", "order_count", "pay_count")


def top_category_clicks(actions: DataFrame, top: DataFrame) -> DataFrame:
    """Click actions whose category is in ``top`` (a left-semi join).

    ``top`` is the result of :func:`category_top10`, so it holds at most ``k`` rows by
    construction; that bound is what justifies the broadcast hint."""
    clicks = (actions.where(real_id("click_category_id"))
                     .select("event_id", F.col("click_category_id").cast("string").alias("category_id"),
                             "session_id"))
    return clicks.join(F.broadcast(top.select("category_id")), "category_id", "left_semi") \
                 .select("event_id", "category_id", "session_id")


def category_session_clicks(clicks: DataFrame) -> DataFrame:
    """(category_id, session_id, n) click counts (partial aggregation before the shuffle)."""
    return clicks.groupBy("category_id", "session_id").agg(F.count(F.lit(1)).alias("n"))


def category_session_top10(actions: DataFrame, k: int = 10, top: DataFrame | None = None) -> DataFrame:
    """For each top category, its ``k`` sessions with most clicks (ties: smaller session id).

    ``row_number() <= k`` plans a partial ``WindowGroupLimit`` before the shuffle, so each map
    task sends at most ``k`` rows per category however hot a category is."""
    if top is None:
        top = category_top10(actions, k=10)
    counts = category_session_clicks(top_category_clicks(actions, top))
    w = Window.partitionBy("category_id").orderBy(F.desc("n"), F.asc("session_id"))
    return (counts.withColumn("rank", F.row_number().over(w))
                  .where(F.col("rank") <= int(k))
                  .select("category_id", F.col("rank").cast("bigint").alias("rank"), "session_id",
                          F.col("n").alias("click_count")))


def action_metrics(actions: DataFrame, observation: Observation) -> DataFrame:
    """``actions`` with how many of them click, order and pay (the classes of ``category_action_events``, one a
    row, and how many are none) counted into ``observation`` by the pass that reads them for something else."""
    click = real_id("click_category_id")
    order = ~click & non_blank("order_category_ids")
    pay = ~click & ~order & non_blank("pay_category_ids")
    kinds = {"click": click, "order": order, "pay": pay, "other": ~(click | order | pay)}
    return actions.observe(observation, *[F.count(F.when(c, 1)).alias(k) for k, c in kinds.items()])
