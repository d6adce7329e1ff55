"""Q3 (single-hop page conversion along a target flow) and Q4 (average dwell time per page).

Both rest on one ordered pass per session: each action paired with the session's next
action, ordered by ``(action_time, event_id)`` (:func:`clickflow.operators.sequence.with_next`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .sequence import DEFAULT_SPLIT, with_next, with_position

SESSION, TIME, TIE = "session_id", "action_time", "event_id"


def parse_flow(flow) -> list[int]:
    """Target page flow from ``"1,2,3"`` or a sequence of ids; tokens are trimmed."""
    tokens = flow.split(",") if isinstance(flow, str) else list(flow)
    pages = [int(str(t).strip()) for t in tokens if str(t).strip() != ""]
    if len(pages) < 2:
        raise ValueError(f"a page flow needs at least two pages, got {flow!r}")
    return pages


def flow_pairs(spark: SparkSession, flow) -> DataFrame:
    """Distinct consecutive pairs of the flow parameter, as a small DataFrame (size bounded
    by the length of the parameter, never by the data)."""
    pages = parse_flow(flow)
    pairs = sorted(set(zip(pages[:-1], pages[1:])))
    return spark.createDataFrame(pairs, "page_id bigint, next_page_id bigint")


def session_page_steps(actions: DataFrame, split: str | None = DEFAULT_SPLIT) -> DataFrame:
    """Every action with the session's next page and time (null on the last action)."""
    base = actions.select(SESSION, TIE, TIME, "page_id")
    return with_next(base, [SESSION], TIME, TIE, carry=["page_id", TIME], split=split)


def session_page_hops(actions: DataFrame, split: str | None = DEFAULT_SPLIT) -> DataFrame:
    """(session_id, page_id, next_page_id) for each consecutive pair of a session's actions."""
    s = session_page_steps(actions, split)
    return s.where(F.col("next_page_id").isNotNull()).select(SESSION, "page_id", "next_page_id")


def session_page_paths(actions: DataFrame, split: str | None = DEFAULT_SPLIT) -> DataFrame:
    """Each session's page path, one row per step: (session_id, step, page_id).

    The path stays in rows rather than one string per session, so a session with a huge
    number of actions is never gathered into a single value."""
    base = actions.select(SESSION, TIE, TIME, "page_id")
    return with_position(base, [SESSION], TIME, TIE, name="step", split=split) \
        .select(SESSION, "step", "page_id")


def session_path_text(actions: DataFrame, separator: str = ">", split: str | None = DEFAULT_SPLIT,
                      pages_per_part: int = 100_000) -> DataFrame:
    """(session_id, path): each session's page ids in order, joined by ``separator``.

    Two levels: the pages of each ``pages_per_part`` steps become one text in a task of their own, and a
    session's texts are joined in order. So a hot session's rows are gathered part by part, by position; what
    ends in one task is its path text alone, a single value that no session's reader can do without (some
    7 bytes a page, 2 GB at most, which is Spark's bound for one value: 300 million pages)."""
    steps = session_page_paths(actions, split).withColumn("_part", F.floor((F.col("step") - 1) / int(pages_per_part)))

    def joined(order: str, value: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]), separator)

    page = F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("_page")
    parts = steps.select(SESSION, "_part", "step", page).groupBy(SESSION, "_part").agg(joined("step", "_page").alias("_text"))
    return parts.groupBy(SESSION).agg(joined("_part", "_text").alias("path"))


def page_visit_counts(actions: DataFrame, flow, include_last: bool = False) -> DataFrame:
    """(page_id, visits): actions on each source page of the flow (every flow page but the
    last); ``include_last`` counts the last flow page too (it is never a hop source, so the
    conversion rates do not change)."""
    pages = parse_flow(flow)
    sources = sorted(set(pages if include_last else pages[:-1]))
    return (actions.where(F.col("page_id").isin(sources))
                   .groupBy("page_id").agg(F.count(F.lit(1)).alias("visits")))


def _source_hop_table(actions: DataFrame, flow, split) -> DataFrame:
    """(page_id, next_page_id, n) over source pages of the flow; ``next_page_id`` null counts
    actions that end a session. Small: at most |sources| x (|pages| + 1) rows."""
    sources = sorted(set(parse_flow(flow)[:-1]))
    s = session_page_steps(actions, split)
    return (s.where(F.col("page_id").isin(sources))
             .groupBy("page_id", "next_page_id").agg(F.count(F.lit(1)).alias("n")))


def page_hop_counts(actions: DataFrame, flow, split: str | None = DEFAULT_SPLIT) -> DataFrame:
    """(page_id, next_page_id, hops) for the target hops of the flow that occur."""
    spark = actions.sparkSession
    t = _source_hop_table(actions, flow, split)
    return (t.join(F.broadcast(flow_pairs(spark, flow)), ["page_id", "next_page_id"])
             .select("page_id", "next_page_id", F.col("n").alias("hops")))


def page_conversion_rate(actions: DataFrame, flow, include_zero: bool = False,
                         split: str | None = DEFAULT_SPLIT) -> DataFrame:
    """(page_id, next_page_id, hops, visits, rate) with rate = hops / visits of the source page.

    One ordered pass gives numerator and denominator together: the per-(page, next page)
    table is aggregated once and both counts are read from it. Target hops that never occur
    are left out unless ``include_zero``."""
    spark = actions.sparkSession
    t = _source_hop_table(actions, flow, split)
    # visits of the source page = all its rows in the small hop table, read with a window so
    # the session pass is not run a second time for the denominator
    t = t.withColumn("visits", F.sum("n").over(Window.partitionBy("page_id")))
    pairs = F.broadcast(flow_pairs(spark, flow))
    if include_zero:
        visits = t.select("page_id", "visits").distinct()
        hops = t.select("page_id", "next_page_id", F.col("n").alias("hops"))
        j = pairs.join(hops, ["page_id", "next_page_id"], "left").join(visits, "page_id", "left")
        j = j.select("page_id", "next_page_id", F.coalesce("hops", F.lit(0)).cast("bigint").alias("hops"),
                     F.coalesce("visits", F.lit(0)).cast("bigint").alias("visits"))
    else:
        j = t.join(pairs, ["page_id", "next_page_id"]).select("page_id", "next_page_id",
                                                             F.col("n").alias("hops"), "visits")
    return j.select("page_id", "next_page_id", F.col("hops").cast("bigint").alias("hops"),
                    F.col("visits").cast("bigint").alias("visits"),
                    (F.col("hops") / F.col("visits")).cast("double").alias("rate"))


def page_dwell_intervals(actions: DataFrame, split: str | None = DEFAULT_SPLIT) -> DataFrame:
    """(event_id, page_id, dwell_ms): time from an action to the session's next action,
    charged to the earlier page. A session's last action contributes nothing."""
    s = session_page_steps(actions, split)
    return (s.where(F.col("next_" + TIME).isNotNull())
             .select(TIE, "page_id",
                     (F.unix_millis(F.col("next_" + TIME)) - F.unix_millis(F.col(TIME))).alias("dwell_ms")))


def page_dwell_time(actions: DataFrame, split: str | None = DEFAULT_SPLIT) -> DataFrame:
    """(page_id, n, avg_ms, avg_ms_exact). ``avg_ms`` keeps the reference's integer mean
    (sum div count, then widened to double); ``avg_ms_exact`` is the real mean."""
    d = page_dwell_intervals(actions, split)
    return d.groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.expr("cast(sum(dwell_ms) div count(1) as double)").alias("avg_ms"),
        (F.sum("dwell_ms") / F.count(F.lit(1))).cast("double").alias("avg_ms_exact"))
