"""Decoding of ad-log wire lines into typed records, with a rejects output for bad lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import day_of, split_line, timestamp_of_ms

# Field order of a wire line and the reject reasons we report.
LINE_FIELDS = ["ts_ms", "area", "city", "userid", "adid"]
REASON_MISSING_FIELD = "missing_field"
REASON_BAD_TIMESTAMP = "bad_timestamp"


def decode_ad_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Split each line on single spaces and bind the five positional fields.

    Extra trailing fields are ignored, as positional binding does. Adds ``reject_reason``:
    null for good lines, else why the line cannot be decoded. Nothing here throws on bad
    input (ANSI mode stays on; ``get``, ``try_cast`` and ``try_multiply`` return null instead);
    a time that is no number, or out of a timestamp's range, is a bad timestamp.
    """
    parts = split_line(F.col(line_col), " ")
    fields = {name: F.get(parts, i) for i, name in enumerate(LINE_FIELDS)}
    ts_ms = fields["ts_ms"].try_cast("bigint")
    ts = timestamp_of_ms(ts_ms)
    reason = (F.when(F.coalesce(F.size(parts), F.lit(-1)) < len(LINE_FIELDS), F.lit(REASON_MISSING_FIELD))
               .when(ts.isNull(), F.lit(REASON_BAD_TIMESTAMP)))
    keep = [c for c in lines.columns if c != line_col]
    return lines.select(
        *keep,
        F.col(line_col),
        ts.alias("ts"),
        ts_ms.alias("ts_ms"),
        day_of(ts).alias("date"),
        fields["area"].alias("area"),
        fields["city"].alias("city"),
        fields["userid"].alias("userid"),
        fields["adid"].alias("adid"),
        reason.alias("reject_reason"),
    )


def parsed_ad_log(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Good lines only, as ad-log records (``event_id`` kept when present)."""
    d = decode_ad_lines(lines, line_col)
    keep = [c for c in lines.columns if c != line_col]
    return d.where(F.col("reject_reason").isNull()).select(
        *keep, "ts", "ts_ms", "date", "area", "city", "userid", "adid")


def ad_log_rejects(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Bad lines with the reason each was rejected."""
    d = decode_ad_lines(lines, line_col)
    keep = [c for c in lines.columns if c != line_col]
    return d.where(F.col("reject_reason").isNotNull()).select(
        *keep, F.col(line_col), F.col("reject_reason").alias("reason"))
