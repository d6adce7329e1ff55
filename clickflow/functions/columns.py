"""Column helpers. Every helper returns a built-in Spark expression (JVM side, codegen'd);
none of them is a Python UDF."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyy-MM-dd"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def non_blank(c) -> Column:
    """True when the text holds any character above U+0020 (null -> false): tabs, newlines and
    other control characters are blank, as Java's ``String.trim`` has it."""
    return F.coalesce(_c(c).rlike(r"[^\x00-\x20]"), F.lit(False))


def real_id(c, sentinel: int = -1) -> Column:
    """True for an id that is present and not the 'absent' sentinel (null counts as absent)."""
    return F.coalesce(_c(c), F.lit(sentinel)) != F.lit(sentinel)


def split_ids(c, sep: str = ",") -> Column:
    """Split a delimited id list into an array of tokens, dropping blank tokens.

    ``"1,,2,"`` gives ``["1", "2"]``; null gives null."""
    return F.filter(F.split(_c(c), re.escape(sep)), non_blank)


def split_line(c, sep: str = " ") -> Column:
    """Split a text line the way a Java ``String.split`` does: inner empty fields are kept,
    trailing empty fields are dropped."""
    pat = re.escape(sep)
    return F.split(F.regexp_replace(_c(c), f"(?:{pat})+$", ""), pat)


def timestamp_of_ms(c) -> Column:
    """Epoch milliseconds -> timestamp; null where it is out of a timestamp's range."""
    return F.timestamp_micros(F.try_multiply(_c(c), F.lit(1000).cast("bigint")))


def epoch_ms_to_string(c, fmt: str = DEFAULT_TIME_FORMAT) -> Column:
    """Epoch milliseconds -> formatted time text (session time zone); out of range gives null."""
    return F.date_format(timestamp_of_ms(c), fmt)


def epoch_text_to_string(c, fmt: str = DEFAULT_TIME_FORMAT) -> Column:
    """Epoch milliseconds held as text -> formatted time text; non-numeric text gives null."""
    return epoch_ms_to_string(_c(c).try_cast("bigint"), fmt)


def string_to_epoch_ms(c, fmt: str = DEFAULT_TIME_FORMAT) -> Column:
    """Formatted time text -> epoch milliseconds; unparsable text gives null."""
    return F.unix_millis(F.try_to_timestamp(_c(c), F.lit(fmt)))


def floor_time(c, seconds: int) -> Column:
    """Floor a timestamp to a multiple of ``seconds`` since the epoch (10 s: 15:11:09.999 -> 15:11:00)."""
    m = F.unix_micros(_c(c))
    return F.timestamp_micros(m - F.pmod(m, F.lit(int(seconds) * 1_000_000)))


def day_of(c) -> Column:
    """Timestamp -> ``yyyy-MM-dd`` text of its day."""
    return F.date_format(_c(c), DAY_FORMAT)


def time_text(c, fmt: str = DEFAULT_TIME_FORMAT) -> Column:
    return F.date_format(_c(c), fmt)
