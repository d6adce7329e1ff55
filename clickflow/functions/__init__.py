from .columns import (  # noqa: F401
    DAY_FORMAT,
    DEFAULT_TIME_FORMAT,
    day_of,
    epoch_ms_to_string,
    epoch_text_to_string,
    floor_time,
    non_blank,
    real_id,
    split_ids,
    split_line,
    string_to_epoch_ms,
    time_text,
    timestamp_of_ms,
)
