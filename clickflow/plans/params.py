"""Fixed test parameters for the registered queries (FIXTURES.md §2)."""

# Parameters of the registered test queries.
TARGET_FLOW = "1,2,3,4,5,6,7"
START_DATE = "2024-01-05"
END_DATE = "2024-01-20"
BLACKLIST_THRESHOLD = 3
TREND_SPAN_SECONDS = 3600
TREND_WINDOW_SECONDS = 60
TREND_SLIDE_SECONDS = 10
TOP_CATEGORIES = 10
TOP_SESSIONS = 10
TOP_ADS = 3
# Streams: number of replay slices and the event-time watermark delay.
REPLAY_SLICES = 4
WATERMARK_DELAY = "10 minutes"
# Runs on the real trigger: files landed for each, and files read in a batch.
LIVE_FILES = 6
LIVE_FILES_PER_BATCH = 2
# Every so-many-th event of a late replay arrives in the last slice.
LATE_EVERY = 13
# Files of the table stored by session.
SESSION_BUCKETS = 8
# Run id of the registered result records.
TASK_ID = "run-1"
