"""Explicit schemas of the data model (user visit actions, ad log) and of result tables."""

from pyspark.sql import types as T

# One clickstream action; the 13 columns of the reference data model plus ``event_id``,
# a unique id used only to make orderings total.
VISIT_ACTION = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("date", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("action_time", T.TimestampType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType()),
    T.StructField("click_product_id", T.LongType()),
    T.StructField("order_category_ids", T.StringType()),
    T.StructField("order_product_ids", T.StringType()),
    T.StructField("pay_category_ids", T.StringType()),
    T.StructField("pay_product_ids", T.StringType()),
    T.StructField("city_id", T.LongType()),
])

# A decoded ad-click log record. The wire form is one text line
# "<epoch millis> <area> <city> <userid> <adid>"; ids stay text as on the wire.
AD_LOG = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("date", T.StringType()),
    T.StructField("area", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("userid", T.StringType()),
    T.StructField("adid", T.StringType()),
])

# Raw ad log as it arrives from a topic or a landing folder.
AD_LOG_LINE = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("line", T.StringType()),
])

VISIT_ACTION_COLUMNS = [f.name for f in VISIT_ACTION.fields]
AD_LOG_COLUMNS = [f.name for f in AD_LOG.fields]


def conform(df, schema: T.StructType):
    """Select and cast ``df`` to ``schema`` (column order and types), failing on missing columns."""
    from pyspark.sql import functions as F
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
