"""Builders for hand-made clickstream rows."""

from datetime import datetime, timedelta

from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("page_url", T.StringType()),
    T.StructField("page_type", T.StringType()),
    T.StructField("time_on_page_seconds", T.DoubleType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("action", T.StringType()),
])

T0 = datetime(2025, 6, 1, 10, 0, 0)


def ev(event_id, event_type, user="u1", session="s1", minute=0, **kw):
    row = {f.name: None for f in EVENT_SCHEMA.fields}
    row.update(event_id=event_id, event_type=event_type, user_id=user, session_id=session,
               timestamp=None if minute is None else T0 + timedelta(minutes=minute))
    row.update(kw)
    return tuple(row[f.name] for f in EVENT_SCHEMA.fields)


def events_df(spark, rows):
    return spark.createDataFrame(rows, EVENT_SCHEMA)
