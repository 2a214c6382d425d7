"""Parameterised read queries over the warehouse facts."""

from __future__ import annotations

import contextlib
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.schema import FACT_SCHEMAS, METRIC_TO_FACT

# FIXED VALUES of the read API: metrics, default and maximum page size, anomaly page.
PAGE_METRICS = ("bounce_rate", "time_on_page")
DEFAULT_LIMIT = 10
MAX_LIMIT = 100
ANOMALY_PAGE = 100
# --- end fixed values ---


def check_date(value) -> str:
    """An ISO calendar date. Only the plain form counts: what the parser reads must
    print as what came in."""
    parsed = None
    with contextlib.suppress(TypeError, ValueError):
        parsed = date.fromisoformat(value)
    if parsed is None or parsed.isoformat() != value:
        raise ValueError(f"not an ISO calendar date: {value!r}")
    return value


def check_limit(value=None) -> int:
    """Page size, 1 to ``MAX_LIMIT``; the default if none is given."""
    if value is None:
        return DEFAULT_LIMIT
    try:
        size = int(value)
    except (TypeError, ValueError):
        size = 0
    if not 1 <= size <= MAX_LIMIT:
        raise ValueError(f"page size {value!r} isn't between 1 and {MAX_LIMIT}")
    return size


def check_metric(value) -> str:
    if value not in PAGE_METRICS:
        raise ValueError(f"unknown page metric {value!r}; known: {', '.join(PAGE_METRICS)}")
    return value


def to_plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals leave as doubles (JSON-friendly)."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def stored_fact(spark: SparkSession, warehouse_base: str, metric: str) -> DataFrame:
    """A loaded fact table. The reports' date prunes its ``date=`` folders, so a report on it reads one
    day's files and no event."""
    table = METRIC_TO_FACT[metric]
    schema = T.StructType([T.StructField(c, t) for c, t in FACT_SCHEMAS[table]])
    return spark.read.schema(schema).parquet(f"{warehouse_base.rstrip('/')}/{table}")


def _on_date(df: DataFrame, day: str) -> DataFrame:
    return df.where(F.col("date") == F.lit(day).cast("date"))


def pages_top(fact: DataFrame, metric: str, date: str, limit=None) -> DataFrame:
    """Top pages by rank (time_on_page) or by bounce rate."""
    metric, date, limit = check_metric(metric), check_date(date), check_limit(limit)
    if metric == "time_on_page":
        out = _on_date(fact, date).select("page_url", "avg_time_seconds", "session_count", "rank")
        out = out.orderBy(F.asc("rank"), F.asc("page_url"))
    else:
        out = _on_date(fact, date).select("page_type", "bounce_rate", "total_sessions", "bounced_sessions")
        out = out.orderBy(F.desc_nulls_last("bounce_rate"), F.asc("page_type"))
    return to_plain_numbers(out.limit(limit))


def sessions_summary(fact: DataFrame, date: str, country: str | None = None, device: str | None = None) -> DataFrame:
    """Device × country time and sessions; empty filters mean "all"."""
    out = _on_date(fact, check_date(date))
    if country:
        out = out.where(F.col("country") == country)
    if device:
        out = out.where(F.col("device_type") == device)
    out = out.select("device_type", "country", "avg_time_seconds", "session_count")
    return to_plain_numbers(out.orderBy(F.desc("session_count"), "device_type", "country"))


def anomalies_report(fact: DataFrame, date: str, limit: int = ANOMALY_PAGE) -> DataFrame:
    """The strongest anomalies by |z| (ties broken by every output column)."""
    out = _on_date(fact, check_date(date)).select(
        "session_id", "user_id", "page_type", "z_score", "anomaly_type"
    )
    out = out.orderBy(
        F.abs("z_score").desc(), "session_id", "user_id", "page_type", "anomaly_type", "z_score"
    )
    return to_plain_numbers(out.limit(limit))


def anomalies_total(fact: DataFrame, date: str) -> DataFrame:
    """Number of anomalies stored for the date."""
    date = check_date(date)
    return _on_date(fact, date).agg(F.count(F.lit(1)).alias("total")).select(
        F.lit(date).cast("date").alias("date"), "total"
    )
