"""Cleaning: union, deterministic de-duplication, timestamp parsing, group-median imputation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.operators.quantiles import exact_percentiles
from clickmart.plans.joins import fetch_small, join_small

DEDUP_KEYS = ("user_id", "session_id", "timestamp", "event_type")
# percentile_approx accuracy; relative rank error is 1/accuracy (Spark's default).
MEDIAN_ACCURACY = 10000


def union_events(frames: dict[str, DataFrame]) -> DataFrame:
    """One wide table from per-type frames; absent columns become NULL."""
    tagged = [df.withColumn("event_type", F.lit(et)) for et, df in frames.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def dedup_events(
    df: DataFrame,
    keys=DEDUP_KEYS,
    order_by: list[Column] | None = None,
) -> DataFrame:
    """Keep one row per key (NULL keys compare equal); survivor = first by ``order_by``.

    ``row_number() = 1`` is planned with a map-side WindowGroupLimit, so a key with many
    copies is cut down to one row per task before the shuffle.
    """
    order_by = order_by or [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def parse_timestamps(df: DataFrame, column: str = "timestamp", tz: str = "UTC") -> DataFrame:
    """Text -> timestamp (NULL when unparseable), read as wall time in ``tz``."""
    if column not in df.columns:
        return df
    if isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType)):
        return df
    parsed = F.to_utc_timestamp(F.try_to_timestamp(F.col(column)), tz)
    return df.withColumn(column, parsed)


@dataclass(frozen=True)
class Imputation:
    """Fill NULL ``value`` with its exact (lower) median over ``event_type`` rows that
    share the same ``by`` key. Rows whose key is NULL are never filled."""

    value: str
    by: str
    event_type: str


TIME = Imputation("time_on_page_seconds", "page_type", "page_view")
PRICE = Imputation("price", "category", "product_view")


def group_medians(df: DataFrame, rules: tuple[Imputation, ...], accuracy: int = MEDIAN_ACCURACY) -> DataFrame:
    """(value name, key, median) for all rules, from one shared pair of percentile passes:
    each row contributes to the rule of its event type."""
    name, key, x = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("double")
    for r in rules:
        mine = F.col("event_type") == r.event_type
        name = F.when(mine, F.lit(r.value)).otherwise(name)
        key = F.when(mine, F.col(r.by)).otherwise(key)
        x = F.when(mine, F.col(r.value).cast("double")).otherwise(x)
    rows = df.where(F.col("event_type").isin(*[r.event_type for r in rules])).select(
        name.alias("value_name"), key.alias("key"), x.alias("x"))
    return exact_percentiles(rows, "x", ["value_name", "key"], [0.5], names=["median"], accuracy=accuracy)


def impute(df: DataFrame, *rules: Imputation, accuracy: int = MEDIAN_ACCURACY) -> DataFrame:
    """Apply the rules whose columns ``df`` has. The medians are computed once and joined
    back (one row per key, size-checked), so the events aren't shuffled."""
    rules = tuple(r for r in rules if r.value in df.columns and r.by in df.columns)
    if not rules:
        return df
    medians = group_medians(df, rules, accuracy)
    fetched = fetch_small(medians)
    if fetched is not None:
        medians = df.sparkSession.createDataFrame(fetched, medians.schema)
    for r in rules:
        mine = medians.where(F.col("value_name") == r.value).select(F.col("key").alias(r.by), F.col("median").alias("__median"))
        cols = [
            F.coalesce(F.col(r.value).cast("double"), F.col("__median")).alias(r.value) if c == r.value else F.col(c)
            for c in df.columns
        ]
        df = join_small(df, mine, [r.by], "left").select(*cols)
    return df


def impute_time_on_page(df: DataFrame, accuracy: int = MEDIAN_ACCURACY) -> DataFrame:
    return impute(df, TIME, accuracy=accuracy)


def impute_price(df: DataFrame, accuracy: int = MEDIAN_ACCURACY) -> DataFrame:
    return impute(df, PRICE, accuracy=accuracy)


def materialize(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Cut the lineage: written as Parquet on shared storage (partitioned so that later
    filters on ``event_type`` prune files) and read back."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    spark: SparkSession = df.sparkSession
    return spark.read.schema(df.schema).parquet(path)
