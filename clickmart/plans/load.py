"""The load job (W17, S6): metric datasets -> warehouse facts, with a ledger of what was loaded.

    python -m clickmart.plans.load --metrics PROCESSED --warehouse DWH

Each metric's folder holds one ``date=`` partition per run. The ledger (``<warehouse>/load_ledger``) has a
row for each (metric, date) that was loaded, with a fingerprint of its files (names, sizes and
times). A date is pending if the ledger lacks it or its files changed since, so loading twice
adds nothing, a late date is picked up, and a date that was computed again replaces its rows.
The job reads pending dates alone, pruned by partition; a fact is published before its ledger
row is written, so a job that ends in between loads that date again, to the same result.
"""

from __future__ import annotations

import argparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.operators import warehouse
from clickmart.schema import METRIC_TO_FACT
from clickmart.session import get_session
from clickmart.sinks.writers import load_table, read_table
from clickmart.sources.csv_events import read_metric

LEDGER = T.StructType([
    T.StructField("metric", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("fingerprint", T.LongType()), T.StructField("rows", T.LongType()),
    T.StructField("loaded_at", T.TimestampType()),
])


def metric_dates(spark: SparkSession, base: str, metric: str) -> DataFrame:
    """(metric, date, fingerprint) of the dates that a metric's folder holds; a listing, no row is read."""
    schema = T.StructType([T.StructField("metric", T.StringType()), T.StructField("date", T.DateType()),
                           T.StructField("fingerprint", T.LongType())])
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
            "recursiveFileLookup", "true").load(f"{base.rstrip('/')}/{metric}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    day = F.regexp_extract("path", r"/date=(\d{4}-\d{2}-\d{2})/[^/]*$", 1)
    # a sum, so that no list of a date's files is gathered
    mark = F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))
    files = files.withColumn("date", F.try_to_date(day)).where("date is not null")
    dates = files.groupBy("date").agg(F.xxhash64(mark).alias("fingerprint"))
    return dates.select(F.lit(metric).alias("metric"), "date", "fingerprint")


def pending(spark: SparkSession, metrics_base: str, warehouse_base: str, metrics=tuple(METRIC_TO_FACT)) -> DataFrame:
    """(metric, date, fingerprint) that the ledger hasn't got, oldest first."""
    found = None
    for metric in metrics:
        of = metric_dates(spark, metrics_base, metric)
        found = of if found is None else found.unionByName(of)
    done = read_table(spark, f"{warehouse_base.rstrip('/')}/load_ledger", LEDGER).select("metric", "date", "fingerprint")
    return found.join(done, ["metric", "date", "fingerprint"], "left_anti").orderBy("date", "metric")


def load_pending(
    spark: SparkSession, metrics_base: str, warehouse_base: str, metrics=tuple(METRIC_TO_FACT)
) -> dict[tuple[str, str], int]:
    """Load what is pending; rows loaded per (metric, date)."""
    warehouse_base = warehouse_base.rstrip("/")
    loaded: dict[tuple[str, str], int] = {}
    ledger = f"{warehouse_base}/load_ledger"
    for metric, date, fingerprint in pending(spark, metrics_base, warehouse_base, metrics).collect():  # one row a day and metric
        day, table = str(date), METRIC_TO_FACT[metric]
        rows = read_metric(spark, metrics_base, metric, day).drop("date")
        fact = warehouse.valid_records(warehouse.build_fact(metric, rows, day))
        n = load_table(fact, f"{warehouse_base}/{table}", "replace_date", table, day)
        entry = spark.createDataFrame([(metric, date, fingerprint, n, None)], LEDGER)
        load_table(entry.withColumn("loaded_at", F.current_timestamp()), ledger, "append", "ledger")
        loaded[metric, day] = n
    return loaded


def main() -> None:
    p = argparse.ArgumentParser(description="Load metric datasets into the warehouse")
    p.add_argument("--metrics", required=True, help="base folder of the metric datasets")
    p.add_argument("--warehouse", required=True, help="base folder of the warehouse tables")
    a = p.parse_args()
    for (metric, day), n in load_pending(get_session(), a.metrics, a.warehouse).items():
        print(f"{metric}\t{day}\t{n}")


if __name__ == "__main__":
    main()
