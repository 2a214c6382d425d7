"""Sinks (K1–K6): metric Parquet by date, warehouse loads, quarantine, error reports."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.operators import quality, warehouse
from clickmart.schema import DIM_KEYS, REPORT_KEYS
from clickmart.session import dir_exists
from clickmart.sinks.publish import publish, recover

REPORT_NAME = 32  # hexadecimal digits of a report folder's name


def write_metric(df: DataFrame, base: str, metric: str, process_date: str) -> None:
    """K1: ``<base>/<metric>/date=<d>/`` as snappy Parquet. The date's folder is replaced as
    a whole, so a rerun is idempotent, also when its result is empty, and other days stay."""
    path = f"{base.rstrip('/')}/{metric}/date={process_date}"
    publish(df.sparkSession, path, lambda new: df.drop("date").write.option("compression", "snappy").parquet(new))


def load_table(
    df: DataFrame, path: str, mode: str = "replace_date", name: str = "load",
    process_date: str | None = None, key: str | None = None,
) -> int:
    """K1/K2/K3: write a warehouse table and return the rows written.

    ``replace_date`` (default) replaces the folder of ``process_date`` (``df`` holds that
    date alone), also by an empty one; ``merge`` replaces the rows that share a ``key`` and
    keeps the others; ``truncate`` replaces the whole table; ``append`` adds rows (not
    idempotent). All but ``append`` write beside the table and switch (``publish``), so a load that
    fails leaves the table as it was. Row counts come from an ``observe`` on the write itself.
    """
    return _load(df, path, mode, name, process_date, key)[0]


def _load(
    df: DataFrame, path: str, mode: str, name: str, process_date: str | None, key: str | None,
    table: str | None = None,
) -> tuple[int, dict[str, int]]:
    """``load_table``; with a ``table`` the rows that fail each of its rules are counted by the same
    ``observe``, so scoring reads nothing. Returns (rows written, rule -> failing rows)."""
    if mode == "replace_date" and process_date is None:
        raise ValueError("replace_date needs the process date")
    spark = df.sparkSession
    if mode == "merge":
        df = _merged(df, path, key)
    obs = Observation(name)
    checks = warehouse.row_checks(df, table) if table else {}
    failing = [F.count_if(pred).alias(f"failed_{i}") for i, pred in enumerate(checks.values())]
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"), *failing)
    out = out.drop("date") if mode == "replace_date" else out
    writer = out.write.option("compression", "snappy")
    if mode != "replace_date" and "date" in df.columns:
        writer = writer.partitionBy("date")
    if mode == "replace_date":
        publish(spark, f"{path}/date={process_date}", writer.parquet)
    elif mode in ("truncate", "merge"):
        publish(spark, path, writer.parquet)
    elif mode == "append":
        writer.mode("append").parquet(path)
    else:
        raise ValueError(f"unknown load mode {mode!r}")
    seen = obs.get
    failed = {rule: int(seen.get(f"failed_{i}", 0)) for i, rule in enumerate(checks)}
    return int(seen.get("rows", 0)), failed


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A warehouse table as it was last published; empty if there is none."""
    recover(spark, path)
    if not dir_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _merged(df: DataFrame, path: str, key: str | None) -> DataFrame:
    """``df`` and the table's rows with other keys."""
    if key is None:
        raise ValueError("merge needs a key")
    rest = read_table(df.sparkSession, path, df.schema).join(df.select(key), key, "left_anti")
    return df.unionByName(rest.select(*df.columns))


def load_warehouse(
    tables: dict[str, DataFrame], base: str, process_date: str, mode: str = "replace_date",
    states: dict[str, DataFrame] | None = None,
) -> dict[str, int]:
    """Load every table (facts by date, dimensions merged by key, so they cover all
    loaded dates); returns rows per table and the total under ``"total"``.

    ``states`` holds the mergeable aggregates of dimensions that need more than their last
    row: each date's are stored in ``state/<table>`` and replaced with that date, and the
    dimension is folded from all of them."""
    measured = _load_all(tables, base, process_date, mode, states or {})
    counts = {table: n for table, (n, _) in measured.items()}
    return counts | {"total": sum(counts.values())}


def load_scored(
    tables: dict[str, DataFrame], base: str, process_date: str, mode: str = "replace_date",
    states: dict[str, DataFrame] | None = None,
) -> tuple[dict[str, int], DataFrame]:
    """W17 with W16: ``load_warehouse`` and the scorecard of the rows that it wrote. Rules on rows are
    counted by the writes themselves; only a dimension's key is read back, for its uniqueness."""
    spark = next(iter(tables.values())).sparkSession
    measured = _load_all(tables, base, process_date, mode, states or {})
    counts = {table: n for table, (n, _) in measured.items()}
    for table, (_, failed) in measured.items():
        key = DIM_KEYS.get(table)
        if key:
            stored = read_table(spark, f"{base.rstrip('/')}/{table}", tables[table].schema)
            failed[warehouse.key_rule(key)] = stored.agg(warehouse.repeated_keys(stored, key)).first()[0]
    return counts | {"total": sum(counts.values())}, warehouse.scorecard(spark, measured)


def _load_all(
    tables: dict[str, DataFrame], base: str, process_date: str, mode: str, states: dict[str, DataFrame]
) -> dict[str, tuple[int, dict[str, int]]]:
    """Table -> (rows written, rule -> failing rows)."""
    measured = {}
    base = base.rstrip("/")
    for table, df in tables.items():
        key = DIM_KEYS.get(table)
        how = "merge" if key and mode == "replace_date" else mode
        if table in states and mode == "replace_date":
            kept = f"{base}/state/{table}"
            load_table(states[table], kept, mode, f"{table}-state", process_date)
            schema = T.StructType([*states[table].schema.fields, T.StructField("date", T.DateType())])
            df = warehouse.FOLDS[table](read_table(df.sparkSession, kept, schema))
            how = "truncate"
        measured[table] = _load(df, f"{base}/{table}", how, table, process_date, key, table)
    return measured


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
    mode: str = "append", batch_size: int = 1000,
) -> None:
    """K4: JDBC sink in batches of ``batch_size`` rows (needs the driver jar on the
    classpath; ``mode="overwrite"`` with ``truncate`` keeps the table definition)."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    if mode == "overwrite":
        writer = writer.option("truncate", "true")
    writer.mode(mode).save()


def write_quarantine(rows: DataFrame, verdicts: DataFrame, path: str, file_col: str = "source_file") -> None:
    """K5: every row of every file that is not valid, partitioned by event type. ``path`` is
    the folder of one run or micro-batch and is replaced as a whole, so a replay changes
    nothing; raw files are left untouched."""
    bad = quality.route(rows, verdicts, file_col=file_col, valid=False)
    bad.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("event_type").parquet(path)


def write_error_reports(reports: DataFrame, path: str) -> None:
    """K6: one JSON document per invalid file (keys as in the established report format:
    processing time, error type, failed fields, first invalid rows) plus the file, in a folder
    named after the file (``report_folder`` gives it, so a report is found without a listing).
    ``path`` is the folder of one run or micro-batch, replaced as a whole."""
    t_key, type_key, fields_key, rows_key = REPORT_KEYS
    file = F.col(reports.columns[0])
    (
        reports.select(
            F.substring(F.sha2(file.cast("binary"), 256), 1, REPORT_NAME).alias("report"),
            file.alias("file"),
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(t_key),
            F.col("error_type").alias(type_key),
            F.col("failed_fields").alias(fields_key),
            F.col("first_invalid_rows").alias(rows_key),
        )
        .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("report")
        .json(path)
    )


def report_folder(path: str, file: str) -> str:
    """The folder below ``path`` that holds the report on ``file`` (its path as in the verdicts)."""
    return f"{path.rstrip('/')}/report={hashlib.sha256(file.encode()).hexdigest()[:REPORT_NAME]}"
