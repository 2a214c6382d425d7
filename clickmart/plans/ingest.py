"""Batch validation of raw event files: verdicts, routing, quarantine and reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.operators import quality
from clickmart.schema import KNOWN_COLUMNS, all_string_schema
from clickmart.sources.csv_events import RawEvents, check_raw, read_raw

FILE_COL = "source_file"
ORDER_COLS = ["block_start", "row_id"]


@dataclass
class Validation:
    checked: DataFrame
    files: DataFrame
    verdicts: DataFrame
    has_rows: bool = True

    def valid_rows(self) -> DataFrame:
        return quality.route(self.checked, self.verdicts, file_col=FILE_COL, valid=True)

    def quarantined_rows(self) -> DataFrame:
        return quality.route(self.checked, self.verdicts, file_col=FILE_COL, valid=False)

    def error_reports(self, n: int = 3) -> DataFrame:
        samples = quality.first_invalid_rows(self.checked, ORDER_COLS, file_col=FILE_COL, n=n)
        raw_cols = [
            c for c in self.checked.columns
            if c not in {"source_file", "file_size", "block_start", "row_id", "event_type", "row_invalid",
                         "missing_fields", "header"}
            and not c.startswith("invalid_")
        ]
        return quality.error_reports(self.verdicts, samples, raw_cols, file_col=FILE_COL)

    def metrics(self) -> DataFrame:
        return quality.ingest_metrics(self.verdicts)


def _empty_checked(spark: SparkSession) -> DataFrame:
    names = [*KNOWN_COLUMNS, "source_file", "event_type"]
    base = spark.createDataFrame([], all_string_schema(names)).withColumn("header", F.array().cast("array<string>"))
    for c in ("file_size", *ORDER_COLS):
        base = base.withColumn(c, F.lit(None).cast("long"))
    return quality.check_rows(base, header="header")


def validate_raw(raw: RawEvents) -> Validation:
    checked, files = check_raw(raw)
    if checked is None:
        checked = _empty_checked(files.sparkSession)
    verdicts = quality.file_verdicts(
        checked, file_col=FILE_COL, size_agg=F.max("file_size"), files=files
    )
    return Validation(checked, files, verdicts, raw.rows is not None)


def validate_files(
    spark: SparkSession, base: str | None = None, dates: list[str] | None = None,
    paths: list[str] | None = None,
    pattern: str = "*.csv",
) -> Validation:
    """V13–V15 over raw CSVs (all days, some days, or an explicit file list)."""
    return validate_raw(read_raw(spark, base=base, dates=dates, paths=paths, pattern=pattern))
