"""Validate raw event files as they arrive.

A Structured Streaming file source notices new CSV files; each micro-batch validates
exactly the files it brought (a file is never split across batches), so no streaming
state is needed. Verdicts, summaries, quarantined rows and reports go to a ``batch_id=``
folder each, which a batch replayed after a failure replaces as a whole.
The checkpoint remembers which files were seen, so a restart adds nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickmart.plans.ingest import validate_files
from clickmart.session import clear_scratch, scratch_mark
from clickmart.sinks.writers import write_error_reports, write_quarantine

# Fixed schema of Spark's binary-file source.
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"

QUARANTINE_DIR = "quarantine"


def _batch_files(batch: DataFrame) -> list[str]:
    """File paths of one micro-batch (at most ``maxFilesPerTrigger`` names). Files under
    a ``quarantine/`` directory are never validated again (S8)."""
    paths = batch.where(~F.col("path").contains(f"/{QUARANTINE_DIR}/")).select("path")
    return sorted({r[0] for r in paths.collect()})


def validate_batch(
    spark: SparkSession, paths: list[str], base: str | None, verdict_path: str, batch_id: int,
    quarantine_path: str | None = None, report_path: str | None = None, summary_path: str | None = None,
) -> None:
    if not paths:
        return
    mark = scratch_mark(spark)
    v = validate_files(spark, base=base, paths=paths)
    verdicts = v.verdicts.persist()
    verdicts.write.mode("overwrite").parquet(f"{verdict_path}/batch_id={batch_id}")
    if summary_path:
        batch_summary(verdicts.withColumn("batch_id", F.lit(batch_id))).drop("batch_id").write.mode(
            "overwrite").parquet(f"{summary_path}/batch_id={batch_id}")
    if quarantine_path:
        write_quarantine(v.checked, verdicts, f"{quarantine_path}/batch_id={batch_id}")
    if report_path:
        write_error_reports(v.error_reports(), f"{report_path.rstrip('/')}/batch_id={batch_id}")
    verdicts.unpersist()
    clear_scratch(spark, mark)  # the staged lines of this batch


def start_validation_stream(
    spark: SparkSession,
    base: str,
    verdict_path: str,
    checkpoint_path: str,
    max_files_per_trigger: int = 1,
    available_now: bool = True,
    processing_time: str | None = None,
    quarantine_path: str | None = None,
    report_path: str | None = None,
    summary_path: str | None = None,
) -> StreamingQuery:
    """Watch ``base`` (``year=/month=/day=`` tree) for new ``*.csv`` files."""
    # The stream only announces new files: the binary-file source with ``content``
    # pruned lists them without reading their bytes. Files are listed recursively (no
    # partition inference); the batch reader re-discovers partitions from the paths.
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", "true")
        .load(base.rstrip("/"))
        .select("path", "length")
    )

    def handle(batch: DataFrame, batch_id: int) -> None:
        validate_batch(
            batch.sparkSession, _batch_files(batch), base, verdict_path, batch_id,
            quarantine_path, report_path, summary_path,
        )

    writer = arrivals.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_path)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_verdicts(spark: SparkSession, verdict_path: str) -> DataFrame:
    """The verdict table accumulated by the stream."""
    return spark.read.parquet(verdict_path)


def batch_summary(verdicts: DataFrame) -> DataFrame:
    """Per micro-batch, files processed and how many were valid / not valid."""
    valid = F.col("status") == "valid"
    return verdicts.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(valid).alias("valid_files"),
        F.count_if(~valid).alias("invalid_files"),
        F.sum(F.when(valid, F.col("total_rows")).otherwise(0)).alias("valid_records"),
    )
