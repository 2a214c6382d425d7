"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver's tables through the fixture adapter and runs the library
operator over the whole table. Results are presented with doubles rounded to six
decimals, the same rounding the oracle SQL applies.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.functions.columns import round_doubles
from clickmart.operators import cleaning, metrics, quality, serving, warehouse
from clickmart.schema import METRIC_TO_FACT, RAW_COLUMNS
from clickmart.sources import fixture

Query = Callable[[SparkSession, str], DataFrame]


def canon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.load_canon(spark, sf_dir)


def deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.dedup_events(canon(spark, sf_dir), order_by=[F.col("event_id")])


def cleaned(spark: SparkSession, sf_dir: str, *needs: cleaning.Imputation) -> DataFrame:
    """Cleaned events with the imputations that the query reads. Without any it is a plain
    lazy plan; with some, the deduped layer is written once to shared storage, as medians
    and metric both read it."""
    if not needs:
        return deduped(spark, sf_dir)
    from clickmart.session import scratch_dir

    stored = cleaning.materialize(
        deduped(spark, sf_dir), path=f"{scratch_dir(spark, 'dedup')}/events", partition_by=["event_type"]
    )
    return cleaning.impute(stored, *needs)


def stage(df: DataFrame) -> DataFrame:
    """A small derived table, written to shared storage where several steps read it."""
    from clickmart.session import scratch_dir

    return cleaning.materialize(df, f"{scratch_dir(df.sparkSession, 'table')}/rows")


#: Imputed columns that each metric reads.
NEEDS: dict[str, tuple[cleaning.Imputation, ...]] = {
    "top_pages": (cleaning.TIME,),
    "bounce_rate": (),
    "conversion_funnel": (),
    "high_view_low_cart": (cleaning.PRICE,),
    "navigation_paths": (),
    "device_country_time": (cleaning.TIME,),
    "anomalies": (cleaning.TIME,),
}


def _on_clean(fn, *needs: cleaning.Imputation) -> Query:
    return lambda spark, sf_dir: round_doubles(fn(cleaned(spark, sf_dir, *needs)))


def q_dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = canon(spark, sf_dir).select(
        "event_id", "user_id", "session_id",
        # hour truncation in wall-clock (NTZ) arithmetic: independent of the session zone
        F.make_timestamp_ntz(
            F.year("timestamp"), F.month("timestamp"), F.dayofmonth("timestamp"),
            F.hour("timestamp"), F.lit(0), F.lit(0),
        ).alias("timestamp_hour"),
        "event_type",
    )
    return cleaning.dedup_events(
        keyed, keys=("user_id", "session_id", "timestamp_hour", "event_type"), order_by=[F.col("event_id")]
    )


def q_union_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = canon(spark, sf_dir)
    frames = {}
    for et, cols in RAW_COLUMNS.items():
        keep = ["event_id", *[x for x in cols if x in c.columns]]
        frames[et] = c.where(F.col("event_type") == et).select(*keep)
    return cleaning.union_events(frames)


def q_impute_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir, cleaning.TIME).select(
        "event_id", "event_type", "page_type", "time_on_page_seconds"
    )


def q_impute_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir, cleaning.PRICE).select("event_id", "event_type", "category", "price")


def high_view_low_cart(events: DataFrame) -> DataFrame:
    return metrics.high_view_low_cart(events, stage)


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {m: _on_clean(fn, *NEEDS[m]) for m, fn in METRIC_FUNCS.items()}
    q.update({
        "zscore_by_page_type": _on_clean(metrics.zscore_by_page_type, cleaning.TIME),
        "iqr_fences": _on_clean(metrics.iqr_fences, cleaning.TIME),
        "dedup_events": q_dedup_events,
        "union_events": q_union_events,
        "impute_time_on_page": q_impute_time,
        "impute_price": q_impute_price,
    })
    q.update(validation_registry())
    q.update(warehouse_registry())
    q["stream_file_verdicts"] = q_stream_file_verdicts
    q["csv_file_verdicts"] = q_csv_file_verdicts
    q["csv_quoted_cells"] = q_csv_quoted_cells
    q["pipeline_facts_valid_only"] = q_pipeline_facts_valid_only
    return q


# --- validation (fixture form: a "file" is one event type on one day) -----------------
def checked_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = fixture.load_dirty(spark, sf_dir)
    d = d.withColumn(
        "row_bytes", F.octet_length(F.concat_ws(",", *[F.col(c) for c in fixture.RAW_TEXT_COLUMNS])) + 1
    )
    return quality.check_rows(d, columns={"timestamp": "ts_text"})


def dirty_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.file_verdicts(checked_dirty(spark, sf_dir), size_agg=F.sum("row_bytes"))


def _present_verdicts(v: DataFrame) -> DataFrame:
    return v.withColumn("failed_fields", F.array_join("failed_fields", ","))


def q_infer_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = fixture.load_dirty(spark, sf_dir).select("file_key").distinct()
    return keys.select("file_key", quality.infer_event_type(F.col("file_key")).alias("inferred_event_type"))


def _flags(event_type: str | None, *fields: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        c = checked_dirty(spark, sf_dir)
        if event_type is not None:
            c = c.where(F.col("event_type") == event_type)
        extra = ["row_invalid"] if event_type is not None else []
        return c.select("event_id", "file_id", *[quality.flag(f) for f in fields], *extra)
    return run


def q_file_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present_verdicts(dirty_verdicts(spark, sf_dir))


def q_ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(quality.ingest_metrics(dirty_verdicts(spark, sf_dir)))


def _route(valid: bool):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = fixture.load_dirty(spark, sf_dir).select("event_id", "file_id", "event_type")
        return quality.route(rows, dirty_verdicts(spark, sf_dir), valid=valid)
    return run


def q_error_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = stage(checked_dirty(spark, sf_dir))  # rules run once; verdicts and samples read the flags
    verdicts = quality.file_verdicts(checked, size_agg=F.sum("row_bytes"))
    samples = quality.first_invalid_rows(checked, ["row_pos"])
    bad = verdicts.where(F.col("status") == "invalid").select(
        "file_id", F.lit("validation_error").alias("error_type"),
        F.array_join("failed_fields", ",").alias("failed_fields"),
    )
    return bad.join(samples, "file_id").select(
        "file_id", "error_type", "failed_fields", "sample_rank", "event_id", *fixture.RAW_TEXT_COLUMNS
    )


def validation_registry() -> dict[str, Query]:
    return {
        "infer_event_type": q_infer_event_type,
        "validate_common": _flags(None, "user_id", "session_id", "timestamp"),
        "validate_page_view": _flags("page_view", "page_type", "time_on_page_seconds"),
        "validate_product_view": _flags("product_view", "price", "product_id"),
        "validate_cart_event": _flags("cart_event", "action"),
        "validate_click": _flags("click", "x_position", "y_position"),
        "file_verdicts": q_file_verdicts,
        "ingest_metrics": q_ingest_metrics,
        "route_valid": _route(True),
        "route_quarantine": _route(False),
        "error_report": q_error_report,
    }


# --- warehouse and serving --------------------------------------------------------------
RUN_DATE = fixture.FIXTURE_RUN_DATE

METRIC_FUNCS = {
    "top_pages": metrics.top_pages,
    "bounce_rate": metrics.bounce_rate,
    "conversion_funnel": metrics.conversion_funnel,
    "high_view_low_cart": high_view_low_cart,
    "navigation_paths": metrics.navigation_paths,
    "device_country_time": metrics.device_country_time,
    "anomalies": metrics.anomalies,
}


def _fact(metric: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return warehouse.build_fact(metric, METRIC_FUNCS[metric](cleaned(spark, sf_dir, *NEEDS[metric])), RUN_DATE)
    return run


def _dim(fn, *needs: cleaning.Imputation) -> Query:
    return lambda spark, sf_dir: fn(cleaned(spark, sf_dir, *needs))


def q_valid_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.valid_records(_fact("anomalies")(spark, sf_dir))


def q_dq_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten tables are loaded into a scratch warehouse and scored by that load."""
    from clickmart.session import scratch_dir
    from clickmart.sinks.writers import load_scored

    events = cleaned(spark, sf_dir, cleaning.TIME, cleaning.PRICE)
    tables = warehouse.all_tables(events, {m: fn(events) for m, fn in METRIC_FUNCS.items()}, RUN_DATE)
    return load_scored(tables, scratch_dir(spark, "dq"), RUN_DATE)[1]


def q_load_from_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two metrics written by date and loaded by the ledger job, one of them late; a third
    run finds nothing to load."""
    from clickmart.plans.load import load_pending
    from clickmart.session import scratch_dir
    from clickmart.sinks.writers import write_metric

    root = scratch_dir(spark, "ledger")
    events = cleaned(spark, sf_dir)
    write_metric(metrics.bounce_rate(events), f"{root}/metrics", "bounce_rate", RUN_DATE)
    load_pending(spark, f"{root}/metrics", f"{root}/dwh")
    write_metric(metrics.conversion_funnel(events), f"{root}/metrics", "conversion_funnel", RUN_DATE)
    load_pending(spark, f"{root}/metrics", f"{root}/dwh")
    if load_pending(spark, f"{root}/metrics", f"{root}/dwh"):
        raise RuntimeError("a loaded date was loaded again")
    bounce = serving.stored_fact(spark, f"{root}/dwh", "bounce_rate").select(
        F.lit("bounce_rate").alias("fact"), F.col("page_type").alias("name"),
        F.col("total_sessions").cast("long").alias("n"), F.col("bounced_sessions").cast("long").alias("m"))
    funnel = serving.stored_fact(spark, f"{root}/dwh", "conversion_funnel").select(
        F.lit("conversion_funnel").alias("fact"), F.col("stage").alias("name"),
        F.col("user_count").cast("long").alias("n"), F.lit(None).cast("long").alias("m"))
    return bounce.unionByName(funnel)


def _report(metric: str, fn) -> Query:
    return lambda spark, sf_dir: fn(_fact(metric)(spark, sf_dir))


def warehouse_registry() -> dict[str, Query]:
    q: dict[str, Query] = {METRIC_TO_FACT[m]: _fact(m) for m in METRIC_FUNCS}
    q.update({
        "dim_product": _dim(warehouse.dim_product, cleaning.PRICE),
        "dim_page": _dim(warehouse.dim_page),
        "dim_date": _dim(warehouse.dim_date),
        "valid_records": q_valid_records,
        "dq_scorecard": q_dq_scorecard,
        "load_from_metrics": q_load_from_metrics,
        "report_pages_time": _report(
            "top_pages", lambda f: serving.pages_top(f, "time_on_page", RUN_DATE, 10)),
        "report_pages_bounce": _report(
            "bounce_rate", lambda f: serving.pages_top(f, "bounce_rate", RUN_DATE, 10)),
        "report_sessions": _report(
            "device_country_time", lambda f: serving.sessions_summary(f, RUN_DATE, device="mobile")),
        "report_anomalies": _report("anomalies", lambda f: serving.anomalies_report(f, RUN_DATE)),
        "report_anomaly_total": _report("anomalies", lambda f: serving.anomalies_total(f, RUN_DATE)),
    })
    return q


# --- streaming ----------------------------------------------------------------------------
def q_stream_file_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1–T3 end to end: stage the dirty rows as raw CSV files on shared storage, validate
    them with the file stream (availableNow, 50 files per micro-batch), read the verdicts."""
    from clickmart.session import scratch_dir
    from clickmart.streaming.validate_stream import read_verdicts, start_validation_stream

    root = scratch_dir(spark, "stream")
    fixture.write_dirty_csv(fixture.load_dirty(spark, sf_dir), f"{root}/raw")
    query = start_validation_stream(
        spark, f"{root}/raw", f"{root}/verdicts", f"{root}/checkpoint", max_files_per_trigger=50
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    v = read_verdicts(spark, f"{root}/verdicts")
    return v.select(
        fixture.file_id_from_path(F.col("source_file")).alias("file_id"),
        "event_type", "status",
        F.array_join("failed_fields", ",").alias("failed_fields"),
        "invalid_rows", "total_rows",
    )


# --- raw CSV files ------------------------------------------------------------------------
def q_csv_file_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V13 over raw CSVs staged per event type (five headers), where one day's page views
    carry an unknown column, one day's clicks have their columns reordered, and one day's
    product views lack the price."""
    from clickmart.plans.ingest import validate_files
    from clickmart.session import scratch_dir

    root = f"{scratch_dir(spark, 'csv')}/raw"
    fixture.write_typed_csv(fixture.load_dirty(spark, sf_dir), root)
    v = validate_files(spark, base=root, pattern="event_type=*/*.csv").verdicts
    return v.select(
        fixture.file_id_from_path(F.col("source_file")).alias("file_id"), "event_type", "status",
        F.array_join("failed_fields", ",").alias("failed_fields"), "invalid_rows", "total_rows",
    )


def q_csv_quoted_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V13 over raw CSVs whose quoted cells hold commas, quotes and line breaks."""
    from clickmart.plans.ingest import validate_files
    from clickmart.session import scratch_dir

    root = f"{scratch_dir(spark, 'csv')}/raw"
    fixture.write_quoted_csv(fixture.load_dirty(spark, sf_dir), root)
    v = validate_files(spark, base=root, pattern="event_type=*/*.csv").verdicts
    return v.select(
        fixture.file_id_from_path(F.col("source_file")).alias("file_id"), "event_type", "status",
        F.array_join("failed_fields", ",").alias("failed_fields"), "invalid_rows", "total_rows",
    )


def q_pipeline_facts_valid_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily run over raw CSVs of which a third are invalid: facts of the valid files."""
    from clickmart.plans import pipeline
    from clickmart.session import scratch_dir

    root = scratch_dir(spark, "facts")
    fixture.write_typed_csv(fixture.load_dirty(spark, sf_dir), f"{root}/raw")
    pipeline.run(spark, f"{root}/raw", f"{root}/out", RUN_DATE, scope="all",
                 warehouse_path=f"{root}/dwh", pattern="event_type=*/*.csv")
    read = lambda t: spark.read.parquet(f"{root}/dwh/{t}")
    bounce = read("fact_bounce_rate").select(
        F.lit("bounce_rate").alias("fact"), F.col("page_type").alias("name"),
        F.col("total_sessions").cast("long").alias("n"), F.col("bounced_sessions").cast("long").alias("m"))
    funnel = read("fact_conversion_funnel").select(
        F.lit("conversion_funnel").alias("fact"), F.col("stage").alias("name"),
        F.col("user_count").cast("long").alias("n"), F.lit(None).cast("long").alias("m"))
    products = read("dim_product").select(
        F.lit("dim_product").alias("fact"), F.col("product_id").alias("name"),
        (F.col("avg_price") * 100).cast("long").alias("n"), F.lit(None).cast("long").alias("m"))
    return bounce.unionByName(funnel).unionByName(products)
