"""Warehouse conform (W1–W19): typed fact and dimension tables plus data-quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.functions.columns import stable
from clickmart.schema import DIM_KEYS, DIM_SCHEMAS, FACT_SCHEMAS, FUNNEL_STAGES

# --- fixed values: (source column, target column) per metric (W4) ---
MAPPINGS: dict[str, list[tuple[str, str]]] = {
    "top_pages": [
        ("date", "date"), ("page_url", "page_url"), ("avg_time_on_page_seconds", "avg_time_seconds"),
        ("event_count", "session_count"), ("rank", "rank"),
    ],
    "bounce_rate": [
        ("date", "date"), ("page_type", "page_type"), ("bounce_rate", "bounce_rate"),
        ("total_sessions", "total_sessions"), ("bounced_sessions", "bounced_sessions"),
    ],
    "conversion_funnel": [
        ("date", "date"), ("stage", "stage"), ("user_count", "user_count"),
        ("conversion_rate", "conversion_rate"),
    ],
    "high_view_low_cart": [
        ("date", "date"), ("product_id", "product_id"), ("category", "category"),
        ("avg_price", "avg_price"), ("view_count", "view_count"), ("cart_add_count", "cart_add_count"),
        ("conversion_rate", "conversion_rate"),
    ],
    "navigation_paths": [
        ("date", "date"), ("path", "path"), ("session_count", "session_count"), ("rank", "rank"),
    ],
    "device_country_time": [
        ("date", "date"), ("device_type", "device_type"), ("country", "country"),
        ("avg_time_on_page_seconds", "avg_time_seconds"), ("distinct_sessions", "session_count"),
    ],
    "anomalies": [
        ("date", "date"), ("session_id", "session_id"), ("user_id", "user_id"),
        ("page_type", "page_type"), ("time_on_page_seconds", "time_on_page"), ("z_score", "z_score"),
        ("is_iqr_outlier", "is_iqr_outlier"), ("anomaly_type", "anomaly_type"),
    ],
}

# --- end fixed values ---
# Order that defines ``rank`` for the ranked facts (W2): (column, descending); the key
# column breaks ties.
RANK_ORDER: dict[str, list[tuple[str, bool]]] = {
    "top_pages": [("avg_time_on_page_seconds", True), ("page_url", False)],
    "navigation_paths": [("session_count", True), ("path", False)],
}


def with_process_date(df: DataFrame, process_date: str) -> DataFrame:
    """The run's process date as a DATE column."""
    return df.withColumn("date", F.lit(process_date).cast("date"))


def with_rank(df: DataFrame, order: list[Column]) -> DataFrame:
    """1-based position in ``order``. Only for top-k outputs (at most k rows), so the
    single-partition window is bounded by k."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def funnel_long(funnel: DataFrame) -> DataFrame:
    """Wide funnel row -> one row per stage; rate as a fraction, NULL for stage 1."""
    s1, s2, s3, s4 = FUNNEL_STAGES
    return funnel.select(
        F.expr(
            "stack(4, "
            f"'{s1}', stage1_page_view_users, CAST(NULL AS DOUBLE), "
            f"'{s2}', stage2_product_view_users, stage2_over_stage1_pct, "
            f"'{s3}', stage3_cart_add_users, stage3_over_stage2_pct, "
            f"'{s4}', stage4_checkout_users, stage4_over_stage3_pct"
            ") AS (stage, user_count, pct)"
        )
    ).select(
        "stage",
        F.coalesce(F.col("user_count"), F.lit(0)).alias("user_count"),
        (F.col("pct") / F.lit(100.0)).alias("conversion_rate"),
    )


def apply_mapping(df: DataFrame, mapping: list[tuple[str, str]], schema: list[tuple[str, T.DataType]]) -> DataFrame:
    """Rename, cast and project. Values that do not fit the target type (e.g. a
    DECIMAL overflow) become NULL instead of failing the load."""
    types = dict(schema)
    def typed(src: str, dst: str) -> Column:
        value = F.col(src)
        if isinstance(types[dst], T.DecimalType) and isinstance(df.schema[src].dataType, T.DoubleType):
            value = stable(value)  # the rounding to decimals mustn't depend on the summation order
        return value.try_cast(types[dst]).alias(dst)

    return df.select(*[typed(src, dst) for src, dst in mapping])


def build_fact(metric: str, metric_df: DataFrame, process_date: str) -> DataFrame:
    """Metric output -> typed warehouse fact table."""
    df = metric_df
    if metric == "conversion_funnel":
        df = funnel_long(df)
    if metric in RANK_ORDER:
        df = with_rank(df, [stable(c).desc() if d else F.asc(c) for c, d in RANK_ORDER[metric]])
    df = with_process_date(df, process_date)
    table = _fact_table(metric)
    return apply_mapping(df, MAPPINGS[metric], FACT_SCHEMAS[table])


def _fact_table(metric: str) -> str:
    from clickmart.schema import METRIC_TO_FACT

    return METRIC_TO_FACT[metric]


def _typed(df: DataFrame, table: str) -> DataFrame:
    schema = DIM_SCHEMAS[table]
    return apply_mapping(df, [(c, c) for c, _ in schema], schema)


def dim_product(events: DataFrame) -> DataFrame:
    """Product -> category (smallest seen) and average viewed price."""
    pv = events.where((F.col("event_type") == "product_view") & F.col("product_id").isNotNull())
    return _typed(
        pv.groupBy("product_id").agg(
            F.min("category").alias("category"), F.avg("price").alias("avg_price")
        ),
        "dim_product",
    )


def product_state(events: DataFrame) -> DataFrame:
    """W12 as a mergeable aggregate of one load: smallest category, sum and count of viewed prices."""
    pv = events.where((F.col("event_type") == "product_view") & F.col("product_id").isNotNull())
    return pv.groupBy("product_id").agg(
        F.min("category").alias("category"), F.sum("price").alias("price_sum"), F.count("price").alias("price_count"))


def fold_products(states: DataFrame) -> DataFrame:
    """``dim_product`` over all loads: the mean of all prices, not of the last load's."""
    whole = states.groupBy("product_id").agg(
        F.min("category").alias("category"), F.sum("price_sum").alias("price_sum"), F.sum("price_count").alias("n"))
    mean = F.when(F.col("n") > 0, F.col("price_sum") / F.col("n"))
    return _typed(whole.select("product_id", "category", mean.alias("avg_price")), "dim_product")


#: Dimensions that are folded from the stored states of all loads.
FOLDS = {"dim_product": fold_products}


def dim_page(events: DataFrame) -> DataFrame:
    """Page URL -> page type (smallest seen) over page views."""
    pv = events.where((F.col("event_type") == "page_view") & F.col("page_url").isNotNull())
    return _typed(pv.groupBy("page_url").agg(F.min("page_type").alias("page_type")), "dim_page")


def dim_date(events: DataFrame) -> DataFrame:
    """Every day between the first and last event; ISO weekday (Monday = 1)."""
    bounds = events.agg(
        F.min(F.to_date("timestamp")).alias("lo"), F.max(F.to_date("timestamp")).alias("hi")
    ).where(F.col("lo").isNotNull())
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date_id"))
    return _typed(
        days.select(
            "date_id",
            F.year("date_id").alias("year"),
            F.month("date_id").alias("month"),
            F.dayofmonth("date_id").alias("day"),
            (F.weekday("date_id") + 1).alias("day_of_week"),
        ),
        "dim_date",
    )


def all_tables(events: DataFrame, results: dict[str, DataFrame], process_date: str) -> dict[str, DataFrame]:
    """Every warehouse table: the facts of the metric ``results`` and the dimensions."""
    tables = {_fact_table(m): build_fact(m, df, process_date) for m, df in results.items()}
    return tables | {"dim_product": dim_product(events), "dim_page": dim_page(events), "dim_date": dim_date(events)}


# W15 / W16 ---------------------------------------------------------------------------
TIME_COLUMNS = ("time_on_page", "avg_time_seconds")


def valid_records(df: DataFrame) -> DataFrame:
    """Keep rows with a date, non-NULL ids (where present), times in [0, 3600]."""
    cond = F.col("date").isNotNull()
    for c in ("session_id", "user_id"):
        if c in df.columns:
            cond = cond & F.col(c).isNotNull()
    for c in TIME_COLUMNS:
        if c in df.columns:
            cond = cond & F.coalesce(F.col(c).between(0, 3600), F.lit(False))
    return df.where(cond)


def dq_rules(df: DataFrame, table: str) -> list[tuple[str, Column | None]]:
    """(rule name, failing-row predicate); ``None`` = column missing (fails)."""
    rules: list[tuple[str, Column | None]] = [
        ('ColumnExists "date"', F.lit(False) if "date" in df.columns else None),
    ]
    for c in ("date", "session_id", "user_id"):
        if c in df.columns:
            rules.append((f'ColumnValues "{c}" IS NOT NULL', F.col(c).isNull()))
    for c in TIME_COLUMNS:
        if c in df.columns:
            rules.append((f'ColumnValues "{c}" BETWEEN 0 AND 3600', ~F.coalesce(F.col(c).between(0, 3600), F.lit(False))))
    return rules


def row_checks(df: DataFrame, table: str) -> dict[str, Column]:
    """Rule -> failing-row predicate (a missing column fails every row); dimensions carry no date."""
    rules = [r for r in dq_rules(df, table) if not (r[0].startswith("ColumnExists") and table in DIM_KEYS)]
    return {name: F.lit(True) if pred is None else pred for name, pred in rules}


def key_rule(key: str) -> str:
    return f'IsPrimaryKey "{key}"'


def repeated_keys(df: DataFrame, key: str) -> Column:
    return F.count(F.lit(1)) - F.count_distinct(df[key])


def scorecard(spark: SparkSession, measured: dict[str, tuple[int, dict[str, int]]]) -> DataFrame:
    """One row per (table, rule) of what was measured: table -> (rows checked, rule -> failing rows)."""
    rows = [
        (table, rule, n, failed, "pass" if failed == 0 else "fail")
        for table, (n, rules) in measured.items() for rule, failed in rules.items()
    ]
    return spark.createDataFrame(
        rows, "table_name string, rule string, rows_checked long, failed_rows long, outcome string")


def dq_scorecard(tables: dict[str, DataFrame]) -> DataFrame:
    """W16 of tables that lie somewhere already: each is scanned once, for all its rules. What is
    being loaded is scored by the load itself (``sinks.load_scored``)."""
    measured = {}
    for table, df in tables.items():
        aggs = {rule: F.count_if(pred) for rule, pred in row_checks(df, table).items()}
        key = DIM_KEYS.get(table)
        if key:
            aggs[key_rule(key)] = repeated_keys(df, key)
        found = df.agg(F.count(F.lit(1)), *aggs.values()).first()
        measured[table] = (found[0], dict(zip(aggs, found[1:], strict=True)))
    return scorecard(next(iter(tables.values())).sparkSession, measured)
