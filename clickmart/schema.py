"""Schemas and fixed domain values.

FIXED VALUES — these must stay equal to the source application's domain for results to
match: the five event types (in file-name matching order), the allowed page types and
cart actions, the funnel stage names, the anomaly labels, the columns of the raw files, and
the tables and columns of the warehouse. All of them lie between the two marks below.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------------------
EVENT_TYPES = ("page_view", "click", "search", "product_view", "cart_event")
PAGE_TYPES = ("home", "category", "product", "cart", "checkout")
CART_ACTIONS = ("add", "remove")
FUNNEL_STAGES = ("page_view", "product_view", "cart_add", "checkout")
ANOMALY_LABELS = ("z_score_and_iqr", "z_score", "iqr")
DEVICE_TYPES = ("mobile", "desktop", "tablet")
# Missing-value tokens pandas.read_csv recognises by default (pandas documentation).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Path separator used by the navigation-path metric.
PATH_SEPARATOR = "→"
# Error-report document keys (external JSON format), in document order:
# processing time, error type, failed fields, first problematic rows.
REPORT_KEYS = ("timestamp_proceso", "tipo_error", "campos_fallidos", "primeras_3_filas_problematicas")
COMMON_COLUMNS = ("user_id", "session_id", "timestamp")

# Columns each raw CSV carries, per event type (order as written by the producer).
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "page_view": (
        "user_id", "session_id", "page_url", "page_type", "timestamp",
        "time_on_page_seconds", "referrer", "device_type", "country",
    ),
    "click": (
        "user_id", "session_id", "element_id", "element_type", "page_url", "timestamp",
        "x_position", "y_position",
    ),
    "search": ("user_id", "session_id", "query", "results_count", "timestamp"),
    "product_view": (
        "user_id", "session_id", "product_id", "category", "price", "timestamp",
        "time_on_page_seconds",
    ),
    "cart_event": ("user_id", "session_id", "product_id", "action", "timestamp"),
}

# Every column name any event file may carry; used to recognise header lines.
KNOWN_COLUMNS: tuple[str, ...] = tuple(
    dict.fromkeys(c for cols in RAW_COLUMNS.values() for c in cols)
)

# Typed form of the unified (wide) event table after parsing.
TYPED_COLUMNS: dict[str, T.DataType] = {
    "user_id": T.StringType(),
    "session_id": T.StringType(),
    "timestamp": T.TimestampType(),
    "event_type": T.StringType(),
    "page_url": T.StringType(),
    "page_type": T.StringType(),
    "time_on_page_seconds": T.DoubleType(),
    "referrer": T.StringType(),
    "device_type": T.StringType(),
    "country": T.StringType(),
    "element_id": T.StringType(),
    "element_type": T.StringType(),
    "x_position": T.DoubleType(),
    "y_position": T.DoubleType(),
    "query": T.StringType(),
    "results_count": T.LongType(),
    "product_id": T.StringType(),
    "category": T.StringType(),
    "price": T.DoubleType(),
    "action": T.StringType(),
}


def all_string_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


# Warehouse tables: (column, Spark type) in declared order.
FACT_SCHEMAS: dict[str, list[tuple[str, T.DataType]]] = {
    "fact_top_pages": [
        ("date", T.DateType()),
        ("page_url", T.StringType()),
        ("avg_time_seconds", T.DecimalType(8, 2)),
        ("session_count", T.IntegerType()),
        ("rank", T.IntegerType()),
    ],
    "fact_bounce_rate": [
        ("date", T.DateType()),
        ("page_type", T.StringType()),
        ("bounce_rate", T.DecimalType(5, 2)),
        ("total_sessions", T.IntegerType()),
        ("bounced_sessions", T.IntegerType()),
    ],
    "fact_conversion_funnel": [
        ("date", T.DateType()),
        ("stage", T.StringType()),
        ("user_count", T.IntegerType()),
        ("conversion_rate", T.DecimalType(5, 4)),
    ],
    "fact_high_view_low_cart": [
        ("date", T.DateType()),
        ("product_id", T.StringType()),
        ("category", T.StringType()),
        ("avg_price", T.DecimalType(10, 2)),
        ("view_count", T.IntegerType()),
        ("cart_add_count", T.IntegerType()),
        ("conversion_rate", T.DecimalType(5, 4)),
    ],
    "fact_navigation_paths": [
        ("date", T.DateType()),
        ("path", T.StringType()),
        ("session_count", T.IntegerType()),
        ("rank", T.IntegerType()),
    ],
    "fact_device_country_time": [
        ("date", T.DateType()),
        ("device_type", T.StringType()),
        ("country", T.StringType()),
        ("avg_time_seconds", T.DecimalType(8, 2)),
        ("session_count", T.IntegerType()),
    ],
    "fact_anomalies": [
        ("date", T.DateType()),
        ("session_id", T.StringType()),
        ("user_id", T.StringType()),
        ("page_type", T.StringType()),
        ("time_on_page", T.DecimalType(8, 2)),
        ("z_score", T.DecimalType(6, 3)),
        ("is_iqr_outlier", T.BooleanType()),
        ("anomaly_type", T.StringType()),
    ],
}

DIM_SCHEMAS: dict[str, list[tuple[str, T.DataType]]] = {
    "dim_product": [
        ("product_id", T.StringType()),
        ("category", T.StringType()),
        ("avg_price", T.DecimalType(10, 2)),
    ],
    "dim_page": [("page_url", T.StringType()), ("page_type", T.StringType())],
    "dim_date": [
        ("date_id", T.DateType()),
        ("year", T.IntegerType()),
        ("month", T.IntegerType()),
        ("day", T.IntegerType()),
        ("day_of_week", T.IntegerType()),
    ],
}

# Primary keys of the dimensions (checked as data-quality rules).
DIM_KEYS = {"dim_product": "product_id", "dim_page": "page_url", "dim_date": "date_id"}

# Metric dataset name -> warehouse fact table.
METRIC_TO_FACT = {
    "top_pages": "fact_top_pages",
    "bounce_rate": "fact_bounce_rate",
    "conversion_funnel": "fact_conversion_funnel",
    "high_view_low_cart": "fact_high_view_low_cart",
    "navigation_paths": "fact_navigation_paths",
    "device_country_time": "fact_device_country_time",
    "anomalies": "fact_anomalies",
}
# --- end fixed values ---------------------------------------------------------------
