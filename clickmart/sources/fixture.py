"""Adapter from the driver's ``events`` table to canonical clickstream events.

The driver tables carry a generic ``events`` stream (event_id, ts, user_id, event_type,
value, props). This module projects it into the five clickstream event kinds with the
columns the application expects (see FIXTURES.md §3), and into a "dirty" raw-text form
(FIXTURES.md §4) that exercises file validation. Everything is a single projection over
the scan, so the adapter is one map-only stage whatever the input size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES of the adapter (FIXTURES.md §3): lookup lists indexed from 0.
FIXTURE_PAGE_TYPES = ["home", "category", "product", "cart", "checkout"]
FIXTURE_DEVICES = ["mobile", "desktop", "tablet"]
FIXTURE_COUNTRIES = ["Colombia", "Mexico", "Argentina", "Chile", "Peru", "Ecuador", "Uruguay"]
# Process-date label used for fixture runs of the daily pipeline (last day of the data).
FIXTURE_RUN_DATE = "2024-01-30"

EVENT_COLUMNS = (
    "event_id", "user_id", "session_id", "timestamp", "event_type", "page_url", "page_type",
    "time_on_page_seconds", "device_type", "country", "product_id", "category", "price",
    "action", "x_position", "y_position",
)

RAW_TEXT_COLUMNS = (
    "user_id", "session_id", "ts_text", "page_type", "time_on_page_seconds", "price",
    "product_id", "action", "x_position", "y_position",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sql_list(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def canon_events(events: DataFrame) -> DataFrame:
    """Project driver ``events`` rows into canonical clickstream events.

    Written as SQL expressions: one projection, three analysed steps, no per-column
    round trips from Python.
    """
    src = events.selectExpr(
        "event_id", "ts", "user_id AS src_user", "event_type AS src_type", "value",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
    )
    typed = src.selectExpr(
        "*",
        "lpad(CAST(src_user * 10 + floor((dayofmonth(ts) - 1) / 7) AS STRING), 32, '0') AS user_id",
        """CASE WHEN src_type = 'view' THEN 'page_view'
                WHEN src_type = 'error' AND k >= 25 THEN 'page_view'
                WHEN src_type = 'error' THEN 'search'
                WHEN src_type = 'signup' THEN 'product_view'
                WHEN src_type = 'purchase' THEN 'cart_event'
                WHEN src_type = 'click' THEN 'click' END AS event_type""",
    )
    return typed.selectExpr(
        "event_id",
        "user_id",
        "concat('S', user_id, '-', date_format(ts, 'yyyyMMdd')) AS session_id",
        "ts AS timestamp",
        "event_type",
        """CASE WHEN event_type IN ('page_view', 'click') THEN
             CASE k % 5 WHEN 0 THEN '/'
                        WHEN 1 THEN concat('/category/category_', lpad(CAST(k % 10 AS STRING), 2, '0'))
                        WHEN 2 THEN concat('/product/PROD-', lpad(CAST(k AS STRING), 4, '0'))
                        WHEN 3 THEN '/cart' ELSE '/checkout' END END AS page_url""",
        f"""CASE WHEN event_type = 'page_view'
             THEN element_at({_sql_list(FIXTURE_PAGE_TYPES)}, k % 5 + 1) END AS page_type""",
        """CASE WHEN event_type IN ('page_view', 'product_view') AND k % 17 <> 0 THEN value END
             AS time_on_page_seconds""",
        f"""CASE WHEN event_type = 'page_view'
             THEN element_at({_sql_list(FIXTURE_DEVICES)}, CAST(event_id % 3 + 1 AS INT)) END AS device_type""",
        f"""CASE WHEN event_type = 'page_view'
             THEN element_at({_sql_list(FIXTURE_COUNTRIES)}, CAST(src_user % 7 + 1 AS INT)) END AS country""",
        """CASE WHEN event_type IN ('product_view', 'cart_event')
             THEN concat('PROD-', lpad(CAST(k AS STRING), 4, '0')) END AS product_id""",
        """CASE WHEN event_type = 'product_view'
             THEN concat('category_', lpad(CAST(k % 10 AS STRING), 2, '0')) END AS category""",
        "CASE WHEN event_type = 'product_view' AND k % 13 <> 0 THEN value END AS price",
        """CASE WHEN event_type = 'cart_event' THEN CASE WHEN k % 5 = 0 THEN 'remove' ELSE 'add' END END
             AS action""",
        "CASE WHEN event_type = 'click' THEN CAST(event_id % 1921 AS DOUBLE) END AS x_position",
        "CASE WHEN event_type = 'click' THEN CAST(event_id % 1081 AS DOUBLE) END AS y_position",
    )


def load_canon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon_events(read_table(spark, sf_dir, "events"))


def dirty_events(canon: DataFrame) -> DataFrame:
    """Raw-text events with rule violations on every third day (FIXTURES.md §4).

    Output columns are all strings except the tie-break ``event_id`` and ``row_pos``
    (position of the row inside its file), plus ``file_id`` / ``file_key``.
    """
    flagged = canon.selectExpr("*", "dayofmonth(timestamp) % 3 = 0 AS dd")
    return flagged.selectExpr(
        "event_id",
        "event_id AS row_pos",
        "event_type",
        "concat(event_type, '/', date_format(timestamp, 'yyyy-MM-dd')) AS file_id",
        """concat('events/year=', date_format(timestamp, 'yyyy'), '/month=', date_format(timestamp, 'MM'),
                  '/day=', date_format(timestamp, 'dd'), '/', event_type, '.csv') AS file_key""",
        """CASE WHEN dd AND event_id % 97 = 0 THEN concat('bad-', CAST(event_id AS STRING))
                WHEN dd AND event_id % 101 = 0 THEN CAST(NULL AS STRING) ELSE user_id END AS user_id""",
        "CASE WHEN dd AND event_id % 89 = 0 THEN '  ' ELSE session_id END AS session_id",
        """CASE WHEN dd AND event_id % 83 = 0 THEN 'not-a-date'
                ELSE date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss") END AS ts_text""",
        """CASE WHEN event_type = 'page_view' AND dd AND event_id % 41 = 0 THEN 'unknown'
                ELSE page_type END AS page_type""",
        """CAST(CASE WHEN event_type = 'page_view' AND NOT dd
                     THEN greatest(coalesce(time_on_page_seconds, 1.0D), 1.0D)
                     ELSE time_on_page_seconds END AS STRING) AS time_on_page_seconds""",
        """CASE WHEN event_type = 'product_view' THEN
             CASE WHEN dd AND event_id % 29 = 0 THEN '-1' ELSE CAST(coalesce(price, 9.5D) AS STRING) END
           END AS price""",
        """CASE WHEN event_type = 'product_view' AND dd AND event_id % 43 = 0 THEN ''
                ELSE product_id END AS product_id""",
        """CASE WHEN event_type = 'cart_event' AND dd AND event_id % 47 = 0 THEN 'hold'
                ELSE action END AS action""",
        """CASE WHEN event_type = 'click' THEN
             CASE WHEN dd AND event_id % 31 = 0 THEN '-5' ELSE CAST(event_id % 1921 AS STRING) END
           END AS x_position""",
        """CASE WHEN event_type = 'click' THEN
             CASE WHEN dd AND event_id % 37 = 0 THEN '1.5' ELSE CAST(event_id % 1081 AS STRING) END
           END AS y_position""",
    )


def load_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_events(load_canon(spark, sf_dir))


def write_dirty_csv(dirty: DataFrame, path: str) -> None:
    """Stage dirty rows as raw CSV files, one file per (day, event type), rows in file
    order, under ``year=/month=/day=/event_type=`` directories."""
    day = F.to_date(F.substring_index(F.col("file_id"), "/", -1))
    staged = dirty.select(
        F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"),
        "event_type", "row_pos",
        "user_id", "session_id", F.col("ts_text").alias("timestamp"), "page_type",
        "time_on_page_seconds", "price", "product_id", "action", "x_position", "y_position",
    )
    keys = ["year", "month", "day", "event_type"]
    (
        staged.repartition(*keys)
        .sortWithinPartitions(*keys, "row_pos")
        .drop("row_pos")
        .write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .partitionBy(*keys)
        .csv(path)
    )


# FIXED VALUES: days of the month whose staged file differs from its type's layout.
EXTRA_COLUMN_DAY, REORDERED_DAY, MISSING_COLUMN_DAY = 2, 4, 5

TYPED_CSV_COLUMNS = {
    "page_view": ["user_id", "session_id", "page_type", "timestamp", "time_on_page_seconds"],
    "product_view": ["user_id", "session_id", "product_id", "price", "timestamp"],
    "cart_event": ["user_id", "session_id", "product_id", "action", "timestamp"],
    "click": ["user_id", "session_id", "timestamp", "x_position", "y_position"],
    "search": ["user_id", "session_id", "timestamp"],
}


def write_typed_csv(dirty: DataFrame, path: str) -> None:
    """Stage dirty rows as raw CSVs, each event type with its own columns: one file per (day,
    type). Page views of one day carry an unknown column, clicks of one day are reordered,
    product views of one day lack the price."""
    day = F.to_date(F.substring_index(F.col("file_id"), "/", -1))
    keys = ["year", "month", "day", "event_type"]
    staged = dirty.withColumn("timestamp", F.col("ts_text")).withColumn("locale", F.lit("es-CO")).select(
        "*", F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"))

    def write(rows: DataFrame, columns: list[str]) -> None:
        (
            rows.repartition(*keys).sortWithinPartitions(*keys, "row_pos").select(*columns, *keys)
            .write.mode("append").option("header", True)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .partitionBy(*keys).csv(path)
        )

    odd = {
        "page_view": (EXTRA_COLUMN_DAY, ["locale", *TYPED_CSV_COLUMNS["page_view"]]),
        "click": (REORDERED_DAY, TYPED_CSV_COLUMNS["click"][::-1]),
        "product_view": (MISSING_COLUMN_DAY, [c for c in TYPED_CSV_COLUMNS["product_view"] if c != "price"]),
    }
    for event_type, columns in TYPED_CSV_COLUMNS.items():
        rows = staged.where(F.col("event_type") == event_type)
        if event_type in odd:
            special, other = odd[event_type]
            write(rows.where(F.col("day") == special), other)
            rows = rows.where(F.col("day") != special)
        write(rows, columns)


def write_quoted_csv(dirty: DataFrame, path: str) -> None:
    """Stage cart events as raw CSVs with a first column of quoted notes: commas, doubled quotes,
    line breaks (also blank lines and lines that look like records), and in some rows 20,000
    quotes in one cell."""
    note = (
        F.when(F.col("event_id") % 211 == 0, F.repeat(F.lit('"'), 20_000))
        .when(F.col("event_id") % 3 == 0, F.lit('two\n\nlines, "quoted"\n1,2,3,4,5'))
        .when(F.col("event_id") % 3 == 1, F.lit('5" wide, 7" high'))
    )
    day = F.to_date(F.substring_index(F.col("file_id"), "/", -1))
    keys = ["year", "month", "day", "event_type"]
    rows = dirty.where("event_type = 'cart_event'").withColumn("timestamp", F.col("ts_text")).select(
        "*", note.alias("note"), F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"))
    (
        rows.repartition(*keys).sortWithinPartitions(*keys, "row_pos")
        .select("note", *TYPED_CSV_COLUMNS["cart_event"], *keys)
        .write.mode("append").option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .partitionBy(*keys).csv(path)
    )


def file_id_from_path(path: Column) -> Column:
    """``.../year=2024/month=1/day=3/event_type=click/...`` -> ``click/2024-01-03``."""
    m = r"year=(\d+)/month=(\d+)/day=(\d+)/"
    y = F.regexp_extract(path, m, 1).cast("int")
    mo = F.regexp_extract(path, m, 2).cast("int")
    d = F.regexp_extract(path, m, 3).cast("int")
    et = F.regexp_extract(path, r"event_type=([^/]+)/", 1)
    return F.concat(et, F.lit("/"), F.format_string("%04d-%02d-%02d", y, mo, d))
